"""Best-fit packing under conflicts: pieces of documents into bins of a fixed number of words.

Documents longer than a bin are cut into whole bins and a rest. Pieces are dealt to shards of bounded size
by hash; each shard is packed by one task, largest piece first. Open bins stay ordered by residual; the
search starts at the tightest bin that has room and goes on to its successors until one is compatible, else
a new bin opens. A bin carries bitmaps: one of the duplicate clusters in it (never two pieces of one
cluster) and one plane per allowed piece of a source (at most ``source_limit`` pieces of a source).

Null ids are kept as they are; a null source or cluster never conflicts. Rows without a word take no space
and come back with a null bin. Repeated rows are packed as often as they occur (they share a cluster, so
never a bin). Ties go by size, cluster, source, id. Empty tables give no rows; other columns are ignored.
"""

from bisect import bisect_left, insort
from math import ceil

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import common

#: Pieces in a shard, about.
SHARD_ROWS = 8192

PACKED = "doc_id long, piece int, start_word long, n_words long, shard int, bin int, place long"


def bits_of(values):
    """One bit per value; null has none."""
    seen = {}
    out = []
    for value in values:
        out.append(0 if value is None or value != value else 1 << seen.setdefault(value, len(seen)))
    return out


def best_fit(sizes, sources, clusters, capacity, source_limit):
    """(bin, place in the bin) of every piece, taken in the given order; size 0 gets (-1, 0)."""
    source_bits = bits_of(sources)
    repeated = pd.Series(clusters).duplicated(keep=False).tolist()
    cluster_bits = bits_of([c if twice else None for c, twice in zip(clusters, repeated)])
    order: list[tuple[int, int]] = []
    planes: list[list[int]] = []
    held: list[int] = []
    places = []
    for size, source, cluster in zip(sizes, source_bits, cluster_bits):
        if size <= 0:
            places.append((-1, 0))
            continue
        at = bisect_left(order, (size, -1))
        while at < len(order):
            no = order[at][1]
            if not (held[no] & cluster or planes[no][-1] & source):
                break
            at += 1
        if at < len(order):
            room, no = order.pop(at)
        else:
            room, no = capacity, len(planes)
            planes.append([0] * source_limit)
            held.append(0)
        places.append((no, capacity - room))
        held[no] |= cluster
        for i, plane in enumerate(planes[no]):
            if not plane & source:
                planes[no][i] |= source
                break
        if room > size:
            insort(order, (room - size, no))
    return places


def pieces_of(df: DataFrame, capacity: int) -> DataFrame:
    """One row per piece; columns doc_id, source, cluster, total -> plus piece, start_word, n_words."""
    last = F.greatest(F.ceil(F.col("total") / F.lit(capacity)).cast("long") - 1, F.lit(0))
    start = F.col("piece") * F.lit(capacity).cast("long")
    return df.select(
        "doc_id", "source", "cluster", "total", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece")
    ).select(
        "doc_id",
        "source",
        "cluster",
        F.col("piece").cast("int").alias("piece"),
        start.alias("start_word"),
        F.least(F.lit(capacity).cast("long"), F.col("total") - start).alias("n_words"),
    )


def pack(
    df: DataFrame,
    size,
    cluster,
    capacity: int = 2048,
    source_limit: int = 2,
    doc_id="doc_id",
    source="source",
) -> DataFrame:
    """doc_id, piece, start_word, n_words, bin_id, place. ``size`` and ``cluster`` are columns of ``df``."""
    rows = df.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        cluster.alias("cluster"),
        F.coalesce(size, F.lit(0)).cast("long").alias("total"),
    )
    # sizes are worked out once; shards are counted by pieces, so that long documents do not fill one
    rows = common.stored(rows, "packing-sizes")
    pieces = rows.agg(F.sum(F.greatest(F.ceil(F.col("total") / F.lit(capacity)), F.lit(1)))).first()[0]
    shards = max(1, ceil((pieces or 0) / SHARD_ROWS))
    shard = F.pmod(F.xxhash64("doc_id", "cluster", "piece"), F.lit(shards)).cast("int")

    def pack_shard(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(
            ["n_words", "cluster", "source", "doc_id", "piece"], ascending=[False, True, True, True, True]
        )
        places = best_fit(
            group["n_words"].tolist(),
            group["source"].tolist(),
            group["cluster"].tolist(),
            capacity,
            source_limit,
        )
        out = group[["doc_id", "piece", "start_word", "n_words", "shard"]].copy()
        out["bin"] = [b for b, _ in places]
        out["place"] = [p for _, p in places]
        return out

    packed = pieces_of(rows, capacity).withColumn("shard", shard).groupBy("shard").applyInPandas(pack_shard, PACKED)
    bin_id = F.when(F.col("bin") >= 0, F.col("shard").cast("long") * F.lit(2**32) + F.col("bin"))
    return packed.select("doc_id", "piece", "start_word", "n_words", bin_id.alias("bin_id"), "place")
