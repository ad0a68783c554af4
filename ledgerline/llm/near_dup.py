"""Near-duplicate documents by bottom-k sketches and exact Jaccard, without a list of all pairs.

A document is its set of distinct word shingles, hashed by one function. Link: Jaccard of at least ``PERCENT``.

1. One pass gives every document its set size, a 128-bit fingerprint of the whole set and the ``SKETCH`` smallest hashes.
   Equal fingerprints are one class at once; only a class's smallest id goes on.
2. Two linked sets share at least ``needed(n)`` retained values. A document of which fewer retained
   values occur in any other set is alone.
3. The others' sets are built in full. Their retained values are now the first ``n - ceil(0.8 n) + 1`` in the
   order (number of these documents that hold the value, hash): linked sets share one of them for certain. They
   form the inverted lists. Values that stand in too late a place for the overlap that a link needs are no candidates
   (positions bound the overlap), so lists of a passage that many documents share give no pairs.
4. Per list each row is paired with its predecessor and with the first row. Candidates pass the estimate from the
   union sketch (the smallest hashes of both sketches), then exact Jaccard on the whole sets. Links are joined to components.
5. What is left are lists with rows of several components: every pair across components that the positions allow
   is estimated and verified too. So no link between components is missed, and none inside one is needed.

Null or empty texts are linked with nothing. Rows with a null id take no part. Of rows that share an id the one with the
largest set counts (ties: larger fingerprint). An empty table gives no rows; other columns are ignored.
The step 2 bound holds for certain up to 1.25 * n <= SKETCH, else with a probability above 1 - 1e-7 at the threshold.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import bound_batches, discard, stored
from ledgerline.llm.components import components
from ledgerline.llm.hashing import run_hashes
from ledgerline.session import use_checkpoint_dir

PERCENT = 80
SKETCH = 64
#: Retained values that two linked sets larger than the sketch share at least (six deviations below the mean).
SHARED = 32
#: The estimate from the union sketch may be this much below the threshold.
MARGIN = 30
#: Rows of a list that meet in one window or one block of the join.
LIST_ROWS = 1024


def needed(n: Column) -> Column:
    """Values of its sketch that a set of size n shares with any linked set."""
    own = F.ceil(n * PERCENT / 100)
    return F.when(n * 100 <= SKETCH * PERCENT, own).otherwise(F.lit(SHARED)).cast("long")


def least_overlap(a: Column, b: Column) -> Column:
    """Smallest intersection of linked sets with these sizes."""
    return F.ceil((a + b) * PERCENT / (100 + PERCENT)).cast("long")


def signed_sets(docs: DataFrame, k: int, whole: bool) -> DataFrame:
    """doc_id, n, f1, f2 (fingerprint of the set), and the set's values: all of them, or the smallest ones."""
    keep = None if whole else SKETCH

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            grams = [np.unique(runs) for runs in run_hashes(batch["text"], k)]
            prints = [np.frombuffer(xxhash.xxh3_128_digest(g.tobytes()), dtype=np.int64) for g in grams]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "n": [len(g) for g in grams],
                    "f1": [f[0] for f in prints],
                    "f2": [f[1] for f in prints],
                    "grams": [g[:keep] for g in grams],
                }
            )

    return docs.mapInPandas(run, "doc_id long, n long, f1 long, f2 long, grams array<long>")


def has_repeats(signed: DataFrame) -> bool:
    totals = signed.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("doc_id").alias("ids")).first()
    return totals["rows"] != totals["ids"]


def once_per_id(signed: DataFrame) -> DataFrame:
    order = Window.partitionBy("doc_id").orderBy(F.desc("n"), F.desc("f1"), F.desc("f2"))
    return signed.withColumn("at", F.row_number().over(order)).where("at = 1").drop("at")


def candidates(signed: DataFrame) -> DataFrame:
    """Ids of class representatives that share enough retained values with other sets."""
    held = signed.where("n > 0").select("doc_id", "f1", F.explode("grams").alias("v"))
    shared = held.groupBy("v").agg(F.min("f1").alias("low"), F.max("f1").alias("high")).where("low <> high")
    hits = held.select("doc_id", "v").join(shared.select("v"), "v").groupBy("doc_id").agg(F.count(F.lit(1)).alias("hits"))
    classes = signed.where("n > 0").groupBy("f1", "f2").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"))
    return hits.join(classes.select("doc_id", "n"), "doc_id").where(F.col("hits") >= needed(F.col("n"))).select("doc_id")


def inverted_lists(sets: DataFrame) -> DataFrame:
    """v, df, doc_id, n, left: the retained values in rare-first order; ``left`` of the set's values stand here or later."""
    held = sets.select("doc_id", "n", F.explode("grams").alias("v"))
    shared = held.groupBy("v").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    hits = held.join(shared, "v")
    whole = Window.partitionBy("doc_id")
    # values that only one set holds come first in the order
    place = F.col("n") - F.count(F.lit(1)).over(whole) + F.row_number().over(whole.orderBy("df", "v"))
    prefix = F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1
    return (
        hits.withColumn("place", place)
        .where(F.col("place") <= prefix)
        .select("v", "df", "doc_id", "n", (F.col("n") - F.col("place") + 1).alias("left"))
    )


def positions_allow(x, y) -> Column:
    return F.least(x["left"], y["left"]) >= least_overlap(x["n"], y["n"])


def first_pairs(lists: DataFrame) -> DataFrame:
    """a < b: each row of a list with its predecessor and with the first row, if positions allow."""
    part = F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("df") / LIST_ROWS).cast("long"))
    w = Window.partitionBy("v", "part").orderBy(F.desc(F.col("left") / F.col("n")), "doc_id")
    row = F.struct("doc_id", "n", "left")
    with_both = lists.withColumn("part", part).select(
        row.alias("x"), F.array(F.lag(row).over(w), F.first(row).over(w)).alias("partners")
    )
    with_both = with_both.select("x", F.explode("partners").alias("y"))
    pairs = with_both.where(F.col("y").isNotNull() & (F.col("x.doc_id") != F.col("y.doc_id")) & positions_allow(F.col("x"), F.col("y")))
    return ordered(pairs.select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b")))


def ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def cross_pairs(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs across components within the lists that hold more than one, if positions allow.

    Long lists are cut into blocks; each pair of blocks is a join key of its own.
    """
    known = lists.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn(
        "component", F.coalesce("component", "doc_id")
    )
    open_lists = (
        known.groupBy("v")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("rows"))
        .where("low <> high")
        .select("v", F.ceil(F.col("rows") / LIST_ROWS).cast("int").alias("blocks"))
    )
    rows = known.join(open_lists, "v").withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        "v", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "doc_id", "n", "left", "component"
    )
    x, y = rows.alias("x"), rows.alias("y")
    same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("v", "lo", "hi")]
    left = F.struct(F.col("x.n"), F.col("x.left"))
    right = F.struct(F.col("y.n"), F.col("y.left"))
    met = x.join(
        y,
        same[0] & same[1] & same[2]
        & (F.col("x.doc_id") < F.col("y.doc_id"))
        & (F.col("x.component") != F.col("y.component"))
        & ((F.col("x.own") != F.col("y.own")) | (F.col("x.lo") == F.col("x.hi")))
        & positions_allow(left, right),
    )
    return ordered(met.select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b")))


def verified(pairs: DataFrame, signed: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs that pass the union-sketch estimate and then exact Jaccard on whole sets."""
    low = signed.select("doc_id", F.col("grams").alias("sketch"))
    near = pairs.join(low.select(F.col("doc_id").alias("a"), F.col("sketch").alias("sa")), "a")
    near = near.join(low.select(F.col("doc_id").alias("b"), F.col("sketch").alias("sb")), "b")
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, SKETCH)
    near = near.withColumn("u", union)
    both = F.size(F.array_intersect(F.array_intersect("sa", "sb"), "u"))
    near = near.where(both * 100 >= (PERCENT - MARGIN) * F.size("u")).select("a", "b")
    near = near.join(sets.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("grams").alias("ga")), "a")
    near = near.join(sets.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("grams").alias("gb")), "b")
    near = near.withColumn("i", F.size(F.array_intersect("ga", "gb")).cast("long"))
    return near.where(F.col("i") * 100 >= PERCENT * (F.col("na") + F.col("nb") - F.col("i"))).select("a", "b")


def near_duplicates(df: DataFrame, k: int = 4, doc_id="doc_id", text="text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable), kept (the id is the component's)."""
    bound_batches(df.sparkSession)
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("doc_id is not null")
    use_checkpoint_dir(df.sparkSession)
    signed = stored(signed_sets(docs, k, whole=False), "sketches")
    repeats = has_repeats(signed)  # only then are ids brought together
    signed = once_per_id(signed) if repeats else signed
    sets = signed_sets(docs.join(candidates(signed), "doc_id", "left_semi"), k, whole=True)
    sets = stored(once_per_id(sets) if repeats else sets, "sets")
    lists = stored(inverted_lists(sets), "lists")
    links = stored(verified(first_pairs(lists), signed, sets), "links")
    labels = stored(components(links), "labels")
    more = stored(verified(cross_pairs(lists, labels), signed, sets), "more-links")
    if more.limit(1).count():
        stars = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
        labels = stored(components(stars.unionByName(more)), "labels")
    discard(sets, lists, links, more)
    slim = signed.select("doc_id", "n", "f1", "f2")
    classes = slim.where("n > 0").groupBy("f1", "f2").agg(F.min("doc_id").alias("least"))
    named = classes.join(labels, F.col("least") == F.col("node"), "left").select(
        F.col("f1").alias("g1"), F.col("f2").alias("g2"), F.coalesce("component", "least").alias("of_class")
    )
    # empty sets have equal fingerprints but no class
    out = slim.join(named, (F.col("f1") == F.col("g1")) & (F.col("f2") == F.col("g2")) & (F.col("n") > 0), "left")
    component = F.coalesce("of_class", "doc_id")
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        (F.col("doc_id") == component).alias("kept"),
    )
