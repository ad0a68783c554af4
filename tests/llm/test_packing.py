import random
from collections import defaultdict

import pytest
from helpers import awkward, docs, text
from pyspark.sql import functions as F

from ledgerline.llm import common, packing


def plain_best_fit(sizes, sources, clusters, capacity, limit):
    """Looks at every bin: the tightest compatible one, ties to the older."""
    bins, places = [], []
    for size, source, cluster in zip(sizes, sources, clusters):
        if size <= 0:
            places.append((-1, 0))
            continue
        fits = [
            (capacity - used, no)
            for no, (used, srcs, clus) in enumerate(bins)
            if capacity - used >= size
            and (source is None or srcs.count(source) < limit)
            and (cluster is None or cluster not in clus)
        ]
        no = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append([0, [], []])
        places.append((no, bins[no][0]))
        bins[no][0] += size
        bins[no][1].append(source)
        bins[no][2].append(cluster)
    return places


@pytest.mark.parametrize("seed", range(8))
def test_best_fit_equals_a_look_at_every_bin(seed):
    rng = random.Random(seed)
    n = 300
    sizes = sorted((rng.randint(0, 60) for _ in range(n)), reverse=True)
    sources = [rng.choice(["a", "a", "a", "b", "c", None]) for _ in range(n)]
    clusters = [rng.choice([*range(150), None]) for _ in range(n)]
    limit = 1 + seed % 3
    assert packing.best_fit(sizes, sources, clusters, 64, limit) == plain_best_fit(sizes, sources, clusters, 64, limit)


def packed(df, **kw):
    return packing.pack(df, common.n_words(F.col("text")), common.digest_of_words(F.col("text")), **kw).collect()


def test_pieces_cover_documents_and_bins_hold_what_they_may(spark):
    rows = [(i, text(i, 5 + 37 * i % 300), "en", f"s{i % 3 if i % 2 else 0}") for i in range(120)]
    rows += [(200 + i, rows[0][1], "en", "s9") for i in range(5)]
    out = packed(docs(spark, rows), capacity=100, source_limit=2)
    source = {r[0]: r[3] for r in rows}
    length = {r[0]: len(r[1].split()) for r in rows}
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in out:
        pieces[r["doc_id"]].append(r)
        bins[r["bin_id"]].append(r)
    for doc, parts in pieces.items():
        at = 0
        for p in sorted(parts, key=lambda p: p["piece"]):
            assert p["start_word"] == at
            at += p["n_words"]
        assert at == length[doc]
    assert set(pieces) == set(length)
    for held in bins.values():
        end = 0
        for p in sorted(held, key=lambda p: p["place"]):
            assert p["place"] == end
            end += p["n_words"]
        assert end <= 100
        sources = [source[p["doc_id"]] for p in held]
        assert max(map(sources.count, sources)) <= 2
        assert sum(p["doc_id"] >= 200 or p["doc_id"] == 0 for p in held) <= 1


def test_awkward_rows(spark):
    df = awkward(spark)
    out = packed(df, capacity=2048)
    whole = [r for r in out if r["bin_id"] is not None]
    assert sum(r["n_words"] for r in whole) == df.agg(F.sum(common.n_words(F.col("text")))).first()[0]
    assert {r["doc_id"] for r in out if r["bin_id"] is None} == {3, 4, 5}
    assert len({r["bin_id"] for r in whole if r["doc_id"] in (1, 2, None)}) == 4
    assert packed(df.limit(0)) == []


def test_shards_are_counted_by_pieces(spark, monkeypatch):
    from pyspark.sql import functions as F

    from ledgerline.llm import packing

    monkeypatch.setattr(packing, "SHARD_ROWS", 100)
    docs = spark.createDataFrame([(i, f"s{i % 3}", 3000 + i) for i in range(20)], "doc_id long, source string, size long")
    packed = packing.pack(docs, F.col("size"), F.col("doc_id"), capacity=16).collect()
    shards = {}
    for r in packed:
        shards.setdefault(r.bin_id >> 32, []).append(r)
    pieces = sum(-(-(3000 + i) // 16) for i in range(20))
    assert len(packed) == pieces and len(shards) > pieces // 150
    assert max(map(len, shards.values())) < 200
    assert sum(r.n_words for r in packed) == sum(3000 + i for i in range(20))
