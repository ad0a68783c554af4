"""Queries of this folder against their SQL, and the pipeline against brute force."""

import os

import check_oracle
import duckdb
import pytest
from helpers import awkward
from test_near_dup import brute

import corpus_pipeline
from ledgerline.llm.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE_SQL) <= set(QUERIES)


@needs_tables
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_agrees_with_sql(spark, name):
    db = duckdb.connect()
    for table in check_oracle.TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = QUERIES[name](spark, FOLDER)
    rows = [tuple(row) for row in df.collect()]
    cursor = db.execute(ORACLE_SQL[name])
    assert check_oracle.compare(df.columns, rows, [c[0] for c in cursor.description], cursor.fetchall()) is None


@pytest.fixture(scope="module")
def corpus(spark):
    """Clean texts, near copies, a shared passage, and the awkward rows."""
    from helpers import docs, words

    passage = words("passage", 70)
    rows = [(100 + i, " ".join(words(i, 150)), "en", f"s{i % 3}") for i in range(40)]
    rows += [(200 + i, rows[i][1] + " end", "en", "s1") for i in range(5)]
    rows += [(300 + i, " ".join(words(("x", i), 60) + passage + words(("y", i), 60)), "en", "s2") for i in range(4)]
    rows += [(400, rows[20][1] + " one more", "en", "s0"), (400, "a shorter text"), (401, "only here"), (401, "only here")]
    return awkward(spark).unionByName(docs(spark, rows))


def test_stages(spark, corpus, tmp_path):
    names = [n for n, _ in corpus_pipeline.STAGES]
    stage = dict(corpus_pipeline.STAGES)
    assert names == ["language_id", "near_dup", "substring_dedup", "source_mix", "packing"]
    seen = corpus
    after = {}
    for name in names:
        out = stage[name](spark, seen, "")
        if name != "packing":
            assert out.columns == corpus.columns
        out.write.parquet(str(tmp_path / name))
        seen = spark.read.parquet(str(tmp_path / name))
        after[name] = seen.collect()
    ids = {name: {r["doc_id"] for r in rows} for name, rows in after.items()}
    assert ids["language_id"] == {r["doc_id"] for r in corpus.collect()} - {3, 4, 5}
    in_order = sorted(after["language_id"], key=lambda r: len(r["text"]))  # of one id the longest text counts
    groups = brute([(r["doc_id"], r["text"]) for r in in_order], k=5)
    assert ids["near_dup"] == {i for i, (_, c) in groups.items() if i == c} | {None}
    assert sum(r["doc_id"] == 401 for r in after["near_dup"]) == 1 and 400 not in ids["near_dup"]
    texts = {r["doc_id"]: r["text"] for r in after["substring_dedup"]}
    before = {r["doc_id"]: r["text"] for r in after["near_dup"]}
    assert texts[300] == before[300]
    assert all(len(texts[i].split()) <= 122 for i in (301, 302, 303))
    assert all(texts[i] == before[i] for i in before if i is None or i < 300)
    assert ids["source_mix"] == ids["substring_dedup"]
    counts = [sum(r["doc_id"] == i for r in after["source_mix"]) for i in ids["source_mix"]]
    assert max(counts) <= 2
    whole = sum(len((r["text"] or "").split()) for r in after["source_mix"])
    assert sum(r["n_words"] for r in after["packing"]) == whole


def test_empty_pipeline(spark, corpus):
    seen = corpus.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        seen = stage(spark, seen, "")
        assert seen.count() == 0


@needs_tables
def test_pipeline_over_the_tables(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.where("bin_id is null").count() == 0
    bins = out.groupBy("bin_id").sum("n_words").collect()
    assert max(r["sum(n_words)"] for r in bins) <= corpus_pipeline.CAPACITY
