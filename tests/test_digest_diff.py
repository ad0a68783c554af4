"""Snapshot comparison by digests equals the full comparison and opens only what differs."""

import glob
import random

import pytest

from ledgerline.plans import digest_diff, followup

SCHEMA = "id string, a int, b string, ingested_date string"


def test_equals_the_full_diff(spark, tmp_path):
    rng = random.Random(5)
    old = [(f"k{i % 180}", rng.randrange(3), rng.choice(["x", None]), "d1") for i in range(200)] + [(None, 1, "n", "d1")]
    new = [r[:3] + ("d2",) for r in old if r[0] != "k3"]
    new[10] = (*new[10][:2], "other", "d2")
    new += [("fresh", 1, "x", "d2"), ("k50", 9, "twice", "d2"), (None, 2, "n", "d2")]
    before, after = (spark.createDataFrame(rows, SCHEMA) for rows in (old, new))
    for name, df in (("before", before), ("after", after)):
        digest_diff.store_digests(df, "id", f"{tmp_path}/{name}", buckets=16, group=4)
    paths = f"{tmp_path}/before", f"{tmp_path}/after"
    found = sorted(map(tuple, digest_diff.digest_diff(spark, *paths, "id").collect()), key=str)
    full = followup.snapshot_diff(before, after, "id")
    assert found == sorted(map(tuple, full.where("change <> 'UNCHANGED'").collect()), key=str)
    counts = {r.change: r.rows for r in digest_diff.digest_changes(spark, *paths, "id").collect()}
    assert counts == {r.change: r["count"] for r in full.groupBy("change").count().collect()}


def test_one_changed_row_opens_one_bucket(spark, tmp_path):
    old = [(f"k{i}", i, "x", "d") for i in range(500)]
    new = [(k, a + (k == "k77"), b, d) for k, a, b, d in old]
    for name, rows in (("before", old), ("after", new), ("same", old)):
        digest_diff.store_digests(spark.createDataFrame(rows, SCHEMA), "id", f"{tmp_path}/{name}", buckets=64, group=8)
    before, after, same = (f"{tmp_path}/{n}" for n in ("before", "after", "same"))
    (opened,) = digest_diff.opened_buckets(spark, before, after)
    for path in glob.glob(f"{before}/keys/bucket=*/*.parquet") + glob.glob(f"{after}/keys/bucket=*/*.parquet"):
        if f"bucket={opened}/" not in path:
            with open(path, "wb") as file:
                file.write(b"whoever opens this fails")
    assert [tuple(r) for r in digest_diff.digest_diff(spark, before, after, "id").collect()] == [("k77", "CHANGED")]
    assert digest_diff.opened_buckets(spark, before, same) == []


def test_other_bucket_numbers_are_refused(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, "x", "d")], SCHEMA)
    digest_diff.store_digests(df, "id", f"{tmp_path}/a", buckets=8)
    digest_diff.store_digests(df, "id", f"{tmp_path}/b", buckets=16)
    digest_diff.store_digests(df.limit(0), "id", f"{tmp_path}/c", buckets=8)
    with pytest.raises(ValueError):
        digest_diff.digest_diff(spark, f"{tmp_path}/a", f"{tmp_path}/b", "id")
    found = digest_diff.digest_diff(spark, f"{tmp_path}/c", f"{tmp_path}/a", "id").collect()
    assert [tuple(r) for r in found] == [("a", "ADDED")]
    counts = digest_diff.digest_changes(spark, f"{tmp_path}/c", f"{tmp_path}/c", "id")
    assert counts.count() == 0


def test_keys_are_stored_after_one_shuffle_as_short_rows(spark, tmp_path):
    rows = [(f"k{i}", i, "x", "d") for i in range(2000)] + [(None, 1, "n", "d")] + [("hot", i, "h", "d") for i in range(500)]
    shuffle = spark.conf.get("spark.sql.shuffle.partitions")
    digest_diff.store_digests(spark.createDataFrame(rows, SCHEMA).repartition(6), "id", f"{tmp_path}/a", buckets=16, group=4)
    assert spark.conf.get("spark.sql.shuffle.partitions") == shuffle
    keys = digest_diff.read_keys(spark, f"{tmp_path}/a")
    assert [t for _, t in keys.dtypes] == ["string", "bigint", "bigint", "int"]
    assert keys.count() == keys.distinct().count() == 2002
    per_bucket = -(-max(int(shuffle), 1) // 16)
    for bucket in glob.glob(f"{tmp_path}/a/keys/bucket=*"):
        assert len(glob.glob(f"{bucket}/*.parquet")) <= per_bucket
