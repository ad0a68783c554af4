"""Snapshot comparison by stored digests: what is equal on both sides is not opened.

When a snapshot lands, ``store_digests`` keeps one row per key (two digests of how many rows it has and of the sums of their hashes), dealt
to buckets by the key's hash, and above them one digest per bucket and one per group of buckets. Two snapshots are compared from the top: only groups
that differ have their buckets compared, only buckets that differ have their keys read and joined. With few changes the work
follows the changes, not the tables. Buckets hold distinct keys, so a key with many rows makes no bucket large.

A null key is a key like any other; rows that share a key are one entry. The lists that pass the driver are group and
bucket numbers, as many as were asked for. Snapshots must be stored with the same numbers of buckets.
"""

from contextlib import contextmanager
from math import ceil

from pyspark.sql import functions as F

BUCKETS, GROUP = 1024, 32


def summed(*columns):
    """Two order-free digests of rows; decimals, because sums of 64-bit hashes overflow."""
    return [F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)")).alias(f"h{seed}") for seed in (1, 2)]


def halves(*columns):
    """The sums of ``summed`` as sums of 32-bit halves: whole numbers of 8 bytes, for up to two thousand million rows a key."""
    low, out = F.lit(0xFFFFFFFF), []
    for seed in (1, 2):
        h = F.xxhash64(F.lit(seed), *columns)
        out += [F.sum(h.bitwiseAND(low)).alias(f"low{seed}"), F.sum(F.shiftrightunsigned(h, 32)).alias(f"high{seed}")]
    return out


@contextmanager
def groups_dealt(spark, buckets):
    """Groups go to a multiple of ``buckets`` tasks. ``hash`` is also what Spark deals groups by, so a bucket's keys then come to
    few tasks and need no second shuffle to lie in few files; under other settings there are only more files."""
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    spark.conf.set(setting, buckets * ceil(int(before) / buckets))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def store_digests(df, key, path, buckets=BUCKETS, group=GROUP):
    """Write the digests of a snapshot to ``path``: keys by bucket, buckets, groups."""
    spark = df.sparkSession
    columns = [c for c in sorted(df.columns) if c not in (key, "ingested_date")]
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]))
    of_keys = df.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n"), *halves(row))
    # the rows of a key as two numbers: they are shuffled twice more
    entry = [F.xxhash64(F.lit(seed), "n", "low1", "high1", "low2", "high2").alias(f"h{seed}") for seed in (1, 2)]
    dealt = of_keys.select("key", *entry).withColumn("bucket", F.pmod(F.hash("key"), F.lit(buckets)).cast("int"))
    with groups_dealt(spark, buckets):
        dealt.write.partitionBy("bucket").parquet(f"{path}/keys")
    keys = spark.read.schema(dealt.schema).parquet(f"{path}/keys")
    leaves = keys.groupBy("bucket").agg(F.count("*").alias("keys"), *summed("key", "h1", "h2"))
    leaves = leaves.withColumns({"part": F.floor(F.col("bucket") / group).cast("int"), "buckets": F.lit(buckets)})
    leaves.coalesce(1 + buckets // 100_000).write.parquet(f"{path}/buckets")
    stored = spark.read.parquet(f"{path}/buckets")
    tops = stored.groupBy("part").agg(F.sum("keys").alias("keys"), *summed("bucket", "keys", "h1", "h2"))
    shape = {"buckets": F.lit(buckets), "per_group": F.lit(group)}
    no_key = F.lit(None).cast(df.schema[key].dataType).alias("key")  # tells the key's type, also of an empty snapshot
    tops.withColumns(shape).select("*", no_key).coalesce(1).write.parquet(f"{path}/groups")


def read_keys(spark, path):
    key = spark.read.parquet(f"{path}/groups").schema["key"]
    kinds = "h1 long, h2 long, bucket int"
    return spark.read.schema(f"key {key.dataType.simpleString()}, {kinds}").parquet(f"{path}/keys")


def unequal(before, after, number):
    """Numbers whose digests differ or that one side lacks."""
    sides = [
        df.select(F.col(number).alias(f"_{i}"), F.struct("keys", "h1", "h2").alias(f"_d{i}"))
        for i, df in enumerate((before, after))
    ]
    both = sides[0].join(sides[1], F.col("_0") == F.col("_1"), "full")
    differ = both.where(~F.col("_d0").eqNullSafe(F.col("_d1")))
    return sorted(row[0] for row in differ.select(F.coalesce("_0", "_1")).collect())


def opened_buckets(spark, before, after):
    """Buckets that have to be read to tell the two stored snapshots apart."""
    groups = [spark.read.parquet(f"{path}/groups") for path in (before, after)]
    shapes = {tuple(r) for df in groups for r in df.select("buckets", "per_group").distinct().collect()}
    if len(shapes) > 1:
        raise ValueError(f"snapshots stored with different numbers of buckets: {sorted(shapes)}")
    parts = unequal(*groups, "part")
    leaves = [spark.read.parquet(f"{path}/buckets").where(F.col("part").isin(parts)) for path in (before, after)]
    return unequal(*leaves, "bucket") if parts else []


def digest_diff(spark, before, after, key, opened=None):
    """Keys added, removed or changed between two stored snapshots."""
    opened = opened_buckets(spark, before, after) if opened is None else opened
    sides = [
        read_keys(spark, path)
        .where(F.col("bucket").isin(opened))
        .select(F.col("key").alias(f"_key{i}"), F.struct("h1", "h2").alias(f"_d{i}"))
        for i, path in enumerate((before, after))
    ]
    joined = sides[0].join(sides[1], F.col("_key0").eqNullSafe(F.col("_key1")), "full")
    change = F.when(F.col("_d0").isNull(), "ADDED").when(F.col("_d1").isNull(), "REMOVED").otherwise("CHANGED")
    differ = joined.where(~F.col("_d0").eqNullSafe(F.col("_d1")))
    return differ.select(F.coalesce("_key0", "_key1").alias(key), change.alias("change"))


def digest_changes(spark, before, after, key):
    """How many keys changed in which way; the unchanged ones from the digests alone."""
    found = digest_diff(spark, before, after, key).groupBy("change").agg(F.count("*").alias("rows"))
    total = spark.read.parquet(f"{before}/groups").agg(F.sum("keys").alias("rows"))
    gone = found.where("change <> 'ADDED'").select((-F.col("rows")).alias("rows"))
    same = total.unionByName(gone).agg(F.lit("UNCHANGED").alias("change"), F.sum("rows").alias("rows"))
    return found.unionByName(same).where("rows > 0")
