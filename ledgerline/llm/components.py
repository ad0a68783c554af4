"""Connected components of a link table by alternating stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fingerprint(edges: DataFrame):
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]


def components(links: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) for every node of ``links`` (columns a, b; loops are ignored).

    Each round hangs every neighbour of a node that is larger than it on the smallest one, then does the same from below; the
    number of rows never grows, and the rounds grow with the logarithm of the longest path. Every round is cut off by a
    checkpoint in the shared folder. A hub's rows are split by the adaptive join.
    """
    edges = (
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().checkpoint()
    )
    before = fingerprint(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.join(least, F.col("a") == F.col("u")).where("b > a").select(F.col("b").alias("x"), F.col("m").alias("y"))
        large = large.distinct()
        low = large.groupBy("x").agg(F.min("y").alias("m"))
        down = large.join(low.withColumnRenamed("x", "u"), F.col("x") == F.col("u")).where("y <> m")
        small = down.select(F.col("y").alias("a"), F.col("m").alias("b"))
        edges = small.unionByName(low.select(F.col("x").alias("a"), F.col("m").alias("b"))).distinct().checkpoint()
        now = fingerprint(edges)
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = now
