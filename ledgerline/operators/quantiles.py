"""Exact order statistics in two passes, without a per-group state that grows with the data."""

from functools import reduce

from pyspark.sql import functions as F

from ledgerline.operators.ranking import cumulative_before


def select_ranks(df, value, bucket, ranks, group_cols=(), few_groups=False, coarse=None):
    """The values at given zero-based ranks of each group, ascending, nulls left out.

    Pass one counts rows per bucket and finds the bucket of each wanted rank. Pass two reads only the
    rows of those buckets and counts them per value. ``bucket`` is a column that grows with ``value``;
    the values of a bucket meet in one task. So do the buckets of a group; where the value range makes them many,
    ``coarse`` (bucket column -> column) puts a level above them. ``ranks`` turns the group size column into an
    array of ranks. With ``few_groups`` the caller vouches that the groups
    are a short fixed list; then the wanted buckets, at most one per group and rank, are broadcast.

    Gives group_cols, pos (index in the array), rank, value and group_size.
    """
    group_cols = list(group_cols)
    hint = F.broadcast if few_groups or not group_cols else (lambda table: table)
    keys = [*group_cols, "_b"]
    rows = df.select(*group_cols, value.alias("_v"), bucket.alias("_b")).where("_v is not null")
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    levels = ["_b"]
    if coarse is not None:
        sizes, levels = sizes.withColumn("_c", coarse(F.col("_b"))), ["_c", "_b"]
    counts = with_group_size(cumulative_before(sizes, levels, ["n"], group_cols), sizes, group_cols)
    wanted = (
        counts.select("*", F.posexplode(ranks(F.col("group_size"))).alias("pos", "rank"))
        .where((F.col("rank") >= F.col("n_before")) & (F.col("rank") < F.col("n_before") + F.col("n")))
        .select(*keys, "pos", "rank", "group_size", F.col("n_before").alias("_start"))
    )
    inside = rows.join(hint(wanted.select(*keys).distinct()), keys, "left_semi")
    cells = cumulative_before(
        inside.groupBy(*keys, "_v").agg(F.count("*").alias("n")), ["_v"], ["n"], keys
    )
    offset = F.col("rank") - F.col("_start")
    return (
        cells.join(hint(wanted), keys)
        .where((offset >= F.col("n_before")) & (offset < F.col("n_before") + F.col("n")))
        .select(*group_cols, "pos", "rank", F.col("_v").alias("value"), "group_size")
    )


def with_group_size(counts, sizes, group_cols):
    """Add ``group_size``, the sum of ``n``: by partial sums, since a window would gather a group's buckets."""
    if not group_cols:
        return counts.withColumn("group_size", sizes.agg(F.sum("n")).scalar())
    totals = sizes.groupBy(*[F.col(c).alias(f"_of_{c}") for c in group_cols]).agg(F.sum("n").alias("group_size"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in group_cols])
    return counts.join(totals, same).drop(*[f"_of_{c}" for c in group_cols])


def exact_quantiles(df, value, bucket, probs, group_cols=(), few_groups=False, coarse=None):
    """Quantiles with linear interpolation: one row per group, one column ``q<i>`` per probability."""

    def place(size, p):
        return F.lit(float(p)) * (size - 1)

    def ranks(size):
        lows = [F.floor(place(size, p)).cast("long") for p in probs]
        highs = [F.ceil(place(size, p)).cast("long") for p in probs]
        return F.array(*lows, *highs)

    picked = select_ranks(df, value, bucket, ranks, group_cols, few_groups, coarse)
    n = len(probs)
    found = picked.groupBy(*group_cols).agg(
        F.max("group_size").alias("_size"),
        *[
            F.max(F.when(F.col("pos") == i, F.col("value").cast("double"))).alias(f"_v{i}")
            for i in range(2 * n)
        ],
    )

    def interpolated(i, p):
        low, high = F.col(f"_v{i}"), F.col(f"_v{n + i}")
        at = place(F.col("_size"), p)
        return low + (high - low) * (at - F.floor(at))

    return found.select(*group_cols, *[interpolated(i, p).alias(f"q{i}") for i, p in enumerate(probs)])


def money_bucket(c):
    """Whole hundreds: a bucket holds at most 10,000 distinct amounts."""
    return F.expr(f"bigint({c}) div 100")


def money_millions(bucket):
    """The level above: 10,000 hundreds, so amounts up to 10**10 have 10,000 of them."""
    return F.floor(bucket / 10000)


def money_quantiles(df, c, probs, group_cols=(), approx=False):
    """Quantiles of an amount column; ``approx`` trades exactness for a single pass."""
    if approx:
        group = df.groupBy(*group_cols)
        values = [
            F.percentile_approx(F.col(c).cast("double"), float(p), 10000).alias(f"q{i}")
            for i, p in enumerate(probs)
        ]
        return group.agg(*values)
    return exact_quantiles(df, F.col(c), money_bucket(c), probs, group_cols, coarse=money_millions)
