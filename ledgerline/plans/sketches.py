"""Mergeable sketches per landing or calendar day: distinct counts and quantiles of any span without reading its rows again.

``day_sketches`` keeps one row per (day, group): the number of rows, a HyperLogLog sketch of each distinct-counted column and a KLL
sketch of each measured one, all by Spark's own aggregates. States of a span are merged by ``over_span``; a day that is
landed again just has its row replaced. A state's size depends on its precision, not on the rows behind it.

Nulls take no part in a sketch; a group without values estimates 0 distinct ones and null quantiles. Bounds: the
distinct estimate is within 3 x 1.04 / sqrt(2 ** HLL_BITS) of the exact count (3 standard errors); a quantile's rank is
within KLL_RANK of the wanted one.
"""

from math import sqrt

from pyspark.sql import functions as F

HLL_BITS, KLL_K = 12, 400
DISTINCT_ERROR = 3 * 1.04 / sqrt(1 << HLL_BITS)
#: About twice the documented normalised rank error (99 %) of a sketch of this size.
KLL_RANK = 0.02


def day_sketches(df, day, group, distinct=(), measured=()):
    """One state per day and group: rows, ``<column>_hll`` and ``<column>_kll``."""
    return df.groupBy(F.col(day).alias("day"), *group).agg(
        F.count("*").alias("rows"),
        *[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(HLL_BITS)).alias(f"{c}_hll") for c in distinct],
        *[F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(KLL_K)).alias(f"{c}_kll") for c in measured],
    )


def over_span(states, group, first=None, last=None, probs=(0.5, 0.9)):
    """Merged states of the days from ``first`` to ``last``: rows, ``<column>_distinct`` and ``<column>_quantiles``."""
    kept = states
    if first is not None:
        kept = kept.where(F.col("day") >= F.lit(first))
    if last is not None:
        kept = kept.where(F.col("day") <= F.lit(last))
    distinct = [c.removesuffix("_hll") for c in states.columns if c.endswith("_hll")]
    measured = [c.removesuffix("_kll") for c in states.columns if c.endswith("_kll")]
    merged = kept.groupBy(*group).agg(
        F.sum("rows").alias("rows"),
        *[F.hll_union_agg(f"{c}_hll").alias(f"{c}_hll") for c in distinct],
        *[F.kll_merge_agg_double(f"{c}_kll").alias(f"{c}_kll") for c in measured],
    )

    def quantiles(c):
        sketch = F.col(f"{c}_kll")
        found = F.array(*[F.kll_sketch_get_quantile_double(sketch, F.lit(float(p))) for p in probs])
        return F.when(F.kll_sketch_get_n_double(sketch) > 0, found)

    return merged.select(
        *group,
        "rows",
        *[F.hll_sketch_estimate(f"{c}_hll").alias(f"{c}_distinct") for c in distinct],
        *[quantiles(c).alias(f"{c}_quantiles") for c in measured],
    )


def checked(rows, estimates, group, distinct, measured, probs=(0.5, 0.9)):
    """The estimates beside exact values from the rows: whether each lies within its stated bound.

    A quantile is right if the shares of values below it and up to it enclose the wanted share, give or take KLL_RANK.
    """
    marked = estimates.select(*group, *[F.col(c).alias(f"_{c}") for c in estimates.columns if c not in group])
    joined = rows.join(marked, group)
    exact = joined.groupBy(*group).agg(
        F.count("*").alias("rows"),
        F.count_distinct(distinct).alias("exact_distinct"),
        F.max(f"_{distinct}_distinct").alias("estimate"),
        F.max("_rows").alias("_rows"),
        F.count(measured).alias("_n"),
        *[
            F.count_if(test(F.col(measured).cast("double"), F.col(f"_{measured}_quantiles")[i])).alias(f"_{name}{i}")
            for i in range(len(probs))
            for name, test in (("below", lambda v, q: v < q), ("upto", lambda v, q: v <= q))
        ],
    )
    near = [
        (F.col(f"_below{i}") <= (p + KLL_RANK) * F.col("_n")) & (F.col(f"_upto{i}") >= (p - KLL_RANK) * F.col("_n"))
        for i, p in enumerate(probs)
    ]
    error = F.abs(F.col("estimate") - F.col("exact_distinct"))
    right = near[0]
    for test in near[1:]:
        right = right & test
    return exact.select(
        *group,
        "rows",
        (F.col("_rows") == F.col("rows")).alias("rows_agree"),
        "exact_distinct",
        (error <= F.greatest(F.lit(1.0), F.col("exact_distinct") * DISTINCT_ERROR)).alias("distinct_within_bound"),
        right.alias("quantiles_within_bound"),
    )
