"""Running counts over an order too large for one task.

A plain window without partition keys sends every row to one task. Here the rows are first grouped to
cells, the cells are ordered by levels from coarse to fine, and each level's running sum is a window
inside the level above. Only the coarsest totals meet in one task: the caller picks levels whose coarsest
has few values.
"""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F


def cumulative_before(cells, levels, measures, group_cols=()):
    """Add ``<measure>_before``: the sum over all cells of the group that come earlier in the order.

    ``cells`` holds one row per (group_cols, levels). ``levels`` are column names, coarse to fine;
    each coarse one must grow with the fine ones, like a bucket number with its value.

    The start of each coarse cell reaches the finer ones as an extra row at the head of their window.
    A join would do the same, but it adds null filters to one side only, and the cells would then be
    computed once per level instead of being reused.
    """
    before = [f"{m}_before" for m in measures]
    placed = None
    for i, level in enumerate(levels):
        above = [*group_cols, *levels[:i]]
        finest = i == len(levels) - 1
        sums = [F.sum(m).alias(m) for m in measures]
        totals = cells if finest else cells.groupBy(*above, level).agg(*sums)
        totals = totals.withColumn("_head", F.lit(0))
        if placed is not None:
            heads = placed.select(*above, *before, F.lit(1).alias("_head"))
            totals = totals.unionByName(heads, allowMissingColumns=True)
        order = Window.partitionBy(*above).orderBy(F.col("_head").desc(), F.col(level))
        earlier = order.rowsBetween(Window.unboundedPreceding, -1)
        so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        running = {}
        for m, b in zip(measures, before):
            start = F.lit(0) if placed is None else F.max(b).over(so_far)
            running[b] = start + F.coalesce(F.sum(m).over(earlier), F.lit(0))
        placed = totals.withColumns(running).where("_head = 0").drop("_head")
    return placed


def rank_by_cells(df, levels, group_cols=(), rank_name="rank"):
    """Competition rank (ties share it) by columns given coarse to fine, smallest first.

    ``levels`` maps a name to a column, bucketed or negated so that ascending order is the wanted one.
    Rows find their rank by a null-safe join on the cell, so none is lost; nulls come first.
    """
    keyed = df.withColumns(levels)
    keys = [*group_cols, *levels]
    cells = keyed.groupBy(*keys).agg(F.count("*").alias("n"))
    ranked = cumulative_before(cells, list(levels), ["n"], group_cols)
    places = ranked.select(
        *[F.col(k).alias(f"_at_{k}") for k in keys], (F.col("n_before") + 1).alias(rank_name)
    )
    same_cell = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_at_{k}")) for k in keys])
    return keyed.join(places, same_cell).select(*df.columns, rank_name)
