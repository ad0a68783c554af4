"""Mixing sources to target weights by temperature.

A source with n tokens gets weight n**a / sum(n**a). The exponent a in [0, 1] is found by bisection on the
table of source totals, four levels a pass: one aggregate evaluates a grid of 15 inner points. Aims:

* ``max_repeats``: the smallest a (flattest mix) at which no source repeats more often; the budget lets the
  largest source pass exactly once, so that no document is lost;
* ``target_entropy``: the largest a whose weights have at least this entropy (nats), with a given budget.

A source's budget becomes whole passes over its documents and part of one more. The order of a pass is a
permutation of blocks (documents dealt by a seeded digest to about sqrt(rows) blocks); whole blocks are taken while
they fit, and only the block on the limit is ordered by document. No sort spans more than one block, and no
window more than one source's blocks.

Null sources form a source of their own; null ids are mixed like others. Texts without a word have no
tokens: they ride along in whole passes, and in a part pass as long as the limit is not passed. Repeated
rows count as often as they occur. An empty table gives no rows. Ties in the digest go by id. Columns of
the input with any name stay out of the work: they come back only from ``mixed_rows``.
"""

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import discard, stored
from ledgerline.session import use_checkpoint_dir

SEED = 17
PASSES = 8
GRID = 16
#: Entries per source of about 100 bytes are broadcast up to this many.
MAX_SOURCES = 50_000


def source_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source").agg(
        F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")
    )


def weighted(totals: DataFrame, exponent) -> DataFrame:
    """Sources with a token, their weight at the exponent."""
    return totals.where("tokens > 0").withColumn("power", F.pow(F.col("tokens").cast("double"), exponent))


def find_exponent(totals: DataFrame, max_repeats=None, target_entropy=None) -> float:
    """Bisection; 1 if even the natural mix misses the aim, 0 if the flat mix meets it."""
    low, high = 0.0, 1.0
    n = F.col("tokens").cast("double")
    for _ in range(PASSES):
        step = (high - low) / GRID
        aggs = [F.max(n).alias("largest"), F.min(n).alias("smallest")]
        points = [low + i * step for i in range(GRID + 1)]
        for i, a in enumerate(points):
            power = F.pow(n, F.lit(a))
            aggs += [F.sum(power).alias(f"z{i}"), F.sum(power * a * F.log(n)).alias(f"e{i}")]
        row = totals.where("tokens > 0").agg(*aggs).first()
        if row["largest"] is None:
            return 1.0

        def fits(i):
            if max_repeats is not None:
                return (row["largest"] / row["smallest"]) ** (1 - points[i]) <= max_repeats
            return math.log(row[f"z{i}"]) - row[f"e{i}"] / row[f"z{i}"] >= target_entropy

        if max_repeats is not None:  # fits from some point on
            first = next((i for i in range(GRID + 1) if fits(i)), GRID)
            low, high = points[max(first - 1, 0)], points[first]
        else:  # fits up to some point
            last = next((i for i in reversed(range(GRID + 1)) if fits(i)), 0)
            low, high = points[last], points[min(last + 1, GRID)]
        if low == high:
            break
    return high if max_repeats is not None else low


def source_budgets(totals: DataFrame, exponent: float, budget_tokens=None) -> DataFrame:
    """source, docs, tokens, weight, passes (whole ones), rest (tokens of one more), blocks."""
    powers = weighted(totals, F.lit(exponent))
    all_of = powers.agg(F.sum("power").alias("z"), F.max("tokens").alias("most"), F.max("power").alias("top")).first()
    if all_of["z"] is None:
        z, budget = 1.0, 0.0
    else:
        z = all_of["z"]
        budget = float(budget_tokens) if budget_tokens is not None else all_of["most"] * z / all_of["top"]
    out = powers.withColumn("weight", F.col("power") / F.lit(z))
    # within 1e-9 of a whole number of passes counts as whole: the largest source's own share is exactly one
    repeats = F.col("weight") * F.lit(budget) / F.col("tokens")
    passes = F.floor(repeats + F.lit(1e-9)).cast("long")
    rest = F.greatest(F.floor((repeats - passes) * F.col("tokens")).cast("long"), F.lit(0).cast("long"))
    return out.select(
        "source",
        "docs",
        "tokens",
        "weight",
        passes.alias("passes"),
        rest.alias("rest"),
        F.ceil(F.sqrt(F.col("docs").cast("double"))).cast("long").alias("blocks"),
    )


def order_digest(epoch, doc_id):
    """The first 48 bits of a seeded digest, as a number."""
    text = F.concat_ws(":", F.lit(str(SEED)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")


def by_source(table: DataFrame, small: DataFrame, sources: int) -> DataFrame:
    """Rows with the entry of their source. Up to MAX_SOURCES entries are broadcast, more are joined by shuffle."""
    side = small.withColumnRenamed("source", "s")
    side = F.broadcast(side) if sources <= MAX_SOURCES else side
    return table.join(side, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")


def placed(rows: DataFrame, epoch) -> DataFrame:
    """Rows with their place in a pass over their source: block, then order_key, then doc_id."""
    return rows.withColumn("order_key", order_digest(epoch, F.col("doc_id"))).withColumn(
        "block", F.when(F.col("blocks") > 0, F.pmod("order_key", "blocks"))
    )


def edges(slim: DataFrame, budgets: DataFrame, sources: int) -> DataFrame:
    """source, edge_block, edge (order_key and doc_id): up to where the part pass of a source goes.

    Blocks before the edge are taken whole; in it, rows up to ``edge`` (null: none).
    """
    part = placed(by_source(slim, budgets.where("rest > 0"), sources).where("rest > 0"), F.col("passes"))
    sizes = part.groupBy("source", "block").agg(F.sum("n_tokens").alias("size"), F.max("rest").alias("limit"))
    before = F.sum("size").over(
        Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    sizes = sizes.withColumn("before", F.coalesce(before, F.lit(0).cast("long")))
    edge = (
        sizes.where("before <= limit and before + size > limit")
        .groupBy("source")
        .agg(F.min("block").alias("edge_block"), F.min(F.col("limit") - F.col("before")).alias("room"))
    )
    inside = by_source(part, edge, sources).where("block = edge_block")
    # rows that tie in both keys are repeats of one row: they go in together or not at all
    running = F.sum("n_tokens").over(Window.partitionBy("source", "block").orderBy("order_key", "doc_id"))
    last = (
        inside.withColumn("running", running)
        .where("running <= room")
        .groupBy("source")
        .agg(F.max(F.struct("order_key", "doc_id")).alias("edge"))
    )
    return by_source(edge.select("source", "edge_block"), last, sources)


def mixed_rows(
    df: DataFrame,
    tokens,
    max_repeats=2.0,
    target_entropy=None,
    budget_tokens=None,
    doc_id="doc_id",
    source="source",
) -> DataFrame:
    """Every use of a row: ``row`` (the input row), n_tokens, epoch, block, order_key, weight.

    The uses are worked out on ids and sizes; whole rows only meet one entry per source, so texts are not shuffled.
    Rows of sources without any token come back once.
    """
    use_checkpoint_dir(df.sparkSession)
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        F.coalesce(tokens, F.lit(0)).cast("long").alias("n_tokens"),
    )
    slim = stored(rows.select("doc_id", "source", "n_tokens"), "sizes")
    totals = source_totals(slim).checkpoint()
    sources = totals.count()
    aim = {"max_repeats": None if target_entropy is not None else max_repeats, "target_entropy": target_entropy}
    exponent = find_exponent(totals, **aim)
    budgets = source_budgets(totals, exponent, budget_tokens).drop("docs", "tokens").checkpoint()
    plan = by_source(budgets, edges(slim, budgets, sources), sources).checkpoint()
    discard(slim)

    uses = placed(by_source(rows, plan, sources), F.col("passes"))
    key = F.struct("order_key", "doc_id")
    in_edge = (F.col("block") == F.col("edge_block")) & (key <= F.col("edge"))
    in_part = (F.col("rest") > 0) & ((F.col("block") < F.col("edge_block")) | F.coalesce(in_edge, F.lit(False)))
    none = F.array().cast("array<bigint>")
    zero = F.lit(0).cast("long")
    whole = F.when(F.col("passes") > 0, F.sequence(zero, F.greatest(F.col("passes") - 1, zero))).otherwise(none)
    part = F.when(in_part, F.array(F.col("passes"))).otherwise(none)
    epochs = F.when(F.col("passes").isNull(), F.array(zero)).otherwise(F.concat(whole, part))
    uses = placed(uses.withColumn("epoch", F.explode(epochs)), F.col("epoch"))
    return uses.select("row", "doc_id", "source", "n_tokens", "epoch", "block", "order_key", "weight")
