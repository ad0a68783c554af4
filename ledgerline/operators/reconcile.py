"""Reconciliation of ledger lines with paid invoices by date and amount tolerance.

A line matches if any paid invoice lies within some days and some rand of it. No pair of line and
invoice is ever formed. Lines and invoices first collapse to distinct (day, amount) points; an invoice
point is repeated for each day of its window; then one sorted pass per day and amount cell finds, for
every line, the largest invoice amount up to the upper end of its tolerance. The line matches exactly
when that amount is not below the lower end.
"""

from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.functions import fixed_values as fv
from ledgerline.functions import rules as r

CELL_WIDTH = 1000


def ledger_points(bank):
    return bank.groupBy(
        F.col("transaction_date").alias("day"),
        F.abs("debit_amount").alias("amount"),
        (F.col("debit_amount") < 0).alias("is_negative"),
    ).agg(F.count("*").alias("lines"))


def match_points(bank, invoices, days=fv.RECON_DAYS, tolerance=fv.RECON_AMOUNT, width=CELL_WIDTH):
    """Distinct (day, amount) points of the ledger, their number of lines and whether they match.

    Amounts are compared in whole cents. A cell holds at most ``width`` rand of one day, that is
    100 x ``width`` distinct amounts on either side, however many lines share them. A line lies in the
    cell of its upper end; an invoice is repeated in every cell such an end can fall into.
    """
    slack = Decimal(str(tolerance)) * 100
    if slack != int(slack) or slack < 0:
        raise ValueError(f"tolerance of {tolerance} is no whole number of cents")
    slack = int(slack)

    def cents(amount):
        return (F.col(amount) * 100).cast("bigint")

    def cell(end):
        return F.floor(end / (width * 100)).cast("bigint")

    upper = cents("amount") + slack
    lines = ledger_points(bank).withColumns({"at": upper, "cell": cell(upper), "is_line": F.lit(1)})
    offer = cents("amount_incl_vat")
    paid = (
        invoices.where(r.paid_with_date() & F.col("amount_incl_vat").isNotNull())
        .select("payment_date", offer.alias("offer"))
        .distinct()
    )
    shifts = F.array(*[F.lit(shift) for shift in range(-days, days + 1)])
    per_day = paid.select("payment_date", "offer", F.explode(shifts).alias("shift"))
    offers = per_day.select(
        F.date_add("payment_date", F.col("shift")).alias("day"),
        F.col("offer").alias("at"),
        "offer",
        F.explode(F.sequence(cell(F.col("offer")), cell(F.col("offer") + 2 * slack))).alias("cell"),
        F.lit(0).alias("is_line"),
    )
    so_far = (
        Window.partitionBy("day", "cell")
        .orderBy("at", "is_line")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    within = F.max("offer").over(so_far) >= F.col("at") - 2 * slack
    return (
        lines.unionByName(offers, allowMissingColumns=True)
        .withColumn("matched", F.coalesce(within, F.lit(False)))
        .where("is_line = 1")
        .select("day", "amount", "is_negative", "lines", "matched")
    )


def in_population(population):
    """Which points count: all, only debits, or negative amounts where the ledger has any."""
    if population == "all":
        return F.lit(True)
    if population == "debits":
        return F.col("amount") > 0
    if population == "auto":
        return F.col("is_negative") | ~F.col("any_negative")
    raise ValueError(population)


def recon_counts(df):
    unmatched = F.col("total") - F.col("matched")
    return df.withColumns(
        {"unmatched": unmatched, "unmatched_rate": r.share(unmatched, "total")}
    )


def bank_reconciliation(bank, invoices, population="auto", **tolerances):
    """Total, matched and unmatched ledger lines.

    ``auto`` counts negative amounts if the ledger has any and all lines otherwise.
    """
    points = match_points(bank, invoices, **tolerances)
    by_sign = points.groupBy("is_negative", (F.col("amount") > 0).alias("is_debit")).agg(
        F.sum("lines").alias("lines"),
        F.sum(F.when(F.col("matched"), F.col("lines")).otherwise(0)).alias("matched"),
    )
    everything = Window.partitionBy()
    chosen = (
        by_sign.withColumn("any_negative", F.max("is_negative").over(everything))
        .withColumn("amount", F.when(F.col("is_debit"), 1).otherwise(0))
        .where(in_population(population))
    )
    return recon_counts(
        chosen.agg(
            F.coalesce(F.sum("lines"), F.lit(0)).alias("total"),
            F.coalesce(F.sum("matched"), F.lit(0)).alias("matched"),
        )
    )


def monthly_reconciliation(bank, invoices, population="auto", limit=fv.RECON_MONTHLY_LIMIT, **tolerances):
    """The same counts per month, with months above the limit flagged."""
    points = match_points(bank, invoices, **tolerances)
    cells = points.groupBy(
        r.month_start("day").alias("month"), "is_negative", (F.col("amount") > 0).alias("is_debit")
    ).agg(
        F.sum("lines").alias("lines"),
        F.sum(F.when(F.col("matched"), F.col("lines")).otherwise(0)).alias("matched"),
    )
    everything = Window.partitionBy()
    monthly = (
        cells.withColumn("any_negative", F.max("is_negative").over(everything))
        .withColumn("amount", F.when(F.col("is_debit"), 1).otherwise(0))
        .where(in_population(population) & F.col("month").isNotNull())
        .groupBy("month")
        .agg(F.sum("lines").alias("total"), F.sum("matched").alias("matched"))
    )
    return recon_counts(monthly).select(
        r.month_key("month").alias("year_month"),
        "matched",
        "total",
        "unmatched",
        "unmatched_rate",
        (F.col("unmatched_rate") > limit).alias("above_limit"),
    )


def flag_lines(bank, invoices, **tolerances):
    """Every ledger line with its ``matched`` flag; lines of one point share the point's answer."""
    points = match_points(bank, invoices, **tolerances).select(
        F.col("day").alias("transaction_date"),
        F.col("amount").alias("_amount"),
        F.col("is_negative").alias("_negative"),
        "matched",
    )
    keyed = bank.withColumns(
        {"_amount": F.abs("debit_amount"), "_negative": F.col("debit_amount") < 0}
    )
    # only matched points answer anything, and undated lines or lines without an amount never match one
    matched = points.where("matched")
    can_match = F.col("transaction_date").isNotNull() & F.col("_amount").isNotNull()
    dated = keyed.where(can_match).join(matched, ["transaction_date", "_amount", "_negative"], "left")
    rest = keyed.where(~can_match).withColumn("matched", F.lit(False))
    flagged = dated.withColumn("matched", F.coalesce("matched", F.lit(False))).unionByName(rest)
    return flagged.drop("_amount", "_negative")
