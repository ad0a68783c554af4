"""Gold kept up to date by landing day, without reading the days that did not change.

For every landing day and group (month, supplier) the additive measures are stored as states. When days are landed or landed
again, only their rows are measured; the totals per group take the difference between a day's new and old states. A
largest value cannot be taken back, so groups whose largest value a replaced day held look it up in the
states again. The running balance is rebuilt from the first month that changed.

An update writes a new version folder: states of the changed days, totals, report; ``_COMMITTED`` comes last. Readers take the
last committed version, and a day's states from the last committed version that has the day. Nothing is
overwritten, so an update that is lost half way leaves the old gold, and may simply run again.
"""

from dataclasses import dataclass, field
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from ledgerline.functions import fixed_values as fv
from ledgerline.functions import rules as r
from ledgerline.plans.gold import MASTER_COLUMNS, METRIC_COLUMNS
from ledgerline.sources.committed import commit, committed
from ledgerline.sources.landing import names_in, path_on

DAY = "ingested_date"


@dataclass(frozen=True)
class Measures:
    """Additive measures of a gold table per group. ``sums`` ignore nulls, as SQL does; ``counts`` are conditions."""

    group: str
    key: Column
    keep: Column
    counts: dict = field(default_factory=dict)
    sums: dict = field(default_factory=dict)
    maxima: dict = field(default_factory=dict)

    @property
    def added(self):
        """State columns that add up; each sum comes with its number of values, so that no value at all gives null."""
        return ["rows", *self.counts, *self.sums, *[f"{name}__n" for name in self.sums]]

    def of_days(self, df):
        """States per landing day and group."""
        zero = F.lit(0)
        return (
            df.where(self.keep)
            .groupBy(DAY, self.key.alias(self.group))
            .agg(
                F.count("*").alias("rows"),
                *[r.count_where(condition).alias(name) for name, condition in self.counts.items()],
                *[F.coalesce(F.sum(value), zero).alias(name) for name, value in self.sums.items()],
                *[F.count(value).alias(f"{name}__n") for name, value in self.sums.items()],
                *[F.max(value).alias(name) for name, value in self.maxima.items()],
            )
        )

    def sum_of(self, name):
        return F.when(F.col(f"{name}__n") > 0, F.col(name))


def vat_measures():
    return Measures(
        "month_start",
        r.month_start("invoice_date"),
        F.col("vat_validation_status") == "VALID",
        {"paid_count": r.has_status("PAID"), "overdue_count": r.has_status("OVERDUE")},
        {
            "total_excl_vat": F.col("amount_excl_vat"),
            "total_vat_input_tax": F.col("vat_amount"),
            "total_incl_vat": F.col("amount_incl_vat"),
            "overdue_amount_zar": F.when(r.has_status("OVERDUE"), F.col("amount_incl_vat")),
            "claimable_vat_input_tax": F.when(r.has_status("PAID"), F.col("vat_amount")),
        },
    )


def supplier_measures():
    return Measures(
        "supplier_id",
        F.col("supplier_id"),
        F.lit(True),
        {"current_overdue_count": r.has_status("OVERDUE")},
        {
            "late": F.col("is_late").cast("int").cast("long"),
            "total_spend_zar": F.col("amount_incl_vat"),
            "total_vat_zar": F.col("vat_amount"),
            "days": F.col("days_past_due").cast("long"),
            "current_overdue_zar": F.when(r.has_status("OVERDUE"), F.col("amount_incl_vat")),
        },
        {"max_days_past_due": F.col("days_past_due")},
    )


def cash_measures():
    return Measures(
        "month_start",
        r.month_start("transaction_date"),
        F.lit(True),
        {"unreconciled_count": ~F.col("reconciled")},
        {
            "total_credits_zar": F.col("credit_amount"),
            "total_debits_zar": F.col("debit_amount"),
            "net_cash_flow_zar": F.col("balance_impact"),
        },
    )


# ---- versions ----


def versions(spark, root):
    """Committed version folders, oldest first."""
    return [f"{root}/{name}" for name in committed(spark, root) if name.startswith("v=")]


def next_version(spark, root):
    """A folder that neither a committed nor a lost update has used."""
    last = max([int(n[2:]) for n in names_in(spark, root) if n.startswith("v=")], default=0)
    return f"{root}/v={last + 1:08d}"


def state_folders(spark, root):
    """Landing day -> folder of its states, from the last committed version that has the day."""
    found = {}
    for version in versions(spark, root):
        for name in names_in(spark, f"{version}/states"):
            if name.startswith(f"{DAY}="):
                found[name.split("=", 1)[1]] = f"{version}/states/{name}"
    return found


def read_totals(spark, root):
    done = versions(spark, root)
    if not done:
        raise ValueError(f"no committed version under {root}")
    return spark.read.parquet(f"{done[-1]}/totals")


# ---- one update ----


def update(spark, silver, measures, root, days):
    """Bring the totals under ``root`` up to date with the rows of ``days`` in ``silver``; gives the new version's folder.

    ``silver`` has the column ``ingested_date``; only its rows of ``days`` are read. A day without rows takes the
    day's old rows out. The version is not committed yet.
    """
    days = sorted({str(day) for day in days})
    version, done, known = next_version(spark, root), versions(spark, root), state_folders(spark, root)
    fresh = measures.of_days(silver.where(F.col(DAY).cast("string").isin(days)))
    fresh.withColumn(DAY, F.col(DAY).cast("string")).write.partitionBy(DAY).parquet(f"{version}/states")
    for day in days:  # a day without rows has an empty folder, which hides its old states
        fs, path = path_on(spark, f"{version}/states/{DAY}={day}")
        fs.mkdirs(path)

    columns = [measures.group, *measures.added, *measures.maxima]
    schema = fresh.select(*columns).schema

    def states(folders):
        return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)

    replaced = [known[day] for day in days if day in known]
    parts = [
        states([f"{version}/states/{DAY}={day}" for day in days]).withColumn("part", F.lit("new")),
        states(replaced).withColumn("part", F.lit("old")),
    ]
    if done:
        parts.append(spark.read.parquet(f"{done[-1]}/totals").select(*columns).withColumn("part", F.lit("total")))
    every = reduce(lambda a, b: a.unionByName(b), parts)
    is_old = F.col("part") == "old"
    merged = every.groupBy(measures.group).agg(
        *[F.sum(F.when(is_old, -F.col(c)).otherwise(F.col(c))).cast(schema[c].dataType).alias(c) for c in measures.added],
        F.max(F.col("part") != "total").alias("changed"),
        *[F.max(F.when(~is_old, F.col(c))).alias(c) for c in measures.maxima],
        *[F.max(F.when(is_old, F.col(c))).alias(f"{c}__old") for c in measures.maxima],
        *[F.max(F.when(F.col("part") == "new", F.col(c))).alias(f"{c}__new") for c in measures.maxima],
    )
    merged.where("rows > 0").write.parquet(f"{version}/merged")
    merged = spark.read.parquet(f"{version}/merged")
    for c in measures.maxima:
        merged = with_maximum(merged, measures.group, c, states, days, known, version)
    merged.select(*columns, "changed").write.parquet(f"{version}/totals")
    return version


def with_maximum(merged, group, c, states, days, known, version):
    """Corrects ``c`` where a replaced day may have held it, from the states of all days."""
    lost = merged.where((F.col(f"{c}__old") >= F.col(c)) & (F.coalesce(F.col(f"{c}__new") < F.col(c), F.lit(True))))
    if not lost.limit(1).count():
        return merged
    folders = [path for day, path in known.items() if day not in days]
    folders += [f"{version}/states/{DAY}={day}" for day in days]
    of_lost = states(folders).select(group, c).join(lost.select(group), group, "left_semi")
    again = of_lost.groupBy(group).agg(F.max(c).alias("again"), F.lit(True).alias("is_lost"))
    joined = merged.join(again, group, "left")
    return joined.withColumn(c, F.when(F.col("is_lost"), F.col("again")).otherwise(F.col(c))).drop("again", "is_lost")


# ---- the three reports ----


def vat_report(totals):
    m = vat_measures()
    zero = F.lit(Decimal("0.00"))
    return totals.select(
        r.month_key("month_start").alias("year_month"),
        F.year("month_start").alias("year"),
        F.month("month_start").alias("month"),
        F.col("rows").alias("invoice_count"),
        *[m.sum_of(c).alias(c) for c in ("total_excl_vat", "total_vat_input_tax", "total_incl_vat")],
        "paid_count",
        "overdue_count",
        *[F.coalesce(F.col(c), zero).alias(c) for c in ("overdue_amount_zar", "claimable_vat_input_tax")],
    )


def scorecard_report(totals, suppliers):
    """The scorecard; the supplier master is read as it is now, since it is a snapshot."""
    m = supplier_measures()
    n = F.col("rows")
    average = m.sum_of("total_spend_zar") / F.col("total_spend_zar__n")
    late_pct = F.round(F.lit(Decimal("100.0")) * m.sum_of("late") / n, 1).cast("decimal(5,1)")
    pct = F.col("late_payment_pct")
    tier = F.when(pct >= fv.SCORECARD_HIGH_PCT, "HIGH").when(pct >= fv.SCORECARD_MEDIUM_PCT, "MEDIUM").otherwise("LOW")
    days = m.sum_of("days").cast("double") / F.col("days__n")
    metrics = totals.select(
        "supplier_id",
        n.alias("total_invoices"),
        F.round(average.cast("decimal(22,6)"), 2).cast(r.MONEY).alias("avg_invoice_value_zar"),
        *[m.sum_of(c).alias(c) for c in ("total_spend_zar", "total_vat_zar")],
        F.round(days, 1).alias("avg_days_past_due"),
        "max_days_past_due",
        late_pct.alias("late_payment_pct"),
        "current_overdue_count",
        F.coalesce(F.col("current_overdue_zar"), F.lit(Decimal("0.00"))).alias("current_overdue_zar"),
    ).withColumn("payment_risk_tier", tier)
    master = suppliers.select("supplier_id", *MASTER_COLUMNS)
    return metrics.join(master, "supplier_id").select("supplier_id", *MASTER_COLUMNS, *METRIC_COLUMNS)


CASH_COLUMNS = ["total_credits_zar", "total_debits_zar", "net_cash_flow_zar", "transaction_count", "unreconciled_count"]


def cash_report(totals, before=None):
    """Cash flow from the first changed month on; earlier months come from ``before``, the last version's report."""
    m = cash_measures()
    monthly = totals.select(
        r.month_key("month_start").alias("year_month"),
        *[m.sum_of(c).alias(c) for c in CASH_COLUMNS[:3]],
        F.col("rows").alias("transaction_count"),
        "unreconciled_count",
        "changed",
    )
    kept = last = None
    if before is not None:
        span = [F.min("year_month").alias("first"), F.max(F.col("year_month").isNull()).alias("undated")]
        # months that lost all their rows are in the old report only
        now = monthly.select(F.col("year_month").alias("now"))
        gone = before.join(now, F.col("year_month").eqNullSafe(F.col("now")), "left_anti")
        both = monthly.where("changed").select("year_month").unionByName(gone.select("year_month"))
        found = both.agg(*span).first()
        if not found.undated:
            earlier = F.lit(True) if found.first is None else F.col("year_month").isNull() | (F.col("year_month") < found.first)
            kept = before.where(earlier)
            last = kept.orderBy(F.col("year_month").desc_nulls_last()).limit(1).first()
            monthly = monthly.where(~earlier)
    net, previous = F.col("net_cash_flow_zar"), F.col("prev_month_net_cash_flow")
    order = Window.orderBy(F.col("year_month").asc_nulls_first())
    total = F.sum(net).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    carried = F.lit(last.running_cash_balance_zar if last else None).cast("decimal(38,2)")
    running = F.when(total.isNotNull() | carried.isNotNull(), F.coalesce(total, F.lit(0)) + F.coalesce(carried, F.lit(0)))
    first = F.row_number().over(order) == 1
    earlier_net = F.lit(last.net_cash_flow_zar if last else None).cast("decimal(28,2)")
    growth = F.lit(Decimal("100.0")) * (net - previous) / F.nullif(F.abs(previous), F.lit(0))
    rebuilt = (
        monthly.drop("changed")
        .withColumns(
            {
                "running_cash_balance_zar": running.cast("decimal(38,2)"),
                "prev_month_net_cash_flow": F.when(first, earlier_net).otherwise(F.lag(net, 1).over(order)),
            }
        )
        .withColumn("mom_growth_rate_pct", F.round(growth, 1).cast("decimal(28,1)"))
    )
    return rebuilt if kept is None else kept.unionByName(rebuilt)


def update_vat(spark, invoices, root, days):
    version = update(spark, invoices, vat_measures(), root, days)
    commit(spark, version)
    return vat_report(read_totals(spark, root))


def update_scorecard(spark, invoices, suppliers, root, days):
    version = update(spark, invoices, supplier_measures(), root, days)
    commit(spark, version)
    return scorecard_report(read_totals(spark, root), suppliers)


def update_cash_flow(spark, transactions, root, days):
    done = versions(spark, root)
    version = update(spark, transactions, cash_measures(), root, days)
    before = spark.read.parquet(f"{done[-1]}/report") if done else None
    cash_report(spark.read.parquet(f"{version}/totals"), before).write.parquet(f"{version}/report")
    commit(spark, version)
    return spark.read.parquet(f"{version}/report")


def refresh_gold(spark, silver, root, days):
    """The three gold tables after ``days`` have been landed or landed again.

    ``silver`` has silver_invoices and silver_bank_transactions with ``ingested_date``, and silver_suppliers.
    """
    return {
        "gold_vat_summary": update_vat(spark, silver["silver_invoices"], f"{root}/vat", days),
        "gold_supplier_scorecard": update_scorecard(
            spark, silver["silver_invoices"], silver["silver_suppliers"], f"{root}/scorecard", days
        ),
        "gold_cash_flow_monthly": update_cash_flow(spark, silver["silver_bank_transactions"], f"{root}/cash", days),
    }
