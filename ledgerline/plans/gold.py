"""Gold reports: monthly VAT, supplier scorecard, monthly cash flow."""

from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.functions import fixed_values as fv
from ledgerline.functions import rules as r


def vat_summary(invoices, month_of="invoice_date", keep=None):
    """Monthly input tax over invoices with valid tax: one filter, one aggregate.

    Claimable tax counts paid invoices only. ``month_of`` picks the date that names the month.
    """
    valid = invoices.where(F.col("vat_validation_status") == "VALID")
    if keep is not None:
        valid = valid.where(keep)
    monthly = valid.groupBy(r.month_start(month_of).alias("month_start")).agg(
        F.count("*").alias("invoice_count"),
        F.sum("amount_excl_vat").alias("total_excl_vat"),
        F.sum("vat_amount").alias("total_vat_input_tax"),
        F.sum("amount_incl_vat").alias("total_incl_vat"),
        r.count_where(r.has_status("PAID")).alias("paid_count"),
        r.count_where(r.has_status("OVERDUE")).alias("overdue_count"),
        r.sum_where(r.has_status("OVERDUE"), "amount_incl_vat").alias("overdue_amount_zar"),
        r.sum_where(r.has_status("PAID"), "vat_amount").alias("claimable_vat_input_tax"),
    )
    return monthly.select(
        r.month_key("month_start").alias("year_month"),
        F.year("month_start").alias("year"),
        F.month("month_start").alias("month"),
        *monthly.columns[1:],
    )


def vat_summary_by_payment_period(invoices):
    """The cash-basis rule as written: tax is claimed in the month the invoice is paid."""
    return vat_summary(invoices, "payment_date", r.paid_with_date())


def supplier_metrics(invoices):
    """Per-supplier totals, averages, late share and tier, before the master data joins in."""
    late = F.sum(F.col("is_late").cast("int"))
    metrics = invoices.groupBy("supplier_id").agg(
        F.count("*").alias("total_invoices"),
        F.round(F.avg("amount_incl_vat"), 2).cast(r.MONEY).alias("avg_invoice_value_zar"),
        F.sum("amount_incl_vat").alias("total_spend_zar"),
        F.sum("vat_amount").alias("total_vat_zar"),
        F.round(F.avg(F.col("days_past_due").cast("double")), 1).alias("avg_days_past_due"),
        F.max("days_past_due").alias("max_days_past_due"),
        late.alias("late_count"),
        F.round(F.lit(Decimal("100.0")) * late / F.count("*"), 1)
        .cast("decimal(5,1)")
        .alias("late_payment_pct"),
        r.count_where(r.has_status("OVERDUE")).alias("current_overdue_count"),
        r.sum_where(r.has_status("OVERDUE"), "amount_incl_vat").alias("current_overdue_zar"),
    )
    pct = F.col("late_payment_pct")
    tier = (
        F.when(pct >= fv.SCORECARD_HIGH_PCT, "HIGH")
        .when(pct >= fv.SCORECARD_MEDIUM_PCT, "MEDIUM")
        .otherwise("LOW")
    )
    return metrics.withColumn("payment_risk_tier", tier)


# The published columns of the scorecard
MASTER_COLUMNS = [
    "supplier_name",
    "category",
    "city",
    "payment_terms_days",
    "cipc_number",
]
METRIC_COLUMNS = [
    "total_invoices",
    "avg_invoice_value_zar",
    "total_spend_zar",
    "total_vat_zar",
    "avg_days_past_due",
    "max_days_past_due",
    "late_payment_pct",
    "current_overdue_count",
    "current_overdue_zar",
    "payment_risk_tier",
]


def supplier_scorecard(invoices, suppliers, keep_orphans=False):
    """Metrics joined to the master. Invoices collapse to one row per supplier before the join.

    Orphans drop by default; ``keep_orphans`` gives the left-join form, with ``late_count``.
    """
    master = suppliers.select("supplier_id", *MASTER_COLUMNS)
    how = "left" if keep_orphans else "inner"
    extra = ["late_count"] if keep_orphans else []
    return (
        supplier_metrics(invoices)
        .join(master, "supplier_id", how)
        .select("supplier_id", *MASTER_COLUMNS, *METRIC_COLUMNS, *extra)
    )


def monthly_cash(transactions, entity=()):
    monthly = transactions.groupBy(
        *entity, r.month_start("transaction_date").alias("month_start")
    ).agg(
        F.sum("credit_amount").alias("total_credits_zar"),
        F.sum("debit_amount").alias("total_debits_zar"),
        F.sum("balance_impact").alias("net_cash_flow_zar"),
        F.count("*").alias("transaction_count"),
        F.sum(F.when(~F.col("reconciled"), 1).otherwise(0)).alias("unreconciled_count"),
    )
    return monthly.withColumn("month_start", r.month_key("month_start")).withColumnRenamed(
        "month_start", "year_month"
    )


def with_month_spine(monthly, entity=()):
    """Every calendar month between an entity's first and last one; a month without lines has zeros.

    The undated group stays as it is.
    """
    month = F.to_date(F.concat("year_month", F.lit("-01")))
    span = monthly.where("year_month is not null").groupBy(*entity)
    span = span.agg(F.min(month).alias("first"), F.max(month).alias("last"))
    days = F.explode(F.sequence("first", "last", F.expr("interval 1 month"))).alias("start")
    spine = span.select(*[F.col(c).alias(f"_{c}") for c in entity], days)
    spine = spine.select(*[f"_{c}" for c in entity], r.month_key("start").alias("_month"))
    same = F.col("year_month") == F.col("_month")
    for c in entity:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    measures = [c for c in monthly.columns if c not in ("year_month", *entity)]
    filled = spine.join(monthly, same, "left").select(
        *[F.col(f"_{c}").alias(c) for c in entity],
        F.col("_month").alias("year_month"),
        *[
            F.when(F.col("year_month").isNull(), F.lit(0)).otherwise(F.col(c)).cast(monthly.schema[c].dataType).alias(c)
            for c in measures
        ],
    )
    return filled.unionByName(monthly.where("year_month is null"))


def cash_flow_monthly(transactions, entity=(), calendar=False):
    """Monthly cash with running balance, previous net and growth.

    The windows run over the monthly rows, of which there is one per month (and entity), never over
    ledger lines. Previous means the previous month present, or with ``calendar`` the previous calendar month, where
    months without lines count as zero; a zero previous net gives null growth.
    """
    order = Window.partitionBy(*entity).orderBy(F.col("year_month").asc_nulls_first())
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    net, previous = F.col("net_cash_flow_zar"), F.col("prev_month_net_cash_flow")
    growth = F.lit(Decimal("100.0")) * (net - previous) / F.nullif(F.abs(previous), F.lit(0))
    monthly = monthly_cash(transactions, entity)
    if calendar:
        monthly = with_month_spine(monthly, entity)
    return (
        monthly
        .withColumns(
            {
                "running_cash_balance_zar": F.sum(net).over(running),
                "prev_month_net_cash_flow": F.lag(net, 1).over(order),
            }
        )
        .withColumn("mom_growth_rate_pct", F.round(growth, 1).cast("decimal(28,1)"))
    )
