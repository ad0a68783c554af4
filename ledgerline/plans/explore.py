"""Exploratory reports over invoices (joined with suppliers where they need supplier columns)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.functions import fixed_values as fv
from ledgerline.functions import rules as r
from ledgerline.operators.quantiles import exact_quantiles, money_millions, money_quantiles

# The published columns of the profile and of the correlations
PROFILE_COLUMNS = [
    "amount_excl_vat",
    "vat_amount",
    "amount_incl_vat",
    "days_past_due",
    "payment_terms_days",
    "late_payment_probability",
]
#: Days, terms and rated probabilities: value counts are small however many rows there are.
FEW_VALUED = ["days_past_due", "payment_terms_days", "late_payment_probability"]
CORRELATED_COLUMNS = [
    "amount_incl_vat",
    "vat_amount",
    "days_past_due",
    "payment_terms_days",
    "late_payment_probability",
    "is_late",
]


def late_int():
    return F.col("is_late").cast("int")


def late_count():
    return F.coalesce(F.sum(late_int()), F.lit(0))


def late_rate():
    """Share of late among all rows with a flag, exact until one division."""
    return r.share(late_count(), F.count("is_late"))


def monthly_totals(invoices):
    monthly = (
        invoices.where(F.col("invoice_date").isNotNull())
        .groupBy(r.month_start("invoice_date").alias("month"))
        .agg(
            F.count("invoice_id").alias("invoice_count"),
            F.sum("amount_incl_vat").alias("total_spend"),
            late_count().alias("late_count"),
        )
    )
    return monthly.withColumn("late_rate", r.share("late_count", "invoice_count"))


def monthly_trend(invoices):
    """Monthly invoices, spend and late rate; the peak-spend and worst-late months are marked.

    Ties go to the earliest month.
    """
    monthly = monthly_totals(invoices).select(
        r.month_key("month").alias("year_month"),
        "invoice_count",
        "total_spend",
        "late_count",
        "late_rate",
    )
    earliest = -F.expr("int(replace(year_month, '-', ''))")
    months = Window.partitionBy()
    peak = F.max_by("year_month", F.struct("total_spend", earliest)).over(months)
    worst = F.max_by("year_month", F.struct("late_rate", earliest)).over(months)
    return monthly.withColumns(
        {
            "is_peak_spend": F.col("year_month") == peak,
            "is_worst_late": F.col("year_month") == worst,
        }
    )


def late_by_category(invoices):
    by_category = (
        invoices.where(F.col("category").isNotNull())
        .groupBy("category")
        .agg(
            late_rate().alias("late_rate"),
            F.count("is_late").alias("total_invoices"),
            late_count().alias("late_invoices"),
        )
    )
    risk = r.band("late_rate", fv.LATE_RATE_HIGH, fv.LATE_RATE_MEDIUM)
    return by_category.withColumn("risk_band", risk).orderBy(F.desc("late_rate"), "category")


def late_exposure_by_category(invoices):
    return (
        invoices.where(F.col("is_late") & F.col("category").isNotNull())
        .groupBy("category")
        .agg(
            F.sum("amount_incl_vat").alias("total_late_exposure"),
            r.share(F.sum("amount_incl_vat"), F.count("amount_incl_vat")).alias("avg_late_invoice"),
            F.count("amount_incl_vat").alias("late_invoices"),
        )
        .orderBy(F.desc("total_late_exposure"), "category")
    )


def numeric_profile(df, columns=PROFILE_COLUMNS, few_valued=FEW_VALUED):
    """Count, mean, deviation, extremes and exact quartiles of each column, one row per column.

    The first four come from one wide aggregate. Quartiles of amounts take two passes over (metric, bucket)
    counts; those of columns with few distinct values are taken over value counts.
    """
    probs = [0.25, 0.5, 0.75]
    basics = df.agg(
        *[
            F.struct(
                F.lit(c).alias("metric"),
                F.count(c).alias("count"),
                r.share(F.sum(F.col(c).cast("decimal(22,4)")), F.count(c)).alias("mean"),
                F.stddev_samp(F.col(c).cast("double")).alias("std"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in columns
        ]
    ).select(F.inline(F.array(*[F.col(c) for c in columns])))

    def long(names):
        entries = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("decimal(22,4)").alias("value")) for c in names]
        return df.select(F.inline(F.array(*entries))).where("value is not null")

    amounts = exact_quantiles(
        long([c for c in columns if c not in few_valued]),
        F.col("value"),
        F.expr("bigint(value) div 100"),
        probs,
        ["metric"],
        few_groups=True,
        coarse=money_millions,
    )
    counts = long([c for c in columns if c in few_valued]).groupBy("metric", "value").agg(F.count("*").alias("n"))
    value = F.col("value").cast("double")
    others = counts.groupBy("metric").agg(*[F.percentile(value, p, F.col("n")).alias(f"q{i}") for i, p in enumerate(probs)])
    # one row per column on either side
    return basics.join(F.broadcast(amounts.unionByName(others)), "metric").select(
        "metric",
        "count",
        "mean",
        "std",
        "min",
        F.col("q0").alias("p25"),
        F.col("q1").alias("p50"),
        F.col("q2").alias("p75"),
        "max",
    )


def histogram(df, value, bins, scales=None):
    """Equal-width bins between the extremes; the last bin is closed. Empty bins have no row.

    ``scales`` maps names to growing functions of the value: each gives a histogram of its own from the same two
    passes (extremes, counts), told apart by ``scale``.
    """
    rows = df.select(value.cast("double").alias("v")).where("v is not null")
    edges = rows.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")).alias("limits")).scalar()
    entries = []
    for name, of in (scales or {"": lambda v: v}).items():
        lo = of(edges["lo"])
        width = (of(edges["hi"]) - lo) / bins
        entries.append(F.struct(F.lit(name).alias("scale"), of(F.col("v")).alias("v"), lo.alias("lo"), width.alias("width")))
    placed = rows.select(F.inline(F.array(*entries)))
    number = F.when(F.col("width") == 0, 0).otherwise(F.floor((F.col("v") - F.col("lo")) / F.col("width")))
    counted = placed.groupBy(
        "scale", F.least(number, F.lit(bins - 1)).cast("int").alias("bin"), "lo", "width"
    ).agg(F.count("*").alias("n"))
    binned = counted.select(
        "scale",
        "bin",
        (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_start"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_end"),
        "n",
    )
    return binned if scales else binned.drop("scale")


def amount_histogram(invoices, bins=50):
    """Bins of the gross amount and of its log1p."""
    return histogram(invoices, F.col("amount_incl_vat"), bins, {"raw": lambda v: v, "log1p": F.log1p})


def amount_median(invoices, approx=False):
    return money_quantiles(invoices, "amount_incl_vat", [0.5], approx=approx).select(
        F.col("q0").alias("median_amount")
    )


def payment_delay(invoices):
    """Paid invoices with days to pay and the difference to the agreed terms."""
    return invoices.where(r.paid_with_date()).withColumns(
        {
            "actual_days": r.days_to_pay(),
            "days_delta": r.days_to_pay() - F.col("payment_terms_days"),
        }
    )


def days_delta_histogram(invoices, bins=40):
    return histogram(payment_delay(invoices), F.col("days_delta"), bins)


def correlation_matrix(df, columns=CORRELATED_COLUMNS):
    """Pearson correlation of every pair, lower triangle, all pairs in one aggregate."""
    numbers = df.select(*[F.col(c).cast("int" if c == "is_late" else "double").alias(c) for c in columns])
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[:i]]
    row = numbers.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    entries = [
        F.struct(
            F.lit(a).alias("row_metric"),
            F.lit(b).alias("column_metric"),
            F.col(f"{a}|{b}").alias("correlation"),
        )
        for a, b in pairs
    ]
    return row.select(F.inline(F.array(*entries)))


def late_correlates(df, columns=CORRELATED_COLUMNS):
    """Correlation of each column with the late flag, strongest first."""
    others = [c for c in columns if c != "is_late"]
    flag = late_int()
    row = df.agg(*[F.corr(F.col(c).cast("double"), flag).alias(c) for c in others])
    entries = [
        F.struct(F.lit(c).alias("metric"), F.col(c).alias("correlation")) for c in others
    ]
    return row.select(F.inline(F.array(*entries))).orderBy(
        F.abs("correlation").desc_nulls_last(), "metric"
    )


def status_breakdown(invoices):
    counted = (
        invoices.where(F.col("invoice_status").isNotNull())
        .groupBy("invoice_status")
        .agg(F.count("*").alias("invoices"))
    )
    total = F.sum("invoices").over(Window.partitionBy())
    return counted.withColumn("share", r.share("invoices", total))


def kpi_summary(invoices):
    """Totals of the portfolio with the category that is late most often."""
    amount = F.col("amount_incl_vat")
    by_category = invoices.groupBy("category").agg(
        F.count("*").alias("n"),
        F.count("is_late").alias("n_flagged"),
        late_count().alias("n_late"),
        F.sum(amount).alias("spend"),
        F.sum("vat_amount").alias("vat"),
        r.sum_where(F.col("is_late"), amount).alias("late_spend"),
        r.count_where(~F.col("is_paid")).alias("n_unpaid"),
        F.min("invoice_date").alias("first_day"),
        F.max("invoice_date").alias("last_day"),
    )
    rate = F.when(F.col("category").isNotNull(), r.share("n_late", "n_flagged"))
    top = F.struct(rate, F.col("category"))
    totals = by_category.agg(
        F.sum("n").alias("invoices"),
        F.min("first_day").alias("first_invoice_date"),
        F.max("last_day").alias("last_invoice_date"),
        F.sum("spend").alias("total_spend"),
        F.sum("vat").alias("total_vat"),
        F.sum("late_spend").alias("late_exposure"),
        r.share(F.sum("late_spend"), F.sum("spend")).alias("late_exposure_share"),
        r.share(F.sum("n_late"), F.sum("n_flagged")).alias("late_rate"),
        F.sum("n_unpaid").alias("unpaid_invoices"),
        F.max_by("category", top).alias("top_late_category"),
        F.max(rate).alias("top_late_rate"),
    )
    return totals


def dataset_snapshot(invoices):
    """Date range, suppliers, late rates and status counts in one row.

    Both late rates are given: over all invoices and over paid ones.
    """
    statuses = [
        r.count_where(r.has_status(s)).alias(f"{s.lower()}_invoices") for s in fv.INVOICE_STATUSES
    ]
    by_supplier = invoices.groupBy("supplier_id").agg(
        F.count("*").alias("n"),
        F.min("invoice_date").alias("lo"),
        F.max("invoice_date").alias("hi"),
        late_count().alias("n_late"),
        F.count("is_late").alias("n_flagged"),
        r.count_where("is_paid").alias("n_paid"),
        r.count_where(F.col("is_paid") & F.col("is_late")).alias("n_paid_late"),
        F.collect_set("currency").alias("currencies"),
        *statuses,
    )
    return by_supplier.agg(
        F.sum("n").alias("invoices"),
        F.min("lo").alias("first_invoice_date"),
        F.max("hi").alias("last_invoice_date"),
        F.count("supplier_id").alias("suppliers"),
        r.share(F.sum("n_late"), F.sum("n_flagged")).alias("late_rate_all"),
        r.share(F.sum("n_paid_late"), F.sum("n_paid")).alias("late_rate_paid"),
        F.concat_ws(
            ",", F.array_sort(F.array_distinct(F.flatten(F.collect_set("currencies"))))
        ).alias("currencies"),
        *[F.sum(f"{s.lower()}_invoices").alias(f"{s.lower()}_invoices") for s in fv.INVOICE_STATUSES],
    )
