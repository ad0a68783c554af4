"""Internal KPIs against external benchmarks."""

from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.functions import fixed_values as fv
from ledgerline.functions import rules as r
from ledgerline.plans.explore import late_count, late_int, late_rate, monthly_totals


def mismatch():
    return r.vat_mismatch_rounded("amount_excl_vat", "vat_amount")


def compliance_rate():
    """Share of dated payments at most two days over the terms; null when there are none."""
    delta = r.days_to_pay() - F.col("payment_terms_days")
    within = r.paid_with_date() & (delta <= fv.ON_TIME_UP_TO_DAYS)
    return r.share(r.count_where(within), r.count_where(r.paid_with_date()))


def internal_kpis(invoices):
    """The internal column of every comparison, in one aggregate."""
    days = F.when(r.paid_with_date(), r.days_to_pay())
    return invoices.agg(
        F.count("*").alias("invoices"),
        F.count_distinct("supplier_id").alias("suppliers"),
        F.sum("amount_incl_vat").alias("total_spend"),
        r.share(F.sum("amount_incl_vat"), F.count("amount_incl_vat")).alias("avg_invoice"),
        F.sum("vat_amount").alias("total_vat"),
        r.share(F.sum("vat_amount"), F.sum("amount_incl_vat")).alias("vat_share"),
        late_rate().alias("late_rate_all"),
        r.share(
            r.count_where(F.col("is_paid") & F.col("is_late")), r.count_where("is_paid")
        ).alias("late_rate_paid"),
        r.share(r.count_where(mismatch()), F.count("*")).alias("vat_mismatch_rate"),
        compliance_rate().alias("terms_compliance"),
        r.share(F.sum(days), F.count(days)).alias("avg_days_to_pay"),
    )


def yoy_change(periods, previous, current):
    """Change in percent between two periods, from (category, period, value) rows."""

    def value_of(period):
        return F.sum(F.when(F.col("period") == period, F.col("value")).otherwise(0))

    change = F.col("current") - F.col("previous")
    pct = F.round(
        F.lit(Decimal("100.0")) * change / F.nullif(F.col("previous"), F.lit(0)), 1
    ).cast("decimal(18,1)")
    return (
        periods.groupBy("category")
        .agg(value_of(previous).alias("previous"), value_of(current).alias("current"))
        .withColumn("change_pct", pct)
        .withColumn(
            "direction", F.when(F.col("change_pct") < 0, "IMPROVED").otherwise("REGRESSED")
        )
    )


def late_and_unpaid_by_year(invoices, regions):
    """(category, period, value) rows: late and unpaid invoices per region and invoice year.

    Invoices collapse to one row per supplier and year before the region joins in.
    """
    per_supplier = (
        invoices.groupBy("supplier_id", F.year("invoice_date").alias("period"))
        .agg(late_count().alias("late"), r.count_where(~F.col("is_paid")).alias("unpaid"))
        .join(regions.select("supplier_id", "region"), "supplier_id")
    )
    kinds = F.array(
        F.struct(F.lit("Paid Late").alias("kind"), F.col("late").alias("n")),
        F.struct(F.lit("Unpaid").alias("kind"), F.col("unpaid").alias("n")),
    )
    return (
        per_supplier.select("region", "period", F.inline(kinds))
        .groupBy(F.concat_ws(": ", "region", "kind").alias("category"), "period")
        .agg(F.sum("n").alias("value"))
    )


def region_totals(invoices, regions):
    """Late and unpaid counts and values per region, aggregated by supplier before the join."""
    amount = F.col("amount_incl_vat")
    per_supplier = invoices.groupBy("supplier_id").agg(
        late_count().alias("late_invoices"),
        r.sum_where(F.col("is_late"), amount).alias("late_value"),
        r.count_where(~F.col("is_paid")).alias("unpaid_invoices"),
        r.sum_where(~F.col("is_paid"), amount).alias("unpaid_value"),
    )
    sums = ["late_invoices", "late_value", "unpaid_invoices", "unpaid_value"]
    return (
        per_supplier.join(regions.select("supplier_id", "region"), "supplier_id")
        .groupBy("region")
        .agg(*[F.sum(c).alias(c) for c in sums])
    )


def region_ranking(totals):
    """Regions by unpaid invoices, most first, with a band on their number."""
    band = (
        F.when(F.col("unpaid_invoices") > fv.REGION_CRITICAL, "CRITICAL")
        .when(F.col("unpaid_invoices") > fv.REGION_WATCH, "WATCH")
        .otherwise("LOW")
    )
    return totals.withColumn("unpaid_band", band).orderBy(F.desc("unpaid_invoices"), "region")


def benchmark_gap(invoices):
    """Late rate minus each external benchmark, one row per benchmark; no gap where it counts something else."""
    entries = [
        F.struct(F.lit(name).alias("benchmark"), F.lit(rate).alias("benchmark_rate"))
        for name, rate in fv.BENCHMARK_RATES.items()
    ]
    return (
        invoices.agg(late_rate().alias("late_rate"))
        .select("late_rate", F.inline(F.array(*entries)))
        .withColumn("comparable", ~F.col("benchmark").isin(fv.NOT_COMPARABLE))
        .withColumn("gap", F.when(F.col("comparable"), F.col("late_rate") - F.col("benchmark_rate")))
    )


def prime_rates(spark):
    """The published rates, a fixed 18 rows."""
    return spark.createDataFrame(list(fv.PRIME_RATES.items()), "year_month string, table_rate double")


def with_prime_rate(monthly, rates, month="year_month"):
    """Join a rate to every month. Months before the table take its default, later gaps stay null."""
    first = min(fv.PRIME_RATES)
    dimension = F.broadcast(rates.withColumnRenamed("year_month", month))
    return (
        monthly.join(dimension, month, "left")
        .withColumn(
            "prime_rate",
            F.when(F.col(month) < first, fv.PRIME_RATE_BEFORE_TABLE).otherwise(F.col("table_rate")),
        )
        .drop("table_rate")
    )


def prime_rate_join(invoices, rates):
    """Monthly spend and late rate next to the prime rate."""
    monthly = monthly_totals(invoices).select(
        r.month_key("month").alias("year_month"),
        "invoice_count",
        "total_spend",
        "late_count",
        "late_rate",
    )
    return with_prime_rate(monthly, rates)


def late_vs_prime(invoices, rates):
    """Pearson correlation of late rate and prime rate over the months, with its reading.

    No value unless more than three months have a rate.
    """
    joined = prime_rate_join(invoices, rates)
    c = F.col("correlation")
    label = (
        F.when(c > fv.CORRELATION_NOTABLE, "positively")
        .when(c < -fv.CORRELATION_NOTABLE, "negatively")
        .when(c.isNotNull(), "weak")
    )
    return joined.agg(
        F.count("prime_rate").alias("months"),
        F.when(F.count("prime_rate") > 3, F.corr("late_rate", "prime_rate")).alias("correlation"),
    ).withColumn("reading", label)


def per_invoice_late_cost(invoices, rates):
    """Implicit financing cost of each late invoice: amount x rate / 365 x days late.

    The rate is that of the invoice month, from the fixed table.
    """
    late = invoices.where(F.col("is_late")).withColumn("year_month", r.month_key("invoice_date"))
    rated = with_prime_rate(late, rates)
    # Exact product of amount, percent and days; one division by 365 days x 100 percent at the end.
    product = F.col("amount_incl_vat") * F.col("prime_rate").cast("decimal(5,2)") * F.col("days_past_due")
    return rated.select(
        "invoice_id",
        "supplier_id",
        "amount_incl_vat",
        "days_past_due",
        "prime_rate",
        (product.cast("double") / 36500).alias("late_cost"),
    )


def vat_effective_rate(invoices):
    """Effective tax share against 15/115, and tax that is claimable or at risk."""
    totals = invoices.agg(
        F.sum("vat_amount").alias("total_vat"),
        F.sum("amount_incl_vat").alias("total_incl"),
        F.coalesce(F.sum(F.when(~mismatch(), F.col("vat_amount"))), F.lit(0))
        .cast("decimal(28,2)")
        .alias("claimable_vat"),
    )
    return totals.withColumn(
        "vat_at_risk", (F.col("total_vat") - F.col("claimable_vat")).cast("decimal(28,2)")
    ).withColumns(
        {
            "vat_share": r.share("total_vat", "total_incl"),
            "theoretical_share": F.lit(fv.VAT_SHARE_OF_INCL),
            "claimable_share": F.coalesce(r.share("claimable_vat", "total_vat"), F.lit(0.0)),
        }
    )


def vat_by_category(invoices):
    """Tax share, mismatches and claimable tax per category."""
    grouped = (
        invoices.where(F.col("category").isNotNull())
        .groupBy("category")
        .agg(
            F.sum("vat_amount").alias("total_vat"),
            F.sum("amount_incl_vat").alias("total_incl"),
            r.share(F.sum("vat_amount"), F.sum("amount_incl_vat")).alias("vat_share"),
            r.share(r.count_where(mismatch()), F.count("*")).alias("mismatch_rate"),
            F.coalesce(F.sum(F.when(~mismatch(), F.col("vat_amount"))), F.lit(0))
            .cast("decimal(28,2)")
            .alias("claimable_vat"),
        )
    )
    gap = F.abs(F.col("vat_share") - fv.VAT_SHARE_OF_INCL)
    return (
        grouped.withColumn(
            "vat_at_risk", (F.col("total_vat") - F.col("claimable_vat")).cast("decimal(28,2)")
        )
        .withColumn("deviates", gap > fv.VAT_SHARE_DEVIATION)
        .orderBy(F.desc("vat_share"), "category")
    )


def rag_scorecard(invoices):
    """Six KPIs with their rating and distance to best practice.

    Late rate and unpaid age are rated amber and the yearly trend red by rule, whatever their value.
    """
    # Days past due have few distinct values, so the exact median keeps a small state.
    row = invoices.agg(
        late_rate().alias("late"),
        F.percentile(F.when(F.col("is_late"), F.col("days_past_due")), 0.5).alias("age"),
        r.share(F.sum("vat_amount"), F.sum("amount_incl_vat")).alias("vat"),
        r.share(r.count_where(mismatch()), F.count("*")).alias("wrong"),
        compliance_rate().alias("ok"),
    )
    nothing = F.lit(None).cast("double")
    late, vat, wrong, ok = F.col("late"), F.col("vat"), F.col("wrong"), F.col("ok")
    vat_gap = vat - fv.VAT_SHARE_OF_INCL
    vat_rag = F.when(F.abs(vat_gap) < fv.RAG_VAT_SHARE_BAND, "GREEN").otherwise("AMBER")
    wrong_rag = (
        F.when(wrong > fv.RAG_MISMATCH_RED, "RED")
        .when(wrong > fv.RAG_MISMATCH_AMBER, "AMBER")
        .otherwise("GREEN")
    )
    ok_rag = (
        F.when(ok > fv.RAG_COMPLIANCE_GREEN, "GREEN")
        .when(ok > fv.RAG_COMPLIANCE_AMBER, "AMBER")
        .when(ok > 0, "RED")
        .otherwise("GREY")
    )
    best_late = fv.BEST_PRACTICE_LATE_RATE
    lines = [
        (late, F.lit(best_late), F.lit("AMBER"), late - best_late),
        (F.col("age"), F.lit(0.0), F.lit("AMBER"), nothing),
        (nothing, nothing, F.lit("RED"), nothing),
        (vat, F.lit(fv.VAT_SHARE_OF_INCL), vat_rag, vat_gap),
        (
            wrong,
            F.lit(fv.RAG_MISMATCH_AMBER),
            wrong_rag,
            wrong - fv.RAG_MISMATCH_AMBER,
        ),
        (
            ok,
            F.lit(fv.RAG_COMPLIANCE_GREEN),
            ok_rag,
            F.when(ok > 0, ok - fv.RAG_COMPLIANCE_GREEN),
        ),
    ]
    entries = [
        F.struct(
            F.lit(kpi).alias("kpi"),
            internal.alias("internal_value"),
            best.alias("best_practice"),
            rag.alias("rag"),
            gap.alias("gap_vs_best"),
        )
        for kpi, (internal, best, rag, gap) in zip(fv.KPI_NAMES, lines)
    ]
    return row.select(F.inline(F.array(*entries)))


def financing_cost(invoices):
    """Late spend against the best-practice target, and its implicit yearly financing cost."""
    late_spend = r.sum_where(F.col("is_late"), "amount_incl_vat")
    days = F.when(F.col("is_late"), F.col("days_past_due"))
    row = invoices.agg(
        late_spend.alias("late_spend"),
        F.sum("amount_incl_vat").alias("total_spend"),
        r.share(F.sum(days), F.count(days)).alias("avg_days_late"),
    )
    target = F.col("total_spend").cast("double") * fv.BEST_PRACTICE_LATE_RATE
    monthly_rate = float(fv.FINANCING_RATE) / 12
    spend = F.col("late_spend").cast("double")
    return row.select(
        "late_spend",
        target.alias("target_late_spend"),
        (spend - target).alias("improvement_gap"),
        "avg_days_late",
        (spend * monthly_rate * (F.col("avg_days_late") / 30)).alias("estimated_cost"),
    )
