"""Operational reports: overdue depth, payment terms, tax mismatches."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.functions import fixed_values as fv
from ledgerline.functions import rules as r
from ledgerline.plans.explore import payment_delay

# Days have few distinct values, so their exact percentiles are taken over (group, days) counts:
# the state is one entry per distinct day, however many invoices there are.


def day_counts(df, days, *group_cols):
    return df.groupBy(*group_cols, F.col(days).alias("days")).agg(F.count("*").alias("n"))


def day_percentile(p):
    return F.percentile("days", p, F.col("n"))


def mean_days():
    return r.share(F.sum(F.col("days").cast("long") * F.col("n")), F.sum("n"))


def overdue_summary(invoices):
    """Invoices past due: count, share of all, median, 90th percentile and maximum."""
    counts = day_counts(invoices, "days_past_due")
    late = F.col("days") > 0
    weight = F.when(late, F.col("n")).otherwise(0)
    return counts.withColumn("weight", weight).agg(
        F.sum("weight").alias("overdue_invoices"),
        r.share(F.sum("weight"), F.sum("n")).alias("overdue_share"),
        F.percentile("days", 0.5, F.col("weight")).alias("median_days"),
        F.percentile("days", 0.9, F.col("weight")).alias("p90_days"),
        F.max(F.when(late, F.col("days"))).alias("max_days"),
    )


def overdue_day_counts(invoices):
    overdue = invoices.where((F.col("days_past_due") > 0) & F.col("category").isNotNull())
    return day_counts(overdue, "days_past_due", "category")


def overdue_by_category(invoices):
    """Depth of the overdue queue per category, one decimal, with a band on the median."""
    grouped = overdue_day_counts(invoices).groupBy("category").agg(
        F.round(day_percentile(0.5), 1).alias("median_days"),
        F.round(mean_days(), 1).alias("mean_days"),
        F.max("days").alias("max_days"),
        F.sum("n").alias("overdue_invoices"),
    )
    depth = r.band("median_days", fv.OVERDUE_DAYS_HIGH, fv.OVERDUE_DAYS_MEDIUM)
    return grouped.withColumn("overdue_band", depth).orderBy(F.desc("median_days"), "category")


def overdue_boxplot(invoices):
    """Quartiles, whiskers at 1.5 interquartile ranges and outliers per category.

    Everything after the first aggregate runs over (category, days) counts.
    """
    counts = overdue_day_counts(invoices)
    quartiles = counts.groupBy("category").agg(
        day_percentile(0.25).alias("q1"),
        day_percentile(0.5).alias("median"),
        day_percentile(0.75).alias("q3"),
    )
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = F.col("days").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        counts.join(quartiles, "category")
        .groupBy("category", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("days"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("days"))).alias("whisker_high"),
            F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("outliers"),
        )
    )


def terms_compliance(invoices):
    """Early, on-time and late payments; median and mean difference to the terms on every row."""
    counts = day_counts(payment_delay(invoices).where("days_delta is not null"), "days_delta")
    everything = Window.partitionBy()
    return (
        counts.withColumns(
            {
                "total": F.sum("n").over(everything),
                "median_days_delta": day_percentile(0.5).over(everything),
                "mean_days_delta": r.share(
                    F.sum(F.col("days").cast("long") * F.col("n")).over(everything),
                    F.sum("n").over(everything),
                ),
            }
        )
        .groupBy(
            r.compliance_class("days").alias("compliance_status"),
            "total",
            "median_days_delta",
            "mean_days_delta",
        )
        .agg(F.sum("n").alias("invoices"))
        .select(
            "compliance_status",
            "invoices",
            r.share("invoices", "total").alias("share"),
            "median_days_delta",
            "mean_days_delta",
        )
    )


COMPLIANCE_CLASSES = ["Late", "On-time", "Early"]


def compliance_by_category(invoices):
    """Share of each compliance class per category, classes as columns."""
    classed = (
        payment_delay(invoices)
        .where(F.col("category").isNotNull())
        .withColumn("compliance_status", r.compliance_class("days_delta"))
    )
    pivoted = (
        classed.groupBy("category").pivot("compliance_status", COMPLIANCE_CLASSES).count().fillna(0)
    )
    total = F.col("Late") + F.col("On-time") + F.col("Early")
    return pivoted.select("category", *[r.share(c, total).alias(c) for c in COMPLIANCE_CLASSES])


def vat_mismatch_rate(invoices, *group_cols):
    """Invoices whose tax differs from the rounded expectation, overall or per group."""
    wrong = r.vat_mismatch_rounded("amount_excl_vat", "vat_amount")
    return invoices.groupBy(*group_cols).agg(
        F.count("*").alias("invoices"),
        r.count_where(wrong).alias("mismatch_invoices"),
        r.share(r.count_where(wrong), F.count("*")).alias("mismatch_rate"),
    )
