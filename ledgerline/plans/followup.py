"""Follow-up reports: history checks, rankings, escalation, alerts, exceptions, snapshots."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.functions import fixed_values as fv
from ledgerline.functions import rules as r
from ledgerline.operators.joins import unmatched_by_reference
from ledgerline.operators.ranking import rank_by_cells
from ledgerline.operators.reconcile import flag_lines
from ledgerline.plans.explore import payment_delay
from ledgerline.plans.operations import overdue_by_category


def history_reached(invoices, minimum=fv.MIN_PRIOR_INVOICES):
    """Per supplier, the first day by whose end it had ``minimum`` invoices; null if never.

    The running count is over (supplier, day) counts, so a hot supplier is a few thousand rows.
    """
    daily = invoices.groupBy("supplier_id", "invoice_date").agg(F.count("*").alias("n"))
    so_far = F.sum("n").over(
        Window.partitionBy("supplier_id")
        .orderBy("invoice_date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    reached = F.when(F.col("so_far") >= minimum, F.col("invoice_date"))
    return (
        daily.where("invoice_date is not null")
        .withColumn("so_far", so_far)
        .groupBy("supplier_id")
        .agg(F.min(reached).alias("history_from"))
    )


def insufficient_history(open_invoices, history, minimum=fv.MIN_PRIOR_INVOICES):
    """Open invoices with a flag: fewer than ``minimum`` invoices of the supplier on earlier days."""
    known = history_reached(history, minimum)
    enough = F.col("invoice_date") > F.col("history_from")
    return open_invoices.join(known, "supplier_id", "left").select(
        "invoice_id",
        "supplier_id",
        "invoice_date",
        (~F.coalesce(enough, F.lit(False))).alias("insufficient_history"),
    )


def risk_ranked_open_invoices(open_invoices, risk="late_payment_probability"):
    """Open invoices with their rank by risk, then amount; equal ones share a rank.

    A missing probability counts as 0, a missing amount comes last among equals.

    The order is by the probability as it is. Its first 16 bits are the coarsest level, so at most
    65,537 totals meet in one task.
    """
    probability = F.coalesce(F.col(risk).cast("double"), F.lit(0.0))
    amount = F.coalesce("amount_incl_vat", F.lit(0)).cast(r.MONEY)
    levels = {
        "_step": -F.least(F.greatest(F.floor(probability * 2**16), F.lit(0)), F.lit(2**16)),
        "_risk": -probability,
        "_hundreds": -F.floor(amount.cast("bigint") / 100),
        "_amount": -amount,
    }
    ranked = rank_by_cells(open_invoices, levels, rank_name="risk_rank")
    return ranked.select(
        "invoice_id", "supplier_id", "due_date", "amount_incl_vat", risk, "risk_rank"
    )


def rolling_compliance_90d(invoices, days=90):
    """Compliance over the last ``days`` days per supplier, one row per supplier and payment day.

    Payments collapse to (supplier, day) counts before the window.
    """
    within = F.col("days_delta") <= fv.ON_TIME_UP_TO_DAYS
    daily = (
        payment_delay(invoices)
        .groupBy("supplier_id", "payment_date")
        .agg(F.count("*").alias("n"), r.count_where(within).alias("ok"))
    )
    day = F.datediff("payment_date", F.lit("1970-01-01").cast("date"))
    span = Window.partitionBy("supplier_id").orderBy("_day").rangeBetween(-(days - 1), 0)
    return (
        daily.withColumn("_day", day)
        .withColumns({"paid_in_window": F.sum("n").over(span), "compliant": F.sum("ok").over(span)})
        .select(
            "supplier_id",
            "payment_date",
            "paid_in_window",
            "compliant",
            r.share("compliant", "paid_in_window").alias("compliance_rate"),
        )
    )


def unreconciled_exceptions(
    bank,
    invoices,
    as_of,
    amount="debit_amount",
    min_amount=fv.EXCEPTION_MIN_AMOUNT,
    max_business_days=fv.EXCEPTION_BUSINESS_DAYS,
    by_tolerance=False,
):
    """Ledger lines above an amount that stay unreconciled for more than some business days.

    A line counts as explained if it is marked as reconciled, or if its reference names an invoice; with
    ``by_tolerance``, if a paid invoice lies near it in days and amount.
    """
    waiting = r.business_days_between("transaction_date", F.lit(as_of).cast("date"))
    open_lines = bank.where((F.col(amount) > F.lit(min_amount)) & ~F.coalesce("reconciled", F.lit(False)))
    if by_tolerance:
        as_debits = open_lines.withColumn("_debit", F.col("debit_amount")).withColumn("debit_amount", F.col(amount))
        unexplained = flag_lines(as_debits, invoices).where(~F.col("matched"))
        unexplained = unexplained.withColumn("debit_amount", F.col("_debit")).drop("_debit", "matched")
    else:
        unexplained = unmatched_by_reference(open_lines, invoices)
    return (
        unexplained.withColumn("business_days_open", waiting)
        .where(F.col("business_days_open") > max_business_days)
        .select(
            "transaction_id",
            "transaction_date",
            "description",
            F.col(amount).alias("amount"),
            "reconciled",
            "business_days_open",
        )
    )


def escalation_tier(invoices, as_of):
    """Action per unpaid invoice by days past due, with an alert for late ones in deep categories.

    A category is high-risk when the median of its overdue days is above the high threshold.
    """
    past_due = F.datediff(F.lit(as_of).cast("date"), F.col("due_date"))
    action = (
        F.when(F.col("days_over") >= fv.ESCALATE_MANAGEMENT_DAYS, "MANAGEMENT_REVIEW")
        .when(F.col("days_over") >= fv.ESCALATE_ACCOUNT_MANAGER_DAYS, "ACCOUNT_MANAGER")
        .when(F.col("days_over") >= 0, "REMINDER")
        .otherwise("NOT_DUE")
    )
    deep = (
        overdue_by_category(invoices)
        .where("overdue_band = 'HIGH'")
        .select("category", F.lit(True).alias("_deep"))
    )
    alert = (F.col("days_over") > fv.ESCALATE_ALERT_DAYS) & F.coalesce("_deep", F.lit(False))
    return (
        invoices.where(~F.col("is_paid"))
        .withColumn("days_over", past_due)
        .join(deep, "category", "left")
        .select(
            "invoice_id",
            "supplier_id",
            "category",
            "due_date",
            "amount_incl_vat",
            "days_over",
            action.alias("escalation"),
            F.coalesce(alert, F.lit(False)).alias("alert"),
        )
    )


def due_soon_alert(invoices, as_of, days=fv.DUE_SOON_DAYS, limit=fv.DUE_SOON_SHARE):
    """Share of unpaid invoices due within some days; an alert when it is above the limit."""
    ahead = F.datediff("due_date", F.lit(as_of).cast("date"))
    soon = ahead.between(0, days)
    return (
        invoices.where(~F.col("is_paid"))
        .agg(
            F.count("*").alias("outstanding"),
            r.count_where(soon).alias("due_soon"),
            r.share(r.count_where(soon), F.count("*")).alias("due_soon_share"),
        )
        .withColumn("alert", F.coalesce(F.col("due_soon_share") > limit, F.lit(False)))
    )


def log_scale_outliers(invoices, limit=3.0):
    """Invoices more than ``limit`` deviations from their category's mean on the log scale.

    The statistics have one row per category. While they are below the broadcast threshold, invoices
    are not shuffled.
    """
    logged = invoices.where("amount_incl_vat is not null and category is not null").withColumn(
        "log_amount", F.log1p(F.col("amount_incl_vat").cast("double"))
    )
    stats = logged.groupBy("category").agg(
        F.avg("log_amount").alias("_mean"), F.stddev_samp("log_amount").alias("_std")
    )
    z = (F.col("log_amount") - F.col("_mean")) / F.nullif(F.col("_std"), F.lit(0.0))
    return (
        logged.join(stats, "category")
        .withColumn("z_score", z)
        .where(F.abs("z_score") > limit)
        .select("invoice_id", "category", "amount_incl_vat", "z_score")
    )


def snapshot_diff(before, after, key):
    """Rows added, removed, changed or unchanged between two snapshots of a table, by key.

    Only the key and sums of row hashes are shuffled. The hashes are over named fields, so a value that
    moves from one column to another counts as a change. Rows that share a key are one entry: it is unchanged if
    both sides have the same rows, each as often. A null key is a key like any other.
    """

    def digests(df, name):
        columns = [c for c in sorted(df.columns) if c not in (key, "ingested_date")]
        row = F.to_json(F.struct(*columns))
        # order-free and additive, so partial sums travel; decimals, because sums of 64-bit hashes overflow
        sums = [F.sum(F.xxhash64(F.lit(seed), row).cast("decimal(38,0)")) for seed in (1, 2)]
        return df.groupBy(F.col(key).alias(f"{name}_key")).agg(F.struct(F.count("*"), *sums).alias(name))

    old, new = digests(before, "_old"), digests(after, "_new")
    joined = old.join(new, F.col("_old_key").eqNullSafe(F.col("_new_key")), "full").withColumn(
        key, F.coalesce("_old_key", "_new_key")
    )
    return joined.select(
        key,
        F.when(F.col("_old").isNull(), "ADDED")
        .when(F.col("_new").isNull(), "REMOVED")
        .when(F.col("_old") == F.col("_new"), "UNCHANGED")
        .otherwise("CHANGED")
        .alias("change"),
    )


def snapshot_changes(before, after, key):
    """How many rows changed in which way."""
    return snapshot_diff(before, after, key).groupBy("change").agg(F.count("*").alias("rows"))
