"""Invoice life-cycle rules as column logic over plain tables."""

from pyspark.sql import functions as F

from ledgerline.functions import rules as r


def with_lifecycle(invoices, as_of):
    """Add due date, days past due, late flag and raw status.

    Input: invoice_date, payment_terms_days, payment_date (null if unpaid), is_paid and
    paid_after_due. ``as_of`` is a date literal, never the clock.
    """
    day = F.lit(as_of).cast("date")
    dated = invoices.withColumn("due_date", r.derive_due_date("invoice_date", "payment_terms_days"))
    return dated.withColumns(
        {
            "days_past_due": r.derive_days_past_due("due_date", "payment_date", day),
            "is_late": r.derive_is_late("paid_after_due", "is_paid"),
            "invoice_status": r.derive_status("is_paid", "due_date", day),
        }
    ).drop("paid_after_due")


def cashbook(invoices, receipts, keep=()):
    """One ledger: a debit line per paid invoice, a credit line per receipt.

    Line ids come from the source keys, so no counter has to run over all rows. ``receipts`` has
    receipt_id, receipt_date, description, amount, reconciled. ``keep`` names columns of the invoices that come along,
    null on receipts.
    """
    zero = F.lit(0).cast(r.MONEY)
    payments = invoices.where("is_paid").select(
        F.concat(F.lit("PAY-"), "invoice_id").alias("transaction_id"),
        F.col("payment_date").alias("transaction_date"),
        F.concat(F.lit("EFT Payment - "), "invoice_id").alias("description"),
        r.money("amount_incl_vat").alias("debit_amount"),
        zero.alias("credit_amount"),
        (-r.money("amount_incl_vat")).cast(r.MONEY).alias("balance_impact"),
        F.lit("Supplier Payment").alias("category"),
        F.col("invoice_id").alias("invoice_reference"),
        F.lit(True).alias("reconciled"),
        *keep,
    )
    credits = receipts.select(
        F.concat(F.lit("RCV-"), F.col("receipt_id").cast("string")).alias("transaction_id"),
        F.col("receipt_date").alias("transaction_date"),
        "description",
        zero.alias("debit_amount"),
        r.money("amount").alias("credit_amount"),
        r.money("amount").alias("balance_impact"),
        F.lit("Revenue").alias("category"),
        F.lit(None).cast("string").alias("invoice_reference"),
        "reconciled",
        *[F.lit(None).cast(invoices.schema[c].dataType).alias(c) for c in keep],
    )
    return payments.unionByName(credits)
