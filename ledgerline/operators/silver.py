"""Silver layer: typed, cleaned tables. One projection and one filter each, no shuffle.

``keep`` names further columns of the raw table to carry along.
"""

from pyspark.sql import functions as F

from ledgerline.functions import rules as r

AUDIT_COLUMNS = ["silver_loaded_at", "dbt_run_id"]


def is_positive(df, name):
    """Positive amount; text is read as a number first, a typed column is compared as it is."""
    c = F.col(name)
    return (c.cast("double") if df.schema[name].dataType.typeName() == "string" else c) > 0


def silver_invoices(raw, run_id="", keep=()):
    """Clean invoices: bad dates and rejected amounts become null, statuses are standardised.

    Rows without an id, a supplier or a positive gross amount are dropped. The filter reads the raw
    gross amount, so an amount that only rounds to zero stays, as a null.
    """
    kept = raw.where(
        F.col("invoice_id").isNotNull()
        & F.col("supplier_id").isNotNull()
        & is_positive(raw, "amount_incl_vat")
    )
    return kept.select(
        "invoice_id",
        "supplier_id",
        r.safe_date("invoice_date").alias("invoice_date"),
        r.safe_date("due_date").alias("due_date"),
        r.safe_date("payment_date").alias("payment_date"),
        r.positive_money("amount_excl_vat").alias("amount_excl_vat"),
        r.positive_money("vat_amount", allow_zero=True).alias("vat_amount"),
        r.positive_money("amount_incl_vat").alias("amount_incl_vat"),
        r.vat_status("amount_excl_vat", "vat_amount").alias("vat_validation_status"),
        "currency",
        "category",
        r.positive_terms("payment_terms_days").alias("payment_terms_days"),
        F.col("days_past_due").cast("int").alias("days_past_due"),
        F.col("is_late").cast("boolean").alias("is_late"),
        F.col("is_paid").cast("boolean").alias("is_paid"),
        r.normalise_status("invoice_status").alias("invoice_status"),
        F.current_timestamp().alias("silver_loaded_at"),
        F.lit(run_id).alias("dbt_run_id"),
        *keep,
    )


def silver_suppliers(raw, keep=()):
    kept = raw.where(F.col("supplier_id").isNotNull() & F.col("supplier_name").isNotNull())
    return kept.select(
        "supplier_id",
        r.upper_trim("supplier_name").alias("supplier_name"),
        "cipc_number",
        "vat_number",
        r.upper_trim("category").alias("category"),
        F.col("payment_terms_days").cast("int").alias("payment_terms_days"),
        r.money("avg_invoice_value_zar").alias("avg_invoice_value_zar"),
        F.col("late_payment_probability").cast("decimal(6,4)").alias("late_payment_probability"),
        r.lower_trim("email").alias("email"),
        F.trim("city").alias("city"),
        r.safe_timestamp("created_at").alias("created_at"),
        F.current_timestamp().alias("silver_loaded_at"),
        *keep,
    )


def silver_bank_transactions(raw, keep=()):
    """Clean ledger lines. The filter tests the raw date text, so an unreadable date stays as null."""
    kept = raw.where(
        F.col("transaction_id").isNotNull()
        & F.col("transaction_date").isNotNull()
        & (is_positive(raw, "debit_amount") | is_positive(raw, "credit_amount"))
    )
    return kept.select(
        "transaction_id",
        r.safe_date("transaction_date").alias("transaction_date"),
        F.trim("description").alias("description"),
        r.money("debit_amount").alias("debit_amount"),
        r.money("credit_amount").alias("credit_amount"),
        r.money("balance_impact").alias("balance_impact"),
        r.upper_trim("category").alias("category"),
        "invoice_reference",
        F.col("reconciled").cast("boolean").alias("reconciled"),
        F.current_timestamp().alias("silver_loaded_at"),
        *keep,
    )


def without_audit(df):
    return df.drop(*AUDIT_COLUMNS)
