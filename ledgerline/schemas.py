"""Bronze columns as received (all text) and silver types."""

from pyspark.sql import types as T

# The columns of the three delivered files
BRONZE_COLUMNS = {
    "sa_invoices": [
        "invoice_id",
        "supplier_id",
        "invoice_date",
        "due_date",
        "payment_date",
        "amount_excl_vat",
        "vat_amount",
        "amount_incl_vat",
        "currency",
        "category",
        "payment_terms_days",
        "days_past_due",
        "is_late",
        "is_paid",
        "invoice_status",
    ],
    "sa_suppliers": [
        "supplier_id",
        "supplier_name",
        "cipc_number",
        "vat_number",
        "category",
        "payment_terms_days",
        "avg_invoice_value_zar",
        "late_payment_probability",
        "email",
        "city",
        "created_at",
    ],
    "sa_bank_transactions": [
        "transaction_id",
        "transaction_date",
        "description",
        "debit_amount",
        "credit_amount",
        "balance_impact",
        "category",
        "invoice_reference",
        "reconciled",
    ],
}


def bronze_schema(dataset):
    """All-text schema of a known dataset; None for one that is landed but not modelled."""
    columns = BRONZE_COLUMNS.get(dataset)
    if columns is None:
        return None
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])
