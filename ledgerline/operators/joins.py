"""Joins between invoices, suppliers and the ledger."""

from pyspark.sql import functions as F

from ledgerline.functions import rules as r


def pick_column(df, *candidates):
    """First of the candidate names the table has, resolved when the plan is built."""
    for name in candidates:
        if name in df.columns:
            return F.col(name)
    raise ValueError(f"none of {candidates} in {df.columns}")


def invoices_with_supplier(invoices, suppliers):
    """Left join of invoices to the master; shared names keep the invoice value.

    The supplier's own category and terms come along as ``supplier_category`` and
    ``supplier_payment_terms_days``. No hint: Spark broadcasts the master if its size allows, else
    the adaptive plan splits a hot supplier's invoices over tasks.
    """
    taken = set(invoices.columns) - {"supplier_id"}
    renamed = suppliers.drop("silver_loaded_at").select(
        "supplier_id",
        *[
            F.col(c).alias(f"supplier_{c}" if c in taken else c)
            for c in suppliers.columns
            if c not in ("supplier_id", "silver_loaded_at")
        ],
    )
    return invoices.join(renamed, "supplier_id", "left")


def merge_integrity(invoices, suppliers):
    """Row counts of a full merge: in both, only in invoices, only in suppliers.

    Both sides collapse to one row per supplier first, so a hot supplier costs nothing in the join.
    """
    left = invoices.groupBy("supplier_id").agg(F.count("*").alias("n_left"))
    right = suppliers.groupBy("supplier_id").agg(F.count("*").alias("n_right"))
    merged = left.join(right, "supplier_id", "full").select(
        F.when(F.col("n_right").isNull(), "left_only")
        .when(F.col("n_left").isNull(), "right_only")
        .otherwise("both")
        .alias("merge_status"),
        (F.coalesce("n_left", F.lit(1)) * F.coalesce("n_right", F.lit(1))).alias("rows"),
    )
    counted = merged.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("merge_status") == s, F.col("rows"))), F.lit(0)).alias(s)
            for s in ("both", "left_only", "right_only")
        ]
    )
    return counted.select(
        "both",
        "left_only",
        "right_only",
        (F.col("left_only") == 0).alias("no_orphan_invoices"),
        (F.col("right_only") == 0).alias("no_unused_suppliers"),
    )


def spread_key(key, row_id):
    """Join key in which rows without a reference get a key of their own.

    A null key matches nothing but would still send all those rows to one task.
    """
    return F.coalesce(F.col(key), F.concat(F.lit("no reference: "), F.col(row_id)))


def join_by_reference(bank, invoices, columns):
    """Ledger lines with the given invoice columns, joined on the line's invoice reference."""
    right = invoices.select(F.col("invoice_id").alias("_reference"), *columns)
    left = bank.withColumn("_reference", spread_key("invoice_reference", "transaction_id"))
    return left.join(right, "_reference", "left").drop("_reference")


def recon_by_reference(bank, invoices):
    """Lines whose reference names an invoice, and the rest, per ledger category."""
    known = invoices.select("invoice_id").distinct().withColumn("_found", F.lit(True))
    flagged = join_by_reference(bank, known, ["_found"])
    return flagged.groupBy("category").agg(
        F.count("*").alias("total"),
        r.count_where("_found").alias("matched"),
        r.count_where(F.col("_found").isNull()).alias("unmatched"),
    )


def unmatched_by_reference(bank, invoices):
    """Anti join: lines whose reference names no invoice, or that have none. The ledger is read once."""
    lines = bank.withColumn("_reference", spread_key("invoice_reference", "transaction_id"))
    known = invoices.select(F.col("invoice_id").alias("_id"))
    # the second condition keeps a key made up for a missing reference from naming an invoice
    named = (F.col("_reference") == F.col("_id")) & (F.col("invoice_reference") == F.col("_id"))
    return lines.join(known, named, "left_anti").drop("_reference")


def matched_by_reference(bank, invoices):
    """Semi join: lines whose reference names an invoice."""
    return bank.join(
        invoices.select(F.col("invoice_id").alias("invoice_reference")),
        "invoice_reference",
        "left_semi",
    )


def audit_log(bank, invoices):
    """Ledger lines with their invoice and the state of the match."""
    joined = join_by_reference(bank, invoices, ["invoice_id", "supplier_id", "amount_incl_vat"])
    difference = (F.col("debit_amount") - F.col("amount_incl_vat")).cast(r.MONEY)
    state = (
        F.when(F.col("invoice_reference").isNull(), "NO_REFERENCE")
        .when(F.col("invoice_id").isNull(), "MISSING_INVOICE")
        .when(difference == 0, "MATCHED")
        .otherwise("AMOUNT_DIFFERS")
    )
    return joined.select(
        "transaction_id",
        "transaction_date",
        "description",
        "debit_amount",
        "credit_amount",
        "invoice_reference",
        "supplier_id",
        F.col("amount_incl_vat").alias("invoice_amount"),
        difference.alias("difference"),
        "reconciled",
        state.alias("match_status"),
    )
