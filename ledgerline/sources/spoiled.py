"""The bound raw tables with faults put in by rule, so that every check and join state has both outcomes.

The rule is the order number (invoices, ledger) or supplier number modulo a small number; each remainder has one fault.
"""

from pyspark.sql import functions as F

from ledgerline.sources import binding

#: First number of an invoice id, modulo 40: the order number, or what follows it in the id where that is null.
ORDER_REST = "pmod(coalesce(l_orderkey, l_linenumber, l_partkey, l_suppkey, int(l_quantity)), 40)"


def raw_invoices(spark, sf_dir, as_of=binding.AS_OF):
    clean = binding.raw_invoices(spark, sf_dir, as_of, extra={"k": "pmod(l_orderkey, 40)"})
    k = F.col("k")
    twice = clean.withColumn("copy", F.explode(F.when(k == 7, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    changed = {
        "invoice_id": F.when(k != 13, F.col("invoice_id")),
        "supplier_id": F.when(k == 0, F.concat(F.lit("X"), "supplier_id")).when(k != 5, F.col("supplier_id")),
        "currency": F.when(k == 1, "USD").when(k != 8, F.col("currency")),
        "due_date": F.when(k == 2, F.date_sub("invoice_date", 1)).otherwise(F.col("due_date")),
        "invoice_status": F.when(k == 3, "Void").when(k != 6, F.col("invoice_status")),
        "amount_incl_vat": F.when(k == 4, -F.col("amount_incl_vat"))
        .when(k == 16, F.col("amount_incl_vat") + 1)
        .otherwise(F.col("amount_incl_vat"))
        .cast("decimal(18,2)"),
        "invoice_date": F.when(k == 15, F.lit("2030-01-01").cast("date")).when(k != 9, F.col("invoice_date")),
    }
    return twice.select(*[changed.get(c, F.col(c)).alias(c) for c in clean.columns if c != "k"])


def raw_suppliers(spark, sf_dir):
    """One supplier in twenty is missing, one is known under another id, and some have faulty numbers or terms."""
    clean = binding.raw_suppliers(spark, sf_dir).withColumn("k", F.pmod(F.col("supplier_id").cast("bigint"), F.lit(20)))
    k = F.col("k")
    changed = {
        "supplier_id": F.when(k == 9, F.concat(F.lit("U"), "supplier_id")).otherwise(F.col("supplier_id")),
        "cipc_number": F.when(k == 3, "BAD").otherwise(F.col("cipc_number")),
        "vat_number": F.when(k == 4, "999").otherwise(F.col("vat_number")),
        "payment_terms_days": F.when(k == 5, 45).otherwise(F.col("payment_terms_days")),
        "supplier_name": F.when(k != 6, F.col("supplier_name")),
    }
    return clean.where(k != 7).select(*[changed.get(c, F.col(c)).alias(c) for c in clean.columns if c != "k"])


def raw_bank_transactions(spark, sf_dir, as_of=binding.AS_OF):
    """Payments with a lost or unknown reference, or another amount than the invoice; dates that are missing."""
    clean = binding.raw_bank_transactions(spark, sf_dir, as_of, extra={"k": ORDER_REST})
    k = F.coalesce("k", F.lit(-1))
    changed = {
        "invoice_reference": F.when(k == 10, F.concat(F.lit("GONE-"), "invoice_reference")).when(
            k != 12, F.col("invoice_reference")
        ),
        "reconciled": F.when(k.isin(10, 12), False).otherwise(F.col("reconciled")),
        "debit_amount": F.when(k == 11, F.col("debit_amount") + 5)
        .otherwise(F.col("debit_amount"))
        .cast("decimal(18,2)"),
        "transaction_date": F.when(k != 14, F.col("transaction_date")),
    }
    return clean.select(*[changed.get(c, F.col(c)).alias(c) for c in clean.columns if c != "k"])


#: Days after the first payment of a bill on which it is paid again, by order number modulo 40.
PAID_AGAIN = {3: [0], 17: [2], 23: [10], 29: [1, 2], 31: [-3]}


def raw_double_payments(spark, sf_dir, as_of=binding.AS_OF):
    """The clean ledger with some invoices paid again: on the day, inside and outside the tolerance, and three times."""
    clean = binding.raw_bank_transactions(spark, sf_dir, as_of, extra={"k": ORDER_REST})
    shifts = F.lit(None).cast("array<int>")
    for k, days in PAID_AGAIN.items():
        shifts = F.when(F.col("k") == k, F.array(*[F.lit(d) for d in [0, *days]])).otherwise(shifts)
    copies = clean.select("*", F.posexplode(F.coalesce(shifts, F.array(F.lit(0)))).alias("copy", "shift"))
    again = F.when(F.col("copy") > 0, F.concat("transaction_id", F.lit("/"), "copy")).otherwise(F.col("transaction_id"))
    changed = {
        "transaction_id": again,
        "transaction_date": F.date_add("transaction_date", F.col("shift")),
    }
    return copies.select(*[changed.get(c, F.col(c)).alias(c) for c in clean.columns if c != "k"])


def raw_patterned_invoices(spark, sf_dir, as_of=binding.AS_OF):
    """The clean invoices with a pattern to learn: suppliers of three categories always pay late, of five never."""
    clean = binding.raw_invoices(spark, sf_dir, as_of)
    k = F.pmod(F.col("supplier_id").cast("bigint"), F.lit(10))
    coin = F.pmod(F.crc32("invoice_id"), F.lit(2)) == 0
    late = F.col("is_paid") & ((k < 3) | ((k < 5) & coin))
    return clean.withColumn("is_late", late)
