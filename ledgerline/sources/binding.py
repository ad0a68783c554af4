"""Binding of the supplied star-schema tables to the finance model.

``lineitem`` rows become invoices, ``supplier`` rows the supplier master and ``orders`` rows the
receipts of the ledger. Doubles become whole cents or decimals before any arithmetic. All dates hang on ``AS_OF``.
"""

from pyspark.sql import functions as F

from ledgerline.functions import fixed_values as fv
from ledgerline.functions import rules as r
from ledgerline.operators.lifecycle import cashbook, with_lifecycle

AS_OF = "2001-01-01"


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def category_name(key):
    """One of the fixed categories by key modulo their number."""
    names = F.array(*[F.lit(name) for name in fv.SUPPLIER_CATEGORIES])
    return names[F.pmod(key, F.lit(len(fv.SUPPLIER_CATEGORIES))).cast("int")]


def terms_days(key):
    terms = F.array(*[F.lit(days) for days in fv.PAYMENT_TERMS])
    return terms[F.pmod(key, F.lit(len(fv.PAYMENT_TERMS))).cast("int")]


def amount(cents):
    """Decimal from whole cents: one cheap multiplication, no text in between."""
    return f"cast(cast({cents} as decimal(15,0)) * 0.01BD as {r.MONEY})"


def raw_invoices(spark, sf_dir, as_of=AS_OF, extra=()):
    """Invoices from ``lineitem``, priced in whole cents: numbers on which doubles are exact.

    ``extra`` maps names to expressions over ``lineitem`` that come along.
    """
    extra = dict(extra)
    names = ", ".join(f"'{name}'" for name in fv.SUPPLIER_CATEGORIES)
    terms = ", ".join(str(days) for days in fv.PAYMENT_TERMS)
    priced = table(spark, sf_dir, "lineitem").selectExpr(
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, int(l_quantity)) as invoice_id",
        "string(l_suppkey) as supplier_id",
        "date(l_shipdate) as invoice_date",
        f"array({names})[int(pmod(l_suppkey, {len(fv.SUPPLIER_CATEGORIES)}))] as category",
        f"array({terms})[int(pmod(l_suppkey, {len(fv.PAYMENT_TERMS)}))] as payment_terms_days",
        "l_linestatus = 'F' or l_returnflag <> 'R' as is_paid",
        "int(l_quantity) as quantity",
        "floor((rint(l_extendedprice * 100) * (100 - rint(l_discount * 100)) + 50) / 100) as excl_cents",
        "if(rint(l_tax * 100) >= 8, 14, 15) as tax_percent",
        *[f"{expression} as {name}" for name, expression in extra.items()],
    )
    taxed = priced.selectExpr(
        "*",
        "floor((excl_cents * tax_percent + 50) / 100) as vat_cents",
        "quantity > 40 as paid_after_due",
        "if(is_paid, date_add(invoice_date, payment_terms_days"
        " + if(quantity > 40, quantity - 40, -(quantity % 5 + 1))), null) as payment_date",
    )
    return with_lifecycle(taxed, as_of).selectExpr(
        "invoice_id",
        "supplier_id",
        "invoice_date",
        "due_date",
        "payment_date",
        f"{amount('excl_cents')} as amount_excl_vat",
        f"{amount('vat_cents')} as vat_amount",
        f"{amount('excl_cents + vat_cents')} as amount_incl_vat",
        f"'{fv.CURRENCY}' as currency",
        "category",
        "payment_terms_days",
        "days_past_due",
        "is_late",
        "is_paid",
        "invoice_status",
        *extra,
    )


def raw_suppliers(spark, sf_dir):
    """Supplier master; the nation table has a fixed number of rows, one per country."""
    suppliers = table(spark, sf_dir, "supplier")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    key = F.col("s_suppkey")
    suffixes = F.array(F.lit("07"), F.lit("08"), F.lit("23"))
    average = F.abs(r.money("s_acctbal"))
    return suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
        key.cast("string").alias("supplier_id"),
        F.col("s_name").alias("supplier_name"),
        F.concat_ws(
            "/",
            (F.pmod(key, F.lit(33)) + 1990).cast("string"),
            (key + 100000).cast("string"),
            suffixes[F.pmod(key, F.lit(3)).cast("int")],
        ).alias("cipc_number"),
        F.concat(F.lit(fv.VAT_NUMBER_PREFIX), F.lpad(key.cast("string"), 9, "0")).alias("vat_number"),
        category_name(key).alias("category"),
        terms_days(key).alias("payment_terms_days"),
        average.alias("avg_invoice_value_zar"),
        r.supplier_prior(average, scale=10000).alias("late_payment_probability"),
        F.concat(F.lit(" Accounts."), key.cast("string"), F.lit("@Example.com ")).alias("email"),
        F.col("n_name").alias("city"),
        F.date_add(F.lit("1990-01-01").cast("date"), F.pmod(key, F.lit(1500)).cast("int"))
        .cast("timestamp_ntz")
        .alias("created_at"),
    )


def receipts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_orderkey").alias("receipt_id"),
        F.col("o_orderdate").cast("date").alias("receipt_date"),
        F.lit("Customer payment received").alias("description"),
        r.money("o_totalprice").alias("amount"),
        (F.col("o_orderstatus") != "P").alias("reconciled"),
    )


def raw_bank_transactions(spark, sf_dir, as_of=AS_OF, extra=()):
    """The ledger; ``extra`` as in ``raw_invoices``, null on receipts."""
    return cashbook(raw_invoices(spark, sf_dir, as_of, extra), receipts(spark, sf_dir), keep=list(dict(extra)))


def supplier_regions(spark, sf_dir):
    """Supplier to nation and region, the stand-in for provinces."""
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    return (
        suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").cast("string").alias("supplier_id"),
            F.col("r_name").alias("region"),
            F.col("n_name").alias("nation"),
        )
    )
