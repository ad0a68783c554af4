"""Data-quality checks: one report shape, one pass over a table for all its row checks.

A report has check_name, table, column, severity, rows_checked, failing_rows, status.
"""

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions import fixed_values as fv
from ledgerline.functions import rules as r


@dataclass(frozen=True)
class Check:
    """A row check: ``failing`` is true on rows that break it; null counts as passing."""

    name: str
    column: str
    failing: Column
    severity: str = "error"


def status_of(failing, severity):
    bad = F.when(severity == "warn", "WARN").otherwise("FAIL")
    return F.when(failing == 0, "PASS").otherwise(bad)


def run_checks(df, table, checks):
    """All checks of a table in one aggregate, then one row per check."""
    counts = [r.count_where(c.failing).alias(f"f{i}") for i, c in enumerate(checks)]
    totals = df.agg(F.count("*").alias("rows_checked"), *counts)
    entries = [
        F.struct(
            F.lit(c.name).alias("check_name"),
            F.lit(table).alias("table"),
            F.lit(c.column).alias("column"),
            F.lit(c.severity).alias("severity"),
            F.col("rows_checked"),
            F.col(f"f{i}").alias("failing_rows"),
        )
        for i, c in enumerate(checks)
    ]
    return totals.select(F.inline(F.array(*entries))).withColumn(
        "status", status_of(F.col("failing_rows"), F.col("severity"))
    )


def unique_check(df, table, column, severity="error"):
    """Values that occur more than once count as failing; nulls are left out."""
    values = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return values.agg(
        F.lit("unique").alias("check_name"),
        F.lit(table).alias("table"),
        F.lit(column).alias("column"),
        F.lit(severity).alias("severity"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_checked"),
        r.count_where(F.col("n") > 1).alias("failing_rows"),
    ).withColumn("status", status_of(F.col("failing_rows"), F.col("severity")))


def duplicate_keys(df, column):
    """Values that occur more than once, with their count."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n_records"))
        .where("n_records > 1")
    )


def union_all(reports):
    first, *rest = reports
    for report in rest:
        first = first.unionByName(report)
    return first


def not_null(*columns, severity="error"):
    return [Check("not_null", c, F.col(c).isNull(), severity) for c in columns]


def accepted_values(column, values, severity="error"):
    return Check("accepted_values", column, ~F.col(column).isin(values), severity)


# The columns that the published checks name
NOT_NULL_COLUMNS = {
    "silver_invoices": ["invoice_id", "supplier_id", "invoice_status", "amount_incl_vat"],
    "silver_suppliers": ["supplier_id", "supplier_name"],
    "silver_bank_transactions": ["transaction_id", "transaction_date"],
}


def dq_not_null(tables):
    """``tables`` maps the silver table names to tables."""
    return union_all(
        [run_checks(tables[name], name, not_null(*cols)) for name, cols in NOT_NULL_COLUMNS.items()]
    )


def accepted_value_checks():
    return [
        accepted_values("invoice_status", fv.INVOICE_STATUSES),
        accepted_values("vat_validation_status", fv.VAT_STATUSES),
    ]


def dq_accepted_values(invoices):
    return run_checks(invoices, "silver_invoices", accepted_value_checks())


def dq_unique_warn(invoices, suppliers):
    """The supplier id is a foreign key on invoices, so repeats there only warn, by design."""
    return unique_check(invoices, "silver_invoices", "supplier_id", "warn").unionByName(
        unique_check(suppliers, "silver_suppliers", "supplier_id", "warn")
    )


def currency_check():
    other = F.col("currency").isNull() | (F.col("currency") != fv.CURRENCY)
    return Check("currency_is_zar", "currency", other)


def dq_currency(invoices):
    return run_checks(invoices, "silver_invoices", [currency_check()])


def dq_missing_profile(df):
    """Null count and percent of every column that has any, in one pass."""
    nulls = [r.count_where(F.col(c).isNull()).alias(c) for c in df.columns]
    counted = df.agg(F.count("*").alias("_rows"), *nulls)
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(c).alias("missing_count")) for c in df.columns
    ]
    return (
        counted.select("_rows", F.inline(F.array(*entries)))
        .where("missing_count > 0")
        .select(
            "column",
            "missing_count",
            F.round(F.col("missing_count") * 100 / F.col("_rows"), 2).alias("pct_missing"),
        )
        .orderBy(F.desc("pct_missing"), "column")
    )


def sanity_checks(as_of):
    today = F.lit(as_of).cast("date")
    return [
        Check("negative_amount", "amount_incl_vat", F.col("amount_incl_vat") < 0),
        Check("future_invoice_date", "invoice_date", F.col("invoice_date") > today),
        Check("due_before_issue", "due_date", F.col("due_date") < F.col("invoice_date")),
    ]


def dq_sanity(invoices, as_of):
    return run_checks(invoices, "sa_invoices", sanity_checks(as_of))


def dq_formats(suppliers):
    """Company number and tax number formats; a missing number fails."""
    company = F.col("cipc_number").rlike(fv.COMPANY_NUMBER_PATTERN)
    tax = F.col("vat_number").startswith(fv.VAT_NUMBER_PREFIX) & (
        F.length("vat_number") == fv.VAT_NUMBER_LENGTH
    )
    return run_checks(
        suppliers,
        "sa_suppliers",
        [
            Check("company_number_format", "cipc_number", ~F.coalesce(company, F.lit(False))),
            Check("vat_number_format", "vat_number", ~F.coalesce(tax, F.lit(False))),
        ],
    )


def key_counts(df, key, checks, prefix=""):
    """One row per value of a key: rows (``n``), and rows that break each check (``f0``, ``f1``, ...)."""
    counts = [r.count_where(c.failing).alias(f"{prefix}f{i}") for i, c in enumerate(checks)]
    return df.groupBy(F.col(key).alias(f"{prefix}key")).agg(F.count("*").alias(f"{prefix}n"), *counts)


def key_totals(checks, prefix=""):
    """Totals over key counts: rows, rows with a key, repeated keys, rows that break each check."""

    def total(column):
        return F.coalesce(F.sum(column), F.lit(0).cast("long"))

    n, has_key = F.col(f"{prefix}n"), F.col(f"{prefix}key").isNotNull()
    return [
        total(n).alias(f"{prefix}rows"),
        total(F.when(has_key, n)).alias(f"{prefix}keyed"),
        r.count_where(has_key & (n > 1)).alias(f"{prefix}repeated"),
        *[total(f"{prefix}f{i}").alias(f"{prefix}f{i}") for i in range(len(checks))],
    ]


def key_lines(table, key, checks, unique, prefix=""):
    """Report rows of a table, from the totals: (name, table, column, severity, rows checked, failing rows)."""
    lines = [(c.name, table, c.column, c.severity, f"{prefix}rows", f"{prefix}f{i}") for i, c in enumerate(checks)]
    return [*lines, ("unique", table, key, unique, f"{prefix}keyed", f"{prefix}repeated")]


def report_rows(totals, lines):
    entries = [
        F.struct(
            F.lit(name).alias("check_name"),
            F.lit(table).alias("table"),
            F.lit(column).alias("column"),
            F.lit(severity).alias("severity"),
            F.col(checked).alias("rows_checked"),
            F.col(failing).alias("failing_rows"),
        )
        for name, table, column, severity, checked, failing in lines
    ]
    return totals.select(F.inline(F.array(*entries))).withColumn(
        "status", status_of(F.col("failing_rows"), F.col("severity"))
    )


def keyed_checks(df, table, key, checks, unique="error"):
    """Row checks of a table and the uniqueness of a key, from one read."""
    totals = key_counts(df, key, checks).agg(*key_totals(checks))
    return report_rows(totals, key_lines(table, key, checks, unique))


def dq_unique_ids(suppliers, invoices):
    """Ids are there and occur once; nothing in the data model itself makes an invoice id unique."""
    return union_all(
        [
            keyed_checks(df, table, column, not_null(column))
            for df, table, column in [
                (suppliers, "sa_suppliers", "supplier_id"),
                (invoices, "sa_invoices", "invoice_id"),
            ]
        ]
    )


def dq_amounts(invoices):
    excl, vat, incl = (r.money(c) for c in ("amount_excl_vat", "vat_amount", "amount_incl_vat"))
    return run_checks(
        invoices,
        "sa_invoices",
        [
            Check("amount_positive", "amount_excl_vat", ~F.coalesce(excl > 0, F.lit(False))),
            Check("amount_positive", "amount_incl_vat", ~F.coalesce(incl > 0, F.lit(False))),
            Check(
                "vat_is_fifteen_percent",
                "vat_amount",
                r.vat_mismatch_rounded("amount_excl_vat", "vat_amount"),
            ),
            Check(
                "incl_is_excl_plus_vat",
                "amount_incl_vat",
                ~F.coalesce(incl == excl + vat, F.lit(False)),
            ),
        ],
    )


def dq_dates(invoices):
    in_order = F.col("due_date") >= F.col("invoice_date")
    return run_checks(
        invoices,
        "sa_invoices",
        [Check("due_on_or_after_issue", "due_date", ~F.coalesce(in_order, F.lit(False)))],
    )


def dq_domains(invoices, suppliers):
    """Terms, raw status and currency domains; a missing value is outside the domain."""

    def outside(column, values):
        return ~F.coalesce(F.col(column).isin(values), F.lit(False))

    terms = [
        Check(
            "valid_payment_terms",
            "payment_terms_days",
            outside("payment_terms_days", fv.PAYMENT_TERMS),
        )
    ]
    rest = [
        Check(
            "valid_status", "invoice_status", outside("invoice_status", fv.RAW_INVOICE_STATUSES)
        ),
        Check("currency_is_zar", "currency", outside("currency", [fv.CURRENCY])),
    ]
    return run_checks(suppliers, "sa_suppliers", terms).unionByName(
        run_checks(invoices, "sa_invoices", rest)
    )


# The columns that a delivery must fill
REQUIRED_COLUMNS = [
    "invoice_id",
    "supplier_id",
    "invoice_date",
    "due_date",
    "amount_incl_vat",
    "currency",
]


def dq_required(invoices):
    return run_checks(invoices, "sa_invoices", not_null(*REQUIRED_COLUMNS))


def vat_check():
    """A warning: invoices with another tax than the rule's stay out of the claim, but do not stop the day."""
    return Check("vat_accuracy", "vat_validation_status", F.col("vat_validation_status") != "VALID", "warn")


def silver_report(invoices, suppliers, bank):
    """Every check of the silver layer; each table is read once.

    An invoice whose supplier is not in the master is an error.
    """
    name = "silver_invoices"
    on_invoices = [
        *not_null(*NOT_NULL_COLUMNS[name]),
        *accepted_value_checks(),
        currency_check(),
        vat_check(),
    ]
    on_suppliers = not_null(*NOT_NULL_COLUMNS["silver_suppliers"])
    on_bank = not_null(*NOT_NULL_COLUMNS["silver_bank_transactions"])
    # both tables' counts per supplier meet once: what has no partner on the right are unknown suppliers
    per_supplier = key_counts(invoices, "supplier_id", on_invoices, "i_").join(
        key_counts(suppliers, "supplier_id", on_suppliers, "s_"), F.col("i_key").eqNullSafe(F.col("s_key")), "full"
    )
    unknown = F.when(F.col("i_key").isNotNull() & F.col("s_key").isNull(), F.col("i_n"))
    totals = per_supplier.agg(
        *key_totals(on_invoices, "i_"),
        *key_totals(on_suppliers, "s_"),
        F.coalesce(F.sum(unknown), F.lit(0).cast("long")).alias("unknown"),
    )
    lines = [
        *key_lines(name, "supplier_id", on_invoices, "warn", "i_"),
        *key_lines("silver_suppliers", "supplier_id", on_suppliers, "warn", "s_"),
        ("known", name, "supplier_id", "error", "i_keyed", "unknown"),
    ]
    return report_rows(totals, lines).unionByName(run_checks(bank, "silver_bank_transactions", on_bank))
