import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import rules as r
from ledgerline.operators.lifecycle import cashbook, with_lifecycle
from ledgerline.operators.silver import (
    silver_bank_transactions,
    silver_invoices,
    silver_suppliers,
)
from ledgerline.schemas import bronze_schema


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values))
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "excl,vat,expected",
    [
        ("100.00", "15.00", "VALID"),
        ("100.00", "15.01", "VALID"),
        ("100.00", "15.02", "VAT_MISMATCH"),
        ("100.00", "14.98", "VAT_MISMATCH"),
        ("100.05", "15.03", "VAT_MISMATCH"),
    ],
)
def test_vat_status_is_exact_at_the_tolerance(spark, excl, vat, expected):
    assert one(spark, r.vat_status("e", "v"), e=excl, v=vat) == expected


def test_vat_status_of_missing_tax(spark):
    df = spark.createDataFrame([("100.00", None)], "e string, v string")
    row = df.select(r.vat_status("e", "v").alias("a"), r.vat_mismatch_rounded("e", "v").alias("b"))
    assert tuple(row.first()) == ("VAT_MISMATCH", True)


def test_rounded_variant_accepts_what_the_exact_one_rejects(spark):
    assert one(spark, r.vat_mismatch_rounded("e", "v"), e="100.05", v="15.03") is False


@pytest.mark.parametrize("delta,expected", [(-3, "Early"), (-2, "On-time"), (2, "On-time"), (3, "Late")])
def test_compliance_classes(spark, delta, expected):
    assert one(spark, r.compliance_class("d"), d=delta) == expected


@pytest.mark.parametrize("p,tier", [(0.5, "HIGH"), (0.3, "MEDIUM"), (0.2999, "LOW")])
def test_risk_tiers(spark, p, tier):
    assert one(spark, r.risk_tier("p"), p=p) == tier


def test_business_days_match_a_calendar_walk(spark):
    start = dt.date(2024, 1, 1)
    days = [start + dt.timedelta(days=i) for i in range(20)]
    rows = [(a, b) for a in days for b in days if a <= b]
    df = spark.createDataFrame(rows, "a date, b date")
    for row in df.withColumn("n", r.business_days_between("a", "b")).collect():
        walked = [row.a + dt.timedelta(days=i + 1) for i in range((row.b - row.a).days)]
        assert row.n == sum(d.weekday() < 5 for d in walked)


def raw_invoice(**changes):
    base = {
        "invoice_id": "I1",
        "supplier_id": "S1",
        "invoice_date": "2024-01-10",
        "due_date": "2024-02-09",
        "payment_date": None,
        "amount_excl_vat": "100.00",
        "vat_amount": "15.00",
        "amount_incl_vat": "115.00",
        "currency": "ZAR",
        "category": "Catering",
        "payment_terms_days": "30",
        "days_past_due": "0",
        "is_late": "False",
        "is_paid": "True",
        "invoice_status": "Paid",
    }
    return {**base, **changes}


def clean(spark, *rows):
    schema = bronze_schema("sa_invoices")
    data = [tuple(row[c] for c in schema.names) for row in rows]
    return silver_invoices(spark.createDataFrame(data, schema), "run-1").collect()


@pytest.mark.parametrize(
    "change",
    [
        {"amount_incl_vat": "-50"},
        {"amount_incl_vat": "0"},
        {"amount_incl_vat": None},
        {"invoice_id": None},
        {"supplier_id": None},
    ],
)
def test_silver_invoices_drops_unusable_rows(spark, change):
    assert clean(spark, raw_invoice(**change)) == []


def test_silver_invoices_nulls_and_statuses(spark):
    tiny, bad_date, terms, *statuses = clean(
        spark,
        raw_invoice(amount_incl_vat="0.004"),
        raw_invoice(invoice_date="2024-13-01", amount_excl_vat="-3"),
        raw_invoice(payment_terms_days="-5", vat_amount="0"),
        raw_invoice(invoice_status="paid"),
        raw_invoice(invoice_status=None),
        raw_invoice(invoice_status="Void"),
        raw_invoice(invoice_status="Overdue"),
    )
    assert tiny.amount_incl_vat is None
    assert bad_date.invoice_date is None and bad_date.amount_excl_vat is None
    assert terms.payment_terms_days is None and terms.vat_amount == Decimal("0.00")
    assert [s.invoice_status for s in statuses] == ["UNKNOWN", "UNKNOWN", "UNKNOWN", "OVERDUE"]
    assert tiny.is_paid is True and tiny.is_late is False and tiny.dbt_run_id == "run-1"


def test_silver_bank_keeps_an_unreadable_date_and_drops_empty_lines(spark):
    schema = bronze_schema("sa_bank_transactions")
    rows = [
        ("T1", "oops", " a ", "5", "0", "-5", " Revenue", None, "True"),
        ("T2", "2024-01-01", "b", "0", "0", "0", "x", None, "True"),
        ("T3", None, "b", "5", "0", "0", "x", None, "True"),
        (None, "2024-01-01", "b", "5", "0", "0", "x", None, "True"),
    ]
    (row,) = silver_bank_transactions(spark.createDataFrame(rows, schema)).collect()
    assert (row.transaction_id, row.transaction_date, row.description) == ("T1", None, "a")
    assert row.category == "REVENUE" and row.reconciled is True


def test_silver_suppliers_text(spark):
    schema = bronze_schema("sa_suppliers")
    rows = [
        ("S1", " Acme ", "c", "v", " it ", "30", "10.005", "0.12345", " A@B.C ", " Durban ", "bad"),
        ("S2", None, "c", "v", "it", "30", "1", "0.1", "e", "x", None),
    ]
    (row,) = silver_suppliers(spark.createDataFrame(rows, schema)).collect()
    assert (row.supplier_name, row.category, row.email, row.city) == ("ACME", "IT", "a@b.c", "Durban")
    assert row.avg_invoice_value_zar == Decimal("10.01") and row.created_at is None
    assert row.late_payment_probability == Decimal("0.1235")


def test_lifecycle_states(spark):
    rows = [
        ("a", dt.date(2024, 1, 1), 30, dt.date(2024, 2, 5), True, True),
        ("b", dt.date(2024, 1, 1), 30, None, False, True),
        ("c", dt.date(2024, 1, 1), 60, None, False, False),
    ]
    df = spark.createDataFrame(
        rows,
        "id string, invoice_date date, payment_terms_days int, payment_date date, "
        "is_paid boolean, paid_after_due boolean",
    )
    got = {row.id: row for row in with_lifecycle(df, "2024-02-10").collect()}
    assert [got[k].invoice_status for k in "abc"] == ["Paid", "Overdue", "Pending"]
    assert [got[k].days_past_due for k in "abc"] == [5, 10, 0]
    assert [got[k].is_late for k in "abc"] == [True, False, False]


def test_cashbook_has_one_line_per_payment_and_receipt(spark, make_invoices):
    invoices = make_invoices({"id": "A", "incl": 115}, {"id": "B", "paid": False})
    receipts = spark.createDataFrame(
        [(1, dt.date(2024, 1, 1), "Service revenue", Decimal("50.00"), False)],
        "receipt_id int, receipt_date date, description string, amount decimal(18,2), reconciled boolean",
    )
    lines = {row.transaction_id: row for row in cashbook(invoices, receipts).collect()}
    assert sorted(lines) == ["PAY-A", "RCV-1"]
    assert lines["PAY-A"].balance_impact == Decimal("-115.00")
    assert lines["PAY-A"].invoice_reference == "A" and lines["RCV-1"].invoice_reference is None
    assert lines["RCV-1"].reconciled is False


def test_supplier_prior(spark):
    df = spark.createDataFrame([("150000.00",), ("500.00",)], "a string")
    rows = df.select(r.supplier_prior("a").alias("p")).collect()
    assert [row.p for row in rows] == [Decimal("0.4000"), Decimal("0.1010")]
