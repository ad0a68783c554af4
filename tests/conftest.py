import datetime as dt
import sys
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from ledgerline.session import build_session

INVOICE_SCHEMA = """invoice_id string, supplier_id string, invoice_date date, due_date date,
payment_date date, amount_excl_vat decimal(18,2), vat_amount decimal(18,2),
amount_incl_vat decimal(18,2), currency string, category string, payment_terms_days int,
days_past_due int, is_late boolean, is_paid boolean, invoice_status string,
vat_validation_status string"""

BANK_SCHEMA = """transaction_id string, transaction_date date, description string,
debit_amount decimal(18,2), credit_amount decimal(18,2), balance_impact decimal(18,2),
category string, invoice_reference string, reconciled boolean"""


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[4]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def nothing_cached_by_others(request):
    """What a test leaves in the session's cache is gone before the next one counts what is kept."""
    session = request.getfixturevalue("spark") if "spark" in request.fixturenames else None
    yield
    if session is not None:
        session.catalog.clearCache()


def day(text):
    return dt.date.fromisoformat(text) if text else None


def money(value):
    return Decimal(str(value)) if value is not None else None


@pytest.fixture
def make_invoices(spark):
    """Silver invoices from dicts; what is not given has a plain default."""

    def make(*rows):
        data = []
        for i, row in enumerate(rows):
            incl = money(row.get("incl", 115))
            excl = money(row.get("excl", 100))
            vat = money(row.get("vat", 15))
            paid = row.get("paid", True)
            data.append(
                (
                    row.get("id", f"I{i}"),
                    row.get("supplier", "S1"),
                    day(row.get("date", "2024-01-10")),
                    day(row.get("due", "2024-02-09")),
                    day(row.get("pay", "2024-02-08" if paid else None)),
                    excl,
                    vat,
                    incl,
                    "ZAR",
                    row.get("category", "Catering"),
                    row.get("terms", 30),
                    row.get("dpd", 0),
                    row.get("late", False),
                    paid,
                    row.get("status", "PAID" if paid else "PENDING"),
                    row.get("vat_status", "VALID"),
                )
            )
        return spark.createDataFrame(data, INVOICE_SCHEMA)

    return make


@pytest.fixture
def make_bank(spark):
    def make(*rows):
        data = []
        for i, row in enumerate(rows):
            debit, credit = money(row.get("debit", 0)), money(row.get("credit", 0))
            data.append(
                (
                    row.get("id", f"T{i}"),
                    day(row.get("date", "2024-01-10")),
                    row.get("description", "line"),
                    debit,
                    credit,
                    credit - debit,
                    row.get("category", "SUPPLIER PAYMENT"),
                    row.get("reference"),
                    row.get("reconciled", True),
                )
            )
        return spark.createDataFrame(data, BANK_SCHEMA)

    return make


@pytest.fixture
def make_suppliers(spark):
    def make(*ids, prior="0.2000", average="1000.00", category="CATERING"):
        rows = [
            (
                s,
                f"SUPPLIER {s}",
                "1999/123456/07",
                "4123456789",
                category,
                30,
                Decimal(average),
                Decimal(prior),
                "a@b.c",
                "Durban",
                None,
            )
            for s in ids
        ]
        return spark.createDataFrame(
            rows,
            "supplier_id string, supplier_name string, cipc_number string, vat_number string, "
            "category string, payment_terms_days int, avg_invoice_value_zar decimal(18,2), "
            "late_payment_probability decimal(6,4), email string, city string, "
            "created_at timestamp_ntz",
        )

    return make
