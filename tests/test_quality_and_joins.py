import pytest

from ledgerline.operators import joins, quality


def report(df):
    return {(row["check_name"], row["column"]): row for row in df.collect()}


def test_not_null_and_accepted_values(make_invoices, make_suppliers, make_bank):
    invoices = make_invoices({"incl": None}, {"status": "LOST"}, {"status": None})
    got = report(
        quality.silver_report(invoices, make_suppliers("S1"), make_bank({"debit": 1, "date": None}))
    )
    assert got[("not_null", "amount_incl_vat")].failing_rows == 1
    assert got[("not_null", "invoice_status")].failing_rows == 1
    assert got[("accepted_values", "invoice_status")].failing_rows == 1
    assert got[("not_null", "transaction_date")].status == "FAIL"
    assert got[("not_null", "invoice_id")].status == "PASS"


def test_repeated_supplier_only_warns(make_invoices, make_suppliers):
    invoices = make_invoices({}, {}, {"supplier": "S2"})
    rows = quality.dq_unique_warn(invoices, make_suppliers("S1")).collect()
    got = {row["table"]: (row.failing_rows, row.status) for row in rows}
    assert got == {"silver_invoices": (1, "WARN"), "silver_suppliers": (0, "PASS")}
    (dup,) = quality.duplicate_keys(invoices, "supplier_id").collect()
    assert (dup.supplier_id, dup.n_records) == ("S1", 2)


def test_formats(spark):
    rows = [("2001/123456/07", "4123456789"), ("01/123456/07", "5123456789"), (None, "412")]
    df = spark.createDataFrame(rows, "cipc_number string, vat_number string")
    got = report(quality.dq_formats(df))
    assert got[("company_number_format", "cipc_number")].failing_rows == 2
    assert got[("vat_number_format", "vat_number")].failing_rows == 2


def test_amounts_dates_and_sanity(make_invoices):
    invoices = make_invoices(
        {},
        {"excl": 100, "vat": 15, "incl": 116},
        {"excl": 100, "vat": 14, "incl": 114, "date": "2030-01-01", "due": "2029-01-01"},
    )
    amounts = report(quality.dq_amounts(invoices))
    assert amounts[("vat_is_fifteen_percent", "vat_amount")].failing_rows == 1
    assert amounts[("incl_is_excl_plus_vat", "amount_incl_vat")].failing_rows == 1
    assert report(quality.dq_dates(invoices))[("due_on_or_after_issue", "due_date")].failing_rows == 1
    sanity = report(quality.dq_sanity(invoices, "2024-12-31"))
    assert sanity[("future_invoice_date", "invoice_date")].failing_rows == 1
    assert sanity[("due_before_issue", "due_date")].failing_rows == 1


def test_missing_profile_lists_only_columns_with_gaps(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, None), (3, 1, "z")], "a int, b int, c string")
    rows = quality.dq_missing_profile(df).collect()
    assert [(row.column, row.missing_count, row.pct_missing) for row in rows] == [
        ("b", 2, 66.67),
        ("c", 1, 33.33),
    ]


def test_merge_integrity_counts_rows(make_invoices, make_suppliers):
    invoices = make_invoices({}, {}, {"supplier": "LOST"})
    row = joins.merge_integrity(invoices, make_suppliers("S1", "IDLE")).first()
    assert (row.both, row.left_only, row.right_only) == (2, 1, 1)
    assert row.no_orphan_invoices is False


def test_supplier_join_keeps_the_invoice_value(make_invoices, make_suppliers):
    row = joins.invoices_with_supplier(make_invoices({"category": "Legal"}), make_suppliers("S1")).first()
    assert (row.category, row.supplier_category) == ("Legal", "CATERING")
    assert row.supplier_payment_terms_days == 30


def test_reference_matching(make_bank, make_invoices):
    bank = make_bank(
        {"id": "ok", "debit": 115, "reference": "I0"},
        {"id": "off", "debit": 100, "reference": "I0"},
        {"id": "lost", "debit": 5, "reference": "X"},
        {"id": "none", "credit": 5, "category": "REVENUE"},
    )
    invoices = make_invoices({})
    log = {row.transaction_id: row.match_status for row in joins.audit_log(bank, invoices).collect()}
    assert log == {
        "ok": "MATCHED",
        "off": "AMOUNT_DIFFERS",
        "lost": "MISSING_INVOICE",
        "none": "NO_REFERENCE",
    }
    counts = {row.category: (row.matched, row.unmatched) for row in joins.recon_by_reference(bank, invoices).collect()}
    assert counts == {"SUPPLIER PAYMENT": (2, 1), "REVENUE": (0, 1)}
    semi = {row.transaction_id for row in joins.matched_by_reference(bank, invoices).collect()}
    anti = {row.transaction_id for row in joins.unmatched_by_reference(bank, invoices).collect()}
    assert semi == {"ok", "off"} and anti == {"lost", "none"}


def test_first_of_candidate_columns(make_invoices):
    assert "category" in str(joins.pick_column(make_invoices({}), "category_x", "category"))
    with pytest.raises(ValueError):
        joins.pick_column(make_invoices({}), "nothing")
