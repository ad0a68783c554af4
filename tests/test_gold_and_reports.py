from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import benchmark, explore, followup, gold, operations

# Published government payment performance, two years
TREASURY_TREND = [
    ("National: Paid Late", 111282, 108917),
    ("National: Unpaid at Year-End", 1149, 1427),
    ("Provincial: Paid Late", 231780, 253151),
    ("Provincial: Unpaid at Year-End", 73974, 113481),
    ("Total: Paid Late", 343062, 362068),
    ("Total: Unpaid at Year-End", 75123, 114908),
]

# Published unpaid invoices by province, (count, value in R million)
PROVINCE_UNPAID = [
    ("Eastern Cape", 73449, 4547.0),
    ("Gauteng", 19262, 2765.0),
    ("North West", 11180, 784.0),
    ("Free State", 3752, 753.0),
    ("Northern Cape", 3007, 690.0),
    ("KwaZulu-Natal", 1760, 905.0),
    ("Mpumalanga", 982, 161.0),
    ("Western Cape", 86, 6.0),
    ("Limpopo", 3, 0.15),
]


def by(df, key):
    return {row[key]: row for row in df.collect()}


def test_vat_summary_counts_valid_invoices_only(make_invoices):
    invoices = make_invoices(
        {"vat": 15},
        {"vat": 15, "paid": False, "status": "OVERDUE", "incl": 200},
        {"vat": 99, "vat_status": "VAT_MISMATCH"},
        {"vat": 7, "date": "2024-03-01", "pay": "2024-04-02"},
    )
    got = by(gold.vat_summary(invoices), "year_month")
    january = got["2024-01"]
    assert (january.invoice_count, january.paid_count, january.overdue_count) == (2, 1, 1)
    assert january.claimable_vat_input_tax == Decimal("15.00")
    assert january.overdue_amount_zar == Decimal("200.00")
    assert all(row.claimable_vat_input_tax <= row.total_vat_input_tax for row in got.values())
    by_payment = by(gold.vat_summary_by_payment_period(invoices), "year_month")
    assert sorted(by_payment) == ["2024-02", "2024-04"]


def test_scorecard_tier_uses_the_rounded_share(make_invoices, make_suppliers):
    # 1,199 of 3,000 late is 39.97 percent, shown as 40.0 and rated by it.
    rows = [{"supplier": "S1", "late": i < 1199} for i in range(3000)]
    rows.append({"supplier": "ORPHAN"})
    invoices, master = make_invoices(*rows), make_suppliers("S1", "UNUSED")
    (row,) = gold.supplier_scorecard(invoices, master).collect()
    assert row.supplier_id == "S1"
    assert (row.late_payment_pct, row.payment_risk_tier) == (Decimal("40.0"), "HIGH")
    kept = by(gold.supplier_scorecard(invoices, master, keep_orphans=True), "supplier_id")
    assert sorted(kept) == ["ORPHAN", "S1"] and kept["S1"].late_count == 1199


def test_cash_flow_growth_and_running_balance(make_bank):
    bank = make_bank(
        {"date": "2024-01-05", "debit": 100},
        {"date": "2024-02-05", "credit": 50},
        {"date": "2024-04-05", "credit": 10, "reconciled": False},
        {"date": "2024-04-06", "debit": 10},
        {"date": "2024-05-05", "credit": 25},
    )
    rows = gold.cash_flow_monthly(bank).orderBy("year_month").collect()
    assert [row.net_cash_flow_zar for row in rows] == [-100, 50, 0, 25]
    assert [row.running_cash_balance_zar for row in rows] == [-100, -50, -50, -25]
    assert [row.mom_growth_rate_pct for row in rows] == [None, Decimal("150.0"), Decimal("-100.0"), None]
    assert [row.unreconciled_count for row in rows] == [0, 0, 1, 0]
    assert rows[-1].running_cash_balance_zar == sum(row.net_cash_flow_zar for row in rows)


def test_cash_flow_keeps_a_null_month_first(make_bank):
    rows = gold.cash_flow_monthly(
        make_bank({"date": None, "debit": 5}, {"date": "2024-01-01", "credit": 7})
    ).collect()
    got = {row.year_month: row.running_cash_balance_zar for row in rows}
    assert got == {None: Decimal("-5.00"), "2024-01": Decimal("2.00")}


def test_category_reports(make_invoices):
    invoices = make_invoices(
        {"category": "A", "late": True, "dpd": 40, "incl": 100},
        {"category": "A", "late": False},
        {"category": "A", "late": False},
        {"category": "B", "late": True, "dpd": 10, "incl": 300},
        {"category": None, "late": True, "dpd": 99},
    )
    late = by(explore.late_by_category(invoices), "category")
    assert sorted(late) == ["A", "B"]
    assert late["A"].risk_band == "HIGH" and late["B"].late_rate == 1.0
    exposure = by(explore.late_exposure_by_category(invoices), "category")
    assert exposure["B"].total_late_exposure == Decimal("300.00")
    depth = by(operations.overdue_by_category(invoices), "category")
    assert (depth["A"].overdue_band, depth["B"].overdue_band) == ("HIGH", "LOW")
    summary = operations.overdue_summary(invoices).first()
    assert (summary.overdue_invoices, summary.median_days, summary.max_days) == (3, 40.0, 99)


def test_monthly_trend_marks_the_earliest_peak(make_invoices):
    invoices = make_invoices(
        {"date": "2024-01-02", "incl": 100, "late": True},
        {"date": "2024-02-02", "incl": 100},
        {"date": "2024-03-02", "incl": 40},
    )
    got = by(explore.monthly_trend(invoices), "year_month")
    assert [m for m, row in sorted(got.items()) if row.is_peak_spend] == ["2024-01"]
    assert [m for m, row in sorted(got.items()) if row.is_worst_late] == ["2024-01"]


def test_histogram_covers_every_row(make_invoices):
    invoices = make_invoices(*[{"incl": i + 1} for i in range(101)])
    rows = explore.histogram(invoices, F.col("amount_incl_vat"), 50).collect()
    assert sum(row.n for row in rows) == 101 and len(rows) == 50
    assert max(row.bin for row in rows) == 49
    (flat,) = explore.histogram(make_invoices({"incl": 5}, {"incl": 5}), F.col("amount_incl_vat"), 50).collect()
    assert (flat.bin, flat.n) == (0, 2)


def test_boxplot_against_plain_numbers(make_invoices):
    days = [1, 2, 3, 4, 5, 6, 7, 100]
    (box,) = operations.overdue_boxplot(make_invoices(*[{"dpd": d} for d in days])).collect()
    assert (box.q1, box.median, box.q3) == (2.75, 4.5, 6.25)
    assert (box.whisker_low, box.whisker_high, box.outliers) == (1, 7, 1)


def test_terms_compliance_shares(make_invoices):
    invoices = make_invoices(
        {"date": "2024-01-01", "pay": "2024-01-28", "terms": 30},
        {"date": "2024-01-01", "pay": "2024-01-29", "terms": 30},
        {"date": "2024-01-01", "pay": "2024-02-02", "terms": 30},
        {"date": "2024-01-01", "pay": "2024-02-03", "terms": 30},
        {"paid": False},
    )
    got = by(operations.terms_compliance(invoices), "compliance_status")
    assert {k: row.invoices for k, row in got.items()} == {"Early": 1, "On-time": 2, "Late": 1}
    assert sum(row.share for row in got.values()) == pytest.approx(1.0)
    (row,) = operations.compliance_by_category(invoices).collect()
    assert (row["Late"], row["On-time"], row["Early"]) == (0.25, 0.5, 0.25)


def test_yoy_change_on_the_published_table(spark):
    rows = [
        (name, period, value)
        for name, old, new in TREASURY_TREND
        for period, value in [(2023, old), (2024, new)]
    ]
    periods = spark.createDataFrame(rows, "category string, period int, value long")
    got = by(benchmark.yoy_change(periods, 2023, 2024), "category")
    assert got["National: Paid Late"].change_pct == Decimal("-2.1")
    assert got["National: Paid Late"].direction == "IMPROVED"
    assert got["Provincial: Unpaid at Year-End"].change_pct == Decimal("53.4")
    assert got["Total: Paid Late"].change_pct == Decimal("5.5")


def test_region_bands_on_the_published_table(spark):
    totals = spark.createDataFrame(
        [(name, count) for name, count, _ in PROVINCE_UNPAID], "region string, unpaid_invoices long"
    )
    rows = benchmark.region_ranking(totals).collect()
    assert [row.region for row in rows][:3] == ["Eastern Cape", "Gauteng", "North West"]
    assert [row.unpaid_band for row in rows] == ["CRITICAL"] * 3 + ["WATCH"] * 3 + ["LOW"] * 3


def test_prime_rate_before_inside_and_after_the_table(spark, make_invoices):
    invoices = make_invoices({"date": "2020-05-01"}, {"date": "2025-05-01"}, {"date": "2026-09-01"})
    got = by(benchmark.prime_rate_join(invoices, benchmark.prime_rates(spark)), "year_month")
    assert [got[m].prime_rate for m in sorted(got)] == [11.75, 11.0, None]


def test_late_cost_of_the_published_example(spark, make_invoices):
    invoices = make_invoices({"date": "2024-01-01", "incl": 100000, "late": True, "dpd": 20})
    (row,) = benchmark.per_invoice_late_cost(invoices, benchmark.prime_rates(spark)).collect()
    assert row.late_cost == pytest.approx(643.84, abs=0.01)


def test_rag_scorecard_is_grey_without_payments(make_invoices):
    got = by(benchmark.rag_scorecard(make_invoices({"paid": False})), "kpi")
    assert got["Payment Terms Compliance"].rag == "GREY"
    assert got["VAT Input Tax %"].rag == "GREEN"
    assert got["YoY Late Payment Trend"].rag == "RED"
    assert got["VAT Mismatch Rate"].rag == "GREEN"


def test_insufficient_history_counts_earlier_days_only(make_invoices):
    rows = [{"id": f"P{i}", "date": f"2024-01-0{i + 1}"} for i in range(5)]
    rows += [
        {"id": "SAME", "date": "2024-01-05", "paid": False},
        {"id": "LATER", "date": "2024-01-06", "paid": False},
        {"id": "NEW", "supplier": "S2", "paid": False},
    ]
    everything = make_invoices(*rows)
    got = by(followup.insufficient_history(everything.where("not is_paid"), everything), "invoice_id")
    flags = {k: row.insufficient_history for k, row in got.items()}
    assert flags == {"SAME": True, "LATER": False, "NEW": True}


def test_risk_ranking_shares_ranks(spark):
    rows = [("a", "0.3", 10), ("b", "0.4", 5), ("c", "0.3", 10), ("d", "0.3", 250), ("e", None, 1)]
    df = spark.createDataFrame(
        [(i, "S", None, Decimal(a), Decimal(p) if p else None) for i, p, a in rows],
        "invoice_id string, supplier_id string, due_date date, amount_incl_vat decimal(18,2), "
        "late_payment_probability decimal(6,4)",
    )
    got = {row.invoice_id: row.risk_rank for row in followup.risk_ranked_open_invoices(df).collect()}
    assert got == {"b": 1, "d": 2, "a": 3, "c": 3, "e": 5}


def test_risk_ranking_keeps_small_differences(spark):
    df = spark.createDataFrame(
        [("a", 0.50004, Decimal(5)), ("b", 0.50001, Decimal(10)), ("c", 1.0, Decimal(1)), ("d", 0.0, Decimal(99))],
        "invoice_id string, late_probability double, amount_incl_vat decimal(18,2)",
    ).selectExpr("*", "'S' as supplier_id", "cast(null as date) as due_date")
    ranked = followup.risk_ranked_open_invoices(df, "late_probability").collect()
    assert {row.invoice_id: row.risk_rank for row in ranked} == {"c": 1, "a": 2, "b": 3, "d": 4}


def test_rolling_compliance_window_edges(make_invoices):
    invoices = make_invoices(
        {"date": "2024-01-01", "pay": "2024-01-02", "terms": 30},
        {"date": "2024-01-01", "pay": "2024-03-31", "terms": 30},
        {"date": "2024-01-01", "pay": "2024-04-01", "terms": 90},
    )
    got = by(followup.rolling_compliance_90d(invoices), "payment_date")
    counts = [(row.paid_in_window, row.compliant) for _, row in sorted(got.items())]
    # 2 January is 89 days before 31 March and 90 days before 1 April.
    assert counts == [(1, 1), (2, 1), (2, 1)]


def test_escalation_and_due_soon(make_invoices):
    invoices = make_invoices(
        {"id": "A", "paid": False, "due": "2024-01-01", "dpd": 45, "status": "OVERDUE"},
        {"id": "B", "paid": False, "due": "2024-02-09", "dpd": 6, "status": "OVERDUE"},
        {"id": "C", "paid": False, "due": "2024-02-15"},
        {"id": "D", "paid": False, "due": "2024-02-18"},
        {"id": "E", "paid": True, "dpd": 60, "late": True},
    )
    got = by(followup.escalation_tier(invoices, "2024-02-15"), "invoice_id")
    assert {k: row.escalation for k, row in got.items()} == {
        "A": "MANAGEMENT_REVIEW",
        "B": "ACCOUNT_MANAGER",
        "C": "REMINDER",
        "D": "NOT_DUE",
    }
    assert {k: row.alert for k, row in got.items()} == {"A": True, "B": False, "C": False, "D": False}
    soon = followup.due_soon_alert(invoices, "2024-02-15").first()
    assert (soon.outstanding, soon.due_soon, soon.alert) == (4, 2, True)


def test_exceptions_wait_more_than_five_business_days(make_bank, make_invoices):
    bank = make_bank(
        {"id": "old", "date": "2024-01-05", "debit": 2000},
        {"id": "recent", "date": "2024-01-10", "debit": 2000},
        {"id": "small", "date": "2024-01-05", "debit": 1000},
        {"id": "known", "date": "2024-01-05", "debit": 2000, "reference": "I0"},
        {"id": "lost", "date": "2024-01-05", "debit": 2000, "reference": "GONE"},
        {"id": "settled", "date": "2024-01-05", "debit": 2000, "reconciled": True},
        {"id": "near", "date": "2024-01-08", "debit": 1010},
    ).withColumn("reconciled", F.col("transaction_id") == "settled")
    invoices = make_invoices({"incl": 1000, "pay": "2024-01-09"})
    rows = followup.unreconciled_exceptions(bank, invoices, "2024-01-16").collect()
    got = sorted((row.transaction_id, row.business_days_open) for row in rows)
    assert got == [("lost", 7), ("near", 6), ("old", 7)]
    rows = followup.unreconciled_exceptions(bank, invoices, "2024-01-16", by_tolerance=True).collect()
    assert sorted(row.transaction_id for row in rows) == ["known", "lost", "old"]


def test_snapshot_diff_sees_a_value_that_moves_between_columns(spark):
    schema = "k string, a string, b string"
    before = spark.createDataFrame([("1", "x", None), ("2", "y", "z"), ("3", "q", "q")], schema)
    after = spark.createDataFrame([("1", None, "x"), ("2", "y", "z"), ("4", "n", "n")], schema)
    got = {row.k: row.change for row in followup.snapshot_diff(before, after, "k").collect()}
    assert got == {"1": "CHANGED", "2": "UNCHANGED", "3": "REMOVED", "4": "ADDED"}


def test_snapshot_diff_with_repeated_and_null_keys(spark):
    schema = "k string, a string"
    rows = [("1", "x"), ("1", "y"), ("2", "x"), ("2", "x"), (None, "n"), ("3", "x"), ("3", "y")]
    before = spark.createDataFrame(rows, schema)
    after = spark.createDataFrame([("1", "y"), ("1", "x"), ("2", "x"), (None, "n"), ("3", "x"), ("3", "z")], schema)
    got = {row.k: row.change for row in followup.snapshot_diff(before, after, "k").collect()}
    assert got == {"1": "UNCHANGED", "2": "CHANGED", None: "UNCHANGED", "3": "CHANGED"}
    same = followup.snapshot_changes(before, before, "k").collect()
    assert [(row.change, row.rows) for row in same] == [("UNCHANGED", 4)]


def test_log_outliers_ignore_a_plain_tail(make_invoices):
    rows = [{"incl": 100 + i} for i in range(50)] + [{"id": "OUT", "incl": 1000000}]
    got = followup.log_scale_outliers(make_invoices(*rows)).collect()
    assert [row.invoice_id for row in got] == ["OUT"]


def test_financing_cost(make_invoices):
    row = benchmark.financing_cost(
        make_invoices({"incl": 1200, "late": True, "dpd": 30}, {"incl": 800})
    ).first()
    assert row.late_spend == Decimal("1200.00")
    assert row.target_late_spend == pytest.approx(160.0)
    assert row.estimated_cost == pytest.approx(1200 * 0.105 / 12)
