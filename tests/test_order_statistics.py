"""Distributed order statistics against plain in-memory answers."""

import hashlib
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import metrics, reconcile, splits
from ledgerline.operators.quantiles import money_quantiles
from ledgerline.operators.ranking import cumulative_before


def test_quantiles_match_linear_interpolation(spark):
    rng = random.Random(1)
    rows = [("a", round(rng.uniform(-500, 90000), 2)) for _ in range(997)]
    rows += [("hot", 12.34)] * 400 + [("hot", 99.99), ("one", 5.0), ("none", None)]
    df = spark.createDataFrame(
        [(g, Decimal(str(v)) if v is not None else None) for g, v in rows], "g string, v decimal(18,2)"
    )
    probs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {row.g: row for row in money_quantiles(df, "v", probs, ["g"]).collect()}
    assert sorted(got) == ["a", "hot", "one"]
    for g in got:
        values = [v for k, v in rows if k == g]
        for i, p in enumerate(probs):
            assert got[g][f"q{i}"] == pytest.approx(np.quantile(values, p), abs=1e-9)


def test_quantile_of_whole_table_and_approximation(spark):
    df = spark.range(1001).select((F.col("id") / 4).cast("decimal(18,2)").alias("v"))
    assert money_quantiles(df, "v", [0.75]).first().q0 == 187.5
    assert money_quantiles(df, "v", [0.75], approx=True).first().q0 == pytest.approx(187.5, abs=0.5)


def test_cumulative_before_over_three_levels(spark):
    rng = random.Random(2)
    values = sorted(rng.sample(range(10000), 300))
    cells = spark.createDataFrame([(v // 1000, v // 100, v, v % 7) for v in values], "a int, b int, c int, n int")
    got = {row.c: row.n_before for row in cumulative_before(cells, ["a", "b", "c"], ["n"]).collect()}
    total = 0
    for v in values:
        assert got[v] == total
        total += v % 7


def labelled(spark, n=1716, late=398):
    rows = [(f"INV{i}", int(i < late)) for i in range(n)]
    return spark.createDataFrame(rows, "invoice_id string, label int")


def test_split_has_the_exact_share_of_each_class(spark):
    split = splits.stratified_split(labelled(spark), "label", "invoice_id")
    counts = {(row.label, row.split): row["count"] for row in split.groupBy("label", "split").count().collect()}
    assert counts == {(0, "test"): 264, (1, "test"): 80, (0, "train"): 1054, (1, "train"): 318}
    again = splits.stratified_split(labelled(spark).repartition(3), "label", "invoice_id")
    assert split.exceptAll(again).count() == 0


def test_rows_of_one_key_stay_together(spark):
    rows = [("same", 0)] * 10 + [(f"I{i}", 0) for i in range(90)]
    df = spark.createDataFrame(rows, "invoice_id string, label int")
    split = splits.stratified_split(df, "label", "invoice_id").where("invoice_id = 'same'")
    assert split.count() == 10 and split.select("split").distinct().count() == 1
    folds = splits.stratified_folds(df, "label", "invoice_id").where("invoice_id = 'same'")
    assert folds.select("fold").distinct().count() == 1


@pytest.mark.parametrize("tolerance", [0.29, "0.29", Decimal("0.29")])
def test_tolerance_is_exact_in_cents(make_bank, make_invoices, tolerance):
    bank = make_bank({"debit": "100.00", "date": "2024-01-10"})
    invoices = make_invoices({"incl": "100.29", "pay": "2024-01-10"})
    assert reconcile.flag_lines(bank, invoices, tolerance=tolerance).first().matched
    assert not reconcile.flag_lines(bank, invoices, tolerance="0.28").first().matched
    with pytest.raises(ValueError):
        reconcile.match_points(bank, invoices, tolerance=0.295)


def test_undated_lines_are_flagged_and_kept(make_bank, make_invoices):
    bank = make_bank({"date": None, "debit": 100}, {"debit": 100}, {"credit": 5})
    flagged = reconcile.flag_lines(bank, make_invoices({"incl": 100, "pay": "2024-01-10"})).collect()
    assert sorted((row.transaction_id, row.matched) for row in flagged) == [("T0", False), ("T1", True), ("T2", False)]


def test_split_takes_the_smallest_digests(spark):
    rows = splits.stratified_split(labelled(spark, 40, 10), "label", "invoice_id").collect()
    for label, size in [(0, 6), (1, 2)]:
        keys = sorted(
            (row.invoice_id for row in rows if row.label == label),
            key=lambda k: hashlib.md5(f"42:{k}".encode()).hexdigest(),
        )
        assert {row.invoice_id for row in rows if row.label == label and row.split == "test"} == set(keys[:size])


def test_folds_differ_by_at_most_one(spark):
    folds = splits.stratified_folds(labelled(spark, 1372, 318), "label", "invoice_id")
    counts = folds.groupBy("label", "fold").count().collect()
    for label in (0, 1):
        sizes = [row["count"] for row in counts if row.label == label]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_folds_of_a_class_smaller_than_their_number(spark):
    folds = splits.stratified_folds(labelled(spark, 9, 3), "label", "invoice_id").collect()
    assert sorted(row.fold for row in folds if row.label == 1) == [0, 1, 2]


def test_auc_of_the_known_example(spark):
    df = spark.createDataFrame([(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1)], "late_probability double, label int")
    assert metrics.roc_auc(df).first().auc == 0.75


def test_auc_with_ties_matches_all_pairs(spark):
    rng = random.Random(3)
    rows = [(round(rng.random(), 1) if rng.random() < 0.7 else rng.random(), rng.randint(0, 1)) for _ in range(400)]
    pos = [s for s, y in rows if y]
    neg = [s for s, y in rows if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    got = metrics.roc_auc(spark.createDataFrame(rows, "late_probability double, label int")).first()
    assert got.auc == wins / (len(pos) * len(neg))


def test_auc_is_null_without_a_class(spark):
    df = spark.createDataFrame([(0.1, 0), (0.4, 0)], "late_probability double, label int")
    assert metrics.roc_auc(df).first().auc is None


def test_classification_report(spark):
    rows = [(0.9, 1)] * 12 + [(0.1, 1)] * 68 + [(0.9, 0)] * 21 + [(0.1, 0)] * 243
    report = metrics.classification_report(spark.createDataFrame(rows, "late_probability double, label int"))
    got = {row["class"]: row for row in report.collect()}
    assert got["Late"].precision == pytest.approx(0.36, abs=0.005)
    assert got["Late"].recall == pytest.approx(0.15)
    assert got["On-time"].f1_score == pytest.approx(0.85, abs=0.005)
    assert got["accuracy"].f1_score == pytest.approx(0.74, abs=0.005)
    assert got["macro avg"].f1_score == pytest.approx(0.53, abs=0.005)
    assert got["weighted avg"].f1_score == pytest.approx(0.70, abs=0.005)
    assert [got[c].support for c in ("On-time", "Late", "accuracy")] == [264, 80, 344]


def test_report_of_a_model_that_flags_nothing(spark):
    df = spark.createDataFrame([(0.1, 1), (0.1, 0)], "late_probability double, label int")
    got = {row["class"]: row for row in metrics.classification_report(df).collect()}
    assert (got["Late"].precision, got["Late"].f1_score) == (0.0, 0.0)


def test_class_weights(spark):
    got = {row.label: row.weight for row in metrics.class_weights(labelled(spark, 100, 20)).collect()}
    assert got == {0: 0.625, 1: 2.5}


def test_monitor_uses_a_rolling_window(spark):
    rows = [("2024-01-05", 0.9, 1), ("2024-01-06", 0.1, 0), ("2024-02-01", 0.2, 1), ("2024-02-02", 0.8, 0)]
    rows += [("2024-05-01", 0.3, 1), ("2024-05-02", 0.4, 0)]
    df = spark.createDataFrame(rows, "d string, late_probability double, label int").withColumn(
        "d", F.col("d").cast("date")
    )
    got = {row.year_month: row for row in metrics.model_monitor(df, "d").collect()}
    assert {m: row.auc for m, row in got.items()} == {"2024-01": 1.0, "2024-02": 0.75, "2024-05": 0.0}
    assert [m for m, row in got.items() if row.alert] == ["2024-05"]


@pytest.mark.parametrize(
    "pay,incl,expected",
    [
        ("2024-01-13", 150, 1),
        ("2024-01-07", 50, 1),
        ("2024-01-14", 100, 0),
        ("2024-01-10", 150.01, 0),
        ("2024-01-10", 49.99, 0),
    ],
)
def test_reconciliation_edges(make_bank, make_invoices, pay, incl, expected):
    bank = make_bank({"date": "2024-01-10", "debit": 100})
    row = reconcile.bank_reconciliation(bank, make_invoices({"pay": pay, "incl": incl})).first()
    assert (row.total, row.matched, row.unmatched) == (1, expected, 1 - expected)


def test_two_invoices_match_one_line(make_bank, make_invoices):
    bank = make_bank({"date": "2024-01-10", "debit": 100})
    invoices = make_invoices({"pay": "2024-01-10", "incl": 100}, {"pay": "2024-01-11", "incl": 101})
    assert reconcile.bank_reconciliation(bank, invoices).first().matched == 1


def test_reconciliation_against_brute_force(make_bank, make_invoices):
    rng = random.Random(4)
    amounts = [rng.choice([950, 999.99, 1000, 1049.99, 1050, 1100, 2000.01, rng.uniform(10, 3000)]) for _ in range(150)]
    invoices = [
        {"pay": f"2024-01-{rng.randint(1, 28):02d}", "incl": round(a, 2), "status": rng.choice(["PAID", "PAID", "OVERDUE"])}
        for a in amounts
    ]
    lines = [
        {"date": rng.choice([None, f"2024-01-{rng.randint(1, 31):02d}"]), "debit": round(rng.uniform(900, 2100), 2)}
        for _ in range(200)
    ]
    lines += [{"date": "2024-01-15", "debit": 0, "credit": 5}] * 3
    bank, paid = make_bank(*lines), make_invoices(*invoices)
    expected = {}
    offers = [(i.payment_date, i.amount_incl_vat) for i in paid.where("invoice_status = 'PAID'").collect()]
    for row in bank.collect():
        expected[row.transaction_id] = row.transaction_date is not None and any(
            abs((d - row.transaction_date).days) <= 3 and abs(a - row.debit_amount) <= 50 for d, a in offers
        )
    got = {row.transaction_id: row.matched for row in reconcile.flag_lines(bank, paid).collect()}
    assert got == expected
    totals = reconcile.bank_reconciliation(bank, paid).first()
    assert (totals.total, totals.matched) == (len(lines), sum(expected.values()))
    monthly = reconcile.monthly_reconciliation(bank, paid).collect()
    assert sum(row.total for row in monthly) == sum(line["date"] is not None for line in lines)


def test_only_negative_amounts_count_when_there_are_any(make_bank, make_invoices):
    bank = make_bank({"debit": -100, "credit": 1}, {"debit": 100}, {"debit": 7})
    invoices = make_invoices({"pay": "2024-01-10", "incl": 100})
    auto = reconcile.bank_reconciliation(bank, invoices).first()
    everything = reconcile.bank_reconciliation(bank, invoices, population="all").first()
    assert (auto.total, auto.matched) == (1, 1)
    assert (everything.total, everything.matched) == (3, 2)
