"""One-to-one reconciliation against augmenting paths over all pairs."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import matching
from ledgerline.operators.silver import silver_invoices
from ledgerline.sources import binding, spoiled


def left_over(payments, invoices, slack):
    """Payments in order of place; each is kept if an augmenting path seats it beside those before it."""
    seats = {}

    def seat(i, seen):
        for j, at in enumerate(invoices):
            if j not in seen and abs(at - payments[i]) <= slack:
                seen.add(j)
                if j not in seats or seat(seats[j], seen):
                    seats[j] = i
                    return True
        return False

    lost = Counter()
    for i, at in enumerate(payments):
        lost[at] += not seat(i, set())
    return lost


@pytest.mark.parametrize("width", [1, 3, 1000])
def test_every_key_against_augmenting_paths(spark, width):
    rng = random.Random(width)
    sides, expected = ([], []), {}
    for key in range(60):
        reach = rng.choice([10, 25, 60])
        slack = 3
        payments = sorted(rng.randrange(-reach, reach) for _ in range(rng.randrange(1, 25)))
        invoices = [rng.randrange(-reach, reach) for _ in range(rng.randrange(0, 25))]
        sides[0].extend((f"k{key}", at) for at in payments)
        sides[1].extend((f"k{key}", at) for at in invoices)
        lost = left_over(payments, invoices, slack)
        for at, n in Counter(payments).items():
            near = any(abs(i - at) <= slack for i in invoices)
            expected[f"k{key}", at] = (n, lost[at], near)
    payments, invoices = (spark.createDataFrame(rows, "key string, at long") for rows in sides)
    nulls = spark.createDataFrame([(None, 1), ("k1", None)], "key string, at long")
    found = matching.match_runs(payments.union(nulls), invoices.union(nulls), ["key"], 3, width).collect()
    assert {(r.key, r.at): (r.payments, r.left_over, r.near) for r in found} == expected
    assert len(found) == len(expected)


def test_a_second_payment_stays_unmatched(make_bank, make_invoices):
    bank = make_bank(
        {"debit": 115, "date": "2024-02-08"},
        {"debit": 115, "date": "2024-02-10"},
        {"debit": 115, "date": "2024-03-20"},
        {"debit": 99, "date": None},
        {"credit": 115, "date": "2024-02-08"},
    )
    row = matching.recon_one_to_one(bank, make_invoices({"pay": "2024-02-09"}, {"paid": False})).first()
    assert (row.payments, row.matched, row.unmatched, row.double_paid) == (4, 1, 3, 1)
    both = make_invoices({"pay": "2024-02-09"}, {"pay": "2024-02-07", "supplier": "S2"})
    assert matching.recon_one_to_one(bank, both).first().matched == 2


def test_suppliers_and_amounts(make_bank, make_invoices):
    from pyspark.sql import functions as F

    bank = make_bank({"debit": 100}, {"debit": 140}, {"debit": 900}).withColumn("payer", F.lit("S1"))
    invoices = make_invoices({"incl": 120, "pay": "2024-01-10"}, {"incl": 160, "pay": "2024-01-10", "supplier": "S2"})
    by_amount = {"axis": "amount", "tolerance": 50}
    rows = matching.one_to_one_points(bank, invoices, **by_amount).collect()
    assert {float(r.debit_amount): (r.matched, r.near) for r in rows} == {100: (1, True), 140: (1, True), 900: (0, False)}
    own = matching.one_to_one_points(bank, invoices, suppliers=("payer", "supplier_id"), **by_amount).collect()
    assert {float(r.debit_amount): r.matched for r in own} == {100: 1, 140: 0, 900: 0}


def test_no_rows_and_wrong_arguments(make_bank, make_invoices):
    row = matching.recon_one_to_one(make_bank(), make_invoices()).first()
    assert (row.payments, row.matched, row.double_paid, row.unmatched_rate) == (0, 0, 0, None)
    for wrong in ({"axis": "weeks"}, {"axis": "amount", "tolerance": "0.001"}, {"days": -1}):
        with pytest.raises(ValueError):
            matching.recon_one_to_one(make_bank(), make_invoices(), **wrong)


def test_the_points_are_not_joined_again(spark):
    sides = [spark.createDataFrame([("k", at) for at in places], "key string, at long") for places in ([1, 9], [2, 30])]
    found = matching.match_runs(*sides, ["key"], 3, 1000)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 2, plan  # linked cells with their events, all cells with the linked ones' starts
    assert {tuple(r) for r in found.collect()} == {("k", 1, 1, 0, True), ("k", 9, 1, 1, False)}


def star_tables(spark, folder, *keys):
    """One paid line for each order number, and no receipts."""
    lines = [(k, 7, 9, 2, 10.0, 100.0, 0.0, 0.08, "N", "F", f"1995-03-0{1 + i}") for i, k in enumerate(keys)]
    names = "orderkey long, partkey long, suppkey long, linenumber int, quantity double, extendedprice double, discount double"
    schema = ", ".join(f"l_{c}" for c in (names + ", tax double, returnflag string, linestatus string, shipdate string").split(", "))
    spark.createDataFrame(lines, schema).withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp_ntz")).write.parquet(
        f"{folder}/lineitem.parquet"
    )
    orders = "o_orderkey long, o_orderdate timestamp_ntz, o_totalprice double, o_orderstatus string"
    spark.createDataFrame([], orders).write.parquet(f"{folder}/orders.parquet")
    return str(folder)


@pytest.mark.parametrize("axis", ["days", "amount"])
def test_the_scan_of_the_invoices_is_short_enough_to_be_compiled(spark, tmp_path, monkeypatch, axis):
    seen = []

    def keep(payments, invoices, keys, slack, width):
        seen.append(matching.counted(invoices, keys))
        return found(payments, invoices, keys, slack, width)

    found = matching.match_runs
    monkeypatch.setattr(matching, "match_runs", keep)
    d = star_tables(spark, tmp_path, 1)
    bank, invoices = binding.raw_bank_transactions(spark, d), silver_invoices(binding.raw_invoices(spark, d))
    matching.one_to_one_points(bank, invoices, axis=axis)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = seen[0].select("*")._jdf.queryExecution()
        code = spark._jvm.PythonSQLUtils.explainString(plan, "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000  # the JVM interprets longer methods


def test_bills_paid_again_by_the_first_number_of_their_id(spark, tmp_path):
    # without an order number the line number, 2, comes first in the id; 2, 43 and 46 are 2, 3 and 6 modulo 40
    d = star_tables(spark, tmp_path, 43, 46, None, 71)
    rows = spoiled.raw_double_payments(spark, d).orderBy("transaction_id").collect()
    assert [(row.transaction_id, row.transaction_date.isoformat()) for row in rows] == [
        ("PAY-2-7-9-10", "1995-03-16"),
        ("PAY-43-2-7-9-10", "1995-03-14"),
        ("PAY-43-2-7-9-10/1", "1995-03-14"),
        ("PAY-46-2-7-9-10", "1995-03-15"),
        ("PAY-71-2-7-9-10", "1995-03-17"),
        ("PAY-71-2-7-9-10/1", "1995-03-14"),
    ]
