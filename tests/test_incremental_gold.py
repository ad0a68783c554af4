"""Gold kept up to date by landing day equals the full run, reads changed days only and survives lost updates."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import gold
from ledgerline.plans import incremental_gold as ig

DAYS = ["2024-03-01", "2024-03-02", "2024-03-03"]


def same(found, expected):
    columns = expected.columns
    assert set(found.columns) == set(columns)
    rows = [sorted(map(str, df.select(*columns).collect())) for df in (found, expected)]
    assert rows[0] == rows[1]


def put(df, day, target):
    out = df.withColumn("ingested_date", F.lit(day)).write.mode("overwrite")
    out.option("partitionOverwriteMode", "dynamic").partitionBy("ingested_date").parquet(target)


@pytest.fixture
def some_invoices(make_invoices):
    def make(seed, n=25):
        rng = random.Random(seed)
        rows = []
        for i in range(n):
            status = rng.choice(["PAID", "OVERDUE", "PENDING"])
            rows.append(
                {
                    "id": f"{seed}-{i}",
                    "supplier": rng.choice(["S1", "S2", "S3", f"only-{seed}"]),
                    "date": rng.choice(["2024-01-10", "2024-02-11", "2024-03-12", None]),
                    "incl": rng.choice([None, 115, 230.55]),
                    "vat": rng.choice([15, None]),
                    "dpd": rng.randrange(50),
                    "late": rng.random() < 0.5,
                    "paid": status == "PAID",
                    "status": status,
                    "vat_status": rng.choice(["VALID", "VAT_MISMATCH"]),
                }
            )
        return make_invoices(*rows)

    return make


def test_invoice_tables(spark, tmp_path, some_invoices, make_suppliers):
    target, root = f"{tmp_path}/silver", f"{tmp_path}/gold"
    master = make_suppliers("S1", "S2", "S3", "only-1")
    landings = [(1, [0]), (2, [1]), (3, [2]), (4, [1]), (5, [0, 2])]
    for seed, at in landings:
        for i in at:
            put(some_invoices(10 * seed + i), DAYS[i], target)
        silver = spark.read.parquet(target)
        changed = [DAYS[i] for i in at]
        same(ig.update_vat(spark, silver, f"{root}/vat", changed), gold.vat_summary(silver))
        found = ig.update_scorecard(spark, silver, master, f"{root}/card", changed)
        same(found, gold.supplier_scorecard(silver, master))


def test_cash_flow_from_the_first_changed_month(spark, tmp_path, make_bank):
    target, root = f"{tmp_path}/silver", f"{tmp_path}/gold"
    landings = [
        (DAYS[0], [("2024-01-05", 10, 0), ("2024-03-05", 0, 4), (None, 1, 0)]),
        (DAYS[1], [("2024-03-06", 7, 0), ("2024-05-06", 0, 3)]),
        (DAYS[2], [("2024-06-06", 20, 0)]),
        (DAYS[1], [("2024-04-06", 0, 9)]),
        (DAYS[2], []),
        (DAYS[0], [("2023-12-31", 5, 0)]),
    ]
    empty = set()
    for day, lines in landings:
        rows = make_bank(*[{"date": d, "credit": c, "debit": b, "reconciled": c > 0} for d, c, b in lines])
        if lines:
            put(rows, day, target)
        empty = empty - {day} if lines else empty | {day}
        silver = spark.read.parquet(target).where(~F.col("ingested_date").cast("string").isin(list(empty)))
        same(ig.update_cash_flow(spark, silver, root, [day]), gold.cash_flow_monthly(silver))


def test_other_days_are_not_read(spark, tmp_path, some_invoices):
    target, root = f"{tmp_path}/silver", f"{tmp_path}/gold"
    for i in (0, 1):
        put(some_invoices(i), DAYS[i], target)
    ig.update_vat(spark, spark.read.parquet(target), root, DAYS[:2])
    expected = gold.vat_summary(spark.read.parquet(target)).collect()
    schema = spark.read.parquet(target).schema
    for path in glob.glob(f"{target}/ingested_date={DAYS[0]}/*.parquet"):
        with open(path, "wb") as file:
            file.write(b"no longer readable")
    found = ig.update_vat(spark, spark.read.schema(schema).parquet(target), root, [DAYS[1]])
    assert sorted(map(str, found.collect())) == sorted(map(str, expected))


def test_a_lost_update_changes_nothing(spark, tmp_path, some_invoices):
    target, root = f"{tmp_path}/silver", f"{tmp_path}/gold"
    put(some_invoices(1), DAYS[0], target)
    ig.update_vat(spark, spark.read.parquet(target), root, [DAYS[0]])
    before = sorted(map(str, ig.read_totals(spark, root).collect()))
    put(some_invoices(2), DAYS[0], target)
    silver = spark.read.parquet(target)
    ig.update(spark, silver, ig.vat_measures(), root, [DAYS[0]])  # ends before its commit
    assert sorted(map(str, ig.read_totals(spark, root).collect())) == before
    same(ig.update_vat(spark, silver, root, [DAYS[0]]), gold.vat_summary(silver))
    with pytest.raises(ValueError):
        ig.read_totals(spark, f"{tmp_path}/nothing")
