"""Day sketches, sparse levels and the month spine."""

import random

import pytest
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ledgerline.operators import features, levels
from ledgerline.plans import gold, sketches


def test_states_of_a_span_merge_like_its_rows(spark, tmp_path):
    rng = random.Random(3)
    rows = [(f"2024-01-{1 + i % 28:02d}", rng.choice("ab"), rng.randrange(3000), rng.gauss(100, 40)) for i in range(20_000)]
    rows += [("2024-01-09", "c", None, None)]
    df = spark.createDataFrame(rows, "day string, g string, who long, amount double")
    sketches.day_sketches(df, "day", ["g"], ["who"], ["amount"]).write.parquet(f"{tmp_path}/s")
    states = spark.read.parquet(f"{tmp_path}/s")
    assert states.count() == 57
    for first, last in [(None, None), ("2024-01-05", "2024-01-11"), ("2024-01-09", "2024-01-09")]:
        inside = df.where(F.col("day").between(first or "0", last or "9"))
        found = sketches.over_span(states, ["g"], first, last)
        checked = {r.g: r for r in sketches.checked(inside, found, ["g"], "who", "amount").collect()}
        for g in "ab":
            assert checked[g].rows_agree and checked[g].distinct_within_bound and checked[g].quantiles_within_bound
        empty = found.where("g = 'c'").first()
        assert (empty.rows, empty.who_distinct, empty.amount_quantiles) == (1, 0, None)
    # a bound that would accept anything proves nothing
    wrong = sketches.over_span(states, ["g"]).withColumn("who_distinct", F.col("who_distinct") * 2)
    assert not sketches.checked(df, wrong, ["g"], "who", "amount").where("g = 'a'").first().distinct_within_bound


def test_levels_are_numbered_in_order_and_unseen_ones_have_no_entry(spark, tmp_path):
    names = [f"L{i}" for i in range(500)] + ["", "é", "zz top"]
    df = spark.createDataFrame([(n,) for n in names * 2 + [None, "L7"]], "c string").repartition(7)
    table = levels.fit_levels(df, "c", str(tmp_path / "l"))
    rows = sorted((r.level_id, r.level, r.rows) for r in table.collect())
    assert [r[1] for r in rows] == sorted(names) and [r[0] for r in rows] == list(range(len(names)))
    assert dict((r[1], r[2]) for r in rows)["L7"] == 3
    some = spark.createDataFrame([("L0",), ("new",), (None,)], "c string")
    encoded = levels.one_hot(levels.with_level_id(some, "c", table), table.count())
    got = {r.c: r.level_vector for r in encoded.collect()}
    assert got["L0"].size == len(names) and list(got["L0"].indices) == [sorted(names).index("L0")]
    assert got["new"].numNonzeros() == got[None].numNonzeros() == 0
    frequent = levels.fit_levels(df, "c", str(tmp_path / "f"), min_rows=3)
    assert [r.level for r in frequent.collect()] == ["L7"]


def test_sparse_and_dense_give_the_same_probabilities(spark, tmp_path):
    rng = random.Random(8)
    rows = []
    for i in range(600):
        c = rng.randrange(10)
        x = rng.random()
        rows.append((i, f"C{c}", x, int(rng.random() < 0.1 + 0.08 * c * x)))
    df = spark.createDataFrame(rows, "id long, c string, x double, label int").coalesce(1).cache()
    table = levels.fit_levels(df, "c", str(tmp_path / "l"))
    sparse = levels.sparse_features(df, ["x"], "c", table).select("id", "label", "features")
    columns = [F.col("c").eqNullSafe(f"C{i}").cast("int").alias(f"C{i}") for i in range(10)]
    dense = VectorAssembler(inputCols=["x", *[f"C{i}" for i in range(10)]], outputCol="features")
    dense = dense.transform(df.select("id", "label", "x", *columns)).select("id", "label", "features")
    tree = DecisionTreeClassifier(maxDepth=4)  # no sampling: binary and numeric columns split alike
    logistic = LogisticRegression(regParam=0.01, standardization=False, maxIter=200, tol=1e-12)
    for model in (tree, logistic):
        both = []
        for data in (sparse.orderBy("id").coalesce(1), dense.orderBy("id").coalesce(1)):
            p = model.fit(data).transform(data).select("id", vector_to_array("probability")[1].alias("p"))
            both.append({r.id: r.p for r in p.collect()})
        assert both[0] == pytest.approx(both[1], abs=1e-6)


def test_many_levels_fit_and_score(spark, tmp_path):
    n = 100_000
    df = spark.range(2 * n).select(
        F.concat(F.lit("part-"), F.col("id") % n).alias("c"),
        (F.col("id") % 7).cast("double").alias("x"),
        (F.col("id") % 2).cast("int").alias("label"),
    )
    table = levels.fit_levels(df, "c", str(tmp_path / "l"))
    data = levels.sparse_features(df, ["x"], "c", table)
    model = LogisticRegression(maxIter=1, standardization=False).fit(data)
    assert model.numFeatures == n + 1
    assert model.transform(data.limit(50)).where("prediction is not null").count() == 50


def test_dense_columns_are_bounded(make_invoices):
    rows = make_invoices(*[{"category": f"c{i}"} for i in range(6)])
    assert len(features.category_levels(rows, limit=6)) == 6
    with pytest.raises(ValueError):
        features.category_levels(rows, limit=5)


def test_months_without_lines_are_zeros(make_bank):
    lines = [("2023-11-05", 10), ("2024-02-05", 4), ("2024-02-06", 6), (None, 1)]
    bank = make_bank(*[{"date": d, "credit": c} for d, c in lines]).withColumn("who", F.lit(None).cast("string"))
    rows = gold.cash_flow_monthly(bank, calendar=True).orderBy(F.col("year_month").asc_nulls_first()).collect()
    assert [r.year_month for r in rows] == [None, "2023-11", "2023-12", "2024-01", "2024-02"]
    assert [int(r.running_cash_balance_zar) for r in rows] == [1, 11, 11, 11, 21]
    assert rows[4].prev_month_net_cash_flow == 0 and rows[4].mom_growth_rate_pct is None
    by_entity = gold.cash_flow_monthly(bank, ["who"], calendar=True)
    assert by_entity.count() == 5 and by_entity.where("transaction_count = 0").count() == 2
    assert gold.cash_flow_monthly(bank.where("transaction_date is null"), calendar=True).count() == 1
