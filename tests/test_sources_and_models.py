import datetime as dt
import hashlib
import json
import threading
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.features import (
    BASE_FEATURES,
    FittedFeatures,
    align_features,
    engineer_features,
    fit_features,
)
from ledgerline.operators.joins import invoices_with_supplier
from ledgerline.operators.quality import dq_not_null, silver_report
from ledgerline.plans import daily, run_ledger, training
from ledgerline.schemas import BRONZE_COLUMNS
from ledgerline.sources import bronze, landing, sinks
from ledgerline.streaming.incremental import bronze_incremental


def write_text(path, lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def supplier_file(tmp_path, *rows):
    header = ",".join(BRONZE_COLUMNS["sa_suppliers"])
    return write_text(tmp_path / "suppliers.csv", [header, *rows])


SUPPLIER_ROW = 'S1," Acme ""Best"", Ltd ",1999/123456/07,4123456789,IT,30,100.5,0.2,A@b.C,Durban,'


def test_landing_keeps_text_as_received_and_other_days(spark, tmp_path):
    root = str(tmp_path / "bronze")
    path = supplier_file(tmp_path, SUPPLIER_ROW)
    bronze.land_bronze(spark, path, root, "sa_suppliers", "2025-05-01")
    bronze.land_bronze(spark, path, root, "sa_suppliers", "2025-05-02")
    supplier_file(tmp_path, SUPPLIER_ROW, SUPPLIER_ROW.replace("S1", "S2"))
    bronze.land_bronze(spark, path, root, "sa_suppliers", "2025-05-02")
    assert bronze.ingested_dates(spark, root, "sa_suppliers") == ["2025-05-01", "2025-05-02"]
    landed = bronze.read_bronze(spark, root, "sa_suppliers")
    counts = {row.ingested_date: row["count"] for row in landed.groupBy("ingested_date").count().collect()}
    assert counts == {"2025-05-01": 1, "2025-05-02": 2}
    row = landed.where("ingested_date = '2025-05-01'").first()
    assert row.supplier_name == ' Acme "Best", Ltd ' and row.created_at is None
    assert row.avg_invoice_value_zar == "100.5"


def test_columns_are_found_by_name_and_bytes_stay(spark, tmp_path):
    root = str(tmp_path / "bronze")
    swapped = write_text(tmp_path / "a.csv", ["supplier_name,supplier_id,extra", "Acme,SUP0001,kept"])
    bronze.land_bronze(spark, swapped, root, "sa_suppliers", "2025-05-01")
    bronze.land_bronze(spark, supplier_file(tmp_path, SUPPLIER_ROW), root, "sa_suppliers", "2025-05-02")
    rows = {r.ingested_date: r for r in bronze.read_bronze(spark, root, "sa_suppliers").collect()}
    assert (rows["2025-05-01"].supplier_id, rows["2025-05-01"].supplier_name) == ("SUP0001", "Acme")
    assert rows["2025-05-01"].city is None and rows["2025-05-02"].supplier_id == "S1"
    (first,) = (tmp_path / "bronze" / "sa_suppliers" / "ingested_date=2025-05-01").glob("*.csv")
    assert first.read_bytes() == (tmp_path / "a.csv").read_bytes()
    extras = bronze.landed(spark, root, "sa_suppliers", ["2025-05-01"])
    assert [df.first().extra for df in extras] == ["kept"]


def test_quoted_line_break_and_misfit_records(spark, tmp_path):
    root = str(tmp_path / "bronze")
    lines = ["transaction_id,description", '1,"two', 'lines"', "2,plain", "3,too,many"]
    bronze.land_bronze(spark, write_text(tmp_path / "b.csv", lines), root, "sa_bank_transactions", "2025-05-01")
    rows = bronze.read_bronze(spark, root, "sa_bank_transactions", multi_line=True).collect()
    assert [(r.transaction_id, r.description) for r in rows][:2] == [("1", "two\nlines"), ("2", "plain")]
    counted = bronze.corrupt_records(spark, root, "sa_bank_transactions", multi_line=True).first()
    assert (counted.records, counted.corrupt) == (3, 1)


def test_landing_a_folder_of_files(spark, tmp_path):
    root, out = str(tmp_path / "bronze"), str(tmp_path / "delivered")
    frame = spark.range(10).selectExpr("string(id) as month", "string(id * 2) as rate")
    bronze.write_csv(frame.repartition(3), out)
    bronze.land_bronze(spark, out, root, "rates", "2025-05-01")
    got = {(r.month, r.rate) for r in bronze.read_bronze(spark, root, "rates").collect()}
    assert got == {(str(i), str(2 * i)) for i in range(10)}


def test_snapshot_is_the_latest_day_or_an_earlier_one(spark, tmp_path):
    root = str(tmp_path / "bronze")
    path = supplier_file(tmp_path, SUPPLIER_ROW)
    for day in ["2025-05-01", "2025-05-03"]:
        bronze.land_bronze(spark, path, root, "sa_suppliers", day)
    assert bronze.bronze_snapshot(spark, root, "sa_suppliers").first().ingested_date == "2025-05-03"
    older = bronze.bronze_snapshot(spark, root, "sa_suppliers", "2025-05-02")
    assert [row.ingested_date for row in older.collect()] == ["2025-05-01"]
    with pytest.raises(ValueError):
        bronze.bronze_snapshot(spark, root, "sa_invoices")


def test_missing_file_is_skipped_and_an_unmodelled_one_landed(spark, tmp_path):
    rates = write_text(tmp_path / "rates.csv", ["month,rate", "2025-01,11.25"])
    outcomes = bronze.land_all(
        spark,
        [(rates, "sarb_benchmarks"), (str(tmp_path / "none.csv"), "sa_invoices")],
        str(tmp_path / "b"),
        "2025-05-01",
    )
    assert outcomes == [("sarb_benchmarks", "landed"), ("sa_invoices", "skipped")]
    row = bronze.read_bronze(spark, str(tmp_path / "b"), "sarb_benchmarks").first()
    assert (row.month, row.rate) == ("2025-01", "11.25")


def test_incremental_cleans_each_landing_once(spark, tmp_path):
    root, target, log = (str(tmp_path / n) for n in ("bronze", "silver", "log"))
    path = supplier_file(tmp_path, SUPPLIER_ROW)
    bronze.land_bronze(spark, path, root, "sa_suppliers", "2025-05-01")
    bronze_incremental(spark, root, "sa_suppliers", target, log)
    bronze_incremental(spark, root, "sa_suppliers", target, log)
    assert spark.read.parquet(target).count() == 1
    bronze.land_bronze(spark, path, root, "sa_suppliers", "2025-05-02")
    bronze_incremental(spark, root, "sa_suppliers", target, log)
    rows = spark.read.parquet(target).collect()
    assert [row.supplier_name for row in rows] == ['ACME "BEST", LTD'] * 2
    # the same day delivered again, with one row more: the day is replaced, not added
    supplier_file(tmp_path, SUPPLIER_ROW, SUPPLIER_ROW.replace("S1", "S2"))
    bronze.land_bronze(spark, path, root, "sa_suppliers", "2025-05-02")
    bronze_incremental(spark, root, "sa_suppliers", target, log)
    rows = spark.read.parquet(target).collect()
    assert sorted((str(row.ingested_date), row.supplier_id) for row in rows) == [
        ("2025-05-01", "S1"),
        ("2025-05-02", "S1"),
        ("2025-05-02", "S2"),
    ]


def test_views_and_export(spark, tmp_path, make_suppliers):
    path = supplier_file(tmp_path, SUPPLIER_ROW)
    bronze.land_bronze(spark, path, str(tmp_path / "b"), "sa_suppliers", "2025-05-01")
    bronze.bronze_snapshot(spark, str(tmp_path / "b"), "sa_suppliers").createOrReplaceTempView("sa_suppliers")
    assert spark.sql("select count(*) from sa_suppliers").first()[0] == 1
    sinks.register_views({"silver_suppliers": make_suppliers("S1", "S2")})
    assert spark.sql("select count(*) from silver_suppliers").first()[0] == 2
    sinks.export_gold({"t": make_suppliers("S1")}, str(tmp_path / "gold"))
    assert bronze.read_csv(spark, str(tmp_path / "gold" / "t")).first().supplier_id == "S1"


def feature_frame(spark):
    rows = [
        ("2024-01-15", 11500.00, 1500.00, 10000.00, 0.10, 30, "IT Equipment"),
        ("2024-12-28", 50000.00, 6521.74, 45000.00, 0.40, 60, "Legal Services"),
        ("2024-06-01", 500.00, 65.22, 1000.00, 0.05, 14, "Office Supplies"),
    ]
    return spark.createDataFrame(
        [(dt.date.fromisoformat(d), Decimal(str(a)), *rest) for d, a, *rest in rows],
        "invoice_date date, amount_incl_vat decimal(18,2), vat_amount double, "
        "avg_invoice_value_zar double, late_payment_probability double, payment_terms_days int, "
        "category string",
    )


def test_features_of_the_known_frame(spark):
    rows = engineer_features(feature_frame(spark), keep=["invoice_date"]).orderBy("invoice_date").collect()
    january, june, december = rows
    assert len(rows) == 3
    assert january.log_invoice_amount == pytest.approx(9.350189, abs=1e-6)
    assert december.log_invoice_amount == pytest.approx(10.819798, abs=1e-6)
    assert june.log_invoice_amount == pytest.approx(6.216606, abs=1e-6)

    def flags(row):
        names = ["is_large_invoice", "invoice_month", "invoice_quarter", "invoice_day_of_week"]
        return [row[n] for n in [*names, "is_month_end", "is_q4", "is_vat_period_end"]]

    assert flags(january) == [0, 1, 1, 0, 0, 0, 0]
    assert flags(december) == [1, 12, 4, 5, 1, 1, 1]
    assert flags(june) == [0, 6, 2, 5, 0, 0, 1]
    assert (january["cat_IT Equipment"], january["cat_Legal Services"]) == (1, 0)
    assert all(value is not None for row in rows for value in row)


def test_fitted_features(spark):
    fitted = fit_features(feature_frame(spark))
    assert fitted.q75 == 30750.0
    assert fitted.levels == ["IT Equipment", "Legal Services", "Office Supplies"]
    assert fitted.columns[: len(BASE_FEATURES)] == BASE_FEATURES


def test_null_inputs_become_zero(spark):
    df = feature_frame(spark).withColumn("late_payment_probability", F.lit(None).cast("double"))
    row = engineer_features(df.withColumn("category", F.lit(None).cast("string")), FittedFeatures(1.0, ["A"])).first()
    assert (row.supplier_late_pct, row.cat_A) == (0.0, 0)


def test_align_adds_missing_levels_and_drops_new_ones(spark):
    features = engineer_features(feature_frame(spark))
    expected = [*BASE_FEATURES, "cat_Office Supplies", "cat_Marketing"]
    aligned = align_features(features, expected)
    assert aligned.columns == expected
    assert {row["cat_Marketing"] for row in aligned.collect()} == {0}


def joined_frame(spark, make_invoices, make_suppliers, pending=4):
    rows = [
        {
            "id": f"P{i}",
            "supplier": f"S{i % 2}",
            "incl": 100 + i,
            "late": i % 2 == 1,
            "date": f"2024-0{1 + i % 9}-11",
            "category": ["A", "B"][i % 2],
        }
        for i in range(60)
    ]
    rows += [{"id": f"O{i}", "supplier": f"S{i % 2}", "paid": False, "category": "C"} for i in range(pending)]
    masters = make_suppliers("S0", prior="0.1000").unionByName(make_suppliers("S1", prior="0.3900"))
    return invoices_with_supplier(make_invoices(*rows), masters)


@pytest.mark.parametrize(
    "model_type,overrides",
    [
        ("GradientBoosting", {"maxIter": 3}),
        ("RandomForest", {"numTrees": 3}),
        ("LogisticRegression", {"maxIter": 20}),
    ],
)
def test_models_learn_a_clean_signal(spark, make_invoices, make_suppliers, model_type, overrides):
    prepared = training.prepare(joined_frame(spark, make_invoices, make_suppliers))
    model = training.fit_model(spark, prepared, model_type, **overrides)
    run = training.run_row(
        spark, "r1", model_type, prepared, training.with_probability(model, prepared.test)
    ).first()
    prepared.release()
    assert run.test_auc > 0.99
    assert (run.n_features, run.n_train_rows, run.cv_auc_mean) == (len(BASE_FEATURES) + 2, 48, None)


def test_a_fit_deals_its_rows_to_one_wave_of_tasks():
    assert [training.fit_partitions(rows, 12) for rows in (0, 40_000, 240_000)] == [1, 1, 5]
    assert training.fit_partitions(3_000_000, 12) == 12  # one for every 50,000 rows would be five waves a pass
    assert training.fit_partitions(30_000_000, 12) == 120


def test_folds_that_share_the_cores_are_dealt_to_fewer_partitions():
    assert training.fold_partitions(400_000, 8, 12, 5) == 4  # eight for each of five fits would be over three waves a pass
    assert training.fold_partitions(400_000, 8, 12, 1) == 8
    assert training.fold_partitions(24_000_000, 96, 12, 5) == 96  # none is made longer than can be kept
    assert training.fold_partitions(0, 1, 12, 5) == 1


def test_models_on_few_rows_are_fitted_side_by_side(spark, tmp_path, monkeypatch, make_invoices, make_suppliers):
    begun = threading.Barrier(3, timeout=60)  # breaks where one model waits for another
    fit = training.fit_model

    def fit_with_others(*args, **params):
        begun.wait()
        return fit(*args, **params)

    monkeypatch.setattr(training, "fit_model", fit_with_others)
    rows = [{"id": f"P{i}", "supplier": f"S{i % 2}", "incl": 100 + i, "late": i % 2 == 1, "date": "2024-01-11"} for i in range(40)]
    short = {"GradientBoosting": {"maxIter": 2}, "RandomForest": {"numTrees": 2}, "LogisticRegression": {"maxIter": 5}}
    masters = make_suppliers("S0", prior="0.1000").unionByName(make_suppliers("S1", prior="0.3900"))
    kept = spark.sparkContext._jsc.getPersistentRDDs().size()
    runs = training.train_all(spark, make_invoices(*rows), masters, str(tmp_path), "d1", overrides=short, folds=2)
    assert runs.where("cv_auc_mean is not null and attempt = 1").count() == 3
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == kept
    many = training.SIDE_BY_SIDE_ROWS + 1
    assert [training.models_at_once(n, 3) for n in (0, many)] == [3, 1] and training.models_at_once(0, 0) == 1


def test_prepared_rows_are_kept_once_as_vectors(spark, make_invoices, make_suppliers):
    prepared = training.prepare(joined_frame(spark, make_invoices, make_suppliers))
    assert prepared.data.columns == ["invoice_id", "label", "split", "features"]
    columns = prepared.fitted.columns
    for row, whole in zip(prepared.data.orderBy("invoice_id").collect(), prepared.rows.orderBy("invoice_id").collect()):
        assert list(row.features.toArray()) == [float(whole[c]) for c in columns]
    types = {c: prepared.rows.schema[c].dataType.simpleString() for c in ("log_invoice_amount", "invoice_month", "is_q4")}
    assert types == {"log_invoice_amount": "double", "invoice_month": "int", "is_q4": "int"}
    prepared.release()


def test_cross_validation_scores_every_fold(spark, make_invoices, make_suppliers):
    prepared = training.prepare(joined_frame(spark, make_invoices, make_suppliers), balanced=True)
    per_fold = training.cv_auc(prepared, "LogisticRegression", folds=3, weight="weight", maxIter=10)
    summary = training.cv_summary(per_fold).first()
    assert per_fold.count() == 3 and summary.cv_auc_mean > 0.99
    assert summary.cv_auc_std == pytest.approx(0.0, abs=1e-9)
    prepared.release()


def test_saved_model_scores_pending_invoices_only(spark, tmp_path, make_invoices, make_suppliers):
    joined = joined_frame(spark, make_invoices, make_suppliers)
    prepared = training.prepare(joined)
    model = training.fit_model(spark, prepared, "LogisticRegression", maxIter=10)
    training.save_model(spark, model, prepared.fitted, str(tmp_path / "m"))
    loaded, fitted = training.load_model(spark, str(tmp_path / "m"))
    assert fitted == prepared.fitted
    scored = training.score_open_invoices(loaded, fitted, joined)
    got = {row.invoice_id: row for row in scored.collect()}
    assert sorted(got) == ["O0", "O1", "O2", "O3"]
    assert got["O1"].late_probability > got["O0"].late_probability
    batch = training.score_open_invoices(loaded, fitted, joined, batch_state=True)
    assert batch.columns == sinks.SCORE_COLUMNS and batch.count() == 4
    nothing = training.score_open_invoices(loaded, fitted, joined.where("is_paid"))
    assert nothing.count() == 0
    prepared.release()


def test_best_run_prefers_boosting(spark, tmp_path):
    def run(run_id, model_type, auc):
        return spark.createDataFrame([(run_id, model_type, 0.5, 0.1, auc, 23, 100)], training.RUN_SCHEMA)

    path = str(tmp_path / "runs")
    training.append_runs(run("a", "RandomForest", 0.647), path)
    assert training.best_run(spark.read.parquet(path)).first().run_id == "a"
    training.append_runs(run("b", "GradientBoosting", 0.600), path)
    training.append_runs(run("c", "GradientBoosting", 0.610), path)
    assert training.best_run(spark.read.parquet(path)).first().run_id == "c"


def test_quality_gate_stops_the_day(make_invoices, make_suppliers, make_bank):
    tables = {
        "silver_invoices": make_invoices({"incl": None}),
        "silver_suppliers": make_suppliers("S1"),
        "silver_bank_transactions": make_bank({"debit": 1}),
    }
    with pytest.raises(daily.QualityError, match="amount_incl_vat"):
        daily.require_quality(dq_not_null(tables))
    tables["silver_invoices"] = make_invoices({})
    daily.require_quality(dq_not_null(tables))


def test_unknown_supplier_stops_the_day(make_invoices, make_suppliers, make_bank):
    report = silver_report(make_invoices({"supplier": "S1"}, {"supplier": "S2"}), make_suppliers("S1"), make_bank({"debit": 1}))
    rows = {(row.check_name, row.table): row for row in report.collect()}
    assert (rows["known", "silver_invoices"].rows_checked, rows["known", "silver_invoices"].failing_rows) == (2, 1)
    with pytest.raises(daily.QualityError, match="known: 1"):
        daily.require_quality(report)
    wrong_tax = make_invoices({"vat_status": "VAT_MISMATCH"})
    warned = silver_report(wrong_tax, make_suppliers("S1"), make_bank({"debit": 1}))
    assert warned.where("check_name = 'vat_accuracy'").first().status == "WARN"
    daily.require_quality(warned)


def test_training_flow_leads_from_runs_to_scores(spark, tmp_path, make_invoices, make_suppliers):
    rows = [
        {"id": f"P{i}", "supplier": f"S{i % 2}", "incl": 100 + i, "late": i % 2 == 1, "date": f"2024-0{1 + i % 9}-11"}
        for i in range(60)
    ]
    rows += [{"id": f"O{i}", "supplier": s, "paid": False, "date": "2024-12-01"} for i, s in enumerate(["S0", "S1", "NEW"])]
    masters = make_suppliers("S0", "NEW", prior="0.1000").unionByName(make_suppliers("S1", prior="0.3900"))
    root = str(tmp_path)
    short = {"GradientBoosting": {"maxIter": 2}, "RandomForest": {"numTrees": 2}, "LogisticRegression": {"maxIter": 5}}
    training.train_all(spark, make_invoices(*rows), masters, root, "d1", overrides=short, folds=2)
    runs = run_ledger.runs(spark, root).collect()
    assert sorted(run.model_type for run in runs) == sorted(training.MODEL_TYPES)
    assert all(run.cv_auc_mean is not None and run.attempt == 1 for run in runs)
    assert run_ledger.reports(spark, root).where("run_id = 'd1-RandomForest'").count() == 5
    assert run_ledger.folds(spark, root).count() == 6
    run_id, _, _ = training.load_best(spark, root)
    assert run_id == "d1-GradientBoosting"
    scored, apart = training.score_with_best(spark, make_invoices(*rows), masters, root)
    assert {row.invoice_id: row.run_id for row in scored.collect()} == {"O0": run_id, "O1": run_id}
    assert [row.invoice_id for row in apart.collect()] == ["O2"]
    # a retry on the same rows fits nothing again; other parameters are the next attempt, with a model of their own
    before = run_ledger.in_force(spark, root)
    training.train_all(spark, make_invoices(*rows), masters, root, "d1", overrides=short, folds=2)
    assert run_ledger.in_force(spark, root) == before
    deeper = {**short, "GradientBoosting": {"maxIter": 3}}
    training.train_all(spark, make_invoices(*rows), masters, root, "d1", overrides=deeper, folds=2)
    after = run_ledger.in_force(spark, root)
    assert [after[i] != before[i] for i in sorted(after)] == [True, False, False]
    assert after["d1-GradientBoosting"][0] == 2 and run_ledger.runs(spark, root).count() == 3
    assert training.load_best(spark, root)[1].stages[-1].getNumTrees == 3
    # an attempt that was lost before its marker is not seen
    lost, folder = run_ledger.new_attempt(spark, root, "d1-GradientBoosting", "0" * 16)
    training.save_model(spark, training.load_best(spark, root)[1], training.load_best(spark, root)[2], folder)
    assert lost == 3 and run_ledger.in_force(spark, root) == after
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_a_landing_lost_before_its_switch_leaves_the_day(spark, tmp_path):
    root, dataset, day = str(tmp_path / "bronze"), "sa_suppliers", "2025-05-01"
    first = bronze.land_bronze(spark, supplier_file(tmp_path, SUPPLIER_ROW), root, dataset, day)
    supplier_file(tmp_path, SUPPLIER_ROW.replace("S1", "S2"), SUPPLIER_ROW.replace("S1", "S3"))
    path = str(tmp_path / "suppliers.csv")
    copied = landing.copy_files(spark, [path], root, dataset, day)  # no switch follows
    assert [r.supplier_id for r in bronze.read_bronze(spark, root, dataset).collect()] == ["S1"]
    assert landing.entries_of(spark, root, dataset, day) == first
    torn = tmp_path / "bronze" / dataset / "manifests" / f"ingested_date={day}" / "00000002.json"
    torn.write_text('{"files": 2}\n' + json.dumps(copied[0]) + "\n")  # a manifest cut short does not count
    assert [r.supplier_id for r in bronze.read_bronze(spark, root, dataset).collect()] == ["S1"]
    landing.switch_day(spark, root, dataset, day, copied)
    assert {r.supplier_id for r in bronze.read_bronze(spark, root, dataset).collect()} == {"S2", "S3"}
    assert copied[0]["sha256"] == hashlib.sha256((tmp_path / "suppliers.csv").read_bytes()).hexdigest()
    assert landing.drop_replaced(spark, root, dataset, day) == 1
    row = landing.verify(spark, root, dataset).first()
    assert (row.length, row.sha256) == (row.length_now, row.sha256_now)


def test_a_day_copied_but_never_switched_is_no_day(spark, tmp_path):
    root, path = str(tmp_path / "bronze"), supplier_file(tmp_path, SUPPLIER_ROW)
    bronze.land_bronze(spark, path, root, "sa_suppliers", "2025-05-01")
    landing.copy_files(spark, [path], root, "sa_suppliers", "2025-05-02")
    assert bronze.ingested_dates(spark, root, "sa_suppliers") == ["2025-05-01"]
    (tmp_path / "nothing here").mkdir()
    assert bronze.land_bronze(spark, str(tmp_path / "nothing here"), root, "sa_suppliers", "2025-05-01") == []
    assert bronze.read_bronze(spark, root, "sa_suppliers").count() == 0


def test_headers_with_line_breaks_and_repeated_names(spark, tmp_path):
    text = write_text(tmp_path / "odd name+1.csv", ['a,"two', 'lines",a,a_2', "1,2,3,4"])
    assert bronze.header_of(spark, text) == ("a", "two\nlines", "a_2_", "a_2")
    bronze.land_bronze(spark, text, str(tmp_path / "b"), "odd", "2025-05-01")
    row = bronze.read_bronze(spark, str(tmp_path / "b"), "odd", multi_line=True).first()
    assert row["a_2_"] == "3" and row["a_2"] == "4"
    assert landing.verify(spark, str(tmp_path / "b"), "odd").first().length_now is not None
