"""Registered queries agree with their SQL on the supplied tables."""

import os
import re

import duckdb
import pytest

import check_oracle
from __spark_entry__ import entry, oracle_sql, queries
from ledgerline.oracle import ORACLE_SQL
from ledgerline.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"
#: Hundreds of small jobs each; the unit tests of the models fit shorter ones. check_oracle.py compares them too.
LONG = {"train_gbt", "train_rf", "training_flow", "model_runs", "best_run", "cv_auc", "score_open_invoices", "open_invoice_tiers"}
WITHOUT_SQL = set()

needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


def test_every_query_has_sql_or_is_a_model():
    assert set(QUERIES) - set(ORACLE_SQL) == WITHOUT_SQL
    assert set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


@needs_tables
def test_entry_runs(spark):
    assert entry(spark).columns[0] == "year_month"


@needs_tables
@pytest.mark.parametrize("name", sorted(n for n in queries() if n.startswith("dq_")))
def test_every_report_has_a_failing_check(spark, name):
    rows = [row.asDict() for row in queries()[name](spark, FOLDER).collect()]
    assert any(row.get("failing_rows", row.get("missing_count", row.get("n_records", 0))) > 0 for row in rows)


def scans(df):
    """Tables read by the final plan, by their first column."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = re.sub(r"\+- == Initial Plan ==.*?(?=\n\S|\Z)", "", plan, flags=re.S)
    return sorted(re.findall(r"FileScan parquet \[(\w)", plan))


@needs_tables
@pytest.mark.parametrize(
    "name, tables",
    [
        ("dq_unique_ids", ["l", "n", "s"]),
        ("model_monitor", ["l", "n", "s"]),
        ("features", ["l", "n", "s"]),
        ("dq_silver_report", ["l", "l", "n", "o", "s"]),
    ],
)
def test_tables_are_read_once(spark, name, tables):
    """The ledger is made of invoices and orders, so the quality report reads the invoices for both."""
    assert scans(queries()[name](spark, FOLDER)) == tables


@needs_tables
def test_join_states_all_occur(spark):
    states = queries()["audit_log"](spark, FOLDER).select("match_status").distinct().count()
    assert states == 4
    row = queries()["merge_integrity"](spark, FOLDER).first()
    assert row.both and row.left_only and row.right_only
    assert queries()["unreconciled_exceptions"](spark, FOLDER).count() > 0
    left = queries()["scorecard_left_join"](spark, FOLDER)
    assert left.where("supplier_name is null").count() and left.where("supplier_name is not null").count()


@needs_tables
@pytest.mark.parametrize("name", sorted(set(QUERIES) - LONG))
def test_query_agrees_with_sql(spark, name):
    db = duckdb.connect()
    for table in check_oracle.TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = queries()[name](spark, FOLDER)
    rows = [tuple(row) for row in df.collect()]
    cursor = db.execute(oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert check_oracle.compare(df.columns, rows, columns, cursor.fetchall()) is None
