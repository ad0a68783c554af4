"""The daily job order: land, clean, check, report, score. Plain functions, one after the other."""

from functools import reduce

from pyspark.sql import functions as F

from ledgerline.operators.quality import silver_report
from ledgerline.operators.silver import (
    silver_bank_transactions,
    silver_invoices,
    silver_suppliers,
)
from ledgerline.plans.gold import cash_flow_monthly, supplier_scorecard, vat_summary
from ledgerline.plans.training import score_with_best
from ledgerline.sources.bronze import bronze_snapshot, land_all, write_csv
from ledgerline.sources.sinks import export_gold, read_layer, write_layer, write_scores


def build_silver(spark, root, run_id=""):
    """Silver tables from the latest landing of each dataset."""
    return {
        "silver_invoices": silver_invoices(bronze_snapshot(spark, root, "sa_invoices"), run_id),
        "silver_suppliers": silver_suppliers(bronze_snapshot(spark, root, "sa_suppliers")),
        "silver_bank_transactions": silver_bank_transactions(
            bronze_snapshot(spark, root, "sa_bank_transactions")
        ),
    }


def build_gold(silver):
    return {
        "gold_vat_summary": vat_summary(silver["silver_invoices"]),
        "gold_supplier_scorecard": supplier_scorecard(
            silver["silver_invoices"], silver["silver_suppliers"]
        ),
        "gold_cash_flow_monthly": cash_flow_monthly(silver["silver_bank_transactions"]),
    }


class QualityError(RuntimeError):
    """A check of error severity failed; the run stops before the reports."""


def require_quality(report):
    """Stop on a failed check. The report has one row per check, so collecting it is small."""
    failed = report.where("status = 'FAIL'").collect()
    if failed:
        names = [f"{row.table}.{row.column} {row.check_name}: {row.failing_rows}" for row in failed]
        raise QualityError("; ".join(names))


def row_counts(layer, tables):
    parts = [
        df.agg(
            F.lit(layer).alias("layer"), F.lit(name).alias("table"), F.count("*").alias("rows")
        )
        for name, df in tables.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def run_day(spark, files, root, run_date, model_root=None):
    """One day. Silver is written once as Parquet, because checks, reports and scoring share it.

    With ``model_root``, the folder of stored runs, pending invoices are scored by the best of them; invoices of
    suppliers with too short a history go to a list of their own. Gives the row counts of the layers.
    """
    land_all(spark, files, f"{root}/bronze", run_date)
    write_layer(build_silver(spark, f"{root}/bronze", run_date), f"{root}/silver")
    names = ["silver_invoices", "silver_suppliers", "silver_bank_transactions"]
    silver = read_layer(spark, f"{root}/silver", names)
    require_quality(silver_report(*[silver[n] for n in names]))

    gold = build_gold(silver)
    write_layer(gold, f"{root}/gold")
    gold = read_layer(spark, f"{root}/gold", list(gold))
    export_gold(gold, f"{root}/export")

    counts = row_counts("silver", silver).unionByName(row_counts("gold", gold))
    if model_root:
        scored, apart = score_with_best(spark, silver["silver_invoices"], silver["silver_suppliers"], model_root)
        write_scores(scored, f"{root}/scores")
        write_csv(apart, f"{root}/not_scored")
    return counts
