"""Every operator as a query over the supplied tables: name -> (spark, folder) -> DataFrame."""

from decimal import Decimal

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ledgerline.functions import fixed_values as fv
from ledgerline.functions import rules as r
from ledgerline.operators import features as ft
from ledgerline.operators import joins, levels, matching, metrics, quality, reconcile, splits
from ledgerline.operators.silver import (
    silver_bank_transactions,
    silver_invoices,
    silver_suppliers,
    without_audit,
)
from ledgerline.plans import benchmark, daily, digest_diff as digests, explore, followup, gold, incremental_gold, operations, run_ledger, sketches, training
from ledgerline.session import shared_dir, use_checkpoint_dir
from ledgerline.sources import binding, bronze, landing, sinks, spoiled
from ledgerline.sources.binding import AS_OF
from ledgerline.streaming.incremental import bronze_incremental

QUERIES = {}


def named(name):
    def register(fn):
        QUERIES[name] = fn
        return fn

    return register


def query(fn):
    return named(fn.__name__)(fn)


# Cleaned inputs


def invoices(spark, d):
    return without_audit(silver_invoices(binding.raw_invoices(spark, d)))


def suppliers(spark, d):
    return without_audit(silver_suppliers(binding.raw_suppliers(spark, d)))


def bank(spark, d):
    return without_audit(silver_bank_transactions(binding.raw_bank_transactions(spark, d)))


def faulty_invoices(spark, d):
    return without_audit(silver_invoices(spoiled.raw_invoices(spark, d)))


def faulty_suppliers(spark, d):
    return without_audit(silver_suppliers(spoiled.raw_suppliers(spark, d)))


def faulty_bank(spark, d):
    return without_audit(silver_bank_transactions(spoiled.raw_bank_transactions(spark, d)))


def joined(spark, d):
    return joins.invoices_with_supplier(invoices(spark, d), suppliers(spark, d))


def scored_by_prior(spark, d):
    """Paid invoices scored by the supplier's prior: a score that plain SQL can repeat."""
    labelled = training.training_set(joined(spark, d))
    return labelled.withColumn(
        "late_probability", F.col("late_payment_probability").cast("double")
    ).where("late_probability is not null")


def rounded(df, digits, *columns):
    """Columns whose last digits depend on the order of summation, cut to comparable ones."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


# Sources and sinks


def receive(spark, d, root, as_of=AS_OF):
    """Write the three raw tables as the CSV files a source system would deliver."""
    files = []
    for dataset, df in [
        ("sa_invoices", binding.raw_invoices(spark, d, as_of)),
        ("sa_suppliers", binding.raw_suppliers(spark, d)),
        ("sa_bank_transactions", binding.raw_bank_transactions(spark, d, as_of)),
    ]:
        bronze.write_csv(df, f"{root}/received/{dataset}.csv", **bronze.DELIVERY)
        files.append((f"{root}/received/{dataset}.csv", dataset))
    return files


def receive_invoices(spark, d, root, as_of=AS_OF):
    path = f"{root}/received-{as_of}/sa_invoices.csv"
    bronze.write_csv(binding.raw_invoices(spark, d, as_of), path, **bronze.DELIVERY)
    return path


@query
def read_bronze(spark, d):
    root = shared_dir(spark, "read-bronze")
    path = receive_invoices(spark, d, root)
    bronze.land_bronze(spark, path, root, "sa_invoices", "2001-01-01")
    return bronze.read_bronze(spark, root, "sa_invoices")


@query
def land_bronze(spark, d):
    """Two days, the second landed twice: the rerun replaces its own day only."""
    root = shared_dir(spark, "land-bronze")
    path = receive_invoices(spark, d, root)
    for run_date in ["2001-01-01", "2001-01-02", "2001-01-02"]:
        bronze.land_bronze(spark, path, root, "sa_invoices", run_date)
    landed = bronze.read_bronze(spark, root, "sa_invoices")
    return landed.groupBy("ingested_date").agg(
        F.count("*").alias("rows"), F.count("payment_date").alias("paid_rows")
    )


@query
def land_all(spark, d):
    root = shared_dir(spark, "land-all")
    files = receive(spark, d, root) + [(f"{root}/received/rates.csv", "sarb_benchmarks")]
    outcomes = bronze.land_all(spark, files, f"{root}/bronze", "2001-01-01")
    status = spark.createDataFrame(outcomes, "dataset string, outcome string")
    landed = [name for name, outcome in outcomes if outcome == "landed"]
    counts = quality.union_all(
        [
            bronze.read_bronze(spark, f"{root}/bronze", name).agg(
                F.lit(name).alias("dataset"), F.count("*").alias("rows")
            )
            for name in landed
        ]
    )
    return status.join(F.broadcast(counts), "dataset", "left")


@query
def landing_manifest(spark, d):
    """A day landed twice, with a third landing lost before its switch: the second one's files are in force, whole."""
    root, dataset = shared_dir(spark, "manifest"), "sa_invoices"
    for day, as_of in [("2001-01-01", "2000-07-01"), ("2001-01-01", AS_OF), ("2001-01-02", "2000-07-01")]:
        bronze.land_bronze(spark, receive_invoices(spark, d, f"{root}/{day}-{as_of}", as_of), root, dataset, day)
    lost = receive_invoices(spark, d, f"{root}/lost", "1999-01-01")
    landing.copy_files(spark, bronze.data_files(spark, lost), root, dataset, "2001-01-01")
    agrees = (F.col("length") == F.col("length_now")) & (F.col("sha256") == F.col("sha256_now"))
    files = landing.verify(spark, root, dataset).groupBy("ingested_date")
    files = files.agg((F.count_if(agrees) == F.count("*")).alias("files_agree"))
    rows = bronze.read_bronze(spark, root, dataset).groupBy("ingested_date")
    rows = rows.agg(F.count("*").alias("rows"), F.count_if(F.col("invoice_status") == "Overdue").alias("overdue"))
    return rows.join(files, "ingested_date")


def land_two_days(spark, d, root):
    """The same invoices as seen on two days: states differ, ids do not."""
    for as_of in ["2000-07-01", "2001-01-01"]:
        path = receive_invoices(spark, d, root, as_of)
        bronze.land_bronze(spark, path, f"{root}/bronze", "sa_invoices", as_of)


def status_counts(df):
    return df.groupBy("invoice_status").agg(
        F.count("*").alias("invoices"),
        F.sum("amount_incl_vat").alias("total"),
        F.sum("days_past_due").alias("days"),
    )


@query
def bronze_snapshot(spark, d):
    root = shared_dir(spark, "snapshot")
    land_two_days(spark, d, root)
    latest = bronze.bronze_snapshot(spark, f"{root}/bronze", "sa_invoices")
    return status_counts(silver_invoices(latest))


@named("bronze_incremental")
def ingest_two_days(spark, d):
    """Land a day, ingest, land the next twice, ingest after each: every day is there once."""
    root = shared_dir(spark, "incremental")
    target, log = f"{root}/silver", f"{root}/log"
    for as_of in ["2000-07-01", "2001-01-01", "2001-01-01"]:
        path = receive_invoices(spark, d, root, as_of)
        bronze.land_bronze(spark, path, f"{root}/bronze", "sa_invoices", as_of)
        bronze_incremental(spark, f"{root}/bronze", "sa_invoices", target, log)
    return status_counts(spark.read.parquet(target))


@query
def export_gold(spark, d):
    root = shared_dir(spark, "export")
    silver = {
        "silver_invoices": invoices(spark, d),
        "silver_suppliers": suppliers(spark, d),
        "silver_bank_transactions": bank(spark, d),
    }
    tables = daily.build_gold(silver)
    sinks.export_gold(tables, root)
    sums = {
        "gold_vat_summary": "claimable_vat_input_tax",
        "gold_supplier_scorecard": "total_spend_zar",
        "gold_cash_flow_monthly": "net_cash_flow_zar",
    }
    parts = [
        bronze.read_csv(spark, f"{root}/{name}").agg(
            F.lit(name).alias("table"),
            F.count("*").alias("rows"),
            F.sum(F.col(c).cast("decimal(28,2)")).cast("decimal(38,2)").alias("total"),
        )
        for name, c in sums.items()
    ]
    return quality.union_all(parts)


@query
def write_scores(spark, d):
    path = shared_dir(spark, "scores")
    pending = joined(spark, d).where(r.has_status("PENDING"))
    scored = pending.withColumn(
        "late_probability", F.col("late_payment_probability").cast("double")
    ).withColumn("risk_tier", r.risk_tier("late_probability"))
    sinks.write_scores(scored, path)
    back = bronze.read_csv(spark, path)
    return back.select(
        "invoice_id",
        "supplier_id",
        r.safe_date("due_date").alias("due_date"),
        r.money("amount_incl_vat").alias("amount_incl_vat"),
        F.col("late_probability").cast("double").alias("late_probability"),
        "risk_tier",
    )


@query
def daily_run(spark, d):
    root = shared_dir(spark, "daily")
    return daily.run_day(spark, receive(spark, d, root), root, "2001-01-01")


# Silver and its rules


@named("silver_invoices")
def silver_invoices_clean(spark, d):
    return invoices(spark, d)


@named("silver_suppliers")
def silver_suppliers_clean(spark, d):
    return suppliers(spark, d)


@named("silver_bank_transactions")
def silver_bank_clean(spark, d):
    return bank(spark, d)


def lines(spark, d):
    key = F.concat_ws(
        "-",
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("l_quantity").cast("int"),
    )
    return binding.table(spark, d, "lineitem").withColumn("invoice_id", key)


@query
def safe_dates(spark, d):
    """Ship dates as text, with an impossible month wherever the quantity is a multiple of ten."""
    month = F.month("l_shipdate") + F.when(F.col("l_quantity").cast("int") % 10 == 0, 12).otherwise(0)
    text = F.format_string("%04d-%02d-%02d", F.year("l_shipdate"), month, F.dayofmonth("l_shipdate"))
    raw = lines(spark, d).withColumn("raw_date", text)
    return raw.select(
        "invoice_id",
        "raw_date",
        r.safe_date("raw_date").alias("parsed_date"),
        r.safe_timestamp("raw_date").alias("parsed_time"),
    )


@query
def positive_money(spark, d):
    """Prices shifted below zero and a tax that is negative, zero or positive, both as text."""
    raw = lines(spark, d).withColumns(
        {
            "raw_amount": (r.money("l_extendedprice") - 50000).cast("string"),
            "raw_vat": ((F.col("l_tax").cast("decimal(4,2)") - Decimal("0.04")) * 1000)
            .cast(r.MONEY)
            .cast("string"),
        }
    )
    return raw.select(
        "invoice_id",
        r.positive_money("raw_amount").alias("amount"),
        r.positive_money("raw_vat", allow_zero=True).alias("vat"),
    )


@query
def vat_validation(spark, d):
    """Tax moved off the exact 15% by -0.03 to +0.03, across both borders of the tolerance."""
    shift = ((F.col("l_linenumber") - 4) * F.lit(Decimal("0.01"))).cast(r.MONEY)
    raw = lines(spark, d).withColumn("excl", r.money("l_extendedprice"))
    moved = raw.withColumn("vat", (r.derive_vat("excl") + shift).cast(r.MONEY))
    return moved.select(
        "invoice_id", "excl", "vat", r.vat_status("excl", "vat").alias("vat_validation_status")
    )


@query
def positive_terms(spark, d):
    raw = lines(spark, d).withColumn("raw_terms", ((F.col("l_suppkey") % 5) * 10 - 10).cast("string"))
    return raw.select("invoice_id", r.positive_terms("raw_terms").alias("payment_terms_days"))


@query
def normalise_status(spark, d):
    n = F.col("l_linenumber")
    raw = (
        F.when(n == 1, "Paid").when(n == 2, "Overdue").when(n == 3, "Pending").when(n == 4, "paid")
    ).when(n == 5, "Void")
    statuses = lines(spark, d).withColumn("raw_status", raw)
    return statuses.select("invoice_id", r.normalise_status("raw_status").alias("invoice_status"))


@query
def normalise_text(spark, d):
    raw = binding.table(spark, d, "part").withColumns(
        {
            "raw_name": F.concat(F.lit("  "), F.initcap("p_name"), F.lit(" ")),
            "raw_type": F.concat(F.lit(" "), F.col("p_type"), F.lit("   ")),
        }
    )
    return raw.select(
        "p_partkey",
        r.upper_trim("raw_name").alias("upper_name"),
        r.lower_trim("raw_name").alias("lower_name"),
        F.trim("raw_type").alias("trimmed_type"),
    )


# Joins


@query
def invoices_with_supplier(spark, d):
    return joined(spark, d)


@query
def scorecard_left_join(spark, d):
    return gold.supplier_scorecard(faulty_invoices(spark, d), faulty_suppliers(spark, d), keep_orphans=True)


@query
def merge_integrity(spark, d):
    return joins.merge_integrity(faulty_invoices(spark, d), faulty_suppliers(spark, d))


@query
def recon_by_reference(spark, d):
    return joins.recon_by_reference(faulty_bank(spark, d), invoices(spark, d))


@query
def matched_by_reference(spark, d):
    return joins.matched_by_reference(faulty_bank(spark, d), invoices(spark, d))


@query
def unmatched_by_reference(spark, d):
    return joins.unmatched_by_reference(faulty_bank(spark, d), invoices(spark, d))


# Life-cycle rules


@query
def derive_vat(spark, d):
    raw = binding.raw_invoices(spark, d)
    priced = raw.withColumn("vat", r.derive_vat("amount_excl_vat"))
    return priced.select(
        "invoice_id", "amount_excl_vat", "vat", r.derive_incl("amount_excl_vat", "vat").alias("incl")
    )


@query
def derive_due_date(spark, d):
    return binding.raw_invoices(spark, d).select(
        "invoice_id", "invoice_date", "payment_terms_days", "due_date"
    )


@query
def derive_days_past_due(spark, d):
    return binding.raw_invoices(spark, d).select(
        "invoice_id", "due_date", "payment_date", "days_past_due"
    )


@query
def derive_status(spark, d):
    return binding.raw_invoices(spark, d).select(
        "invoice_id", "is_paid", "due_date", "invoice_status"
    )


@query
def derive_is_late(spark, d):
    return binding.raw_invoices(spark, d).select("invoice_id", "is_paid", "is_late")


@query
def cashbook(spark, d):
    return binding.raw_bank_transactions(spark, d)


# Data quality


@query
def dq_not_null(spark, d):
    return quality.dq_not_null(
        {
            "silver_invoices": spoiled.raw_invoices(spark, d),
            "silver_suppliers": spoiled.raw_suppliers(spark, d),
            "silver_bank_transactions": spoiled.raw_bank_transactions(spark, d),
        }
    )


@query
def dq_accepted_values(spark, d):
    """Statuses in upper case but not mapped, and a tax state that is lost where the tax is zero."""
    raw = spoiled.raw_invoices(spark, d).withColumns(
        {
            "invoice_status": F.upper("invoice_status"),
            "vat_validation_status": F.when(
                F.col("amount_excl_vat") > 20000, r.vat_status("amount_excl_vat", "vat_amount")
            ).otherwise("UNCHECKED"),
        }
    )
    return quality.dq_accepted_values(raw)


@query
def dq_unique_warn(spark, d):
    return quality.dq_unique_warn(invoices(spark, d), suppliers(spark, d))


@query
def dq_duplicate_keys(spark, d):
    """Group by / having: suppliers that occur on more than one invoice."""
    return quality.duplicate_keys(invoices(spark, d), "supplier_id")


@query
def dq_currency(spark, d):
    return quality.dq_currency(faulty_invoices(spark, d))


@query
def dq_missing_profile(spark, d):
    return quality.dq_missing_profile(joined(spark, d))


@query
def dq_sanity(spark, d):
    return quality.dq_sanity(spoiled.raw_invoices(spark, d), AS_OF)


@query
def dq_formats(spark, d):
    return quality.dq_formats(spoiled.raw_suppliers(spark, d))


@query
def dq_unique_ids(spark, d):
    return quality.dq_unique_ids(spoiled.raw_suppliers(spark, d), spoiled.raw_invoices(spark, d))


@query
def dq_amounts(spark, d):
    return quality.dq_amounts(spoiled.raw_invoices(spark, d))


@query
def dq_dates(spark, d):
    return quality.dq_dates(spoiled.raw_invoices(spark, d))


@query
def dq_domains(spark, d):
    return quality.dq_domains(spoiled.raw_invoices(spark, d), spoiled.raw_suppliers(spark, d))


@query
def dq_required(spark, d):
    return quality.dq_required(spoiled.raw_invoices(spark, d))


@query
def dq_silver_report(spark, d):
    return quality.silver_report(faulty_invoices(spark, d), faulty_suppliers(spark, d), faulty_bank(spark, d))


# Gold


@query
def vat_summary(spark, d):
    return gold.vat_summary(invoices(spark, d))


@query
def supplier_scorecard(spark, d):
    return gold.supplier_scorecard(invoices(spark, d), suppliers(spark, d))


@query
def cash_flow_monthly(spark, d):
    return gold.cash_flow_monthly(bank(spark, d))


@query
def vat_summary_by_payment_period(spark, d):
    return gold.vat_summary_by_payment_period(invoices(spark, d))


# Exploration


@query
def monthly_trend(spark, d):
    return explore.monthly_trend(invoices(spark, d))


@query
def late_by_category(spark, d):
    return explore.late_by_category(invoices(spark, d))


@query
def late_exposure_by_category(spark, d):
    return explore.late_exposure_by_category(invoices(spark, d))


@query
def numeric_profile(spark, d):
    profile = explore.numeric_profile(joined(spark, d))
    return rounded(profile, 3, "mean", "std", "p25", "p50", "p75")


@query
def amount_histogram(spark, d):
    return rounded(explore.amount_histogram(invoices(spark, d)), 6, "bin_start", "bin_end")


@query
def days_delta_histogram(spark, d):
    return rounded(explore.days_delta_histogram(invoices(spark, d)), 6, "bin_start", "bin_end")


@query
def amount_median(spark, d):
    return rounded(explore.amount_median(invoices(spark, d)), 4, "median_amount")


@query
def correlation_matrix(spark, d):
    return rounded(explore.correlation_matrix(joined(spark, d)), 6, "correlation")


@query
def late_correlates(spark, d):
    return rounded(explore.late_correlates(joined(spark, d)), 6, "correlation")


@query
def status_breakdown(spark, d):
    return explore.status_breakdown(invoices(spark, d))


@query
def kpi_summary(spark, d):
    return explore.kpi_summary(invoices(spark, d))


@query
def cash_flow_calendar(spark, d):
    """Cash flow of a ledger that lacks every fifth month: the gaps are months of zeros."""
    gaps = F.pmod(F.month("transaction_date") + F.year("transaction_date") * 12, F.lit(5)) == 0
    return gold.cash_flow_monthly(bank(spark, d).where(~gaps), calendar=True)


@query
def sketch_span(spark, d):
    """Distinct invoices-a-supplier and amount quantiles of a span of days, from stored day states, against exact values."""
    inv, path = invoices(spark, d), shared_dir(spark, "sketches")
    sketches.day_sketches(inv, "invoice_date", ["category"], ["supplier_id", "due_date"], ["amount_incl_vat"]).write.parquet(path)
    first, last = "1994-03-01", "1997-02-28"
    estimates = sketches.over_span(spark.read.parquet(path), ["category"], first, last)
    rows = inv.where(F.col("invoice_date").between(first, last))
    return sketches.checked(rows, estimates, ["category"], "due_date", "amount_incl_vat")


def with_part(df):
    """The part number inside the invoice id: a column of many levels."""
    return df.withColumn("part", F.get(F.split("invoice_id", "-"), F.lit(2)))


@query
def level_table(spark, d):
    """Levels of a column with as many levels as there are parts, numbered in the order of their text."""
    return levels.fit_levels(with_part(invoices(spark, d)), "part", shared_dir(spark, "levels"))


@query
def sparse_one_hot(spark, d):
    """Levels of the paid invoices applied to the open ones: where each vector's only entry is, if it has one."""
    even = F.pmod(F.split("invoice_id", "-")[0].cast("bigint"), F.lit(2)) == 0
    inv = with_part(invoices(spark, d)).where(even | ~F.col("is_paid"))
    table = levels.fit_levels(inv.where("is_paid"), "part", shared_dir(spark, "levels"), min_rows=8)
    encoded = levels.one_hot(levels.with_level_id(inv.where("not is_paid"), "part", table), table.count())
    vector = F.unwrap_udt("level_vector")
    return encoded.select(
        "invoice_id",
        F.when(F.size(vector["indices"]) > 0, vector["indices"][0].cast("long")).alias("level_id"),
        F.size(vector["indices"]).alias("entries"),
        vector["size"].alias("size"),
    )


def landed_in_parts(df, spoiled_day, root, refresh):
    """Three landing days by order number, the second one first with ``spoiled_day``'s rows, later replaced.

    ``refresh`` is called with the table and the days after each landing; its last answer is returned.
    """
    spark, target = df.sparkSession, f"{root}/silver"
    number = F.regexp_extract(df.columns[0], r"(\d+)", 1).cast("long")
    dated = df.withColumn("ingested_date", F.concat(F.lit("2001-01-0"), F.pmod(number, F.lit(3)) + 1))
    days = ["2001-01-01", "2001-01-02", "2001-01-03"]
    landings = [
        (dated.where(F.col("ingested_date") == days[0]), [days[0]]),
        (spoiled_day(dated.where(F.col("ingested_date") == days[1])), [days[1]]),
        (dated.where(F.col("ingested_date") == days[2]), [days[2]]),
        (dated.where(F.col("ingested_date") == days[1]), [days[1]]),
    ]
    for rows, changed in landings:
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("ingested_date").parquet(target)
        answer = refresh(spark.read.parquet(target), changed)
    return answer


def spoiled_invoice_day(df):
    """Some invoices missing, others much later and dearer than they will turn out to be."""
    late = F.col("days_past_due") + F.lit(1000)
    return df.where("day(invoice_date) <> 7").withColumns(
        {"days_past_due": late, "amount_incl_vat": (F.col("amount_incl_vat") * 2).cast("decimal(18,2)")}
    )


def spoiled_ledger_day(df):
    """The first years are missing, and one month is there that will go."""
    return df.where("year(transaction_date) > 1994").withColumn(
        "transaction_date", F.when(F.dayofmonth("transaction_date") == 7, F.lit("1980-05-05").cast("date")).otherwise(F.col("transaction_date"))
    )


@query
def incremental_vat_summary(spark, d):
    """The tax summary brought up to date landing by landing."""
    root = shared_dir(spark, "gold-vat")
    return landed_in_parts(
        invoices(spark, d),
        spoiled_invoice_day,
        root,
        lambda df, days: incremental_gold.update_vat(spark, df, f"{root}/gold", days),
    )


@query
def incremental_scorecard(spark, d):
    root = shared_dir(spark, "gold-scorecard")
    master = suppliers(spark, d)
    return landed_in_parts(
        invoices(spark, d),
        spoiled_invoice_day,
        root,
        lambda df, days: incremental_gold.update_scorecard(spark, df, master, f"{root}/gold", days),
    )


@query
def incremental_cash_flow(spark, d):
    root = shared_dir(spark, "gold-cash")
    return landed_in_parts(
        bank(spark, d),
        spoiled_ledger_day,
        root,
        lambda df, days: incremental_gold.update_cash_flow(spark, df, f"{root}/gold", days),
    )


@query
def dataset_snapshot(spark, d):
    return explore.dataset_snapshot(invoices(spark, d))


# Operations


@query
def overdue_summary(spark, d):
    return operations.overdue_summary(invoices(spark, d))


@query
def overdue_by_category(spark, d):
    return operations.overdue_by_category(invoices(spark, d))


@query
def overdue_boxplot(spark, d):
    return operations.overdue_boxplot(invoices(spark, d))


@query
def terms_compliance(spark, d):
    return operations.terms_compliance(invoices(spark, d))


@query
def compliance_by_category(spark, d):
    return operations.compliance_by_category(invoices(spark, d))


@query
def bank_reconciliation(spark, d):
    return reconcile.bank_reconciliation(bank(spark, d), invoices(spark, d))


@query
def bank_reconciliation_debits(spark, d):
    return reconcile.bank_reconciliation(bank(spark, d), invoices(spark, d), "debits")


@query
def bank_reconciliation_lines(spark, d):
    """Customer receipts probed against invoices: every ledger line with its flag."""
    receipts_as_debits = bank(spark, d).withColumn(
        "debit_amount", F.greatest("debit_amount", "credit_amount")
    )
    flagged = reconcile.flag_lines(receipts_as_debits, invoices(spark, d))
    return flagged.select("transaction_id", "transaction_date", "debit_amount", "matched")


def double_payments(spark, d):
    """The ledger with some invoices paid again; the reference names the supplier."""
    ledger = without_audit(silver_bank_transactions(spoiled.raw_double_payments(spark, d)))
    reference = F.col("invoice_reference")
    fourth = F.substring_index(F.substring_index(reference, "-", 4), "-", -1)
    return ledger.withColumn("supplier_id", F.when(F.substring_index(reference, "-", 3) != reference, fourth))


SAME_SUPPLIER = ("supplier_id", "supplier_id")


@query
def recon_one_to_one(spark, d):
    """Each invoice settles one payment of the same amount, supplier and week."""
    return matching.recon_one_to_one(double_payments(spark, d), invoices(spark, d), suppliers=SAME_SUPPLIER)


@query
def recon_double_payments(spark, d):
    """The payments that a one-to-one matching leaves over although an invoice lies in reach."""
    points = matching.one_to_one_points(double_payments(spark, d), invoices(spark, d), suppliers=SAME_SUPPLIER)
    return points.where("left_over > 0 and near").drop("near")


@query
def recon_one_to_one_amounts(spark, d):
    """Payments against invoices of any supplier paid that day, amounts within tolerance, each invoice once."""
    return matching.one_to_one_points(double_payments(spark, d), invoices(spark, d), axis="amount")


@query
def monthly_reconciliation(spark, d):
    return reconcile.monthly_reconciliation(bank(spark, d), invoices(spark, d))


@query
def vat_mismatch_rate(spark, d):
    return operations.vat_mismatch_rate(invoices(spark, d))


@query
def vat_mismatch_by_supplier(spark, d):
    return operations.vat_mismatch_rate(invoices(spark, d), "supplier_id")


# Benchmarks


def shifted(spark, d):
    """Invoices moved 25 years ahead, so that they meet the months of the rate table."""
    return invoices(spark, d).withColumn("invoice_date", F.add_months("invoice_date", 300))


@query
def internal_kpis(spark, d):
    return benchmark.internal_kpis(invoices(spark, d))


@query
def yoy_change(spark, d):
    periods = benchmark.late_and_unpaid_by_year(
        invoices(spark, d), binding.supplier_regions(spark, d)
    )
    return benchmark.yoy_change(periods, 1999, 2000)


@query
def region_ranking(spark, d):
    return benchmark.region_ranking(
        benchmark.region_totals(invoices(spark, d), binding.supplier_regions(spark, d))
    )


@query
def benchmark_gap(spark, d):
    return benchmark.benchmark_gap(invoices(spark, d))


@query
def prime_rate_join(spark, d):
    return benchmark.prime_rate_join(shifted(spark, d), benchmark.prime_rates(spark))


@query
def late_vs_prime(spark, d):
    result = benchmark.late_vs_prime(shifted(spark, d), benchmark.prime_rates(spark))
    return rounded(result, 6, "correlation")


@query
def per_invoice_late_cost(spark, d):
    return benchmark.per_invoice_late_cost(shifted(spark, d), benchmark.prime_rates(spark))


@query
def vat_effective_rate(spark, d):
    return benchmark.vat_effective_rate(invoices(spark, d))


@query
def vat_by_category(spark, d):
    return benchmark.vat_by_category(invoices(spark, d))


@query
def rag_scorecard(spark, d):
    return rounded(benchmark.rag_scorecard(invoices(spark, d)), 9, "gap_vs_best")


@query
def financing_cost(spark, d):
    cost = benchmark.financing_cost(invoices(spark, d))
    return rounded(cost, 2, "target_late_spend", "improvement_gap", "estimated_cost")


# Features, splits and metrics


@query
def features(spark, d):
    fitted = ft.fit_features(invoices(spark, d))
    matrix = ft.engineer_features(joined(spark, d), fitted, keep=["invoice_id"])
    return rounded(matrix, 6, "log_invoice_amount")


@query
def align_features(spark, d):
    """Pending invoices with the state of their own batch, in the columns fitted on paid ones."""
    everything = joined(spark, d)
    paid = training.training_set(invoices(spark, d))
    fitted = ft.FittedFeatures(0.0, ft.category_levels(paid))
    return rounded(
        training.pending_features(everything, fitted, batch_state=True), 6, "log_invoice_amount"
    )


@query
def training_set(spark, d):
    return training.training_summary(invoices(spark, d))


@query
def stratified_split(spark, d):
    paid = training.training_set(invoices(spark, d)).select("invoice_id", "label")
    return splits.stratified_split(paid, "label", "invoice_id")


@query
def stratified_folds(spark, d):
    paid = training.training_set(invoices(spark, d)).select("invoice_id", "label")
    return splits.stratified_folds(paid, "label", "invoice_id")


@query
def roc_auc(spark, d):
    return metrics.roc_auc(scored_by_prior(spark, d))


@query
def roc_auc_by_fold(spark, d):
    scored = scored_by_prior(spark, d).select("invoice_id", "label", "late_probability")
    folded = splits.stratified_folds(scored, "label", "invoice_id")
    return metrics.roc_auc(folded, group_cols=["fold"])


@query
def classification_report(spark, d):
    report = metrics.classification_report(scored_by_prior(spark, d), threshold=0.25)
    return rounded(report, 9, "precision", "recall", "f1_score")


@query
def tier_counts(spark, d):
    scored = joined(spark, d).where(r.has_status("PENDING"))
    tiers = scored.withColumn("risk_tier", r.risk_tier("late_payment_probability"))
    return metrics.tier_counts(tiers)


@query
def class_weights(spark, d):
    return metrics.class_weights(training.training_set(invoices(spark, d)))


@query
def model_monitor(spark, d):
    return metrics.model_monitor(scored_by_prior(spark, d), "payment_date")


def scorer_runs(spark, d):
    """One run per single-column scorer, evaluated on the test share of the paid invoices."""
    scored = splits.stratified_split(
        scored_by_prior(spark, d).where("amount_incl_vat is not null"), "label", "invoice_id"
    )
    size = F.col("amount_incl_vat").cast("double")
    scorers = {
        "supplier_prior": F.col("late_probability"),
        "relative_amount": size / (size + F.col("avg_invoice_value_zar").cast("double")),
        "payment_terms": F.col("payment_terms_days") / 100.0,
    }
    rows = scored.select(
        "label",
        "split",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias("model_type"), s.alias("late_probability"))
                    for name, s in scorers.items()
                ]
            )
        ),
    )
    test = metrics.roc_auc(rows.where("split = 'test'"), group_cols=["model_type"])
    train_rows = rows.groupBy("model_type").agg(
        r.count_where(F.col("split") == "train").alias("n_train_rows")
    )
    return test.join(train_rows, "model_type").select(
        F.concat(F.lit("run-"), "model_type").alias("run_id"),
        "model_type",
        F.col("auc").alias("test_auc"),
        F.lit(1).alias("n_features"),
        "n_train_rows",
    )


@query
def scorer_model_runs(spark, d):
    """The run table filled by single-column scorers, whose AUC plain SQL can repeat."""
    path = shared_dir(spark, "runs")
    training.append_runs(scorer_runs(spark, d), path)
    return spark.read.parquet(path)


@query
def scorer_best_run(spark, d):
    return training.best_run(scorer_runs(spark, d))


#: Ledgers trained in this process, by application and tables: five queries read the same three runs.
TRAINED = {}


def trained(spark, d):
    """Folder of a ledger with the three models, fitted and cross-validated in full."""
    key = (spark.sparkContext.applicationId, d)
    if key not in TRAINED:
        root = shared_dir(spark, "ledger")
        training.train_all(spark, invoices(spark, d), suppliers(spark, d), root, "2001-01-01")
        TRAINED[key] = root
    return TRAINED[key]


@query
def model_runs(spark, d):
    """The runs in force of the three trained models."""
    runs = run_ledger.runs(spark, trained(spark, d))
    good = F.col("cv_auc_mean").between(0, 1) & F.col("test_auc").between(0, 1) & (F.col("cv_auc_std") >= 0)
    return runs.select("run_id", "model_type", "attempt", "n_features", "n_train_rows", good.alias("has_auc"))


@query
def best_run(spark, d):
    """The best of the trained runs, and whether its stored model gives the AUC that its row names."""
    root = trained(spark, d)
    run_id, model, fitted = training.load_best(spark, root)
    row = training.best_run(run_ledger.runs(spark, root))
    prepared = training.prepare(invoices(spark, d), suppliers(spark, d))
    auc = metrics.roc_auc(training.with_probability(model, prepared.test)).first().auc
    prepared.release()
    agrees = (F.abs(F.col("test_auc") - F.lit(auc)) < 1e-9) & (F.col("n_features") == len(fitted.columns))
    return row.select("run_id", "model_type", "n_train_rows", (agrees & (F.col("run_id") == run_id)).alias("model_agrees"))


# Model training


def evaluated(spark, d, model_type):
    """Fit, score the test share, store and load again; what must hold whatever the coefficients are."""
    use_checkpoint_dir(spark)
    prepared = training.prepare(invoices(spark, d), suppliers(spark, d))
    model = training.fit_model(spark, prepared, model_type)
    path = shared_dir(spark, "model")
    training.save_model(spark, model, prepared.fitted, path)
    loaded, _ = training.load_model(spark, path)
    scored = training.with_probability(model, prepared.test)
    again = training.with_probability(loaded, prepared.test)
    pairs = scored.select("invoice_id", "late_probability").join(
        again.select("invoice_id", F.col("late_probability").alias("again")), "invoice_id"
    )
    other_auc = BinaryClassificationEvaluator(numBins=0).evaluate(scored)
    support = metrics.classification_report(scored).where("class in ('On-time', 'Late')")
    row = (
        model_type,
        len(prepared.fitted.columns),
        prepared.n_train,
        scored.count(),
        support.agg(F.sum("support")).first()[0],
        abs(metrics.roc_auc(scored).first().auc - other_auc) < 1e-9,
        pairs.where("late_probability <> again").count() == 0,
    )
    result = spark.createDataFrame(
        [row],
        "model_type string, n_features int, n_train_rows long, n_test_rows long, confusion_total long, "
        "auc_agrees boolean, stored_model_agrees boolean",
    )
    return result, model, prepared


@query
def train_gbt(spark, d):
    result, _, prepared = evaluated(spark, d, "GradientBoosting")
    prepared.release()
    return result


@query
def train_rf(spark, d):
    result, _, prepared = evaluated(spark, d, "RandomForest")
    prepared.release()
    return result


@query
def train_lr(spark, d):
    """Also: the gradient of the penalised loss vanishes at the fitted coefficients."""
    result, model, prepared = evaluated(spark, d, "LogisticRegression")
    fit = model.stages[-1]
    rows = training.with_probability(model, prepared.train)
    error = F.col("late_probability") - F.col("label")
    parts = rows.select(error.alias("e"), F.posexplode(vector_to_array("scaled")).alias("i", "x"))
    slopes = parts.groupBy("i").agg(F.avg(F.col("e") * F.col("x")).alias("g")).collect()
    penalty = fit.getRegParam()
    steepest = max(abs(row.g + penalty * fit.coefficients[row.i]) for row in slopes)
    prepared.release()
    return result.withColumn("gradient_vanishes", F.lit(bool(steepest < 1e-3)))


@query
def cv_auc(spark, d):
    """Cross-validation of the three models: the folds' classes, and whether each fold has an AUC."""
    per_fold = run_ledger.folds(spark, trained(spark, d))
    return per_fold.select("model_type", "fold", "positives", "negatives", F.col("auc").between(0, 1).alias("has_auc"))


@query
def training_flow(spark, d):
    """Three models with cross-validation, run rows, reports and stored models; the best run leads to its model.

    The flow runs again on the same rows: no run is fitted twice.
    """
    root = trained(spark, d)
    training.train_all(spark, invoices(spark, d), suppliers(spark, d), root, "2001-01-01")
    run_id, model, fitted = training.load_best(spark, root)
    supports = run_ledger.reports(spark, root).where("class in ('On-time', 'Late')").groupBy("run_id")
    runs = run_ledger.runs(spark, root).join(supports.agg(F.sum("support").alias("n_test_rows")), "run_id")
    return runs.select(
        "run_id",
        "model_type",
        "attempt",
        "n_features",
        "n_train_rows",
        "n_test_rows",
        (F.col("cv_auc_mean").between(0, 1) & F.col("test_auc").between(0, 1)).alias("has_auc"),
        (F.col("run_id") == run_id).alias("is_best"),
    )


def tier_by_rule(p):
    return F.when(p >= fv.RISK_HIGH, "HIGH").when(p >= fv.RISK_MEDIUM, "MEDIUM").otherwise("LOW")


@query
def score_open_invoices(spark, d):
    """Pending invoices scored by the best trained run; those with too short a history are set apart."""
    scored, apart = training.score_with_best(spark, invoices(spark, d), suppliers(spark, d), trained(spark, d))
    p = F.col("late_probability")
    columns = ["invoice_id", "supplier_id", "due_date", "amount_incl_vat"]
    good = p.between(0, 1) & (F.col("risk_tier") == tier_by_rule(p))
    return scored.select(*columns, F.lit(True).alias("is_scored"), good.alias("tier_agrees")).unionByName(
        apart.select(*columns, F.lit(False).alias("is_scored"), F.lit(None).cast("boolean").alias("tier_agrees"))
    )


@query
def open_invoice_tiers(spark, d):
    """Scores on tables with a pattern: late and punctual categories lie on both sides of the tiers' limits.

    Two categories pay late by chance; their tier is not stated, only that it follows from the probability.
    """
    root = shared_dir(spark, "tiers")
    inv = without_audit(silver_invoices(spoiled.raw_patterned_invoices(spark, d)))
    sup = suppliers(spark, d)
    training.train_all(spark, inv, sup, root, "2001-01-01", with_cv=False)
    scored, _ = training.score_with_best(spark, inv, sup, root)
    p, k = F.col("late_probability"), F.pmod(F.col("supplier_id").cast("bigint"), F.lit(10))
    by_chance = k.isin(3, 4)
    return scored.select(
        "invoice_id",
        F.when(~by_chance, F.col("risk_tier")).alias("risk_tier"),
        (F.col("risk_tier") == tier_by_rule(p)).alias("tier_agrees"),
        F.when(~by_chance, p >= 0.5).alias("rather_late"),
    )


# Follow-up


def open_invoices(df):
    return df.where(~F.col("is_paid"))


@query
def insufficient_history(spark, d):
    everything = invoices(spark, d)
    return followup.insufficient_history(open_invoices(everything), everything, minimum=200)


@query
def insufficient_history_default(spark, d):
    everything = invoices(spark, d)
    return followup.insufficient_history(open_invoices(everything), everything)


@query
def risk_ranked_open_invoices(spark, d):
    return followup.risk_ranked_open_invoices(open_invoices(joined(spark, d)))


@query
def rolling_compliance_90d(spark, d):
    return followup.rolling_compliance_90d(invoices(spark, d))


@query
def unreconciled_exceptions(spark, d):
    return followup.unreconciled_exceptions(faulty_bank(spark, d), invoices(spark, d), AS_OF)


@query
def unreconciled_receipts(spark, d):
    """The same rule on the credit side, where no line names an invoice."""
    return followup.unreconciled_exceptions(
        bank(spark, d), invoices(spark, d), AS_OF, amount="credit_amount"
    )


@query
def unreconciled_by_tolerance(spark, d):
    """Unreconciled receipts that lie near no paid invoice in days and amount."""
    return followup.unreconciled_exceptions(
        bank(spark, d), invoices(spark, d), AS_OF, amount="credit_amount", by_tolerance=True
    )


@query
def escalation_tier(spark, d):
    return followup.escalation_tier(invoices(spark, d), AS_OF)


@query
def due_soon_alert(spark, d):
    return followup.due_soon_alert(invoices(spark, d), AS_OF)


@query
def log_scale_outliers(spark, d):
    return rounded(followup.log_scale_outliers(invoices(spark, d)), 5, "z_score")


@query
def audit_log(spark, d):
    return joins.audit_log(faulty_bank(spark, d), invoices(spark, d))


def issued_by(spark, d, day):
    issued = binding.raw_invoices(spark, d, day)
    return issued.where(F.col("invoice_date") <= F.lit(day).cast("date"))


@query
def snapshot_diff(spark, d):
    return followup.snapshot_diff(
        issued_by(spark, d, "2000-07-01"), issued_by(spark, d, AS_OF), "invoice_id"
    )


@query
def snapshot_changes(spark, d):
    return followup.snapshot_changes(
        issued_by(spark, d, "2000-07-01"), issued_by(spark, d, AS_OF), "invoice_id"
    )


def stored_snapshots(spark, root, before, after):
    for name, df in (("before", before), ("after", after)):
        digests.store_digests(df, "invoice_id", f"{root}/{name}", buckets=128, group=16)
    return f"{root}/before", f"{root}/after"


@query
def digest_diff(spark, d):
    """The changed, added and removed invoices between two stored snapshots."""
    root = shared_dir(spark, "digests")
    paths = stored_snapshots(spark, root, issued_by(spark, d, "2000-07-01"), issued_by(spark, d, AS_OF))
    return digests.digest_diff(spark, *paths, "invoice_id")


@query
def digest_changes(spark, d):
    root = shared_dir(spark, "digests")
    paths = stored_snapshots(spark, root, issued_by(spark, d, "2000-07-01"), issued_by(spark, d, AS_OF))
    return digests.digest_changes(spark, *paths, "invoice_id")


@query
def digest_diff_few(spark, d):
    """Snapshots that differ in one order's invoices: no more buckets are opened than invoices changed."""
    root = shared_dir(spark, "digests")
    before = binding.raw_invoices(spark, d)
    changed = F.col("invoice_id").startswith("1-")
    paid = F.when(changed, "Settled").otherwise(F.col("invoice_status"))
    paths = stored_snapshots(spark, root, before, before.withColumn("invoice_status", paid))
    opened = digests.opened_buckets(spark, *paths)
    found = digests.digest_diff(spark, *paths, "invoice_id", opened)
    return found.groupBy("change").agg(F.count("*").alias("rows"), (F.count("*") >= len(opened)).alias("opened_few"))
