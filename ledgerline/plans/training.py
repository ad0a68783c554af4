"""Training, evaluation and scoring of the late-payment classifier with Spark ML."""

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial, reduce
from math import ceil

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ledgerline.functions import fixed_values as fv
from ledgerline.functions import rules as r
from ledgerline.operators.features import (
    FittedFeatures,
    align_features,
    engineer_features,
    fit_features,
)
from ledgerline.operators.joins import invoices_with_supplier
from ledgerline.operators.metrics import class_weights, classification_report, roc_auc
from ledgerline.operators.splits import stratified_folds, stratified_split
from ledgerline.plans import run_ledger
from ledgerline.plans.followup import insufficient_history
from ledgerline.session import use_checkpoint_dir
from ledgerline.sources.sinks import SCORE_COLUMNS

RUN_SCHEMA = (
    "run_id string, model_type string, cv_auc_mean double, cv_auc_std double, test_auc double, "
    "n_features int, n_train_rows long"
)


def training_set(invoices):
    """Paid invoices with a 0/1 label: only there the outcome is known."""
    return invoices.where("is_paid").withColumn("label", F.col("is_late").cast("int"))


def training_summary(invoices):
    labelled = training_set(invoices)
    return labelled.agg(
        F.count("*").alias("paid_invoices"),
        F.sum("label").alias("late_invoices"),
        r.share(F.sum("label"), F.count("label")).alias("late_rate"),
    )


def boosted_trees(weight=None, **overrides):
    """Boosted trees; the growing lineage is cut every tenth tree in the shared checkpoint folder."""
    params = {**fv.GBT_PARAMS, "checkpointInterval": 10, **overrides}
    return assembled(GBTClassifier(seed=fv.MODEL_SEED, **params), weight)


def random_forest(weight=None, **overrides):
    params = {**fv.FOREST_PARAMS, **overrides}
    return assembled(RandomForestClassifier(seed=fv.MODEL_SEED, **params), weight)


def logistic(n_rows, weight=None, **overrides):
    """Standardised features; the penalty 1/n is unit strength on the summed loss."""
    params = {"maxIter": fv.LOGISTIC_MAX_ITER, "regParam": 1.0 / n_rows, **overrides}
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True)
    model = LogisticRegression(featuresCol="scaled", standardization=False, **params)
    return assembled(model, weight, scaler)


def assembled(classifier, weight, *steps):
    """Stages over the ``features`` vector, which is built once for all fits."""
    if weight:
        classifier.setWeightCol(weight)
    return Pipeline(stages=[*steps, classifier])


def estimator(model_type, n_rows, weight=None, **overrides):
    if model_type == "GradientBoosting":
        return boosted_trees(weight, **overrides)
    if model_type == "RandomForest":
        return random_forest(weight, **overrides)
    if model_type == "LogisticRegression":
        return logistic(n_rows, weight, **overrides)
    raise ValueError(model_type)


def with_probability(model, df):
    return model.transform(df).withColumn(
        "late_probability", vector_to_array("probability")[1]
    )


@dataclass
class Prepared:
    """Split training data, kept on the executors while models are fitted."""

    fitted: FittedFeatures
    data: object
    n_train: int
    types: dict

    @property
    def train(self):
        return self.data.where("split = 'train'")

    @property
    def test(self):
        return self.data.where("split = 'test'")

    @property
    def rows(self):
        """The rows with a typed column for each feature, taken out of the vector: only that is kept."""
        values = vector_to_array("features")
        columns = [values[i].cast(self.types[c]).alias(c) for i, c in enumerate(self.fitted.columns)]
        return self.data.select(*[c for c in self.data.columns if c != "features"], *columns)

    def release(self):
        self.data.unpersist()


#: Training rows of a partition: fewer than the first never pay for a task of their own, more than the second are too much to keep.
PARTITION_ROWS, MOST_ROWS = 50_000, 250_000


def fit_partitions(rows, cores):
    """Partitions of a fit: one wave of tasks a pass, as long as partitions keep within their bounds."""
    return max(1, min(ceil(rows / PARTITION_ROWS), max(cores, ceil(rows / MOST_ROWS))))


#: Training rows up to which the models are fitted side by side; with more each fills the cores by itself, and a forest alone
#: keeps several hundred bytes a row.
SIDE_BY_SIDE_ROWS = 1_000_000


def models_at_once(rows, models):
    """Models fitted at a time: all on few rows, where a fit is a chain of small jobs that leaves most cores idle."""
    return max(1, models if rows <= SIDE_BY_SIDE_ROWS else 1)


def prepare(invoices, suppliers=None, balanced=False):
    """Features, label and split of the paid invoices, kept for the fits.

    Levels, threshold and cut points are found on the invoices; the supplier columns are joined once, after that.
    Without ``suppliers`` the invoices have them already. The rows are dealt out by id once, to ``fit_partitions``:
    a fit is hundreds of passes over them, and each pays for its tasks. ``balanced`` adds a class weight column.
    """
    labelled = training_set(invoices)
    parts = fit_partitions(labelled.count(), labelled.sparkSession.sparkContext.defaultParallelism)
    fitted = fit_features(labelled)
    data = stratified_split(labelled, "label", "invoice_id")
    if suppliers is not None:
        data = invoices_with_supplier(data, suppliers)
    data = engineer_features(data, fitted, keep=["invoice_id", "label", "split"])
    if balanced:
        weights = class_weights(data.where("split = 'train'")).select("label", "weight")
        data = data.join(F.broadcast(weights), "label")
    types = {c: data.schema[c].dataType for c in fitted.columns}
    # a row is kept once, as its vector: the feature columns beside it would double what is dealt and kept
    data = vectors(fitted.columns).transform(data).drop(*fitted.columns)
    data = data.repartition(parts, "invoice_id").persist(StorageLevel.MEMORY_AND_DISK)
    return Prepared(fitted, data, data.where("split = 'train'").count(), types)


def vectors(columns):
    return VectorAssembler(inputCols=columns, outputCol="features")


def in_parallel(spark, calls, parallelism):
    """Results of all calls, some at a time: a fit on few rows is a long chain of small jobs that leaves cores idle."""
    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        waiting = [pool.submit(inheritable_thread_target(spark)(call)) for call in calls]
        return [w.result() for w in waiting]


def fold_partitions(rows, parts, cores, fits):
    """Partitions for ``fits`` at a time, which share the cores: of ``parts`` as many are put together as leave one wave of tasks."""
    together = max(1, parts // fit_partitions(rows, ceil(cores / max(1, fits))))
    return ceil(parts / together)


def folded_rows(prepared, folds=fv.FOLDS, fits=None):
    """Training rows with their fold, kept for the cross-validations, of which ``fits`` run at a time, by default all folds."""
    folded = stratified_folds(prepared.train, "label", "invoice_id", folds)
    cores = folded.sparkSession.sparkContext.defaultParallelism
    parts = fold_partitions(prepared.n_train, prepared.data.rdd.getNumPartitions(), cores, fits or folds)
    folded = folded.coalesce(parts).persist(StorageLevel.MEMORY_AND_DISK)
    folded.count()  # kept once, before the folds ask for it at the same time
    return folded


def cv_auc(prepared, model_type, folds=fv.FOLDS, weight=None, parallelism=None, folded=None, **overrides):
    """AUC of each fold, by a model fitted on the other folds; ``parallelism`` fits at a time, by default all.

    ``folded`` are the rows of ``folded_rows``, if several models share them; whoever made them lets them go.
    """
    use_checkpoint_dir(prepared.data.sparkSession)
    shared = folded is not None
    folded = folded if shared else folded_rows(prepared, folds, parallelism)
    n_rows = max(1, prepared.n_train * (folds - 1) // folds)

    def scored_fold(fold):
        model = estimator(model_type, n_rows, weight, **overrides).fit(folded.where(F.col("fold") != fold))
        held_out = with_probability(model, folded.where(F.col("fold") == fold))
        return held_out.select("fold", "label", "late_probability")

    parts = in_parallel(folded.sparkSession, [partial(scored_fold, fold) for fold in range(folds)], parallelism or folds)
    scored = reduce(lambda a, b: a.unionByName(b), parts)
    # one row per fold, cut off from the folds, which can then go
    per_fold = roc_auc(scored, group_cols=["fold"]).checkpoint()
    if not shared:
        folded.unpersist()
    return per_fold


def cv_summary(per_fold):
    return per_fold.agg(
        F.avg("auc").alias("cv_auc_mean"), F.stddev_pop("auc").alias("cv_auc_std")
    )


def fit_model(spark, prepared, model_type, weight=None, **overrides):
    use_checkpoint_dir(spark)
    return estimator(model_type, prepared.n_train, weight, **overrides).fit(prepared.train)


def run_row(spark, run_id, model_type, prepared, scored_test, per_fold=None):
    """One row of the run table; the cross-validation columns are null when it was not run."""
    test = roc_auc(scored_test).first()
    cv = cv_summary(per_fold).first() if per_fold is not None else (None, None)
    row = (
        run_id,
        model_type,
        cv[0],
        cv[1],
        test.auc,
        len(prepared.fitted.columns),
        prepared.n_train,
    )
    return spark.createDataFrame([row], RUN_SCHEMA)


def append_runs(runs, path):
    runs.write.mode("append").parquet(path)


def best_run(runs):
    """Boosted trees by test AUC if there is a run of them, else any model by test AUC."""
    boosted = F.col("model_type") == "GradientBoosting"
    return runs.orderBy(boosted.desc(), F.desc_nulls_last("test_auc"), "run_id").limit(1)


def save_model(spark, model, fitted, path):
    model.write().overwrite().save(f"{path}/model")
    state = spark.createDataFrame([(fitted.q75, fitted.levels)], "q75 double, levels array<string>")
    state.write.mode("overwrite").parquet(f"{path}/features")


def load_model(spark, path):
    state = spark.read.parquet(f"{path}/features").first()
    return PipelineModel.load(f"{path}/model"), FittedFeatures(state.q75, list(state.levels))


SCORED_INPUT = ["invoice_id", "supplier_id", "due_date", "amount_incl_vat"]


def pending_features(joined, fitted, batch_state=False):
    """Aligned features of pending invoices.

    ``batch_state`` takes the large-invoice threshold and the levels from the pending batch itself,
    then aligns them to the trained columns; by default the trained state is used.
    """
    pending = joined.where(r.has_status("PENDING"))
    features = engineer_features(pending, None if batch_state else fitted, keep=SCORED_INPUT)
    return align_features(features, fitted.columns, keep=SCORED_INPUT)


def score_open_invoices(model, fitted, joined, batch_state=False):
    """Late probability and tier of every pending invoice; empty when there is none."""
    pending = vectors(fitted.columns).transform(pending_features(joined, fitted, batch_state))
    scored = with_probability(model, pending)
    return scored.withColumn("risk_tier", r.risk_tier("late_probability")).select(*SCORE_COLUMNS)


MODEL_TYPES = ["GradientBoosting", "RandomForest", "LogisticRegression"]


def train_all(spark, invoices, suppliers, root, run_date, with_cv=True, overrides=None, folds=fv.FOLDS):
    """Fit, cross-validate, evaluate and store the three models; each run gets a folder in the ledger.

    ``overrides`` maps a model type to parameters. A run whose rows and parameters are already in force is not fitted again, so
    a retry goes on where the lost one stopped. On few rows the models are fitted side by side. Gives the run rows in force of
    this date.
    """
    use_checkpoint_dir(spark)
    prepared = prepare(invoices, suppliers)
    rows = run_ledger.rows_digest(prepared.rows)
    before = run_ledger.in_force(spark, root)
    wanted = []
    for model_type in MODEL_TYPES:
        params = (overrides or {}).get(model_type, {})
        run_id = f"{run_date}-{model_type}"
        content = run_ledger.content_of(model_type, params, prepared.fitted.columns, rows, folds if with_cv else 0)
        known = before.get(run_id)
        if not known or known[1] != content:
            wanted.append((model_type, params, root, run_id, content))
    # one set of folds: equal cached rows are one entry, which the first model to let go would take from the others
    folded = folded_rows(prepared, folds) if wanted and with_cv else None
    calls = [partial(train_one, spark, prepared, *run, folds if with_cv else 0, folded) for run in wanted]
    in_parallel(spark, calls, models_at_once(prepared.n_train, len(calls)))
    if folded is not None:
        folded.unpersist()
    prepared.release()
    return run_ledger.runs(spark, root).where(F.col("run_id").startswith(f"{run_date}-"))


def train_one(spark, prepared, model_type, params, root, run_id, content, folds, folded=None):
    """One run: the fit and its cross-validation at the same time, then all its parts, then the marker."""
    attempt, folder = run_ledger.new_attempt(spark, root, run_id, content)
    calls = [partial(fit_model, spark, prepared, model_type, **params)]
    if folds:
        calls.append(partial(cv_auc, prepared, model_type, folds, folded=folded, **params))
    model, per_fold = [*in_parallel(spark, calls, len(calls)), None][:2]
    scored = with_probability(model, prepared.test)
    run = run_row(spark, run_id, model_type, prepared, scored, per_fold)
    save_model(spark, model, prepared.fitted, folder)
    classification_report(scored, threshold=0.5).withColumn("run_id", F.lit(run_id)).write.parquet(f"{folder}/report")
    if per_fold is not None:
        per_fold.withColumn("model_type", F.lit(model_type)).write.parquet(f"{folder}/folds")
    run.withColumns({"attempt": F.lit(attempt), "content": F.lit(content)}).write.parquet(f"{folder}/run")
    run_ledger.finish(spark, folder)


def load_best(spark, root):
    """Run id, model and feature state of the best run in force."""
    best = best_run(run_ledger.runs(spark, root)).first()
    if best is None:
        raise ValueError(f"no committed run under {root}")
    _, _, folder = run_ledger.in_force(spark, root)[best.run_id]
    return (best.run_id, *load_model(spark, folder))


def score_with_best(spark, invoices, suppliers, root):
    """Pending invoices of suppliers with enough history, scored by the best run; the others are set apart.

    Gives (scored, set apart).
    """
    run_id, model, fitted = load_best(spark, root)
    pending = invoices.where(r.has_status("PENDING"))
    flagged = insufficient_history(pending, invoices).where("insufficient_history").select("invoice_id")
    known = pending.join(flagged, "invoice_id", "left_anti")
    scored = score_open_invoices(model, fitted, invoices_with_supplier(known, suppliers))
    apart = pending.join(flagged, "invoice_id", "left_semi").select(*SCORED_INPUT)
    return scored.withColumn("run_id", F.lit(run_id)), apart
