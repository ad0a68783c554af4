"""Classifier metrics from scores and labels."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.functions import fixed_values as fv
from ledgerline.functions import rules as r
from ledgerline.operators.ranking import cumulative_before


def score_cells(scored, score, label, group_cols=()):
    """Positives and negatives per distinct score: tied rows collapse here, whatever their number.

    The first count is the same for every use of the cells, so rows are scored and shuffled once.
    """
    keys = [*group_cols, "score"]
    positive = F.col(label).cast("int") == 1
    counted = (
        scored.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(*group_cols, F.col(score).cast("double").alias("score"), positive.alias("_positive"))
        .agg(F.count("*").alias("n"))
    )
    return counted.groupBy(*keys).agg(
        r.sum_where("_positive", "n").alias("pos"), r.sum_where(~F.col("_positive"), "n").alias("neg")
    )


def auc_from_cells(cells, group_cols=(), carry=()):
    """Area under the ROC curve by ranks: each positive counts the negatives below it, ties half.

    Sums are exact integers; the only rounding is the last division. Null when a class is missing.
    ``carry`` names further counts of the cells that are summed along. Scores are probabilities. They are ordered by their first 16 bits, their first 32 bits, and the
    score itself: however close together they lie, no window holds more than the doubles of one step.
    """

    def step(bits):
        number = F.floor(F.col("score") * 2**bits)
        return F.least(F.greatest(number, F.lit(0)), F.lit(2**bits))

    stepped = cells.withColumns({"coarse": step(16), "fine": step(32)})
    ordered = cumulative_before(stepped, ["coarse", "fine", "score"], ["neg"], group_cols)
    pos, neg = (F.col(c).cast("decimal(18,0)") for c in ("pos", "neg"))
    wins = (2 * F.col("neg_before").cast("decimal(18,0)") + neg) * pos
    totals = ordered.groupBy(*group_cols).agg(
        F.sum(wins).alias("_wins"),
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
        *[F.sum(c).alias(c) for c in carry],
    )
    pairs = 2 * F.col("positives").cast("double") * F.col("negatives").cast("double")
    return totals.select(
        *group_cols, "positives", "negatives", r.share("_wins", pairs).alias("auc"), *carry
    )


def roc_auc(scored, score="late_probability", label="label", group_cols=()):
    return auc_from_cells(score_cells(scored, score, label, group_cols), group_cols)


def classification_report(scored, score="late_probability", label="label", threshold=0.5):
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted averages.

    A ratio with a zero denominator is 0.
    """
    predicted = F.col(score) > threshold
    actual = F.col(label).cast("int") == 1
    counts = scored.agg(
        r.count_where(predicted & actual).cast("double").alias("tp"),
        r.count_where(predicted & ~actual).cast("double").alias("fp"),
        r.count_where(~predicted & actual).cast("double").alias("fn"),
        r.count_where(~predicted & ~actual).cast("double").alias("tn"),
    )

    def ratio(part, whole):
        return F.coalesce(part / F.nullif(whole, F.lit(0.0)), F.lit(0.0))

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    per_class = counts.withColumns(
        {
            "p1": ratio(tp, tp + fp),
            "r1": ratio(tp, tp + fn),
            "p0": ratio(tn, tn + fn),
            "r0": ratio(tn, tn + fp),
            "s1": tp + fn,
            "s0": tn + fp,
        }
    ).withColumns(
        {
            "f1": ratio(2 * F.col("p1") * F.col("r1"), F.col("p1") + F.col("r1")),
            "f0": ratio(2 * F.col("p0") * F.col("r0"), F.col("p0") + F.col("r0")),
            "n": F.col("s0") + F.col("s1"),
        }
    )

    def macro(a, b):
        return (F.col(a) + F.col(b)) / 2

    def weighted(a, b):
        return ratio(F.col(a) * F.col("s0") + F.col(b) * F.col("s1"), F.col("n"))

    accuracy = ratio(tp + tn, F.col("n"))
    lines = [
        ("On-time", F.col("p0"), F.col("r0"), F.col("f0"), F.col("s0")),
        ("Late", F.col("p1"), F.col("r1"), F.col("f1"), F.col("s1")),
        ("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"), accuracy, F.col("n")),
        ("macro avg", macro("p0", "p1"), macro("r0", "r1"), macro("f0", "f1"), F.col("n")),
        (
            "weighted avg",
            weighted("p0", "p1"),
            weighted("r0", "r1"),
            weighted("f0", "f1"),
            F.col("n"),
        ),
    ]
    entries = [
        F.struct(
            F.lit(name).alias("class"),
            p.alias("precision"),
            rec.alias("recall"),
            f1.alias("f1_score"),
            support.cast("long").alias("support"),
        )
        for name, p, rec, f1, support in lines
    ]
    return per_class.select(F.inline(F.array(*entries)))


def tier_counts(scored):
    return scored.groupBy("risk_tier").agg(F.count("*").alias("invoices"))


def class_weights(df, label="label"):
    """Balanced weight per class: rows / (classes x rows of the class)."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    classes = Window.partitionBy()
    rows, kinds = F.sum("n").over(classes), F.count("*").over(classes)
    return counts.withColumn("weight", r.share(rows, kinds * F.col("n")))


def model_monitor(scored, month, score="late_probability", label="label", months=fv.MONITOR_MONTHS):
    """AUC over a rolling window of months, with an alert below the limit.

    Rows collapse to (month, score) cells first; each cell is then counted in the windows it is in.
    Windows end at months that have rows.
    """
    day = r.month_start(month)
    monthly = scored.where(F.col(month).isNotNull()).withColumn("_month", day)
    cells = score_cells(monthly, score, label, ["_month"])
    ahead = F.sequence(F.lit(0), F.lit(months - 1))
    repeated = cells.select("*", F.explode(ahead).alias("_ahead")).withColumn(
        "window_month", F.add_months("_month", F.col("_ahead"))
    )
    in_window = repeated.groupBy("window_month", "score").agg(
        F.sum("pos").alias("pos"),
        F.sum("neg").alias("neg"),
        r.sum_where(F.col("_ahead") == 0, F.col("pos") + F.col("neg")).alias("of_month"),
    )
    per_window = auc_from_cells(in_window, ["window_month"], carry=["of_month"]).where("of_month > 0")
    return per_window.select(
        r.month_key("window_month").alias("year_month"),
        "positives",
        "negatives",
        "auc",
        F.coalesce(F.col("auc") < fv.MONITOR_MIN_AUC, F.lit(False)).alias("alert"),
    )
