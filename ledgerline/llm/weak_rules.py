"""Quality rules under weak supervision, with DataFrame expressions only.

Each rule votes good, bad or nothing on a document, from counts over its whole text. Expectation-maximisation over the
table of vote patterns (at most 3**rules rows, whatever the corpus) estimates the share of good documents and
each rule's accuracy on good and on bad ones; a document is kept if its posterior probability of being good
reaches ``keep_at``. One aggregate over the pattern table is one EM step.

Null text counts as empty (no words: the base test fails). Null ids and repeated rows are rows like any other. Ties
cannot occur: equal votes get equal verdicts. An empty table gives no rows; other columns are ignored.
Windows are compared by 64-bit hash within one text.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import WORD
from ledgerline.session import use_checkpoint_dir

SYMBOLS = r"[#*$%&|<>]"

#: name -> (bad if, good if, abstain otherwise); both over the counts of ``text_counts``.
RULES = {
    "symbols": ("n_symbols > 0.1 * word_chars", "n_symbols < 0.02 * word_chars"),
    "symbol_words": ("n_symbol_words > 0.3 * n_words", "n_symbol_words < 0.1 * n_words"),
    "word_length": (
        "word_chars < 2 * n_words or word_chars > 14 * n_words",
        "word_chars between 3 * n_words and 10 * n_words",
    ),
    "line_copies": ("n_dup_lines > 0.3 * n_lines", "n_dup_lines <= 0.05 * n_lines and n_lines >= 3"),
    "repetition": ("n_repeat_words > 0.3 * n_words", "n_repeat_words < 0.1 * n_words"),
    "capitals": ("n_capitals > 0.4 * word_chars", "n_capitals < 0.2 * word_chars"),
    "capital_words": ("n_capital_words > 0.4 * n_words", "n_capital_words < 0.1 * n_words"),
    "shouting": ("n_marks > 0.2 * n_words", "n_marks < 0.05 * n_words"),
}
SYMBOL_WORD = SYMBOLS + r"[^\x20\x09-\x0D]*"
CAPITAL_WORD = r"(^|[\x20\x09-\x0D])\p{Lu}{2,}"

#: Start and prior of the estimates: share of good documents, accuracy on good ones, accuracy on bad ones.
START = (0.85, 0.99, 0.4)
#: Weight of the prior as a share of all documents.
PRIOR = 0.02
STEPS = 15
KEEP_AT = 0.5


def text_counts(df: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    """One row per input row: doc_id and the counts that base test and rules need."""
    whole = df.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    split = whole.select(
        "doc_id",
        "text",
        F.regexp_extract_all("text", F.lit(f"({WORD})")).alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)).alias("lines"),
    )
    counted = split.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        (F.length("text") - F.regexp_count("text", F.lit(r"[\x20\x09-\x0D]"))).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
        F.regexp_count("text", F.lit(SYMBOL_WORD)).cast("long").alias("n_symbol_words"),
        F.regexp_count("text", F.lit(CAPITAL_WORD)).cast("long").alias("n_capital_words"),
        F.regexp_count("text", F.lit("!")).cast("long").alias("n_marks"),
        F.transform(
            F.slice("words", F.lit(1), F.greatest(F.size("words") - 2, F.lit(0))),
            lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)),
        ).alias("windows"),
    )
    # only texts with a repeated window need their windows in order
    sorted_windows = F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    ordered = counted.withColumn("ordered", sorted_windows).drop("windows")

    def twice(p, i):
        return F.coalesce(F.get("ordered", i - 1)["h"] == p["h"], F.lit(False)) | F.coalesce(
            F.get("ordered", i + 1)["h"] == p["h"], F.lit(False)
        )

    starts = F.sort_array(F.transform(F.filter("ordered", twice), lambda p: p["i"]))
    placed = ordered.withColumn("starts", starts).drop("ordered")
    # a window covers three words; up to the next window's start only those not covered again
    reach = F.aggregate(
        F.transform("starts", lambda s, i: F.least(F.lit(3), F.coalesce(F.get("starts", i + 1) - s, F.lit(3)))),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    return placed.withColumn("n_repeat_words", F.coalesce(reach, F.lit(0).cast("long"))).drop("starts")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def vote(rule: str) -> Column:
    """-1, 1 or 0 for no vote."""
    bad, good = RULES[rule]
    return F.when(F.expr(bad), -1).when(F.expr(good), 1).otherwise(0)


def log_odds(share: float, on_good: list[float], on_bad: list[float]) -> Column:
    """Log odds of a good document given the votes in columns named like the rules."""
    total = F.lit(math.log(share) - math.log(1 - share))
    for rule, g, b in zip(RULES, on_good, on_bad):
        total = total + F.when(F.col(rule) == 1, math.log(g) - math.log(1 - b)).when(
            F.col(rule) == -1, math.log(1 - g) - math.log(b)
        ).otherwise(0.0)
    return total


def posterior(params) -> Column:
    return 1 / (1 + F.exp(-log_odds(*params)))


def estimate(patterns: DataFrame):
    """EM over (votes, n); the start doubles as a prior, which keeps the classes' meaning."""
    share, g0, b0 = START
    params = (share, [g0] * len(RULES), [b0] * len(RULES))
    p, n = F.col("p"), F.col("n")
    for _ in range(STEPS):
        aggs = [F.sum(n * p).alias("good"), F.sum(n).cast("double").alias("all")]
        for rule in RULES:
            v = F.col(rule)
            aggs += [
                F.sum(n * p * (v == 1).cast("int")).alias(f"{rule}_gg"),
                F.sum(n * p * (v != 0).cast("int")).alias(f"{rule}_g"),
                F.sum(n * (1 - p) * (v == -1).cast("int")).alias(f"{rule}_bb"),
                F.sum(n * (1 - p) * (v != 0).cast("int")).alias(f"{rule}_b"),
            ]
        row = patterns.withColumn("p", posterior(params)).agg(*aggs).first()
        if row["all"] is None:
            break
        w = PRIOR * row["all"]
        params = (
            (row["good"] + w * share) / (row["all"] + w),
            [(row[f"{r}_gg"] + w * g0) / (row[f"{r}_g"] + w) for r in RULES],
            [(row[f"{r}_bb"] + w * b0) / (row[f"{r}_b"] + w) for r in RULES],
        )
    return params


def judge(counts: DataFrame, keep_at: float = KEEP_AT) -> DataFrame:
    """Counts plus votes, base_failed, posterior and kept. ``counts`` should be stored: it is read twice."""
    use_checkpoint_dir(counts.sparkSession)
    voted = counts.withColumns({rule: vote(rule) for rule in RULES})
    patterns = voted.groupBy(*RULES).agg(F.count(F.lit(1)).alias("n")).coalesce(1).checkpoint()
    params = estimate(patterns)
    return voted.withColumns({"base_failed": base_failed(), "posterior": posterior(params)}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("posterior") >= keep_at)
    )
