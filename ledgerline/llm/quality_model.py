"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader, sparse scores.

Tokens are runs of word characters and runs of signs, case kept. Features are unigrams, bigrams (a word that repeats the
one before is written as "same", so that repetition has one feature) and the shape of a word (all capitals or not),
hashed to 2**18 slots, with the root of the count, scaled to length 1. The model is fitted on a bounded sample of
labelled rows (``FIT_ROWS`` expected, chosen by hash of the id); scoring covers every row.

Null and empty texts have no feature: their score is that of the intercept. Null ids are scored like others,
but never used for fitting. Repeated rows get equal scores. With no usable label every score is 0.5.
An empty table gives no rows. Other columns are ignored.
"""

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import bound_batches
from ledgerline.llm.hashing import WordIds, mix

SLOTS = 1 << 18
#: Expected size of the sample that the model is fitted on.
FIT_ROWS = 8000
EPOCHS = 5
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.02, 0.05
TOKEN = re.compile(r"\w+|[^\w\s]+")
SAME = 0x5A3E


class Features:
    """Text -> (slots, values); slot numbers are increasing."""

    def __init__(self):
        self.ids = WordIds()

    def __call__(self, text) -> tuple[np.ndarray, np.ndarray]:
        words = TOKEN.findall(text) if text else []
        if not words:
            return np.empty(0, dtype=np.int32), np.empty(0, dtype=np.float32)
        w = self.ids(words).astype(np.uint64)
        shape = np.fromiter((len(x) > 1 and x.isupper() for x in words), dtype=np.uint64, count=len(words))
        before, after = w[:-1], np.where(w[1:] == w[:-1], np.uint64(SAME), w[1:])
        before = np.where(w[1:] == w[:-1], np.uint64(SAME), before)
        grams = np.concatenate(
            [w, (before << np.uint64(32)) | after | np.uint64(1 << 63), shape + np.uint64(1 << 40)]
        )
        slots, counts = np.unique((mix(grams) % np.uint64(SLOTS)).astype(np.int32), return_counts=True)
        values = np.sqrt(counts).astype(np.float32)
        return slots, values / np.float32(np.sqrt((values * values).sum()))


class FollowTheLeader:
    """Per-coordinate FTRL for logistic loss; the last slot is the intercept."""

    def __init__(self):
        self.z = np.zeros(SLOTS + 1)
        self.n = np.zeros(SLOTS + 1)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, slots, values, label) -> None:
        at = np.append(slots, SLOTS)
        x = np.append(values, np.float32(1))
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = (p - label) * x
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def hash_share(column: Column, share: float) -> Column:
    """True for about this share of the values, chosen by hash."""
    return F.pmod(F.xxhash64(F.lit(5), column), F.lit(1_000_000)) < int(round(1_000_000 * min(1.0, share)))


def fit(docs: DataFrame, labels: DataFrame, learnable: Column, doc_id="doc_id", text="text", label="quality") -> np.ndarray:
    """Weights of all slots and the intercept. ``learnable`` is a condition over the labels' ``doc_id``."""
    bound_batches(docs.sparkSession)
    usable = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("double").alias("label")).where(
        learnable & F.col("doc_id").isNotNull() & F.col("label").isin(0.0, 1.0)
    )
    # repeated labels of a document count once; of contradicting ones the higher
    usable = usable.groupBy("doc_id").agg(F.max("label").alias("label"))
    total = usable.count()
    sample = usable.where(hash_share(F.col("doc_id"), FIT_ROWS / max(total, 1)))
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    # about FIT_ROWS rows of two numbers: small by construction, so no text is shuffled
    rows = texts.join(F.broadcast(sample), "doc_id")

    def featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = Features()
        for batch in batches:
            found = [features(t) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "label": batch["label"],
                    "slots": [s for s, _ in found],
                    "values": [v for _, v in found],
                }
            )

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        if not parts:
            return
        examples = pd.concat(parts).sort_values("doc_id", kind="stable")
        model = FollowTheLeader()
        order = np.random.default_rng(1)
        slots, values, marks = (examples[c].tolist() for c in ("slots", "values", "label"))
        for _ in range(EPOCHS):
            for i in order.permutation(len(marks)):
                model.learn(slots[i], values[i], marks[i])
        w = model.weights(np.arange(SLOTS + 1))
        kept = np.nonzero(w)[0]
        yield pd.DataFrame({"slot": kept.astype("int32"), "weight": w[kept]})

    # only the sample's sparse rows meet in one task; the texts are read by many
    sparse = rows.mapInPandas(featurise, "doc_id long, label double, slots array<int>, values array<float>")
    learned = sparse.repartition(1).mapInPandas(train, "slot int, weight double").toPandas()
    weights = np.zeros(SLOTS + 1, dtype=np.float32)
    weights[learned["slot"].to_numpy(dtype=int)] = learned["weight"].to_numpy(dtype=np.float32)
    return weights


def scorer(weights: np.ndarray):
    """A column function: text -> probability of label 1, as sparse dot products."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = Features()
        for texts in batches:
            logits = np.full(len(texts), float(weights[SLOTS]))
            for i, text in enumerate(texts):
                slots, values = features(text)
                logits[i] += float(values @ weights[slots])
            yield pd.Series(1 / (1 + np.exp(-np.clip(logits, -30, 30))))

    return score
