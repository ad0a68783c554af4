"""Masked pseudo-likelihood: each word of a document is predicted from the words on both sides.

Words are hashed to ``BUCKETS`` slots, counted over all documents. The most frequent slots are classes of their own,
the others form bands of equal mass. The model is
``p(word | context) = p(class | two classes on either side) * p(word | class)``; the first factor is a window
network (class embeddings, one hidden layer, softmax) trained in numpy, the second comes from the counts.

The network is trained on the exact counts of all ``CLASSES**4`` contexts over the whole corpus, so that the training table
is bounded by the model and not by the corpus, and does not depend on how rows were partitioned. Scoring looks up the trained
network's output per context. A document's score is the sum of its conditional log-probabilities.

Null and empty texts have no words: score 0, mean null; they teach nothing. Null ids and repeated rows are scored like
other rows (repeated rows are counted as often as they occur). With ties in frequency the smaller slot
comes first. An empty table gives no rows. Other columns are ignored.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import bound_batches
from ledgerline.llm.hashing import chunks, word_hashes

BUCKETS = 1 << 18
#: Class 0 stands beyond the ends of a document; then the most frequent slots, then bands of the others.
CLASSES, OWN = 16, 9
SIDE = 2
EMBED, HIDDEN, STEPS, RATE = 8, 32, 150, 0.03

CONTEXT = "context int, " + ", ".join(f"t{i} long" for i in range(CLASSES))


def tokens(texts) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all words of the texts, and how many each text has."""
    words, lengths = word_hashes(texts)
    return (words % np.uint64(BUCKETS)).astype(np.int64), lengths


@dataclass
class Classes:
    """The class of each slot and the log-probability of a slot within its class."""

    of: np.ndarray
    within: np.ndarray


def make_classes(counts: np.ndarray) -> Classes:
    order = np.argsort(-counts, kind="stable")
    of = np.empty(len(counts), dtype=np.int64)
    of[order[:OWN]] = np.arange(1, OWN + 1)
    rest = order[OWN:]
    bands = CLASSES - 1 - OWN
    mass = np.cumsum(counts[rest]) - counts[rest] / 2
    of[rest] = OWN + 1 + np.minimum((mass / max(counts[rest].sum(), 1) * bands).astype(int), bands - 1)
    share = counts + 0.5  # words that were never seen have a share too
    total = np.bincount(of, weights=share, minlength=CLASSES)
    return Classes(of, np.log(share / total[of]).astype(np.float32))


def count_slots(texts: DataFrame) -> np.ndarray:
    """Occurrences of each slot over all texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for part in chunks(batch["text"]):
                np.add.at(total, tokens(part)[0], 1)
        seen = np.nonzero(total)[0]
        yield pd.DataFrame({"slot": seen.astype("int32"), "n": total[seen]})

    # at most BUCKETS rows, whatever the corpus
    found = texts.mapInPandas(run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(BUCKETS, dtype=np.int64)
    counts[found["slot"].to_numpy(dtype=int)] = found["n"].to_numpy(dtype=np.int64)
    return counts


def contexts(slots: np.ndarray, lengths: np.ndarray, classes: Classes):
    """Context number and class of every word; two classes 0 stand before, between and after the texts."""
    ends = np.cumsum(lengths)
    place = np.arange(len(slots)) + SIDE * (1 + np.repeat(np.arange(len(lengths)), lengths))
    row = np.zeros(len(slots) + SIDE * (len(lengths) + 1), dtype=np.int64)
    row[place] = classes.of[slots]
    code = np.zeros(len(slots), dtype=np.int64)
    for step in (-2, -1, 1, 2):
        code = code * CLASSES + row[place + step]
    return code, row[place], ends


def count_contexts(texts: DataFrame, classes: Classes) -> np.ndarray:
    """Counts of every class in every context over all texts."""
    size = CLASSES**4

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size * CLASSES, dtype=np.int64)
        for batch in batches:
            for part in chunks(batch["text"]):
                slots, lengths = tokens(part)
                code, target, _ = contexts(slots, lengths, classes)
                np.add.at(total, code * CLASSES + target, 1)
        table = total.reshape(size, CLASSES)
        seen = np.nonzero(table.any(axis=1))[0]
        out = pd.DataFrame({"context": seen.astype("int32")})
        for i in range(CLASSES):
            out[f"t{i}"] = table[seen, i]
        yield out

    sums = [F.sum(f"t{i}").alias(f"t{i}") for i in range(CLASSES)]
    # at most CLASSES**4 rows, whatever the corpus
    found = texts.mapInPandas(run, CONTEXT).groupBy("context").agg(*sums).toPandas()
    counts = np.zeros((size, CLASSES))
    counts[found["context"].to_numpy(dtype=int)] = found.drop(columns="context").to_numpy(dtype=float)
    return counts


class WindowNetwork:
    """Embeddings of the classes at the four places -> tanh layer -> softmax over classes."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.p = [
            rng.normal(0, 0.3, (CLASSES, EMBED)),
            rng.normal(0, 0.2, (2 * SIDE * EMBED, HIDDEN)),
            np.zeros(HIDDEN),
            rng.normal(0, 0.2, (HIDDEN, CLASSES)),
            np.zeros(CLASSES),
        ]
        self.p = [p.astype(np.float32) for p in self.p]

    def forward(self, context: np.ndarray):
        e, w, b, v, c = self.p
        x = e[context].reshape(len(context), -1)
        h = np.tanh(x @ w + b)
        z = h @ v + c
        z -= z.max(axis=1, keepdims=True)
        return x, h, z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    def gradients(self, context: np.ndarray, counts: np.ndarray):
        """Mean log-loss per word and its gradients."""
        e, w, b, v, c = self.p
        x, h, logp = self.forward(context)
        n = counts.sum(dtype=float)
        share = (counts / n).astype(np.float32)
        dz = np.exp(logp) * share.sum(axis=1, keepdims=True) - share
        dh = (dz @ v.T) * (1 - h * h)
        dx = (dh @ w.T).reshape(len(context), 2 * SIDE, EMBED)
        de = np.zeros_like(e)
        for place in range(2 * SIDE):
            for d in range(EMBED):
                de[:, d] += np.bincount(context[:, place], weights=dx[:, place, d], minlength=CLASSES)
        return -float((share * logp).sum(dtype=float)), [de, x.T @ dh, dh.sum(axis=0), h.T @ dz, dz.sum(axis=0)]

    def train(self, context: np.ndarray, counts: np.ndarray, steps: int = STEPS) -> list[float]:
        """Adam over the whole table; the losses."""
        first = [np.zeros_like(p) for p in self.p]
        second = [np.zeros_like(p) for p in self.p]
        losses = []
        for step in range(1, steps + 1):
            loss, grads = self.gradients(context, counts)
            losses.append(loss)
            rate = RATE * min(1.0, 2 * (1 - (step - 1) / steps))
            for p, g, m, s in zip(self.p, grads, first, second):
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
        return losses


def all_contexts() -> np.ndarray:
    """The four classes of every context number."""
    code = np.arange(CLASSES**4)
    return np.stack([code // CLASSES**i % CLASSES for i in (3, 2, 1, 0)], axis=1)


@dataclass
class MaskedModel:
    classes: Classes
    logp: np.ndarray

    def score(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Words and summed log-probability of each text."""
        lengths, sums = [np.empty(0, np.int64)], [np.empty(0)]
        for part in chunks(texts):
            slots, n = tokens(part)
            code, target, ends = contexts(slots, n, self.classes)
            total = np.concatenate([[0.0], np.cumsum(self.logp[code, target] + self.classes.within[slots], dtype=float)])
            lengths.append(n)
            sums.append(total[ends] - total[ends - n])
        return np.concatenate(lengths), np.concatenate(sums)


def learn(df: DataFrame, text="text") -> MaskedModel:
    """Counts and network over all rows."""
    bound_batches(df.sparkSession)
    texts = df.select(F.col(text).alias("text"))
    classes = make_classes(count_slots(texts))
    counts = count_contexts(texts, classes)
    network = WindowNetwork()
    context = all_contexts()
    seen = counts.any(axis=1)
    if seen.any():
        network.train(context[seen], counts[seen])
    return MaskedModel(classes, network.forward(context)[2].astype(np.float32))


def scored(df: DataFrame, model: MaskedModel, doc_id="doc_id", text="text") -> DataFrame:
    """doc_id, n_words, log_prob, mean_log_prob."""

    bound_batches(df.sparkSession)

    @F.pandas_udf("n_words long, log_prob double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            n, total = model.score(texts.tolist())
            yield pd.DataFrame({"n_words": n, "log_prob": total})

    out = df.select(F.col(doc_id).alias("doc_id"), score(F.col(text)).alias("s")).select("doc_id", "s.*")
    return out.withColumn("mean_log_prob", F.when(F.col("n_words") > 0, F.col("log_prob") / F.col("n_words")))
