"""Masked pseudo-likelihood by a network of words: each word is predicted from the two words on either side.

Words are hashed to ``BUCKETS`` slots, counted over all documents. The network embeds the four words around a masked one
(a place beyond the ends of a document is a word of its own), has one hidden layer, and predicts the word itself: its probability
is the product of the decisions on its way down a Huffman tree of the counts, each a logistic unit over the hidden layer. The
probabilities of all slots sum to one; slots that were never seen share one leaf.

Training goes over all rows: ``ROUNDS`` rounds, each over its share of the documents. In a round the documents are dealt to shards, by a
hash of id and text; each shard goes on from the common network by AdaGrad, and a row of weights becomes the mean over the
shards that used it. Sums are of whole numbers, so the model does not depend on how rows were partitioned. A shard is streamed
and bounded by the corpus' size over ``MOST_SHARDS``; weights are bounded by BUCKETS. A document's score is the sum of its
conditional log-probabilities.

Null and empty texts have no words: score 0, mean null; they teach nothing. Null ids and repeated rows are scored like
other rows (repeated rows are counted as often as they occur). An empty table gives no rows. Other columns are ignored.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import bound_batches
from ledgerline.llm.hashing import chunks
from ledgerline.llm.pseudo_likelihood import BUCKETS, SIDE, count_slots, tokens

EMBED, HIDDEN, RATE = 8, 8, 0.1
ROUNDS = 2
#: Words of a round that a shard trains on, until there are MOST_SHARDS.
SHARD_WORDS, MOST_SHARDS = 2_000_000, 64
#: Characters read for some training steps, and words of a step.
STEP_CHARS, STEP_WORDS = 1 << 16, 1 << 13
#: A change of a weight travels as a whole number of this unit.
UNIT = 2.0**-24

WIDTH = HIDDEN + 1
CHANGE = "part int, row int, " + ", ".join(f"v{i} long" for i in range(WIDTH))


class Vocabulary:
    """Word numbers of the slots (0 stands beyond the ends, the last for all unseen slots), and each word's way down the tree."""

    def __init__(self, counts: np.ndarray):
        seen = np.nonzero(counts)[0]
        self.of = np.full(len(counts), len(seen) + 1, dtype=np.int32)
        self.of[seen] = np.arange(1, len(seen) + 1)
        self.n_unseen = len(counts) - len(seen)
        self.size = len(seen) + 2
        self.parent, self.sign = tree(np.append(counts[seen], 0.5))
        self.find_ways()

    def find_ways(self) -> None:
        """For each word the start and length of its way; the inner nodes on it and the side taken (1 or -1)."""
        n = self.size - 1
        nodes, sides, leaves = [np.empty(0, np.int32)], [np.empty(0, np.int8)], [np.empty(0, np.int64)]
        leaf, at = np.arange(n if n > 1 else 0), np.arange(n if n > 1 else 0)
        while len(leaf):
            nodes.append(self.parent[at])
            sides.append(self.sign[at])
            leaves.append(leaf)
            more = self.parent[at] != n - 2
            leaf, at = leaf[more], n + self.parent[at][more]
        leaf = np.concatenate(leaves)
        by_leaf = np.argsort(leaf, kind="stable")
        length = np.bincount(leaf, minlength=n)
        self.node, self.side = np.concatenate(nodes)[by_leaf], np.concatenate(sides)[by_leaf]
        self.first, self.length = np.append(0, np.cumsum(length) - length), np.append(0, length)

    def __getstate__(self):
        # the ways are longer than the tree: each task finds them again
        return {k: x for k, x in self.__dict__.items() if k not in ("node", "side", "first", "length")}

    def __setstate__(self, kept):
        self.__dict__.update(kept)
        self.find_ways()


def tree(mass: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Huffman tree: the parent of each leaf, then of each inner node, among the inner nodes (the last is the root), and its side."""
    n = len(mass)
    order = np.argsort(mass, kind="stable").tolist()
    weight = mass.tolist()
    parent, sign = np.zeros(2 * n - 1, dtype=np.int32), np.ones(2 * n - 1, dtype=np.int8)
    made: list[float] = []
    i = j = 0
    for new in range(n - 1):  # leaves by mass, and inner nodes, which come by mass
        total = 0.0
        for s in (1, -1):
            if i < n and (j >= len(made) or weight[order[i]] <= made[j]):
                child, value, i = order[i], weight[order[i]], i + 1
            else:
                child, value, j = n + j, made[j], j + 1
            parent[child], sign[child] = new, s
            total += value
        made.append(total)
    return parent, sign


class WordNetwork:
    """Embeddings of the words at the four places -> tanh layer -> a logistic unit at every inner node of the tree.

    Weights by part: embeddings, hidden layer with its offset as last row, units with their offset as last column.
    """

    def __init__(self, words: Vocabulary, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.words = words
        self.p = [
            rng.normal(0, 0.3, (words.size, EMBED)),
            rng.normal(0, 0.2, (2 * SIDE * EMBED + 1, HIDDEN)),
            np.zeros((max(words.size - 2, 1), WIDTH)),
        ]
        self.p = [p.astype(np.float32) for p in self.p]

    def forward(self, context: np.ndarray, target: np.ndarray):
        e, w, v = self.p
        x = e[context].reshape(len(context), -1)
        h = np.tanh(x @ w[:-1] + w[-1])
        length = self.words.length[target]
        row = np.repeat(np.arange(len(target)), length)
        begin = np.cumsum(length) - length
        way = np.arange(len(row)) + np.repeat(self.words.first[target] - begin, length)
        node, side = self.words.node[way], self.words.side[way]
        hs, vs = h[row], v[node]
        z = (np.einsum("ij,ij->i", hs, vs[:, :-1]) + vs[:, -1]) * side
        logp = np.minimum(z, 0) - np.log1p(np.exp(-np.abs(z)))
        return x, h, begin, node, side, hs, vs, z, logp

    def log_prob(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Log-probability of each word."""
        out = self.forward(context, target)
        total = np.add.reduceat(out[-1], out[2], dtype=float) if len(out[-1]) else np.zeros(len(target))
        return np.where(target == self.words.size - 1, total - np.log(max(self.words.n_unseen, 1)), total)

    def gradients(self, context: np.ndarray, target: np.ndarray):
        """Log-loss of all words and, for each part of the weights, the rows in use and their gradients."""
        e, w, v = self.p
        x, h, begin, node, side, hs, vs, z, logp = self.forward(context, target)
        if not len(node):
            return 0.0, [(np.empty(0, np.int64), p[:0]) for p in self.p]
        dz = -side / (1 + np.exp(np.clip(z, -60, 60)))
        dh = np.add.reduceat(dz[:, None] * vs[:, :-1], begin, axis=0) * (1 - h * h)
        dx = (dh @ w[:-1].T).reshape(-1, EMBED)
        hidden = np.arange(len(w)), np.vstack([x.T @ dh, dh.sum(axis=0)])
        row = np.repeat(np.arange(len(target)), self.words.length[target])
        units = summed_rows(node, [*(dz * column[row] for column in np.ascontiguousarray(h.T)), dz], len(v))
        return -float(logp.sum(dtype=float)), [summed_rows(context.ravel(), dx.T, len(e)), hidden, units]


def summed_rows(row: np.ndarray, columns, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows, and for each the sum of every column."""
    used = np.zeros(size, dtype=bool)
    used[row] = True
    rows = np.nonzero(used)[0]
    number = np.empty(size, dtype=np.int64)
    number[rows] = np.arange(len(rows))
    at = number[row]
    return rows, np.stack([np.bincount(at, weights=c, minlength=len(rows)) for c in columns], axis=1)


class Training:
    """AdaGrad steps of a copy of the network; the changes by row at the end."""

    def __init__(self, network: WordNetwork):
        self.start = network.p
        self.network = WordNetwork.__new__(WordNetwork)
        self.network.words, self.network.p = network.words, [p.copy() for p in network.p]
        self.squares = [np.full(p.shape, 1e-2, dtype=np.float32) for p in self.start]
        self.used = [np.zeros(len(p), dtype=bool) for p in self.start]

    def step(self, texts: list) -> None:
        context, target, _ = windows(texts, self.network.words)
        for i in range(0, len(target), STEP_WORDS):
            _, grads = self.network.gradients(context[i : i + STEP_WORDS], target[i : i + STEP_WORDS])
            for p, (rows, g), s, used in zip(self.network.p, grads, self.squares, self.used):
                g = g.astype(np.float32)
                square = s[rows] + g * g
                s[rows] = square
                p[rows] -= RATE * g / np.sqrt(square)
                used[rows] = True

    def changes(self) -> Iterator[pd.DataFrame]:
        for part, (old, new, used) in enumerate(zip(self.start, self.network.p, self.used)):
            rows = np.nonzero(used)[0]
            for i in range(0, len(rows), 10_000):
                some = rows[i : i + 10_000]
                change = np.zeros((len(some), WIDTH), dtype=np.int64)
                change[:, : old.shape[1]] = np.rint((new[some].astype(float) - old[some]) / UNIT)
                out = pd.DataFrame(change, columns=[f"v{k}" for k in range(WIDTH)])
                out.insert(0, "part", np.int32(part))
                out.insert(1, "row", some.astype(np.int32))
                yield out


def windows(texts, words: Vocabulary):
    """The four words around every word, the words, and where each text ends."""
    slots, lengths = tokens(texts)
    target = words.of[slots]
    place = np.arange(len(slots)) + SIDE * (1 + np.repeat(np.arange(len(lengths)), lengths))
    line = np.zeros(len(slots) + SIDE * (len(lengths) + 1), dtype=np.int32)
    line[place] = target
    return np.stack([line[place + step] for step in (-2, -1, 1, 2)], axis=1), target, np.cumsum(lengths)


def train_round(dealt: DataFrame, network: WordNetwork) -> None:
    """One round: every shard of the rows (shard, text, in order) trains a copy; used rows of weights become the mean."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, training, texts, size = None, None, [], 0
        for batch in batches:
            for number, text in zip(batch["shard"], batch["text"]):
                if number != shard:
                    if training:
                        training.step(texts)
                        yield from training.changes()
                    shard, training, texts, size = number, Training(network), [], 0
                texts.append(text)
                size += len(text or "") + 1
                if size >= STEP_CHARS:
                    training.step(texts)
                    texts, size = [], 0
        if training:
            training.step(texts)
            yield from training.changes()

    sums = [F.sum(f"v{i}").alias(f"v{i}") for i in range(WIDTH)]
    # at most two rows of weights a slot, whatever the corpus
    found = dealt.mapInPandas(run, CHANGE).groupBy("part", "row").agg(F.count("*").alias("n"), *sums).toArrow().to_pandas()
    for part, p in enumerate(network.p):
        rows = found[found["part"] == part]
        mean = rows[[f"v{i}" for i in range(p.shape[1])]].to_numpy(dtype=float) * UNIT / rows[["n"]].to_numpy(dtype=float)
        p[rows["row"].to_numpy(dtype=int)] += mean.astype(np.float32)


@dataclass
class MaskedWords:
    network: WordNetwork

    def score(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Words and summed log-probability of each text."""
        lengths, sums = [np.empty(0, np.int64)], [np.empty(0)]
        for part in chunks(texts):
            context, target, ends = windows(part, self.network.words)
            steps = [slice(i, i + STEP_WORDS) for i in range(0, len(target), STEP_WORDS)]
            logp = [self.network.log_prob(context[at], target[at]) for at in steps]
            total = np.concatenate([[0.0], np.cumsum(np.concatenate([np.empty(0), *logp]))])
            n = np.diff(ends, prepend=0)
            lengths.append(n)
            sums.append(total[ends] - total[ends - n])
        return np.concatenate(lengths), np.concatenate(sums)


def learn(df: DataFrame, doc_id="doc_id", text="text") -> MaskedWords:
    """Counts and network over all rows."""
    bound_batches(df.sparkSession)
    docs = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    counts = count_slots(docs)
    network = WordNetwork(Vocabulary(counts))
    shards = int(min(MOST_SHARDS, max(1, -(-counts.sum() // (ROUNDS * SHARD_WORDS)))))
    docs = docs.where("text is not null").withColumn("dealt", F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS * shards)))
    docs = docs.withColumn("shard", F.floor(F.col("dealt") / ROUNDS).cast("int"))
    for number in range(ROUNDS if counts.any() else 0):
        rows = docs.where(F.col("dealt") % ROUNDS == number)
        dealt = rows.repartition(shards, "shard").sortWithinPartitions("shard", F.xxhash64("text", "doc_id"), "doc_id")
        train_round(dealt.select("shard", "text"), network)
    return MaskedWords(network)


def scored(df: DataFrame, model: MaskedWords, doc_id="doc_id", text="text") -> DataFrame:
    """doc_id, n_words, log_prob, mean_log_prob."""
    bound_batches(df.sparkSession)

    @F.pandas_udf("n_words long, log_prob double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            n, total = model.score(texts.tolist())
            yield pd.DataFrame({"n_words": n, "log_prob": total})

    out = df.select(F.col(doc_id).alias("doc_id"), score(F.col(text)).alias("s")).select("doc_id", "s.*")
    return out.withColumn("mean_log_prob", F.when(F.col("n_words") > 0, F.col("log_prob") / F.col("n_words")))
