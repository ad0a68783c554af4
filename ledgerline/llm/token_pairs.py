"""Cross-tokenizer alignment: which ids of two tokenizers cover the same bytes, counted over the corpus.

Each text is encoded by a byte-level tokenizer A (with a space in front) and a sentence-piece model B (which adds that space).
Offsets where a token of A and a token of B both end cut them into groups; an A token and a B token are linked
if their bytes overlap. A pair of ids counts as often as it is linked anywhere; a link is best if no other
A id has a higher count with its B id.

Counting is external:

1. A task takes its texts in blocks of about ``BLOCK_CHARS`` characters and turns each block's links into (pair,
   document, times) records in side-major order: B id, A id, document. They are dealt by a digit of the B id (radix) and
   written as zstd runs. A run has a list of its pairs with their totals, and the documents behind each pair.
2. Per digit the lists are merged, ``FAN`` at a time, by a heap over the runs' frames, which adds up each pair. The order
   gives all pairs of a B id one after the other, so its highest count is known when its last pair has passed.
3. The runs' documents stream past the merged counts; what each link adds to its document goes back by block.

A B id with a third of all links is one pair list of at most a vocabulary's length in each merge, and its
documents stay split by block, so no task holds a hot id. Tasks hold ``FAN`` runs at a time or so.

Texts that are null or empty, and those whose bytes one of the tokenizers does not give back, have no tokens: counts of
zero and ''. Rows keep their own results if ids repeat or are null. An empty table gives no rows; other columns
are ignored.
"""

import hashlib
import heapq
import re
import struct
from collections.abc import Iterator
from itertools import chain
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import common
from ledgerline.llm.token_ids import Encoder, byte_letters

BLOCK_CHARS = 2_500_000
#: Digits of the radix partition, runs merged at a time, pairs in a frame of a run.
DIGITS, FAN, FRAME = 16, 64, 8192
#: A pair as one number: the B id above the A id.
A_BITS = 31

ALIGNED = (
    "block long, digit int, document int, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
    "groups_sha256 string, pairs binary, holders binary"
)


# ---- zstd runs ----


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers from 0 on, each in the narrowest type, as one zstd frame."""
    out = [struct.pack("<B", len(arrays))]
    for array in arrays:
        kind = np.min_scalar_type(int(array.max(initial=0)))
        out.append(struct.pack("<BQ", kind.itemsize, len(array)))
        out.append(array.astype(f"<u{kind.itemsize}").tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def unpacked(frame: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(frame)
    out, at = [], 1
    for _ in range(raw[0]):
        width, n = struct.unpack_from("<BQ", raw, at)
        at += 9
        out.append(np.frombuffer(raw, dtype=f"<u{width}", count=n, offset=at).astype(np.int64))
        at += width * n
    return out


def run_of(keys: np.ndarray, *values: np.ndarray) -> bytes:
    """A run: frames of up to FRAME rows in order of key, each with its first key and its length before it."""
    out = []
    for at in range(0, len(keys), FRAME):
        part = slice(at, at + FRAME)
        steps = np.diff(keys[part], prepend=keys[at])
        body = packed(steps, *(v[part] for v in values))
        out.append(struct.pack("<qI", keys[at], len(body)) + body)
    return b"".join(out)


def heads(run: bytes) -> Iterator[tuple[int, int, int]]:
    """First key, start and end of each frame."""
    at = 0
    while at < len(run):
        first, size = struct.unpack_from("<qI", run, at)
        yield first, at + 12, at + 12 + size
        at += 12 + size


def rows_of(run: bytes) -> list[np.ndarray]:
    """All rows of a run: keys, then the values."""
    frames = []
    for first, start, end in heads(run):
        steps, *values = unpacked(run[start:end])
        frames.append([first + np.cumsum(steps), *values])
    return [np.concatenate(column) for column in zip(*frames)]


def merged(runs: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """K-way merge of runs of (key, count): ascending keys and their sums, in parts.

    The heap holds the next frame of every run by its first key. Rows below the heap's smallest key are complete.
    """
    frames = [heads(run) for run in runs]
    heap = [(head[0], i, head[1], head[2]) for i, f in enumerate(frames) if (head := next(f, None))]
    heapq.heapify(heap)
    held_keys, held_counts, held = [], [], 0
    while heap:
        first, i, start, end = heap[0]
        following = next(frames[i], None)
        if following:
            heapq.heapreplace(heap, (following[0], i, following[1], following[2]))
        else:
            heapq.heappop(heap)
        steps, counts = unpacked(runs[i][start:end])
        held_keys.append(first + np.cumsum(steps))
        held_counts.append(counts)
        held += len(counts)
        if held < FAN * FRAME and heap:
            continue
        keys, counts = np.concatenate(held_keys), np.concatenate(held_counts)
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        ready = int(np.searchsorted(keys, heap[0][0])) if heap else len(keys)
        if ready:
            at = np.flatnonzero(np.diff(keys[:ready], prepend=-1))
            yield keys[at], np.add.reduceat(counts[:ready], at)
        held_keys, held_counts, held = [keys[ready:]], [counts[ready:]], len(keys) - ready


def with_maxima(parts) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Adds to a side-major stream whether a pair has its B id's highest count; a B id is passed on when it is whole."""
    keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    for more_keys, more_counts in chain(parts, [(None, None)]):
        if more_keys is not None:
            keys, counts = np.append(keys, more_keys), np.append(counts, more_counts)
        if not len(keys):
            continue
        side = keys >> A_BITS
        ready = len(keys) if more_keys is None else int(np.searchsorted(side, side[-1]))
        if ready:
            at = np.flatnonzero(np.diff(side[:ready], prepend=-1))
            most = np.maximum.reduceat(counts[:ready], at)
            best = counts[:ready] == np.repeat(most, np.diff(np.append(at, ready)))
            yield keys[:ready], counts[:ready], best.astype(np.int64)
        keys, counts = keys[ready:], counts[ready:]


# ---- tokens, groups and links of a block ----


class Vocabularies:
    """Both tokenizers, the bytes of their tokens, and their ids as decimal text with each possible mark after it."""

    def __init__(self, a_file: str, b_file: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Encoder(a_file, plain=True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        byte_of = {letter: b for b, letter in byte_letters().items()}
        own = Tokenizer.from_file(a_file)
        n_a, n_b = own.get_vocab_size(), self.b.get_piece_size()
        self.a_bytes = [self._a_bytes(own.id_to_token(i) or "", byte_of) for i in range(n_a)]
        self.b_bytes = [self._b_bytes(self.b.id_to_piece(i)) for i in range(n_b)]
        self.a_sizes = np.array([len(b) for b in self.a_bytes], dtype=np.int64)
        self.b_sizes = np.array([len(b) for b in self.b_bytes], dtype=np.int64)
        names = [str(i).encode() for i in range(max(n_a, n_b))]
        self.width = len(names)
        self.marked = np.array([n + mark for mark in (b",", b"|", b";", b"") for n in names], dtype=object)

    @staticmethod
    def _a_bytes(token: str, byte_of: dict[str, int]) -> bytes:
        if all(c in byte_of for c in token):
            return bytes(byte_of[c] for c in token)
        return token.encode()

    @staticmethod
    def _b_bytes(piece: str) -> bytes:
        if re.fullmatch("<0x[0-9A-F]{2}>", piece):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def tokens(self, texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids by A and by B of all texts, and the numbers of each text's; texts that do not come back have none."""
        texts = [t or None for t in texts]
        a, n_a = self.a(texts, before=" ")
        found = self.b.encode([t or "" for t in texts], num_threads=1)
        n_b = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        b = np.fromiter(chain.from_iterable(found), dtype=np.int64, count=int(n_b.sum()))
        right = np.array([t is not None for t in texts], dtype=bool)
        for ids, counts, table, sizes in ((a, n_a, self.a_bytes, self.a_sizes), (b, n_b, self.b_bytes, self.b_sizes)):
            joined = b"".join(map(table.__getitem__, ids.tolist()))
            ends = np.append(0, np.cumsum(sizes[ids]))[np.cumsum(counts)].tolist()
            start = 0
            for i, (text, end) in enumerate(zip(texts, ends)):
                if text is not None and joined[start:end] != b" " + text.encode():
                    right[i] = False
                start = end
        return a[np.repeat(right, n_a)], n_a * right, b[np.repeat(right, n_b)], n_b * right

    def align(self, texts: list) -> dict:
        """Per text n_a, n_b, n_groups, n_links and digest of its groups; per link its pair and text."""
        a, n_a, b, n_b = self.tokens(texts)
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        a_starts, b_starts = a_ends - self.a_sizes[a], b_ends - self.b_sizes[b]
        a_cut, b_cut = np.isin(a_ends, b_ends), np.isin(b_ends, a_ends)
        texts_of_a = np.repeat(np.arange(len(texts)), n_a)
        first = np.searchsorted(b_ends, a_starts, side="right")
        linked = np.searchsorted(b_starts, a_ends, side="left") - first
        at = np.repeat(np.arange(len(a)), linked)
        other = np.arange(len(at)) + np.repeat(first - (np.cumsum(linked) - linked), linked)
        return {
            "n_a": n_a,
            "n_b": n_b,
            "n_groups": np.bincount(texts_of_a[a_cut], minlength=len(texts)),
            "n_links": np.bincount(texts_of_a, weights=linked, minlength=len(texts)).astype(np.int64),
            "digests": self._digests(a, n_a, a_cut, b, n_b, b_cut),
            "pairs": b[other] << A_BITS | a[at],
            "texts": texts_of_a[at],
        }

    def _digests(self, a, n_a, a_cut, b, n_b, b_cut) -> list[str]:
        a_group, b_group = np.cumsum(a_cut) - a_cut, np.cumsum(b_cut) - b_cut
        comma, bar, semicolon, nothing = np.arange(4) * self.width
        place_a = np.arange(len(a)) + np.searchsorted(b_group, a_group, side="left")
        place_b = np.arange(len(b)) + np.searchsorted(a_group, b_group, side="right")
        row = np.empty(len(a) + len(b), dtype=np.int64)
        row[place_a] = a + np.where(a_cut, bar, comma)
        row[place_b] = b + np.where(b_cut, semicolon, comma)
        ends = np.cumsum(n_a + n_b)
        last = ends[n_a + n_b > 0] - 1
        row[last] += nothing - semicolon
        out, start = [], 0
        for end in ends.tolist():
            text = b"".join(self.marked[row[start:end]].tolist())
            out.append(hashlib.sha256(text).hexdigest() if end > start else "")
            start = end
        return out


def runs_of_block(pairs: np.ndarray, texts: np.ndarray, n_texts: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Per digit of the B id: the run of pairs with their totals, and the documents and times behind each pair."""
    if not len(pairs):
        return
    a, b = pairs & ((1 << A_BITS) - 1), pairs >> A_BITS
    digit = b % DIGITS
    bits = [max(1, int(x.max()).bit_length()) for x in (a, b, np.array([n_texts]))]
    if sum(bits) + 4 > 63:
        raise ValueError("vocabularies and documents of a block do not fit one number")
    rows = ((digit << bits[1] | b) << bits[0] | a) << bits[2] | texts
    rows.sort()
    at = np.flatnonzero(np.diff(rows, prepend=-1))
    times = np.diff(np.append(at, len(rows)))
    rows = rows[at]
    documents, keys = rows & ((1 << bits[2]) - 1), rows >> bits[2]
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    keys = keys[starts]
    held = np.diff(np.append(starts, len(rows)))
    totals = np.add.reduceat(times, starts)
    digits = keys >> (bits[0] + bits[1])
    keys = ((keys >> bits[0]) & ((1 << bits[1]) - 1)) << A_BITS | (keys & ((1 << bits[0]) - 1))
    borders = np.searchsorted(digits, np.arange(DIGITS + 1))
    row_starts = np.append(starts, len(rows))
    for d in range(DIGITS):
        low, high = borders[d], borders[d + 1]
        if low < high:
            part = slice(row_starts[low], row_starts[high])
            yield d, run_of(keys[low:high], totals[low:high]), packed(held[low:high], documents[part], times[part])


def aligned(df: DataFrame, a_file: str, b_file: str, doc_id="doc_id", text="text") -> DataFrame:
    """The stored first step: a row per document (digit null), and a row per block and digit with its runs."""

    def blocks(batches):
        words = Vocabularies(a_file, b_file)
        task, number, ids, texts, size = TaskContext.get().partitionId(), 0, [], [], 0
        for batch in chain(batches, [None]):
            more = [] if batch is None else zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for doc_id, text in more:
                ids.append(doc_id)
                texts.append(text)
                size += len(text or "") + 1
                if size >= BLOCK_CHARS:
                    yield from rows(words, task << 32 | number, ids, texts)
                    number, ids, texts, size = number + 1, [], [], 0
        if ids:
            yield from rows(words, task << 32 | number, ids, texts)

    schema = pa.schema(
        [("block", pa.int64()), ("digit", pa.int32()), ("document", pa.int32()), ("doc_id", pa.int64())]
        + [(name, pa.int64()) for name in ("n_a", "n_b", "n_groups", "n_links")]
        + [("groups_sha256", pa.string()), ("pairs", pa.binary()), ("holders", pa.binary())]
    )

    def rows(words, block, ids, texts):
        found, n = words.align(texts), len(ids)
        table = {"block": [block] * n, "document": list(range(n)), "doc_id": ids, "groups_sha256": found["digests"]}
        table |= {name: found[name] for name in ("n_a", "n_b", "n_groups", "n_links")}
        table |= {name: [None] * n for name in ("digit", "pairs", "holders")}
        yield pa.RecordBatch.from_pydict(table, schema=schema)
        for digit, pairs, holders in runs_of_block(found["pairs"], found["texts"], n):
            row = {name: [None] for name in schema.names} | {"block": [block], "digit": [digit]}
            yield pa.RecordBatch.from_pydict(row | {"pairs": [pairs], "holders": [holders]}, schema=schema)

    common.bound_batches(df.sparkSession)
    rows_in = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return common.stored(rows_in.mapInArrow(blocks, ALIGNED), "token-pairs")


# ---- counts, and what they add to each document ----


def pair_runs(steps: DataFrame) -> DataFrame:
    """(digit, pairs): one run per digit with every pair's count over the corpus and whether it is its B id's best."""
    runs = steps.where("digit is not null").select("digit", F.col("block").alias("run"), "pairs")
    n = runs.select("run").distinct().count()
    while n > FAN:
        n = ceil(n / FAN)

        def merge(key, group: pd.DataFrame) -> pd.DataFrame:
            columns = [np.concatenate(c) for c in zip(*merged(group["pairs"].tolist()))]
            return pd.DataFrame({"digit": [key[0]], "run": [key[1]], "pairs": [run_of(*columns)]})

        keyed = runs.withColumn("run", F.pmod(F.xxhash64("run"), F.lit(n)))
        runs = keyed.groupBy("digit", "run").applyInPandas(merge, "digit int, run long, pairs binary")

    def finish(key, group: pd.DataFrame) -> pd.DataFrame:
        columns = [np.concatenate(c) for c in zip(*with_maxima(merged(group["pairs"].tolist())))]
        return pd.DataFrame({"digit": [key[0]], "pairs": [run_of(*columns)]})

    return common.stored(runs.groupBy("digit").applyInPandas(finish, "digit int, pairs binary"), "pair-counts")


def contributions(steps: DataFrame, counts: DataFrame) -> DataFrame:
    """(block, document, n_best, count_sum): what the links of all pairs add to each document."""
    blocks = steps.where("digit is not null").select("block").distinct().count()
    groups = max(1, ceil(blocks / FAN))
    salt = F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int")
    records = steps.where("digit is not null").select("digit", salt.alias("salt"), "block", "pairs", "holders")
    copies = counts.select("digit", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("salt"), "pairs")

    def stream(records: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(counts):
            keys, totals, best = rows_of(counts["pairs"].iloc[0])
            for block, pairs, holders in zip(records["block"], records["pairs"], records["holders"]):
                at = np.searchsorted(keys, rows_of(pairs)[0])
                held, documents, times = unpacked(holders)
                at = np.repeat(at, held)
                sums = np.zeros((2, int(documents.max()) + 1), dtype=np.int64)
                np.add.at(sums[0], documents, times * best[at])
                np.add.at(sums[1], documents, times * totals[at])
                out.append((block, packed(*sums)))
        return pd.DataFrame(out, columns=["block", "sums"])

    def add(key, group: pd.DataFrame) -> pd.DataFrame:
        parts = [unpacked(s) for s in group["sums"]]
        total = np.zeros((2, max(len(p[0]) for p in parts)), dtype=np.int64)
        for best, sums in parts:
            total[0, : len(best)] += best
            total[1, : len(sums)] += sums
        names = np.arange(total.shape[1])
        return pd.DataFrame({"block": key[0], "document": names, "n_best": total[0], "count_sum": total[1]})

    met = records.groupBy("digit", "salt").cogroup(copies.groupBy("digit", "salt"))
    sums = met.applyInPandas(stream, "block long, sums binary")
    return sums.groupBy("block").applyInPandas(add, "block long, document int, n_best long, count_sum long")


def align(df: DataFrame, a_file: str, b_file: str, **columns) -> tuple[DataFrame, DataFrame]:
    """One row per row of ``df`` (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), and the
    run of pair counts per digit (``pair_table`` turns it into rows)."""
    steps = aligned(df, a_file, b_file, **columns)
    counts = pair_runs(steps)
    docs = steps.where("digit is null").drop("digit", "pairs", "holders")
    joined = docs.join(contributions(steps, counts), ["block", "document"], "left")
    zero = F.lit(0).cast("long")
    found = joined.select(
        "doc_id",
        *("n_a", "n_b", "n_groups", "n_links"),
        F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"),
        "groups_sha256",
    )
    return found, counts


def pair_table(counts: DataFrame) -> DataFrame:
    """The counted pairs as rows (a, b, n, best): the id mapping between the two vocabularies."""

    def rows(frames):
        for frame in frames:
            for run in frame["pairs"]:
                for first, start, end in heads(run):
                    steps, n, best = unpacked(run[start:end])
                    keys = first + np.cumsum(steps)
                    yield pd.DataFrame({"a": keys & ((1 << A_BITS) - 1), "b": keys >> A_BITS, "n": n, "best": best > 0})

    return counts.select("pairs").mapInPandas(rows, "a long, b long, n long, best boolean")
