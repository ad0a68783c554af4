"""Hashes of words and of runs of words, the same in every process, computed over whole batches."""

import zlib
from collections.abc import Iterator

import numpy as np

CHUNK_BYTES = 1 << 18

#: Blanks are space, tab, line feed, vertical tab, form feed and return; A-Z go to lower case.
BLANK = np.zeros(256, dtype=bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: A fixed random 64-bit value for each byte, and an odd base for its place in the word.
BYTE_VALUES = np.random.default_rng(20).integers(0, 1 << 64, 256, dtype=np.uint64)
BASE = 0x9E3779B97F4A7C15
#: Odd multipliers, one per place in a run of words.
PLACES = np.random.default_rng(21).integers(0, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def crc(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass"))


class WordIds:
    """Word -> crc32; the cache is emptied when it holds ``limit`` words."""

    def __init__(self, limit: int = 500_000):
        self.limit = limit
        self.known: dict[str, int] = {}

    def __call__(self, words: list[str]) -> np.ndarray:
        if len(self.known) > self.limit:
            self.known = {}
        known = self.known
        for w in set(words).difference(known):
            known[w] = crc(w)
        return np.fromiter(map(known.__getitem__, words), dtype=np.uint32, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A multiplicative scramble of 64-bit values."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def powers(n: int) -> np.ndarray:
    """BASE ** 0 .. BASE ** (n - 1), modulo 2 ** 64."""
    out = np.full(n, BASE, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(texts) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of all texts in order, and the number of words of each text."""
    raw = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    joined = np.frombuffer(b"\n".join([*raw, b""]), dtype=np.uint8)  # a blank after each text
    inside = ~BLANK[joined]
    edges = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    starts, ends = np.nonzero(edges == 1)[0], np.nonzero(edges == -1)[0]
    after = np.cumsum([len(r) + 1 for r in raw], dtype=np.int64)
    counts = np.diff(np.searchsorted(starts, after), prepend=0)
    if not len(starts):
        return np.empty(0, dtype=np.uint64), counts
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    values = BYTE_VALUES[LOWER[joined[inside]]]
    place = np.arange(len(values)) - np.repeat(first, lengths)
    values *= powers(int(lengths.max()))[place]
    return mix(np.add.reduceat(values, first) + lengths.astype(np.uint64) * PLACES[15]), counts


def chunks(texts) -> Iterator[list]:
    """Texts in lists of about CHUNK_BYTES characters, at least one text each."""
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text or "") + 1
        if size >= CHUNK_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


def run_hashes(texts, k: int) -> Iterator[np.ndarray]:
    """For each text the hashes of its runs of ``k`` words (at most 8), in order of place; signed.

    A text with fewer words is one run, a text without words has none.
    """
    for part in chunks(texts):
        words, counts = word_hashes(part)
        n = len(words)
        whole = np.full(max(n - k + 1, 0), k, dtype=np.uint64)
        for i in range(k):
            whole += words[i : i + len(whole)] * PLACES[i]
        whole = mix(whole).view(np.int64)
        at = 0
        for count in counts.tolist():
            if count >= k:
                yield whole[at : at + count - k + 1]
            elif count:
                run = (words[at : at + count] * PLACES[:count]).sum(dtype=np.uint64) + np.uint64(count)
                yield mix(np.array([run], dtype=np.uint64)).view(np.int64)
            else:
                yield np.empty(0, dtype=np.int64)
            at += count
