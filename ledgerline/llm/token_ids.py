"""Token ids of whole texts under a public tokenizer file, fast enough for corpora with many rare words.

A byte-level tokenizer cuts a text into pieces (words with the blank before them, numbers, runs of signs or blanks)
and merges bytes inside each piece only. So pieces are found for a whole batch of texts by array operations on code
points, and the tokenizer's own model is asked once per distinct piece. Texts that contain an added token's string
are given to the tokenizer as a whole, and so are all texts if the tokenizer is of another make.
"""

import codecs
import json

import numpy as np

from ledgerline.llm.hashing import mix, powers

LETTER, NUMBER, SIGN, SPACE, EDGE, UNSEEN = range(6)

#: Texts are taken together until they have so many characters.
CHUNK_CHARS = 1 << 20
#: Distinct pieces remembered; the memory is emptied when it is full.
KNOWN_PIECES = 600_000


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for letters from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) if b in plain else chr(0x100 + others.index(b)) for b in range(256)}


class Classes:
    """Letter, number, blank or other sign, by code point; worked out when a code point is first met."""

    def __init__(self):
        import regex

        self.table = np.full(0x110000, UNSEEN, dtype=np.uint8)
        self.tests = [(SPACE, regex.compile(r"\p{White_Space}")), (LETTER, regex.compile(r"\p{L}"))]
        self.tests.append((NUMBER, regex.compile(r"\p{N}")))

    def __call__(self, points: np.ndarray) -> np.ndarray:
        found = self.table[points]
        new = found == UNSEEN
        if new.any():
            for point in np.unique(points[new]).tolist():
                self.table[point] = next((c for c, test in self.tests if test.match(chr(point))), SIGN)
            found = self.table[points]
        return found


def piece_starts(points: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """True where a piece or an edge between texts begins. The last place is an edge.

    A run of one kind is a piece and takes one space before it. The other blanks before it are a piece, a blank
    that is no space is one by itself there, and blanks at the end of a text are one piece. ``'s 't 'm 'd 're 've
    'll`` right after something else are pieces.
    """
    start = np.ones(len(points), dtype=bool)
    start[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == EDGE)
    ends = np.flatnonzero((kinds[:-1] == SPACE) & (kinds[1:] < SPACE)) + 1
    start[ends - 1] = True
    start[ends] = points[ends - 1] != 0x20
    quotes = np.flatnonzero((points[:-1] == 0x27) & start[:-1] & (kinds[1:] == LETTER))
    if len(quotes):
        one = points[quotes + 1]
        two = points[np.minimum(quotes + 2, len(points) - 1)]
        size = np.where(np.isin(one, [ord(c) for c in "stmd"]), 2, 0)
        for a, b in ("re", "ve", "ll"):
            size[(one == ord(a)) & (two == ord(b))] = 3
        quotes, size = quotes[size > 0], size[size > 0]
        start[quotes + 1] = False
        start[quotes + 2] &= size != 3
        start[quotes + size] = True
    return start


class _Pieces(dict):
    """Piece -> its ids; a new piece is encoded when it is asked for."""

    def __init__(self, tokenize, letters):
        super().__init__()
        self.tokenize, self.letters = tokenize, letters

    def __missing__(self, piece):
        mapped = codecs.charmap_decode(piece.encode("utf-8", "surrogatepass"), "strict", self.letters)[0]
        self[piece] = ids = tuple([token.id for token in self.tokenize(mapped)])
        return ids


def alike(points: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first piece of each kind, and each piece's number among them.

    Pieces are grouped by a 64-bit hash; if two that share a hash differ, each piece is a kind of its own.
    """
    offset = np.cumsum(sizes) - sizes
    inside = np.arange(int(sizes.sum())) - np.repeat(offset, sizes)
    chars = points[np.repeat(starts, sizes) + inside]
    values = mix(chars.astype(np.uint64) + np.uint64(1)) * powers(int(sizes.max()))[inside]
    _, first, number = np.unique(np.add.reduceat(values, offset), return_index=True, return_inverse=True)
    stand_in = first[number]
    if (sizes[stand_in] != sizes).any() or (chars != chars[np.repeat(offset[stand_in], sizes) + inside]).any():
        everyone = np.arange(len(starts))
        return everyone, everyone
    return first, number


class Encoder:
    """Ids of texts under the tokenizer file at ``path``, as its ``encode(..., add_special_tokens=False)`` gives them.

    With ``plain`` the strings of special tokens inside a text are ordinary text. Null texts have no ids.
    """

    def __init__(self, path: str, plain: bool = False):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        added = [t for t in made.get("added_tokens") or [] if not (plain and t.get("special"))]
        self.strings = [t["content"] for t in added]
        cut, model = made.get("pre_tokenizer") or {}, made["model"]
        self.by_piece = (
            made.get("normalizer") is None
            and cut.get("type") == "ByteLevel"
            and not cut.get("add_prefix_space")
            and cut.get("use_regex", True)
            and model.get("type", "BPE") == "BPE"
            and not model.get("dropout")
        )
        if self.by_piece:
            self.model = self.tokenizer.model
            self.letters = "".join(byte_letters().values())
            self.classes = Classes()
            self.known = _Pieces(self.model.tokenize, self.letters)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.int64)

    def __call__(self, texts: list, before: str = "") -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, each with ``before`` put in front, and the number of ids of each."""
        parts, counts, chunk, size = [], [], [], 0
        for text in texts:
            if text is None:
                text = ""
            elif before:
                text = before + text
            if not self.by_piece or any(s in text for s in self.strings):
                for ids, n in (self._together(chunk), ([whole := self.whole(text)], [len(whole)])):
                    parts += ids
                    counts += n
                chunk, size = [], 0
                continue
            chunk.append(text)
            size += len(text)
            if size > CHUNK_CHARS:
                ids, n = self._together(chunk)
                parts += ids
                counts += n
                chunk, size = [], 0
        ids, n = self._together(chunk)
        parts += ids
        counts += n
        return (np.concatenate(parts) if parts else np.empty(0, np.int64)), np.array(counts, dtype=np.int64)

    def _together(self, texts: list[str]) -> tuple[list[np.ndarray], list[int]]:
        if not texts:
            return [], []
        joined = "\0".join([*texts, ""])
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        edges = np.cumsum([len(t) + 1 for t in texts]) - 1
        kinds = self.classes(points).copy()
        kinds[edges] = EDGE
        starts = np.flatnonzero(piece_starts(points, kinds))
        ends = np.append(starts[1:], len(points))
        real = kinds[starts] != EDGE
        starts, ends = starts[real], ends[real]
        if len(self.known) > KNOWN_PIECES:
            self.known = _Pieces(self.model.tokenize, self.letters)
        if not len(starts):
            return [np.empty(0, np.int64)], [0] * len(texts)
        first, number = alike(points, starts, ends - starts)
        known = self.known
        found = [known[joined[a:b]] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        pool = np.fromiter((i for ids in found for i in ids), dtype=np.int64)
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        place = (np.cumsum(sizes) - sizes)[number]
        sizes = sizes[number]
        after = np.cumsum(sizes)
        ids = pool[np.repeat(place - (after - sizes), sizes) + np.arange(after[-1])]
        total = np.append(0, after)[np.searchsorted(starts, edges)]
        return [ids], np.diff(total, prepend=0).tolist()
