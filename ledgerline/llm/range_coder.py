"""Adaptive context-mixing range coder for sequences of ids, many blocks in step.

Every block starts from an empty model, so each can be decoded alone. All lanes (blocks) of a call advance by one id
at a time, and what they do is array work over the lanes; the decoder does the same with the same whole numbers, so
both agree on every machine.

Inside a block an id is known by its number in order of first appearance. Three predictions are mixed:

* order 2 and order 1: the id that followed the last two, or the last one, when they were met before, with a
  confidence of 0 (never met) to 3 (right several times on end);
* order 0: counts of the ids so far, kept in a tree of 16-fold nodes (only ids that the others missed are counted);
* an id new to the block: all ids below a bound alike.

The weights of the four in the mixture are adapted for each pair of confidences while coding. The coder keeps 64-bit
low and range, emits 16 bits at a time and cuts the range where a carry could pass.
"""

import numpy as np

#: Ids of a block at most: the tree of counts has 16 ** 3 leaves.
BLOCK_IDS = 4096
#: Mixture weights are parts of 2 ** 14; a predictor keeps at least LEAST of them and moves by 1 / 2 ** RATE.
BITS, LEAST, RATE = 14, 16, 4
STATES = 32
HELD = 1 << 32
U = np.uint64
ORDER2, ORDER1, ORDER0, NEW = range(4)


def first_weights() -> np.ndarray:
    """The three bounds between the weights before anything is learned, by state; four 16-bit numbers as one.

    A state holds the confidence of order 2, that of order 1, and whether both predict the same id.
    """
    strength = np.array([0.0, 0.3, 0.5, 0.75])
    state = np.arange(STATES)
    second, first, alike = strength[state >> 3], strength[(state >> 1) & 3], state & 1
    share = np.stack([second, (1 - second) * first * (1 - alike), (1 - second) * (1 - first * (1 - alike)) / 2])
    bounds = np.zeros((STATES, 4), dtype=np.int16)
    bounds[:, :3] = np.cumsum(share * ((1 << BITS) - 4 * LEAST) + LEAST, axis=0).T
    return bounds.view(np.int64)[:, 0]


def targets() -> np.ndarray:
    """Where the three bounds move when a predictor was right."""
    j = np.arange(1, 5)
    rows = [np.where(j <= s, j * LEAST, (1 << BITS) - (4 - j) * LEAST) * (j < 4) for s in range(4)]
    return np.stack(rows).astype(np.int16)


class Model:
    """The adaptive state of ``lanes`` blocks."""

    def __init__(self, lanes: int):
        # what followed a context, times four, plus the confidence
        self.follow2 = np.zeros(lanes * BLOCK_IDS, dtype=np.int16)
        self.follow1 = np.zeros(lanes * BLOCK_IDS, dtype=np.int16)
        self.weights = np.tile(first_weights(), lanes)
        self.targets = targets()
        # running sums of the counts in each node of the tree
        self.tree = [np.zeros((lanes * width, 16), dtype=np.int16) for width in (1, 16, 256)]
        self.flat = [rows.reshape(-1) for rows in self.tree]
        # a node is four 64-bit words of four counts each; sums stay below 2 ** 15, so words add without a carry
        self.words = [rows.view(np.int64) for rows in self.flat]
        self.rise = (np.arange(16)[:, None] <= np.arange(16)).astype(np.int16).view(np.int64)
        self.four = np.arange(4)
        self.lane = np.arange(lanes, dtype=np.int64)
        self.block = self.lane * BLOCK_IDS
        self.states = self.lane * STATES

    def predict(self, n: int, before2: np.ndarray, before1: np.ndarray) -> None:
        """Look up both predictions and the weights for the first ``n`` lanes."""
        block = self.block[:n]
        self.at2 = block + ((before2 * 5189 + before1 * 2909) & (BLOCK_IDS - 1))
        self.at1 = block + before1
        second, first = self.follow2[self.at2], self.follow1[self.at1]
        self.second, self.first = second >> 2, first >> 2
        self.sure2, self.sure1 = second & 3, first & 3
        self.alike = self.second == self.first
        self.state = self.states[:n] + (self.sure2 * 8 + self.sure1 * 2 + self.alike)
        self.bounds = self.weights[self.state].view(np.int16).reshape(n, 4)
        self.known2, self.known1 = self.sure2 > 0, self.sure1 > 0

    def span(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each lane's part of 2 ** BITS for the predictor chosen."""
        n = len(chosen)
        edges = np.zeros((n, 5), dtype=np.int16)
        edges[:, 1:4] = self.bounds[:, :3]
        edges[:, 4] = 1 << BITS
        edges, at = edges.reshape(-1), self.lane[:n] * 5 + chosen
        below = edges[at]
        return below, edges[at + 1] - below

    def learn(self, ids: np.ndarray, chosen: np.ndarray) -> None:
        """Adapt to what came: its number in the block, and which predictor had it."""
        moved = self.bounds + ((self.targets.take(chosen, axis=0) - self.bounds) >> RATE)
        self.weights[self.state] = moved.view(np.int64)[:, 0]
        kept = ids.astype(np.int16) << 2
        hit = (self.second << 2 == kept) & self.known2
        self.follow2[self.at2] = kept + np.where(hit, np.minimum(self.sure2 + 1, 3), 1).astype(np.int16)
        hit = (self.first << 2 == kept) & self.known1
        self.follow1[self.at1] = kept + np.where(hit, np.minimum(self.sure1 + 1, 3), 1).astype(np.int16)
        missed = np.flatnonzero(chosen >= ORDER0)
        ids = ids[missed]
        for level, (width, shift) in enumerate(((1, 8), (16, 4), (256, 0))):
            at = ((missed * width + (ids >> (shift + 4))) * 4)[:, None] + self.four
            self.words[level][at] += self.rise.take((ids >> shift) & 15, axis=0)

    def totals(self, lanes: np.ndarray) -> np.ndarray:
        return self.flat[0][lanes * 16 + 15]

    def counts(self, lanes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts below each id and its own, for ids that the tree holds."""
        below = 0
        for level, (width, shift) in enumerate(((1, 8), (16, 4), (256, 0))):
            digit = ids >> shift
            at = lanes * (width * 16) + digit
            under = self.flat[level][at - 1] * ((digit & 15) > 0)
            below = below + under
        return below, self.flat[2][at] - under

    def find(self, lanes: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The id whose span holds ``wanted``, the counts below it and its own."""
        ids, below, wanted = np.zeros(len(lanes), np.int64), 0, wanted.astype(np.int16)
        for level, width in enumerate((1, 16, 256)):
            digit = (self.tree[level].take(lanes * width + ids, axis=0) <= wanted[:, None]).sum(axis=1)
            ids = ids * 16 + digit
            at = lanes * (width * 16) + ids
            under = self.flat[level][at - 1] * (digit > 0)
            wanted = wanted - under
            below = below + under
        return ids, below, self.flat[2][at] - under


class _Lanes:
    """Low and range of each lane's interval."""

    def __init__(self, lanes: int):
        self.low = np.zeros(lanes, dtype=U)
        self.range = np.full(lanes, 2**64 - 1, dtype=U)
        self.size = np.zeros(lanes, dtype=np.int64)

    def part(self, lanes, total, bits):
        """A lane's range cut into ``total`` or 2 ** ``bits`` parts."""
        return self.range[lanes] >> U(bits) if bits else self.range[lanes] // total.astype(U)

    def narrow(self, lanes, part, below, own) -> None:
        self.low[lanes] += part * below.astype(U)
        self.range[lanes] = width = part * own.astype(U)
        short = np.flatnonzero(width < HELD)
        if not isinstance(lanes, slice):
            short = lanes[short]
        while len(short):
            low, width = self.low[short], self.range[short]
            carry = ((low ^ (low + (width - U(1)))) >> U(48)) != 0
            width = np.where(carry, (~low & U(2**48 - 1)) + U(1), width)
            self.move(short, low)
            self.size[short] += 1
            self.low[short] = low << U(16)
            self.range[short] = width = width << U(16)
            short = short[width < HELD]


class Writer(_Lanes):
    """Range encoder, one per lane. ``lanes`` is a slice from 0 or an array of numbers."""

    def __init__(self, lanes: int, words: int):
        super().__init__(lanes)
        self.words = np.zeros((lanes, words), dtype=np.uint16)

    def put(self, lanes, below, own, total=None, bits=0) -> None:
        """Narrow the lanes' ranges to [below, below + own) of the whole."""
        self.narrow(lanes, self.part(lanes, total, bits), below, own)

    def move(self, lanes, low) -> None:
        self.words[lanes, self.size[lanes]] = low >> U(48)

    def finished(self) -> list[bytes]:
        """The words of every lane; two more end it, zeros may follow."""
        last = self.low + U(HELD - 1)
        out = []
        for i, size in enumerate(self.size.tolist()):
            self.words[i, size : size + 2] = [int(last[i]) >> 48, int(last[i]) >> 32 & 0xFFFF]
            out.append(self.words[i, : size + 2].astype("<u2").tobytes())
        return out


class Reader(_Lanes):
    """Range decoder, one per lane: ``look`` tells where a lane stands, ``take`` follows the writer's step."""

    def __init__(self, streams: list[bytes]):
        super().__init__(len(streams))
        widest = max(map(len, streams)) // 2 + 8
        self.words = np.zeros((len(streams), widest), dtype=np.uint16)
        for i, stream in enumerate(streams):
            self.words[i, : len(stream) // 2] = np.frombuffer(stream, dtype="<u2")
        self.code = np.zeros(len(streams), dtype=U)
        for i in range(4):
            self.code = self.code << U(16) | self.words[:, i]
        self.size += 4
        self.last = widest - 1

    def look(self, lanes, total=None, bits=0) -> np.ndarray:
        self.parts = self.part(lanes, total, bits)
        most = U((1 << bits) - 1) if bits else total.astype(U) - U(1)
        return np.minimum((self.code[lanes] - self.low[lanes]) // self.parts, most).astype(np.int64)

    def take(self, lanes, below, own) -> None:
        self.narrow(lanes, self.parts, below, own)

    def move(self, lanes, low) -> None:
        words = self.words[lanes, np.minimum(self.size[lanes], self.last)]
        self.code[lanes] = self.code[lanes] << U(16) | words


def by_appearance(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each id's number in order of first appearance, and whether it appears for the first time."""
    keys = np.sort(block * BLOCK_IDS + np.arange(len(block)))
    places = keys & (BLOCK_IDS - 1)
    first = np.diff(keys // BLOCK_IDS, prepend=-1) != 0
    new = np.zeros(len(block), dtype=bool)
    new[places[first]] = True
    number = np.empty(len(block), dtype=np.int64)
    number[places] = (np.cumsum(new) - 1)[places[first]][np.cumsum(first) - 1]
    return number, new


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    """One stream per block; a block is up to BLOCK_IDS ids below 2 ** 32. A block's bound must be stored with it."""
    if not blocks:
        return []
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    lengths = np.array([len(blocks[i]) for i in order], dtype=np.int64)
    steps, lanes = int(lengths[0]), len(blocks)
    raw = np.zeros((steps, lanes), dtype=np.int64)
    number = np.zeros((steps, lanes), dtype=np.int64)
    new = np.zeros((steps, lanes), dtype=bool)
    for lane, i in enumerate(order):
        block = blocks[i]
        raw[: len(block), lane] = block
        number[: len(block), lane], new[: len(block), lane] = by_appearance(block)
    high = (raw.max(axis=0, initial=0) >> 16) + 1
    model, writer = Model(lanes), Writer(lanes, 4 * steps + 8)
    before2 = before1 = np.zeros(lanes, dtype=np.int64)
    active = lanes - np.searchsorted(lengths[::-1], np.arange(steps), side="right")
    for step, n in enumerate(active.tolist()):
        ids = number[step, :n]
        model.predict(n, before2[:n], before1[:n])
        chosen = np.where(new[step, :n], NEW, ORDER0)
        chosen[model.known1 & (model.first == ids)] = ORDER1
        chosen[model.known2 & (model.second == ids)] = ORDER2
        writer.put(slice(0, n), *model.span(chosen), bits=BITS)
        seen = np.flatnonzero(chosen == ORDER0)
        if len(seen):
            writer.put(seen, *model.counts(seen, ids[seen]), total=model.totals(seen))
        fresh = np.flatnonzero(chosen == NEW)
        if len(fresh):
            value, one = raw[step, fresh], np.ones(len(fresh), dtype=np.int64)
            wide = high[fresh] > 1
            if wide.any():
                writer.put(fresh[wide], value[wide] >> 16, one[wide], total=high[fresh[wide]])
            writer.put(fresh, value & 0xFFFF, one, bits=16)
        model.learn(ids, chosen)
        before2, before1 = before1[:n], ids
    streams = writer.finished()
    out: list[bytes] = [b""] * lanes
    for lane, i in enumerate(order):
        out[i] = streams[lane]
    return out


def decode(streams: list[bytes], lengths: list[int], bounds: list[int]) -> list[np.ndarray]:
    """The blocks of ``encode``; ``bounds`` holds each block's largest id or more, by the same upper 16 bits."""
    if not streams:
        return []
    order = sorted(range(len(streams)), key=lambda i: -lengths[i])
    sizes = np.array([lengths[i] for i in order], dtype=np.int64)
    high = (np.array([bounds[i] for i in order], dtype=np.int64) >> 16) + 1
    steps, lanes = int(sizes[0]), len(streams)
    model, reader = Model(lanes), Reader([streams[i] for i in order])
    raw = np.zeros((lanes, steps), dtype=np.int64)
    names = np.zeros(lanes * BLOCK_IDS, dtype=np.int64)
    known = np.zeros(lanes, dtype=np.int64)
    before2 = before1 = np.zeros(lanes, dtype=np.int64)
    active = lanes - np.searchsorted(sizes[::-1], np.arange(steps), side="right")
    for step, n in enumerate(active.tolist()):
        model.predict(n, before2[:n], before1[:n])
        lane = model.lane[:n]
        everyone = slice(0, n)
        chosen = (model.bounds[:, :3] <= reader.look(everyone, bits=BITS)[:, None]).sum(axis=1)
        reader.take(everyone, *model.span(chosen))
        ids = np.where(chosen == ORDER2, model.second, model.first).astype(np.int64)
        seen = np.flatnonzero(chosen == ORDER0)
        if len(seen):
            found, under, own = model.find(seen, reader.look(seen, total=model.totals(seen)))
            reader.take(seen, under, own)
            ids[seen] = found
        fresh = np.flatnonzero(chosen == NEW)
        if len(fresh):
            value, one = np.zeros(len(fresh), dtype=np.int64), np.ones(len(fresh), dtype=np.int64)
            wide = np.flatnonzero(high[fresh] > 1)
            if len(wide):
                upper = reader.look(fresh[wide], total=high[fresh[wide]])
                reader.take(fresh[wide], upper, one[wide])
                value[wide] = upper << 16
            lower = reader.look(fresh, bits=16)
            reader.take(fresh, lower, one)
            ids[fresh] = known[fresh]
            names[fresh * BLOCK_IDS + known[fresh]] = value | lower
            known[fresh] += 1
        raw[:n, step] = names[lane * BLOCK_IDS + ids]
        model.learn(ids, chosen)
        before2, before1 = before1[:n], ids
    out: list[np.ndarray] = [raw[0, :0]] * lanes
    for at, i in enumerate(order):
        out[i] = raw[at, : sizes[at]]
    return out
