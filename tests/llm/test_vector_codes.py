"""Product quantisation in whole numbers against plain Lloyd rounds."""

import hashlib
import math

import numpy as np
import pytest

from ledgerline.llm import vector_codes as vc


def plain(rows, rounds=6, parts=8, entries=16):
    """Expected rows: every part is compared with every entry in every round, in Python numbers."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    longest = max((len(r[1]) for r in kept), default=0)
    width = -(-longest // parts)
    if not kept:
        return []
    ints = [
        [math.floor(min(max(x * 4096, -(2.0**24)), 2.0**24)) for x in r[1]] + [0] * (width * parts - len(r[1]))
        for r in kept
    ]
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for v in ints]
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, ints[i]))[:entries]
    books = [[cut[i][p] for i in first] for p in range(parts)]

    def assigned():
        out = []
        for v in cut:
            out.append(
                [min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(books[p])) for p, x in enumerate(v)]
            )
        return out

    for _ in range(rounds):
        found = assigned()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [v[p] for v, f in zip(cut, found) if f[p][1] == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    found = assigned()
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    errors = [sum(d for d, _ in f) for f in found]
    of_label = {}
    for r, error in zip(kept, errors):
        of_label[r[2]] = of_label.get(r[2], 0) + error
    return [
        (r[0], "".join(f"{e:02x}" for _, e in f), error, of_label[r[2]], digest)
        for r, f, error in zip(kept, found, errors)
    ]


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def random_rows(n=150, width=16, seed=1):
    rng = np.random.default_rng(seed)
    vectors = np.round(rng.normal(0, 0.01, (n, width)), 3)  # many ties
    vectors[10:30] = vectors[9]
    labels = [None if i % 7 == 0 else i % 3 for i in range(n)]
    return [(int(i * 13 % 997), v.tolist(), y) for i, (v, y) in enumerate(zip(vectors, labels))]


SCHEMA = "vec_id long, embedding array<double>, label int"


def test_against_plain_rounds(spark):
    rows = random_rows()
    rows += [(5000, None, 1), (5001, [None] * 16, 1), (5002, [float("nan")] * 16, 1), (5003, [float("-inf")] * 16, 1)]
    rows += [(None, rows[3][1], 2), (rows[4][0], rows[5][1], 0), (-1, [], None), (6000, [0.5] * 5, 1)]
    rows += [(6001, [1e300] + [-1e300] * 15, 9)]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", codes int").repartition(3)
    assert in_order(vc.coded(df).collect()) == in_order(plain(rows))


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few_rows(spark, n):
    rows = random_rows(40)[:n]
    found = vc.coded(spark.createDataFrame(rows, SCHEMA)).collect()
    assert in_order(found) == in_order(plain(rows))


def test_moved_entries_are_enough():
    rng = np.random.default_rng(4)
    x, book = rng.integers(-3, 4, (500, 2)), rng.integers(-3, 4, (16, 2))
    codes, distances = vc.nearest(x, book, None, None, None)
    for _ in range(20):
        moved = rng.random(16) < 0.3
        book = np.where(moved[:, None], rng.integers(-3, 4, (16, 2)), book)
        codes, distances = vc.nearest(x, book, codes, distances, moved)
        again, exact = vc.nearest(x, book, None, None, None)
        assert (codes == again).all() and (distances == exact).all()


def test_codes_stand_for_their_vectors(spark):
    rows = random_rows(60, 24)
    found, books = vc.compress(spark.createDataFrame(rows, SCHEMA))
    vectors = {r[0]: np.floor(np.array(r[1]) * 4096).astype(int) for r in rows}
    for r in found.collect():
        near = vc.decoded(np.array([r.codes]), books)[0]
        assert ((vectors[r.vec_id] - near) ** 2).sum() == r.error
