import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import cover_search as cs


def brute(rows, k):
    usable = [(i, [np.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, a in {i: v for i, v in usable if i % 20 == 0}.items():
        scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in usable if i != q)[:k]
        out |= {(q, r, i, int(-s)) for r, (s, i) in enumerate(scores, 1)}
    return out


def search(spark, rows, k=5):
    df = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id long, embedding array<float>, cell int, score double")
    return {tuple(r) for r in cs.top_k(df, F.col("vec_id") % 20 == 0, k).collect()}


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_equals_brute_force(spark, monkeypatch, spread):
    monkeypatch.setattr(cs, "BLOCK_ROWS", 60)
    rng = np.random.default_rng(3)
    middle = rng.normal(0, 1, (6, 12))
    rows = [(i, (middle[i % 6] + rng.normal(0, spread, 12)).tolist()) for i in range(700)]
    assert search(spark, rows) == brute(rows, 5)


def test_trees_prune_and_stay_exact():
    rng = np.random.default_rng(1)
    middle = rng.normal(0, 40, (30, 8))
    points = np.floor(middle[rng.integers(0, 30, 3000)] + rng.normal(0, 1, (3000, 8)))
    queries, ids = points[:200], np.arange(3000)
    best = cs.dual_search(queries, ids[:200], np.full(200, -np.inf), points, ids, 7, leaf=32)
    for q in range(200):
        scores = points @ queries[q]
        scores[q] = -np.inf
        top = np.lexsort((ids, -scores))[:7]
        assert best.id[q].tolist() == top.tolist() and best.score[q].tolist() == scores[top].tolist()


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    one = [0.5, -0.25]
    rows = [(0, one), (1, one), (2, one), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 1.0])]
    rows += [(None, one), (20, []), (40, [1.0]), (41, one), (41, one)]
    assert search(spark, rows, 3) == brute_padded(rows, 3)
    assert search(spark, []) == set()
    assert search(spark, [(0, None)]) == set()


def brute_padded(rows, k):
    width = max(len(v) for _, v in rows if v is not None)
    return brute([(i, None if v is None else [*v, *[0.0] * (width - len(v))]) for i, v in rows], k)
