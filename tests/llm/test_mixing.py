import math
from collections import Counter, defaultdict

import pytest
from helpers import awkward, docs, text
from pyspark.sql import functions as F

from ledgerline.llm import common, mixing


def mixed(df, **kw):
    return mixing.mixed_rows(df, common.n_words(F.col("text")), **kw)


@pytest.fixture(scope="module")
def corpus(spark):
    return docs(spark, [(i, text(i, 20 + i % 7), "en", "big" if i % 10 < 7 else f"s{i % 10}") for i in range(200)])


def test_repeat_limit_is_met_and_nothing_lost(corpus):
    rows = mixed(corpus, max_repeats=2.0).select("doc_id", "source", "epoch", "n_tokens").collect()
    assert {r["doc_id"] for r in rows} == set(range(200))
    uses, tokens, size = Counter(r["doc_id"] for r in rows), Counter(), Counter()
    for r in rows:
        tokens[r["source"]] += r["n_tokens"]
        size[r["source"]] += r["n_tokens"] if r["epoch"] == 0 else 0
    assert max(uses.values()) <= 2
    assert tokens["big"] == size["big"]
    smallest = min(size, key=size.get)
    assert 2 - 30 / size[smallest] <= tokens[smallest] / size[smallest] <= 2


def test_entropy_and_budget(corpus):
    totals = mixing.source_totals(corpus.select("source", common.n_words(F.col("text")).alias("n_tokens")))
    a = mixing.find_exponent(totals, target_entropy=1.2)
    n = [r["tokens"] for r in totals.collect()]

    def entropy(a):
        z = sum(x**a for x in n)
        return -sum(x**a / z * math.log(x**a / z) for x in n)

    assert entropy(a) >= 1.2 > entropy(a + 1e-6)
    rows = mixed(corpus, target_entropy=1.2, budget_tokens=1000).select("source", "n_tokens", "block", "order_key").collect()
    used = defaultdict(int)
    for r in rows:
        used[r["source"]] += r["n_tokens"]
    z = sum(x**a for x in n)
    for r in totals.collect():
        share = 1000 * r["tokens"] ** a / z
        assert share - 30 <= used[r["source"]] <= share
    # what is taken of a source is a prefix of its permutation
    for s in used:
        taken = sorted((r["block"], r["order_key"]) for r in rows if r["source"] == s)
        assert taken[0][0] == 0 and len({b for b, _ in taken}) == taken[-1][0] + 1


def test_awkward_rows(spark):
    df = awkward(spark)
    out = mixed(df).select("row.*")
    assert out.columns == df.columns
    assert Counter(r["doc_id"] for r in out.collect())[2] >= 2
    assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in df.collect()}
    assert mixed(df.limit(0)).count() == 0
    only_empty = mixed(df.where("text = ''"))
    assert [r["doc_id"] for r in only_empty.collect()] == [4]
