"""The masked model predicts words from words: a distribution over slots, gradients, what context tells, awkward rows."""

import random

import numpy as np
import pytest
from helpers import awkward, docs, text

from ledgerline.llm import masked_words as mw


def small():
    rng = np.random.default_rng(3)
    counts = np.zeros(40)
    counts[rng.choice(40, 25, replace=False)] = rng.integers(1, 30, 25)
    net = mw.WordNetwork(mw.Vocabulary(counts))
    net.p = [rng.normal(0, 0.5, p.shape) for p in net.p]
    return counts, net, rng


def test_probabilities_of_all_slots_sum_to_one():
    counts, net, rng = small()
    context = rng.integers(0, net.words.size, (1, 4))
    every = net.words.of
    logp = net.log_prob(np.repeat(context, len(counts), axis=0), every)
    assert np.exp(logp).sum() == pytest.approx(1, abs=1e-9)
    # frequent words have short ways
    lengths = net.words.length[every]
    assert lengths[counts.argmax()] <= lengths[counts > 0].min() and (np.diff(net.words.first[1:]) > 0).all()


def test_gradients_of_the_word_network():
    _, net, rng = small()
    context, target = rng.integers(0, net.words.size, (30, 4)), rng.integers(1, net.words.size, 30)
    _, grads = net.gradients(context, target)
    for p, (used, sums) in zip(net.p, grads):
        g = np.zeros_like(p)
        g[used] = sums
        for _ in range(5):
            at = tuple(rng.integers(0, s) for s in p.shape)
            old = p[at]
            p[at] = old + 1e-5
            up = net.gradients(context, target)[0]
            p[at] = old - 1e-5
            down = net.gradients(context, target)[0]
            p[at] = old
            assert abs((up - down) / 2e-5 - g[at]) < 1e-4


def test_a_word_is_told_from_the_words_around_it(spark):
    # x and y are equally frequent and so alike to a model of frequency classes; only the words beside them tell which it is
    rng = random.Random(4)
    pairs = [("ax", "x", "bx"), ("ay", "y", "by")]
    rows = [(i, " ".join(w for _ in range(60) for w in rng.choice(pairs))) for i in range(300)]
    model = mw.learn(docs(spark, rows))
    n, fits = model.score(["ax x bx", "ay y by"])
    _, wrong = model.score(["ax y bx", "ay x by"])
    assert n.tolist() == [3, 3] and (fits > wrong + 2).all()


def test_scores_of_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(mw, "SHARD_WORDS", 4_000)
    rows = awkward(spark)
    model, other = mw.learn(rows), mw.learn(rows.repartition(5))
    assert all(np.array_equal(a, b) for a, b in zip(model.network.p, other.network.p))
    out = {r["doc_id"]: r for r in mw.scored(rows, model).collect()}
    assert out[1]["log_prob"] == pytest.approx(out[2]["log_prob"]) and out[1]["n_words"] == 80
    assert out[3]["log_prob"] == 0 and out[3]["mean_log_prob"] is None and out[8]["n_words"] == 30_000
    context, target, _ = mw.windows([text("same", 80)], model.network.words)
    one_by_one = sum(float(model.network.log_prob(context[i : i + 1], target[i : i + 1])[0]) for i in range(80))
    assert out[1]["log_prob"] == pytest.approx(one_by_one, rel=1e-5)
    empty = rows.limit(0)
    assert mw.scored(empty, mw.learn(empty)).count() == 0


def test_learned_texts_score_higher_than_unseen_words(spark):
    rows = docs(spark, [(i, text(i % 3, 200)) for i in range(30)])
    _, score = mw.learn(rows).score([text(1, 200), " ".join(f"unseen{i}" for i in range(200))])
    assert score[0] > score[1]
