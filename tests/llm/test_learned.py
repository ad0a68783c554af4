"""Classifier, language identification and masked scores: held-out accuracy, gradients, awkward rows."""

import math
import os

import numpy as np
import pytest
from helpers import awkward, docs, text, words
from pyspark.sql import functions as F

from ledgerline.llm import language, pseudo_likelihood, quality_model
from ledgerline.llm.queries import QUERIES, remainder

FOLDER = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@needs_tables
def test_quality_on_held_out_documents(spark):
    out = QUERIES["op1_quality_classifier"](spark, FOLDER)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "quality")
    rows = out.where("held_out").join(labels, "doc_id").collect()
    good = [r["score"] for r in rows if r["quality"] == 1]
    bad = [r["score"] for r in rows if r["quality"] == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert out.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert out.where("score < 0 or score > 1 or predicted <> int(score >= 0.3)").count() == 0


def test_classifier_on_awkward_rows(spark):
    rows = awkward(spark)
    labels = spark.createDataFrame([(1, 1, "x"), (1, 0, "x"), (9, 0, "y"), (None, 1, "z"), (2, None, "z"), (3, 1, "z")], "doc_id long, quality int, text string")
    weights = quality_model.fit(rows, labels, F.lit(True))
    out = rows.select("doc_id", quality_model.scorer(weights)("text").alias("p")).collect()
    p = {r["doc_id"]: r["p"] for r in out}
    assert len(out) == 11 and p[1] > p[9] and p[3] == p[4] == p[5] and p[1] == p[2] == p[None]
    none = quality_model.fit(rows, labels.limit(0), F.lit(True))
    assert {r["p"] for r in rows.select(quality_model.scorer(none)("text").alias("p")).collect()} == {0.5}
    assert rows.limit(0).select(quality_model.scorer(weights)("text")).count() == 0


def test_logistic_steps_follow_the_plain_formula():
    model = quality_model.FollowTheLeader()
    rng = np.random.default_rng(0)
    z, n = np.zeros(4), np.zeros(4)
    a, b, l1, l2 = quality_model.ALPHA, quality_model.BETA, quality_model.L1, quality_model.L2
    for _ in range(50):
        x, y = rng.normal(size=3), float(rng.integers(0, 2))
        model.learn(np.arange(3), x, y)
        full = np.append(x, 1.0)
        w = [0.0 if abs(z[i]) <= l1 else -(z[i] - np.sign(z[i]) * l1) / ((b + n[i] ** 0.5) / a + l2) for i in range(4)]
        g = (1 / (1 + np.exp(-full @ w)) - y) * full
        for i in range(4):
            z[i] += g[i] - ((n[i] + g[i] ** 2) ** 0.5 - n[i] ** 0.5) / a * w[i]
            n[i] += g[i] ** 2
    at = [0, 1, 2, quality_model.SLOTS]
    assert np.allclose(model.z[at], z) and np.allclose(model.n[at], n)


@needs_tables
def test_language_of_held_out_documents(spark):
    out = QUERIES["op4_language_id"](spark, FOLDER)
    known = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    rows = out.where("held_out").join(known, "doc_id").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.97
    assert np.mean([r["rejected"] for r in rows]) < 0.03
    assert out.where("score < 0 or score > 1 or lang_pred is null").count() == 0


def test_language_on_awkward_rows(spark):
    rows = awkward(spark)
    more = docs(spark, [(100 + i, " ".join(f"qux{j % 7}qo" for j in range(i, i + 30)), "xx", "s") for i in range(30)])
    model = language.learn(rows.unionByName(more), remainder(F.col("doc_id"), 4) != 99)
    predict = language.predictor(model)

    def run(df):
        return {r["doc_id"]: r["p"] for r in df.select("doc_id", predict("text").alias("p")).collect()}

    p = run(rows.unionByName(docs(spark, [(50, "12 34 #"), (51, "qux3qo"), (52, "ΣΣΣ ЖЖЖ")])))
    for i in (3, 4, 5, 50):
        assert tuple(p[i]) == ("und", 0.0, True)
    assert p[1]["lang_pred"] == "en" and p[51]["lang_pred"] == "xx" and p[52]["lang_pred"] in ("en", "xx")
    assert p[1] == p[2] == p[None] and not p[1]["rejected"] and not p[6]["rejected"]
    nothing = language.predictor(language.learn(rows.limit(0), F.lit(True)))
    assert {r["p"]["lang_pred"] for r in rows.select(nothing("text").alias("p")).collect()} == {"und"}
    assert run(rows.limit(0)) == {}


def test_far_texts_are_rejected(spark):
    own = docs(spark, [(i, text(i, 60), "en", "s") for i in range(120)])
    model = language.learn(own, F.lit(True))
    got = model.predict([text("new", 60), "ж" * 300 + " " + "щы " * 100])
    assert got["rejected"].tolist() == [False, True]


def test_far_texts_are_rejected_at_every_length(spark):
    own = docs(spark, [(i, text(i, 60), "en", "s") for i in range(300)])
    model = language.learn(own, F.lit(True))
    for n in (3, 8, 60, 10_000):
        far = " ".join(w.translate(str.maketrans("aeiouknlmprstvz", "аеиоуклнмпрствз")) for w in words(n, n))
        assert model.predict([text(("near", n), n), far])["rejected"].tolist() == [False, True], n


def test_floors_use_all_rows_and_the_nearest_band():
    n = np.zeros(language.BANDS)
    n[[4, 9]] = 100, 5
    floors = language.floors_of(n, n * 0.5, n * 0.26)
    assert floors[4] == pytest.approx(max(0, 0.5 - 6 * 0.1)) and (language.floors_of(n * 0, n, n) == 0).all()
    floors = language.floors_of(n, n * 0.5, n * 0.2501)
    assert floors[4] == pytest.approx(0.44) and floors[8] == floors[20] * 8 == pytest.approx(0.22)
    assert floors[2] == pytest.approx(0.22)
    few = language.floors_of(n / 10, n * 0.05, n * 0.02501)
    assert few[4] == pytest.approx(0.44)


def test_language_is_the_nearest_centroids(spark):
    """Against cosines worked out word by word, in plain Python."""
    rows = [(i, text(i, 5 + i), "en") for i in range(40)]
    rows += [(100 + i, " ".join(f"qu{'xyz'[(i + j) % 3]}o" for j in range(6 + i)), "xx") for i in range(40)]
    model = language.learn(docs(spark, [(*r, "s") for r in rows]), F.lit(True))
    for body in [rows[3][1], rows[50][1], "quxo kalo", "mixed quyo " + text("m", 4)]:
        counts = language.gram_counts(body)
        vector = [math.log1p(c) * float(w) for c, w in zip(counts.tolist(), model.idf.tolist())]
        norm = math.sqrt(sum(v * v for v in vector))
        cosines = [sum(v * float(c) for v, c in zip(vector, centre)) / norm for centre in model.centres.tolist()]
        got = model.predict([body]).iloc[0]
        assert got["lang_pred"] == model.names[max(range(len(cosines)), key=lambda i: cosines[i])]
        assert got["score"] == pytest.approx(max(cosines), abs=1e-4)


def test_gradients_of_the_window_network():
    rng = np.random.default_rng(2)
    net = pseudo_likelihood.WindowNetwork()
    net.p = [p.astype(float) for p in net.p]
    context = rng.integers(0, pseudo_likelihood.CLASSES, (40, 4))
    counts = rng.integers(0, 5, (40, pseudo_likelihood.CLASSES)).astype(float)
    _, grads = net.gradients(context, counts)
    for p, g in zip(net.p, grads):
        at = tuple(rng.integers(0, s) for s in p.shape)
        old = p[at]
        p[at] = old + 1e-4
        up = net.gradients(context, counts)[0]
        p[at] = old - 1e-4
        down = net.gradients(context, counts)[0]
        p[at] = old
        assert abs((up - down) / 2e-4 - g[at]) < 1e-5


def test_masked_scores_word_by_word(spark):
    rows = awkward(spark)
    model = pseudo_likelihood.learn(rows)
    other = pseudo_likelihood.learn(rows.repartition(5))
    assert np.array_equal(model.logp, other.logp) and np.array_equal(model.classes.within, other.classes.within)
    assert np.allclose(np.exp(model.logp).sum(axis=1), 1, atol=1e-4)
    assert np.allclose(np.bincount(model.classes.of, np.exp(model.classes.within.astype(float)))[1:].max(), 1, atol=1e-2)
    out = {r["doc_id"]: r for r in pseudo_likelihood.scored(rows, model).collect()}
    slots, _ = pseudo_likelihood.tokens([text("same", 80)])
    c = [0, 0, *model.classes.of[slots], 0, 0]
    total = 0.0
    for i, slot in enumerate(slots):
        code = ((c[i] * 16 + c[i + 1]) * 16 + c[i + 3]) * 16 + c[i + 4]
        total += float(model.logp[code, c[i + 2]]) + float(model.classes.within[slot])
    assert abs(out[1]["log_prob"] - total) < 1e-6 * abs(total) and out[1]["n_words"] == 80
    assert out[1]["log_prob"] == out[2]["log_prob"] == out[None]["log_prob"]
    assert out[3]["log_prob"] == 0 and out[3]["mean_log_prob"] is None and out[8]["n_words"] == 30_000
    empty = rows.limit(0)
    assert pseudo_likelihood.scored(empty, pseudo_likelihood.learn(empty)).count() == 0


def test_frequent_words_score_higher(spark):
    rows = docs(spark, [(i, text(i % 3, 200)) for i in range(30)])
    model = pseudo_likelihood.learn(rows)
    _, score = model.score([text(1, 200), " ".join(f"unseen{i}" for i in range(200))])
    assert score[0] > score[1]
