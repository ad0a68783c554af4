import random
import re

import pytest
from helpers import awkward, docs, words

from ledgerline.llm import common
from ledgerline.llm import near_dup as nd
from ledgerline.llm.components import components
from ledgerline.session import use_checkpoint_dir


def shingles(body, k):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), body or "")
    ws = re.findall(common.WORD, low)
    return {tuple(ws[i : i + k]) for i in range(max(1, len(ws) - k + 1))} if ws else set()


def brute(rows, k=4):
    sets = {i: shingles(b, k) for i, b in rows if i is not None}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            i, u = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if u and 100 * i >= 80 * u:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def found(spark, rows, k=4):
    out = nd.near_duplicates(docs(spark, rows), k).collect()
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out}
    assert len(got) == len(out)
    return got


def changed(rng, base, edits):
    out = list(base)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"new{rng.random()}"
    return " ".join(out)


@pytest.mark.parametrize("list_rows", [1024, 16])
def test_equals_brute_force(spark, monkeypatch, list_rows):
    """Groups around the threshold, a large family, and a passage that most documents share."""
    monkeypatch.setattr(nd, "LIST_ROWS", list_rows)
    rng = random.Random(9)
    bases = [words(i, rng.choice([5, 9, 40, 150, 300])) for i in range(25)]
    passage = words("passage", 60)
    rows = [(i, changed(rng, bases[i % 25], rng.choice([0, 0, 1, 2, 4, 8]))) for i in range(200)]
    family = words("family", 120)
    rows += [(300 + i, changed(rng, family, rng.randrange(2, 9))) for i in range(120)]
    rows += [(500 + i, " ".join(words(("p", i), rng.choice([20, 60, 120])) + passage)) for i in range(60)]
    rng.shuffle(rows)
    assert found(spark, rows) == brute(rows)


def test_awkward_rows(spark):
    rows = [(r["doc_id"], r["text"]) for r in awkward(spark).collect()]
    got = found(spark, rows)
    assert got == brute([r for r in rows])
    assert got[2][1] == 1 and got[7][1] == 6 and got[3] == (0, 3) and got[4] == (0, 4)
    assert found(spark, []) == {}


def test_repeated_id_with_two_texts(spark):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (2, "z"), (3, "z")]
    assert found(spark, rows) == {1: (3, 1), 2: (3, 1), 3: (1, 3)}


def test_components_of_a_long_path_and_a_star(spark):
    use_checkpoint_dir(spark)
    links = [(i, i + 1) for i in range(50)] + [(100, 200 + i) for i in range(50)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{200 + i: 100 for i in range(50)}, 100: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_stage_keeps_columns_of_any_name_and_type(spark):
    import corpus_pipeline
    from pyspark.sql import functions as F

    rows = awkward(spark)
    extra = {c: F.lit(1) for c in ("gone", "again", "id", "rows", "component_id")}
    docs = rows.withColumns({**extra, "tags": F.create_map(F.lit("a"), F.col("doc_id"))})
    kept = corpus_pipeline.near_dup_stage(spark, docs, "")
    assert kept.columns == docs.columns
    found = sorted((r.doc_id is not None, r.doc_id or 0) for r in kept.collect())
    plain = corpus_pipeline.near_dup_stage(spark, rows, "").collect()
    assert found == sorted((r.doc_id is not None, r.doc_id or 0) for r in plain)
    assert (True, 1) in found and (True, 2) not in found and (False, 0) in found
