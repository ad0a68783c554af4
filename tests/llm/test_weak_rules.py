import random
import re
from collections import Counter

from helpers import awkward, docs, text, words

from ledgerline.llm import common
from ledgerline.llm import weak_rules as wr


def plain_counts(body):
    ws = re.findall(common.WORD, body or "")
    lines = [x for x in (body or "").split("\n") if re.search(common.WORD, x)]
    windows = Counter(tuple(ws[i : i + 3]) for i in range(len(ws) - 2))
    inside = {p for i in range(len(ws) - 2) if windows[tuple(ws[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    return (
        len(ws),
        sum(map(len, ws)),
        len(re.findall(wr.SYMBOLS, body or "")),
        len(lines) - len(set(lines)),
        len(inside),
    )


def test_counts_against_plain_python(spark):
    rng = random.Random(5)
    bodies = [None, "", " \n\t", "a", "a a a a", "a b c a b c d a b c", "x\ny\nx\n\nx \né\x0b#|é z"]
    bodies += [" ".join(rng.choice("ab c\n#".split(" ")) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    got = {r["doc_id"]: r for r in wr.text_counts(docs(spark, list(enumerate(bodies)))).collect()}
    for i, body in enumerate(bodies):
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == plain_counts(body), body


def verdicts(spark, df):
    return {r["doc_id"]: r for r in wr.judge(common.stored(wr.text_counts(df), "counts")).collect()}


def test_junk_goes_and_clean_texts_stay(spark):
    def symbols(seed):
        return " ".join(w + "***" for w in words(seed, 120))

    def shouts(seed):
        return " ".join(w.upper() + "!!" for w in words(seed, 120))

    rows = [(i, text(i, 100 + i).replace(" ", "\n", 4)) for i in range(200)]
    rows += [(1000 + i, symbols(i)) for i in range(15)] + [(2000 + i, shouts(i)) for i in range(15)]
    out = verdicts(spark, docs(spark, rows))
    assert all(out[i]["kept"] == (i < 1000) for i, _ in rows)


def test_awkward_rows(spark):
    out = verdicts(spark, awkward(spark))
    assert all(out[i]["base_failed"] and not out[i]["kept"] for i in (3, 4, 5, 6, 7))
    assert out[1]["kept"] and out[8]["kept"] and out[None]["kept"]
    assert verdicts(spark, awkward(spark).limit(0)) == {}
