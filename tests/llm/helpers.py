"""Small tables with every awkward row: nulls, empty and long texts, ties, repeats, clashing extra columns."""

import random

WORDS = [a + b for a in ("ka", "lo", "mi", "nu", "pe", "ra", "so", "ti", "vu", "ze") for b in ("n", "r", "st", "l", "m", "")]
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, kept int, v string, row int, n long"


def words(seed, n):
    rng = random.Random(str(seed))
    return [rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n)]


def text(seed, n):
    return " ".join(words(seed, n))


def docs(spark, rows):
    """(doc_id, text[, lang, source]) rows with extra columns whose names the operators use inside."""
    full = []
    for row in rows:
        doc_id, body, lang, source = (*row, *["en", "s1"][len(row) - 2 :])[:4] if len(row) < 4 else row
        full.append((doc_id, body, lang, source, len(body or ""), 0.5, 7, "x", 1, 2))
    return spark.createDataFrame(full, DOCS)


def awkward(spark):
    same = text("same", 80)
    return docs(
        spark,
        [
            (1, same),
            (2, same),
            (2, same),
            (3, None),
            (4, ""),
            (5, " \t\n"),
            (None, same),
            (6, "one two"),
            (7, "ONE  Two"),
            (8, text("long", 30_000)),
            (9, text("other", 120), None, None),
        ],
    )
