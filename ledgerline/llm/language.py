"""Language identification by nearest centroid.

A text becomes a vector of hashed character n-grams (1 to 3 letters, words bounded), log(1 + count) times inverse document frequency,
scaled to length 1. Document frequencies come from all learning documents. Per language, spherical k-means
over a bounded sample (``FIT_ROWS`` expected per language, chosen by hash of the id) gives several centroids; a text gets the
language of the centroid with the highest cosine, its score. It is rejected if it has no letter, or if it is further
from that centroid than the language's own texts of its length are: cosine below mean minus ``SPREAD`` deviations, both
taken over all learning rows by language and band of length. A band with fewer than ``BAND_ROWS`` rows takes the floor of
the nearest one that has them, times the square root of the lengths' ratio if it is shorter (cosines of short texts fall like
that), over its fourth root if it is longer (many more n-grams occur in long texts).

Null texts and texts without a letter are ``und`` with score 0, and rejected. Rows with a null language or null id
teach nothing. Repeated rows get equal results; ties go to the language first in order. If there is nothing to
learn from, all texts are ``und``. An empty table gives no rows. Other columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import bound_batches
from ledgerline.llm.quality_model import hash_share

SLOTS = 4096
#: Expected learning rows per language for the centroids; document frequencies use all rows.
FIT_ROWS = 2000
CENTROIDS = 3
BANDS = 24
SPREAD = 6.0
BAND_ROWS = 20
CHUNK = 256


TABLES: dict[str, np.ndarray] = {}


def letter_table() -> np.ndarray:
    """Whether a code point is a letter; made once in a process."""
    if "letters" not in TABLES:
        TABLES["letters"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return TABLES["letters"]


def gram_counts(text) -> np.ndarray | None:
    """Counts of hashed n-grams; None without a letter."""
    if not text:
        return None
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    is_letter = letter_table()[points]
    if not is_letter.any():
        return None
    c = np.where(is_letter, points, np.uint32(0))
    # one blank between words, and one at either end
    keep = is_letter | np.append(True, is_letter[:-1])
    c = np.concatenate([np.zeros(1, np.uint32), c[keep], np.zeros(1, np.uint32)])
    one = c
    two = c[:-1] * np.uint32(0x01000193) + c[1:] + np.uint32(0x9E3779B9)
    three = two[:-1] * np.uint32(0x01000193) + c[2:] + np.uint32(0x85EBCA6B)
    grams = np.concatenate([one[one > 0], two, three]) * np.uint32(2654435761)
    return np.bincount(grams >> np.uint32(20), minlength=SLOTS)


def gram_matrix(texts, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors (zero rows without a letter) and the number of grams of each text."""
    out = np.zeros((len(texts), SLOTS), dtype=np.float32)
    size = np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        counts = gram_counts(text)
        if counts is not None:
            size[i] = counts.sum()
            out[i] = np.log1p(counts) * idf
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    np.divide(out, norm, out=out, where=norm > 0)
    return out, size


def band(size: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(size, 1)).astype(int), BANDS - 1)


def centroids_of(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means, started from the points farthest apart."""
    chosen = [x.mean(axis=0)]
    chosen[0] /= max(np.linalg.norm(chosen[0]), 1e-9)
    near = x @ chosen[0]
    while len(chosen) < min(k, len(x)):
        chosen.append(x[int(near.argmin())])
        near = np.maximum(near, x @ chosen[-1])
    centres = np.array(chosen)
    for _ in range(8):
        own = (x @ centres.T).argmax(axis=1)
        for c in range(len(centres)):
            if (own == c).any():
                mean = x[own == c].mean(axis=0)
                centres[c] = mean / max(np.linalg.norm(mean), 1e-9)
    return centres


class Languages:
    """The learned model: names and centroids side by side, floors by language and length."""

    def __init__(self, idf, names, centres, floors):
        self.idf, self.names, self.centres, self.floors = idf, names, centres, floors

    def predict(self, texts) -> pd.DataFrame:
        names = np.array([*self.names, "und"], dtype=object)
        out = {"lang_pred": [], "score": [], "rejected": []}
        for at in range(0, len(texts), CHUNK):
            x, size = gram_matrix(texts[at : at + CHUNK], self.idf)
            if len(self.names):
                cosines = x @ self.centres.T
                best = cosines.argmax(axis=1)
                score = np.clip(cosines[np.arange(len(x)), best], 0, 1).astype(float)
            else:
                best, score = np.zeros(len(x), dtype=int), np.zeros(len(x))
                size = np.zeros(len(x), dtype=np.int64)
            known = size > 0
            floor = self.floors[best, band(size)] if len(self.names) else np.zeros(len(x))
            out["lang_pred"].append(np.where(known, names[best], "und"))
            out["score"].append(np.where(known, score, 0.0))
            out["rejected"].append(~known | (score < floor))
        return pd.DataFrame({k: np.concatenate(v) if v else [] for k, v in out.items()})


def learn(docs: DataFrame, learnable: Column, doc_id="doc_id", text="text", lang="lang", store=None) -> Languages:
    """Fits on rows that satisfy ``learnable`` (a condition over ``doc_id``) and have a language."""
    bound_batches(docs.sparkSession)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")
    ).where(learnable & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, n = np.zeros(SLOTS, dtype=np.int64), 0
        for batch in batches:
            for value in batch["text"]:
                counts = gram_counts(value)
                if counts is not None:
                    df += counts > 0
                    n += 1
        yield pd.DataFrame({"slot": np.append(np.arange(SLOTS), -1), "df": np.append(df, n)})

    seen = rows.select("text").mapInPandas(frequencies, "slot int, df long")
    seen = seen.groupBy("slot").agg(F.sum("df").alias("df")).toPandas().set_index("slot")["df"]
    idf = (np.log((1 + seen.get(-1, 0)) / (1 + seen.reindex(range(SLOTS), fill_value=0).to_numpy())) + 1).astype(np.float32)

    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).toPandas()
    share = [F.when(F.col("lang") == r.lang, hash_share(F.col("doc_id"), FIT_ROWS / r.n)) for r in sizes.itertuples()]
    if not share:
        return Languages(idf, [], np.zeros((0, SLOTS), np.float32), np.zeros((0, BANDS)))
    sample = rows.where(F.coalesce(*share))

    def cluster(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("doc_id", kind="stable")
        x, size = gram_matrix(group["text"].tolist(), idf)
        x, size = x[size > 0], size[size > 0]
        if not len(x):
            return pd.DataFrame({"lang": [], "centre": []})
        centres = centroids_of(x, CENTROIDS)
        return pd.DataFrame({"lang": [group["lang"].iloc[0]] * len(centres), "centre": list(centres)})

    found = sample.groupBy("lang").applyInPandas(cluster, "lang string, centre array<float>").toPandas()
    found = found.sort_values("lang", kind="stable")
    names = found["lang"].tolist()
    centres = np.array(found["centre"].tolist(), dtype=np.float32).reshape(-1, SLOTS)
    floors = learned_floors(rows, names, centres, idf)
    return Languages(idf, names, centres, np.array([floors[n] for n in names], dtype=float).reshape(-1, BANDS))


def learned_floors(rows: DataFrame, names: list[str], centres: np.ndarray, idf: np.ndarray) -> dict[str, np.ndarray]:
    """Floors of each language by band, from one pass over all learning rows; tasks send sums only."""
    own = {name: centres[[i for i, n in enumerate(names) if n == name]] for name in names}

    def cosines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = {name: np.zeros((3, BANDS)) for name in own}
        for batch in batches:
            for name, group in batch.groupby("lang"):
                for at in range(0, len(group) if name in own else 0, CHUNK):
                    x, size = gram_matrix(group["text"].tolist()[at : at + CHUNK], idf)
                    x, size = x[size > 0], size[size > 0]
                    cosine = (x @ own[name].T).max(axis=1).astype(float) if len(x) else np.empty(0)
                    for i in range(3):
                        sums[name][i] += np.bincount(band(size), weights=cosine**i, minlength=BANDS)
        for name, (n, total, squares) in sums.items():
            yield pd.DataFrame({"lang": name, "band": np.arange(BANDS), "n": n, "total": total, "squares": squares})

    schema = "lang string, band int, n double, total double, squares double"
    found = rows.select("text", "lang").mapInPandas(cosines, schema).groupBy("lang", "band")
    # one row per language and band
    found = found.agg(*[F.sum(c).alias(c) for c in ("n", "total", "squares")]).toPandas()
    out = {name: np.zeros(BANDS) for name in own}
    for name, group in found.groupby("lang"):
        table = np.zeros((3, BANDS))
        table[:, group["band"].to_numpy()] = group[["n", "total", "squares"]].to_numpy().T
        out[name] = floors_of(*table)
    return out


def floors_of(n: np.ndarray, total: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """Floor of every band from counts, sums and sums of squares of the cosines in it."""
    bands = np.flatnonzero(n >= BAND_ROWS)
    if not len(bands):  # all rows together, at the mean of their bands
        if not n.sum():
            return np.zeros(BANDS)
        bands = np.array([int(round((n * np.arange(BANDS)).sum() / n.sum()))])
        n, total, squares = (np.full(BANDS, v.sum()) for v in (n, total, squares))
    mean = total[bands] / n[bands]
    deviation = np.sqrt(np.maximum(squares[bands] / n[bands] - mean**2, 0))
    floors = np.maximum(mean - SPREAD * deviation, 0)
    nearest = np.abs(np.arange(BANDS)[:, None] - bands).argmin(axis=1)
    away = np.arange(BANDS) - bands[nearest]
    return floors[nearest] * 2.0 ** np.where(away < 0, away / 2, -away / 4)


def predictor(model: Languages):
    """A column function: text -> struct of lang_pred, score, rejected."""

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield model.predict(texts.tolist())

    return predict
