"""Exact top-k inner products by dual-tree search over cover trees.

A few hundred centres (farthest-point choice from a bounded sample) are the upper level of the index: each
vector belongs to the cell of its nearest centre, and a cell's covering radius is the largest distance in
it. Below, a cell is cut into blocks of bounded size, dealt by hash, so a cell with a third of all rows is
many blocks. Queries are indexed by the same cells.

1. Home pass: each group of queries meets the blocks of its own cell. This gives every query a kth score.
2. Away pass: a query meets the blocks of another cell only if
   ``<q, c> + |q| * radius`` reaches its kth score; ``c`` is the cell's centre.

In a task that holds one group of queries and one block, both get a cover tree, and node pairs are pruned
by ``<cq, cd> + |cq| rd + |cd| rq + rq rd`` against the worst kth score in the query node. Scores are integers held in
doubles (exact below 2**53). The result does not depend on the choice of centres.

Vectors that are null or hold a null or non-finite component take no part; vectors of different length are
compared as if padded with zeros. A row is never its own query's candidate, by id. Repeated rows with one id
stay separate candidates; as queries they count once. Ties go to the smaller id. Null ids take no part.
An empty table gives no rows. Other columns are ignored.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bounds of the upper level, whatever the table's size.
SAMPLE_ROWS = 2048
MAX_CELLS = 256
BLOCK_ROWS = 4096
QUERY_ROWS = 1024
LEAF = 128

FOUND = "query_id long, vec_id long, score long"


def quantised(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) per component, x as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("double"))


def usable(vector: Column) -> Column:
    """False for null, and for vectors with a null or non-finite component."""

    def bad(x):
        return x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))

    return vector.isNotNull() & ~F.exists(vector, bad)


def matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def choose_centres(points: np.ndarray, count: int) -> np.ndarray:
    """Farthest-point choice: the points that cover the sample with the smallest radius, greedily."""
    chosen = [0]
    near = np.linalg.norm(points - points[0], axis=1)
    while len(chosen) < count and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, np.linalg.norm(points - points[chosen[-1]], axis=1))
    return points[chosen]


@dataclass
class Node:
    rows: np.ndarray
    centre: np.ndarray
    norm: float
    radius: float
    children: list


def cover_tree(points: np.ndarray, rows: np.ndarray, leaf: int = LEAF) -> Node:
    """Each level halves the covering radius with greedily chosen centres; small or tight nodes are leaves."""
    centre = points[rows[0]]
    away = np.linalg.norm(points[rows] - centre, axis=1)
    node = Node(rows, centre, float(np.linalg.norm(centre)), float(away.max()), [])
    if len(rows) <= leaf or node.radius == 0:
        return node
    owner, near = np.zeros(len(rows), dtype=int), away
    centres = 1
    while near.max() > node.radius / 2 and centres < max(2, len(rows) // (leaf // 4)):
        far = int(near.argmax())
        d = np.linalg.norm(points[rows] - points[rows[far]], axis=1)
        closer = d < near
        owner[closer], near = centres, np.where(closer, d, near)
        centres += 1
    parts = [rows[owner == c] for c in range(centres)]
    if max(map(len, parts)) < len(rows):
        node.children = [cover_tree(points, part, leaf) for part in parts if len(part)]
    return node


class Best:
    """The k best (score, id) of each query so far; ties to the smaller id."""

    def __init__(self, k: int, floors: np.ndarray):
        self.k = k
        self.floor = floors.copy()  # scores below are out
        self.score = [np.empty(0) for _ in floors]
        self.id = [np.empty(0, dtype=np.int64) for _ in floors]

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        s = np.concatenate([self.score[query], scores])
        i = np.concatenate([self.id[query], ids])
        top = np.lexsort((i, -s))[: self.k]
        self.score[query], self.id[query] = s[top], i[top]
        if len(top) == self.k:
            self.floor[query] = max(self.floor[query], s[top[-1]])


def dual_search(queries, query_ids, floors, points, ids, k, leaf: int = LEAF) -> Best:
    """Top k of ``points`` for each query among scores of at least its floor."""
    best = Best(k, floors)
    stack = [(cover_tree(queries, np.arange(len(queries)), leaf), cover_tree(points, np.arange(len(points)), leaf))]
    while stack:
        q, d = stack.pop()
        middle = float(q.centre @ d.centre)
        bound = middle + q.norm * d.radius + d.norm * q.radius + q.radius * d.radius
        if bound < best.floor[q.rows].min() - 1e-6 * max(1.0, abs(bound)):
            continue
        if q.children and (not d.children or q.radius >= d.radius):
            stack.extend((child, d) for child in q.children)
        elif d.children:
            stack.extend((q, child) for child in sorted(d.children, key=lambda n: float(q.centre @ n.centre)))
        else:
            scores = queries[q.rows] @ points[d.rows].T
            can = scores >= best.floor[q.rows][:, None]
            for i in np.nonzero(can.any(axis=1))[0]:
                row, at = q.rows[i], d.rows[can[i]]
                mine = ids[at] != query_ids[row]
                if mine.any():
                    best.add(row, scores[i][can[i]][mine], ids[at][mine])
    return best


def assign_cells(df: DataFrame, centres: np.ndarray) -> DataFrame:
    width = centres.shape[1]
    half = (centres**2).sum(axis=1) / 2

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                v = matrix(batch["v"], max(width, max(map(len, batch["v"]))))
                cell = (v[:, :width] @ centres.T - half).argmax(axis=1)
                whole = np.zeros_like(v)
                whole[:, :width] = centres[cell]
                batch["cell"] = cell.astype("int32")
                batch["away"] = np.linalg.norm(v - whole, axis=1)
                yield batch

    return df.mapInPandas(assign, "vec_id long, v array<double>, cell int, away double")


def search_blocks(queries: DataFrame, data: DataFrame, k: int) -> DataFrame:
    """Every (query, cell) row meets the blocks of the cell; at most k rows per query and block come out."""

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        width = max(max(map(len, left["v"])), max(map(len, right["w"])))
        query_ids = left["query_id"].to_numpy()
        best = dual_search(
            matrix(left["v"], width),
            query_ids,
            left["floor"].to_numpy(dtype=float),
            matrix(right["w"], width),
            right["vec_id"].to_numpy(),
            k,
        )
        return pd.DataFrame(
            {
                "query_id": np.repeat(query_ids, [len(s) for s in best.score]),
                "vec_id": np.concatenate(best.id),
                "score": np.concatenate(best.score).astype("int64"),
            }
        )

    # names of their own, because both sides come from the same rows
    groups = queries.select(F.col("cell").alias("c"), F.col("block").alias("b"), F.col("part").alias("p")).distinct()
    held = data.select("vec_id", F.col("v").alias("w"), F.col("cell").alias("dc"), F.col("block").alias("db"))
    met = held.join(groups, (F.col("dc") == F.col("c")) & (F.col("db") == F.col("b")))
    met = met.select("vec_id", "w", "c", "b", "p")
    return queries.groupBy("cell", "block", "part").cogroup(met.groupBy("c", "b", "p")).applyInPandas(search, FOUND)


def best_of(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(df: DataFrame, is_query: Column, k: int = 20, vec_id="vec_id", embedding="embedding", store=None) -> DataFrame:
    """query_id, rank, vec_id, score: each query row's k best other rows."""
    vector = F.col(embedding)
    rows = df.where(usable(vector) & F.col(vec_id).isNotNull()).select(
        F.col(vec_id).cast("long").alias("vec_id"), quantised(vector).alias("v"), is_query.alias("asks")
    )
    plain = rows.select("vec_id", "v")
    sample = plain.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).toPandas()
    if not len(sample):
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    total = plain.count()
    width = max(1, max(map(len, sample["v"])))
    centres = choose_centres(matrix(sample["v"], width), min(MAX_CELLS, max(1, ceil(total / (2 * BLOCK_ROWS)))))

    placed = assign_cells(plain, centres)
    placed = store(placed, "cells") if store else placed
    cells = placed.groupBy("cell").agg(F.max("away").alias("radius"), F.count(F.lit(1)).alias("n")).toPandas()
    radius = dict(zip(cells["cell"], cells["radius"]))
    blocks = {int(c): ceil(n / BLOCK_ROWS) for c, n in zip(cells["cell"], cells["n"])}
    n_blocks = F.element_at(F.create_map(*[F.lit(x) for item in blocks.items() for x in item]), F.col("cell"))
    data = placed.select(
        "vec_id", "v", "cell", F.pmod(F.xxhash64("vec_id"), n_blocks).cast("int").alias("block")
    )
    asked = rows.where("asks").select("vec_id").distinct()
    queries = placed.join(asked, "vec_id", "left_semi").dropDuplicates(["vec_id"])
    parts = max(1, ceil(total / 20 / QUERY_ROWS))
    queries = queries.select(
        F.col("vec_id").alias("query_id"), "v", "cell", F.pmod(F.xxhash64(F.lit(3), "vec_id"), F.lit(parts)).cast("int").alias("part")
    )

    def spread(q):
        """One row for each block of the row's cell."""
        last = F.element_at(F.create_map(*[F.lit(x) for c, n in blocks.items() for x in (c, n - 1)]), F.col("cell"))
        return q.withColumn("block", F.explode(F.sequence(F.lit(0), last)))

    home = search_blocks(spread(queries.withColumn("floor", F.lit(float("-inf")))), data, k)
    home = best_of(home, k)
    home = store(home, "home") if store else home
    kth = home.where(F.col("rank") == k).select("query_id", F.col("score").cast("double").alias("floor"))

    cell_ids = np.array(sorted(blocks))
    reach = np.array([radius[c] for c in cell_ids])

    def survivors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            w = max(width, max(map(len, batch["v"])))
            q = matrix(batch["v"], w)
            norm = np.linalg.norm(q, axis=1)
            bound = q[:, :width] @ centres[cell_ids].T + norm[:, None] * reach
            can = bound >= batch["floor"].to_numpy()[:, None] - 1e-6 * np.maximum(1.0, np.abs(bound))
            can &= batch["cell"].to_numpy()[:, None] != cell_ids
            at, to = np.nonzero(can)
            out = batch.iloc[at].copy()
            out["cell"] = cell_ids[to]
            yield out

    ready = queries.join(kth, "query_id", "left").withColumn(
        "floor", F.coalesce(F.col("floor"), F.lit(float("-inf")))
    )
    away = ready.select("query_id", "v", "cell", "part", "floor").mapInPandas(
        survivors, "query_id long, v array<double>, cell int, part int, floor double"
    )
    far = search_blocks(spread(away), data, k)
    every = home.select("query_id", "vec_id", "score").unionByName(far)
    return best_of(every, k).select("query_id", "rank", "vec_id", "score")
