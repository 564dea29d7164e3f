"""Exact top-k by inner product: M-trees searched best first.

Vectors are dealt to blocks around pivots (large ones divided by hash), and each block's vectors become an M-tree in pages: a node has a
centre, a covering radius, its distance to its parent's centre and the largest norm below it; a leaf has its vectors with their distances
to its centre. The pages are a table. A search walks a block's nodes by their upper bounds, the highest first, and stops at the first one
below the k-th best score so far. With d the Euclidean distance, ``2 <q, x> = |q|^2 + |x|^2 - d(q, x)^2``, so stored distances bound scores by
the triangle inequality, and most nodes and vectors are ruled out without an inner product. Bounds are rounded up, scores are integers:
the result is exact.

Queries go to the blocks in lots of a bounded number: first each to the blocks of its nearest pivot, whose k-th best score is a floor for all others, then to the
others, which most leave at the root. A block is searched for all its queries together; its k best of each are merged with the other blocks'.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casefeatures.sources.files import scratch_path, written

K, SCALE = 5, 256
#: Vectors of a block, about; pivots, at most; vectors of a leaf; children of a node; queries sent out at a time.
BLOCK, MAX_PIVOTS, LEAF, FAN, LOT = 8192, 256, 256, 16, 8192
PAGES = "block long, node int, parent int, leaf boolean, centre array<long>, radius double, to_parent double, norm double, members array<long>, rows array<long>, vectors array<long>, to_centre array<double>"


def integers(rows: DataFrame, key: str, column: str, scale: int = SCALE) -> DataFrame:
    """``id``, ``row``, ``v`` (floor of scale times each component, as long), without rows that take no part: those whose id or vector is
    null or that hold a null or non-finite component. Vectors of unequal length count as filled up with zeros."""
    x = F.col(column).cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    sound = rows.where(F.col(key).isNotNull() & F.col(column).isNotNull()).where(~bad)
    return sound.select(F.col(key).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"), F.transform(x, lambda c: F.floor(F.lit(scale) * c)).alias("v"))


def _matrix(column, dim: int) -> np.ndarray:
    out = np.zeros((len(column), dim), np.int64)
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Euclidean distances, rows of x to centres."""
    x, centres = x.astype(float), centres.astype(float)
    square = (x * x).sum(1)[:, None] + (centres * centres).sum(1)[None, :] - 2 * (x @ centres.T)
    return np.sqrt(np.maximum(square, 0))


def build(ids: np.ndarray, rows: np.ndarray, x: np.ndarray, seed: int) -> list[dict]:
    """The pages of an M-tree, parents before children. Copies that no centre parts are paged in order."""
    rng = np.random.default_rng(seed)
    pages: list[dict] = []
    open_nodes = [(np.arange(len(ids)), -1)]
    while open_nodes:
        at, parent = open_nodes.pop()
        points = x[at]
        centre = np.round(points.mean(0)).astype(np.int64)
        to_centre = np.linalg.norm((points - centre).astype(float), axis=1)
        node = len(pages)
        leaf = len(at) <= LEAF
        page = {
            "node": node, "parent": parent, "leaf": leaf, "centre": centre.tolist(), "radius": float(to_centre.max()), "norm": float(np.linalg.norm(points.astype(float), axis=1).max()),
            "to_parent": 0.0 if parent < 0 else float(np.linalg.norm((centre - np.array(pages[parent]["centre"])).astype(float))),
            "members": [], "rows": [], "vectors": [], "to_centre": [],
        }
        if leaf:
            page |= {"members": ids[at].tolist(), "rows": rows[at].tolist(), "vectors": points.ravel().tolist(), "to_centre": to_centre.tolist()}
        pages.append(page)
        if not leaf:
            seeds = np.unique(points[rng.choice(len(at), min(FAN, len(at)), replace=False)], axis=0)
            near = _distances(points, seeds).argmin(1)
            parts = [at[near == i] for i in range(len(seeds))]
            parts = [p for p in parts if len(p)]
            if len(parts) == 1:
                parts = np.array_split(at, min(FAN, -(-len(at) // LEAF)))
            open_nodes.extend((p, node) for p in parts)
    return pages


class Tree:
    """The pages of one block in memory, and its best-first search."""

    def __init__(self, pages: pd.DataFrame, dim: int) -> None:
        pages = pages.sort_values("node")
        self.centre = _matrix(pages["centre"], dim).astype(float)
        self.radius, self.norm, self.to_parent = (pages[c].to_numpy(float) for c in ("radius", "norm", "to_parent"))
        self.leaf = pages["leaf"].to_numpy(bool)
        parent = pages["parent"].to_numpy(int)
        self.children = [np.flatnonzero(parent == i) if not self.leaf[i] else None for i in range(len(pages))]
        self.entries = [
            (np.array(m, np.int64), np.array(r, np.int64), np.array(v, np.int64).reshape(len(m), dim), np.array(t, float)) if leaf else None
            for m, r, v, t, leaf in zip(pages["members"], pages["rows"], pages["vectors"], pages["to_centre"], self.leaf, strict=True)
        ]
        # Products below 2^53 are exact in floating point.
        self.plain = float(self.norm.max()) ** 2 < 2**52
        if self.plain:
            self.entries = [None if e is None else (e[0], e[1], e[2].astype(float), e[3]) for e in self.entries]
        self.squares = [None if e is None else (e[2].astype(float) ** 2).sum(1) for e in self.entries]

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, floors: np.ndarray) -> list[list[tuple[int, int, int]]]:
        """For each query the k best (score, -id, -row) but row ``own``; what is below its floor may be left out.

        All queries go through the tree together: the node with the highest bound of any of them is next, and it is opened for those whose
        floor its bound still reaches. A leaf's products for these are one matrix product.
        """
        plain = queries.astype(float)
        square = (plain**2).sum(1)
        length, slack = np.sqrt(square), 1 + 1e-9 * (square + float(self.norm.max()) ** 2)
        exact = self.plain and float(square.max(initial=0)) < 2**52
        best: list[list[tuple[int, int, int]]] = [[] for _ in queries]
        least = floors.astype(float)
        everyone = np.arange(len(queries))
        away = np.linalg.norm(plain - self.centre[0], axis=1)
        heap = [(-float("inf"), 0, everyone, np.full(len(queries), float("inf")), away)]
        while heap:
            _, node, who, bound, away = heapq.heappop(heap)
            still = bound >= least[who]
            who, away = who[still], away[still]
            if not len(who):
                continue
            if self.leaf[node]:
                ids, rows, vectors, to_centre = self.entries[node]
                may = (square[who, None] + self.squares[node][None, :] - (away[:, None] - to_centre[None, :]) ** 2) / 2 + slack[who, None] >= least[who, None]
                some = np.flatnonzero(may.any(0))
                if not len(some):
                    continue
                scores = plain[who] @ vectors[some].T if exact else queries[who] @ vectors[some].astype(np.int64).T
                for q, x in zip(*np.nonzero(scores >= least[who, None]), strict=True):
                    i, s, at = int(who[q]), int(scores[q, x]), some[x]
                    if rows[at] == own[i] or s < least[i]:
                        continue
                    item, mine = (s, -int(ids[at]), -int(rows[at])), best[i]
                    if len(mine) < k:
                        heapq.heappush(mine, item)
                    elif item > mine[0]:
                        heapq.heapreplace(mine, item)
                    if len(mine) == k:
                        least[i] = max(least[i], mine[0][0])
                continue
            below = self.children[node]
            # Without a distance of their own: by the parent's distance and the stored one.
            gap = np.maximum(np.abs(away[:, None] - self.to_parent[below][None, :]) - self.radius[below][None, :], 0)
            rough = (square[who, None] + self.norm[below][None, :] ** 2 - gap**2) / 2 + slack[who, None] >= least[who, None]
            below, rough = below[rough.any(0)], rough[:, rough.any(0)]
            if not len(below):
                continue
            apart = np.stack([np.linalg.norm(plain[who] - self.centre[c], axis=1) for c in below], axis=1)
            near = np.maximum(apart - self.radius[below][None, :], 0)
            turned = plain[who] @ self.centre[below].T + length[who, None] * self.radius[below][None, :]
            upper = np.minimum(turned, (square[who, None] + self.norm[below][None, :] ** 2 - near**2) / 2) + slack[who, None]
            open_ = rough & (upper >= least[who, None])
            for j, child in enumerate(below.tolist()):
                at = np.flatnonzero(open_[:, j])
                if len(at):
                    heapq.heappush(heap, (-float(upper[at, j].max()), child, who[at], upper[at, j], apart[at, j]))
        return best


def index(vectors: DataFrame, dim: int) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """The pages of all blocks, and the pivots with their rows."""
    n = vectors.count()
    wanted = min(MAX_PIVOTS, max(1, n // BLOCK * 2))
    drawn = vectors.orderBy(F.xxhash64("row"), "row").limit(wanted).collect()
    pivots, pivot_rows = _matrix([r["v"] for r in drawn], dim), np.array([r["row"] for r in drawn], np.int64)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(2).to_pylist(), dim)
            near = _distances(x, pivots).argmin(1) if len(x) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near, pa.int64())], ["id", "row", "v", "pivot"])

    dealt = written(vectors.mapInArrow(assign, "id long, row long, v array<long>, pivot long"), scratch_path(vectors.sparkSession, "dealt"))
    sizes = dealt.groupBy("pivot").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("parts"))
    block = F.col("pivot") + MAX_PIVOTS * F.pmod(F.xxhash64("row"), F.col("parts"))

    def pages(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("row")
        made = pd.DataFrame(build(block["id"].to_numpy(np.int64), block["row"].to_numpy(np.int64), _matrix(block["v"], dim), int(key[0])))
        return made.assign(block=int(key[0]))[[c.split()[0] for c in PAGES.split(", ")]]

    made = dealt.join(F.broadcast(sizes), "pivot").withColumn("block", block).groupBy("block").applyInPandas(pages, PAGES)
    return written(made, scratch_path(vectors.sparkSession, "pages")), pivots, pivot_rows


def _searcher(sent, dim: int, k: int, first: bool):
    """What searches a block's pages: in the first round for the queries nearest to its pivot, then for all others."""

    def search(pages: pd.DataFrame) -> pd.DataFrame:
        ids, own, queries, floors, nearest_pivot = sent.value
        mine = (nearest_pivot == int(pages["block"].iloc[0]) % MAX_PIVOTS) == first
        out = []
        if mine.any():
            found = Tree(pages, dim).search(queries[mine], own[mine], k, floors[mine])
            out = [(o, i, -x, s) for o, i, best in zip(own[mine].tolist(), ids[mine].tolist(), found, strict=True) for s, x, _ in best]
        return pd.DataFrame(out, columns=["query", "query_id", "vec_id", "score"])

    return search


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, lot: int = LOT) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: for each row of ``queries`` the k rows of ``vectors`` but itself (by ``row``) of highest
    integer inner product, all if fewer, ties to the smaller id. Both as ``integers`` gives them, written once, so that rows keep their
    numbers. Repeated rows are rows of their own. No vectors or no queries give no rows. Scores are exact within 64 bits. Vectors count as filled up
    with zeros to the longest one's length, so a single long vector lengthens what is held of every block in a task.
    """
    spark = vectors.sparkSession
    dim = max(1, vectors.agg(F.max(F.size("v"))).first()[0] or 0)
    many = queries.count()
    if not many:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    pages, pivots, pivot_rows = index(vectors, dim)
    lots = -(-many // lot)
    found, schema = None, "query long, query_id long, vec_id long, score long"
    for i in range(lots):
        part = queries if lots == 1 else queries.where(F.pmod(F.xxhash64("row"), F.lit(lots)) == i)
        rows = part.orderBy("row").collect()
        ids, own, q = np.array([r["id"] for r in rows], np.int64), np.array([r["row"] for r in rows], np.int64), _matrix([r["v"] for r in rows], dim)
        # The k-th best pivot is a floor under each query's k-th best score, the k-th best row of its own block a better one.
        scores = q @ pivots.T
        scores = np.where(pivot_rows[None, :] == own[:, None], np.iinfo(np.int64).min, scores)
        floors = np.full(len(rows), -np.inf) if pivots.shape[0] <= k else np.sort(scores, 1)[:, -k].astype(float)
        home = _distances(q, pivots).argmin(1)
        sent = spark.sparkContext.broadcast((ids, own, q, floors, home))
        near = written(pages.groupBy("block").applyInPandas(_searcher(sent, dim, k, True), schema), scratch_path(spark, "found"))
        ranked = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score")))
        better = near.withColumn("r", ranked).where(F.col("r") == k).select("query", "score").collect()
        at = {r["query"]: r["score"] for r in better}
        floors = np.maximum(floors, [float(at.get(r, -np.inf)) for r in own.tolist()])
        again = spark.sparkContext.broadcast((ids, own, q, floors, home))
        far = written(pages.groupBy("block").applyInPandas(_searcher(again, dim, k, False), schema), scratch_path(spark, "found"))
        one = near.unionByName(far)
        found = one if found is None else found.unionByName(one)
    return _ranked(found, k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(rows: DataFrame, key: str, column: str, every: int = 50, k: int = K) -> DataFrame:
    """``nearest`` with the rows whose id is divisible by ``every`` as queries against all rows."""
    vectors = written(integers(rows, key, column), scratch_path(rows.sparkSession, "vectors"))
    return nearest(vectors, vectors.where(F.col("id") % every == 0), k)
