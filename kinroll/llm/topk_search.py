"""Exact top-k inner-product search by no-random-access aggregation.

Candidates are dealt into blocks, queries into groups, and every block meets
every query group in one task. A block keeps, per dimension, its rows sorted by
component. A query reads these lists from the end that its own component makes
largest, a stretch of all lists at a time (an eighth of the block, then twice as
deep each time), and keeps for every row the sum of what it has seen, and bounds
on the rest: no unread component contributes more than its list's frontier or
less than the list's far end. Reading stops for a query when at most ``FEW`` rows
have an upper bound that reaches the k-th best lower bound; those get their
final scores, and the block's best ``k`` go on. The queries of a group read
together, so that a stretch is a few matrix products. Blocks' results are merged
per query.

Components are integers (``floor(1024 * x)``), scores exact: sums are done in
doubles while they stay under 2 ** 52, and in Python integers otherwise.

Defined cases: vectors that are null, or hold null or non-finite components, and
rows with a null id take no part; shorter vectors count as padded with zeros; a
query id that is repeated is answered once, by its first vector in order, and
rows with the query's id are not its candidates; ties go to the smaller id; an
empty table gives an empty result; scores beyond 64 bits count as the nearest
64-bit integer; other columns play no part.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinroll.llm.common import narrow

SCALE = 1024
BLOCK_ROWS = 4096
GROUP_QUERIES = 1024
EXACT = float(2 ** 52)
FEW = 64
RESULT = "query_id long, vec_id long, score long"


def quantised(vector: str) -> Column:
    """``floor(1024 * x)`` per component, null where the vector takes no part."""
    x = F.col(vector).cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(~F.coalesce(bad, F.lit(True)), F.transform(x, lambda v: F.floor(v * SCALE)))


class Block:
    """Candidates of one block. ``from_top[row, d]`` is the row's place in
    dimension ``d``'s list read from its large end, ``from_low`` from the other."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.x = ids, vectors
        n, dims = vectors.shape
        order = np.argsort(vectors, axis=0, kind="stable")
        self.sorted = np.take_along_axis(vectors, order, axis=0)
        self.from_low = np.empty((n, dims), dtype=np.int32)
        np.put_along_axis(self.from_low, order, np.arange(n, dtype=np.int32)[:, None], axis=0)
        self.from_top = n - 1 - self.from_low

    def read(self, up: np.ndarray, down: np.ndarray, seen: np.ndarray, done: int, depth: int) -> None:
        """Add to ``seen`` what the entries ``done`` to ``depth`` of every list
        contribute; ``up`` and ``down`` are the queries' positive and negative
        components, whose lists are read from either end. Every entry is read once."""
        for part, place in ((up, self.from_top), (down, self.from_low)):
            seen += part @ np.where((place >= done) & (place < depth), self.x, 0).T

    def bounds(self, up: np.ndarray, down: np.ndarray, seen: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper scores of all rows for all queries once ``depth``
        entries of every list are read and their sums are ``seen``. An unread
        entry adds between the list's far end and its frontier; summed over
        dimensions that is a matrix product."""
        if depth >= len(self.x):
            return seen, seen
        unread_top = (self.from_top >= depth).T.astype(np.float64)
        unread_low = (self.from_low >= depth).T.astype(np.float64)
        lowest, highest = self.sorted[0], self.sorted[-1]
        frontier_top, frontier_low = self.sorted[len(self.x) - depth], self.sorted[depth - 1]
        upper = seen + (up * frontier_top) @ unread_top + (down * frontier_low) @ unread_low
        lower = seen + (up * lowest) @ unread_top + (down * highest) @ unread_low
        return lower, upper

    def best_of_each(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query (row numbers, scores) of the ``k`` best rows other than its own."""
        n = len(self.ids)
        found: list = [None] * len(queries)
        waiting, done, depth = np.arange(len(queries)), 0, max(1, n // 8)
        seen = np.zeros((len(queries), n))
        while len(waiting):
            q = queries[waiting]
            up, down = np.maximum(q, 0), np.minimum(q, 0)
            self.read(up, down, seen, done, depth)
            lower, upper = self.bounds(up, down, seen, depth)
            own = self.ids[None, :] == query_ids[waiting][:, None]
            lower = np.where(own, -np.inf, lower)
            bar = np.partition(lower, n - k, axis=1)[:, n - k] if n > k else np.full(len(q), -np.inf)
            alive = (upper >= bar[:, None]) & ~own
            ready = (alive.sum(axis=1) <= max(k, FEW)) | (depth >= n)
            for at in np.flatnonzero(ready):
                rows = np.flatnonzero(alive[at])
                scores = self.x[rows] @ q[at]
                order = np.lexsort((self.ids[rows], -scores))[:k]
                found[waiting[at]] = (rows[order], scores[order])
            waiting, seen = waiting[~ready], seen[~ready]
            done, depth = depth, min(n, depth * 2)
        return found


def _best_exact(ids: np.ndarray, vectors: np.ndarray, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """One query against a block in Python integers, for components of any size."""
    q = [int(v) for v in query]
    clip = lambda s: max(-2 ** 63, min(2 ** 63 - 1, s))
    scored = sorted((-clip(sum(a * int(b) for a, b in zip(q, row, strict=True))), int(i), at)
                    for at, (i, row) in enumerate(zip(ids, vectors, strict=True)) if i != query_id)[:k]
    return np.array([s[2] for s in scored], dtype=np.int64), np.array([-s[0] for s in scored], dtype=np.int64)


def _matrix(vectors, dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims), dtype=np.float64)
    for row, v in zip(out, vectors, strict=True):
        row[:len(v)] = v
    return out


def _meet(k: int):
    def meet(group: pd.DataFrame) -> pd.DataFrame:
        queries, rows = group[group["is_query"]], group[~group["is_query"]]
        if queries.empty or rows.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        dims = max(1, group["x"].map(len).max())
        big = max((max(map(abs, map(int, v)), default=0) for v in group["x"] if len(v)), default=0)
        ids = rows["vec_id"].to_numpy(np.int64)
        if float(big) ** 2 * dims < EXACT:
            answers = Block(ids, _matrix(rows["x"], dims)).best_of_each(
                queries["vec_id"].to_numpy(np.int64), _matrix(queries["x"], dims), k)
        else:
            pad = lambda frame: np.array([[*map(int, v), *[0] * (dims - len(v))] for v in frame["x"]], dtype=object)
            answers = [_best_exact(ids, pad(rows), i, q, k)
                       for i, q in zip(queries["vec_id"].tolist(), pad(queries), strict=True)]
        asked = np.repeat(queries["vec_id"].to_numpy(np.int64), [len(rows) for rows, _ in answers])
        at = np.concatenate([rows for rows, _ in answers])
        scores = np.concatenate([np.asarray(s).astype(np.int64) for _, s in answers])
        return pd.DataFrame({"query_id": asked, "vec_id": ids[at], "score": scores})

    return meet


def top_k(vectors: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row that meets ``queries``
    (a condition on ``vec_id``) its ``k`` best other rows, all if fewer."""
    rows = narrow(vectors, vec_id=id_col, embedding=vector_col).select(
        F.col("vec_id").cast("long"), quantised("embedding").alias("x")).filter("vec_id is not null and x is not null")
    asked = rows.filter(queries).groupBy("vec_id").agg(F.min("x").alias("x"))
    n, n_queries = rows.count(), asked.count()
    blocks, groups = max(1, math.ceil(n / BLOCK_ROWS)), max(1, math.ceil(n_queries / GROUP_QUERIES))
    each = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    spread = F.pmod(F.xxhash64("vec_id", "x"), F.lit(blocks)).cast("int")
    candidates = rows.select("vec_id", "x", F.lit(False).alias("is_query"), spread.alias("block"), each(groups).alias("group"))
    asking = asked.select("vec_id", "x", F.lit(True).alias("is_query"),
                          F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int").alias("group"), each(blocks).alias("block"))
    met = candidates.unionByName(asking).groupBy("block", "group").applyInPandas(_meet(k), RESULT)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
