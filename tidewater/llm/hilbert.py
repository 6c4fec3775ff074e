"""Approximate nearest neighbours on shifted space-filling curves.

Vectors get one more component that makes all their lengths equal, so that the largest
inner product is the nearest point; queries get 0 there.  Each of several orderings
projects onto a few random orthonormal directions, places every projection among
shifted quantiles, and walks the grid along a Hilbert curve.  Curve keys are cut
into ranges; a query looks into its own range and the two beside it, in every ordering.
The windows are scored exactly in double precision and merged per query.

Quantiles and range bounds are fitted on a bounded sample (``SAMPLE`` vectors or ``SAMPLE_VALUES``
components, whichever is less, chosen by hash); every vector is indexed.  A range holds 1/25 of the vectors
at every size of the table.  Ranges and queries are dealt into pieces of bounded size, whatever one
key holds.  A query whose windows hold fewer than ``k`` candidates (tiny tables, or ranges
left empty by many equal vectors) is scored against all vectors, in pieces.  Where the data have no
low-dimensional structure, any window must be a fixed share of them for a fixed recall;
``orderings`` and ``ranges`` trade work for recall.

Null, zero and non-finite vectors, and vectors without an id or of another dimension than
the most common one, take no part.  Rows that share an id, equal rows included, are one candidate, of
which the nearest counts, and one query, which keeps the best of what its rows find.  Ties go to the
smaller id.  An empty table, or one without usable vectors, gives no rows.  Columns other than
``vec_id`` and ``embedding`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut
from .vectors import matrix, usable

ORDERINGS, DIMS, LEVELS = 16, 8, 4
RANGES = 25
SAMPLE, SAMPLE_VALUES = 20_000, 4_000_000
PIECE, QUERIES = 8192, 2048  # vectors and queries of one task's comparison
SEED = 7


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of grid cells (rows of ``bits``-bit coordinates) on the Hilbert curve."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):  # undo the rotations, from the coarsest level down
        low = (1 << level) - 1
        for i in range(dims):
            flips = (x[i] >> level) & 1 == 1
            swap = np.where(flips, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(flips, low, swap)
            x[i] ^= swap
    for i in range(1, dims):  # Gray code across the dimensions
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | (x[i] >> level) & 1
    return key


class Curves:
    """The orderings: directions, shifted quantiles and range bounds of each."""

    def __init__(self, sample: np.ndarray, radius: float, ranges: int, orderings: int, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.radius = radius
        points = self.lift(sample, False)
        dims = min(DIMS, points.shape[1])
        self.curves = []
        for _ in range(orderings):
            lines = np.linalg.qr(rng.normal(size=(points.shape[1], dims)))[0]
            steps = np.arange(1, 1 << LEVELS) / (1 << LEVELS)
            at = np.clip(steps[:, None] + rng.uniform(-0.5, 0.5, dims) / (1 << LEVELS), 0, 1)
            grid = [np.quantile(points @ lines[:, d], at[:, d]) for d in range(dims)]
            key = self._key(points, lines, grid)
            bounds = np.quantile(key, np.arange(1, ranges) / ranges) if ranges > 1 else np.zeros(0)
            self.curves.append((lines, grid, bounds))

    def lift(self, x: np.ndarray, queries: bool) -> np.ndarray:
        """Points of equal length whose distances order the inner products."""
        size = np.linalg.norm(x, axis=1)
        if queries:
            return np.column_stack([x * (self.radius / size)[:, None], np.zeros(len(x))])
        return np.column_stack([x, np.sqrt(np.maximum(self.radius ** 2 - size ** 2, 0))])

    @staticmethod
    def _key(points: np.ndarray, lines: np.ndarray, grid: list[np.ndarray]) -> np.ndarray:
        y = points @ lines
        return hilbert_key(np.column_stack([np.searchsorted(g, y[:, d], "right") for d, g in enumerate(grid)]), LEVELS)

    def places(self, x: np.ndarray, queries: bool) -> np.ndarray:
        """The range of every vector in every ordering."""
        points = self.lift(x, queries)
        return np.column_stack([np.searchsorted(b, self._key(points, w, g), "right") for w, g, b in self.curves])


def _place(curves, queries: bool):
    """Rows ``(ordering, range)`` of every vector; a query also looks beside its own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("embedding"))
            places = curves.value.places(x, queries)
            for o, (_, _, bounds) in enumerate(curves.value.curves):
                for beside in (-1, 0, 1) if queries else (0,):
                    at = places[:, o] + beside
                    real = np.flatnonzero((at >= 0) & (at <= len(bounds)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(real), o, np.int32)), pa.array(at[real].astype(np.int32)),
                         batch.column("vec_id").take(pa.array(real)),
                         pa.array([v.tobytes() for v in x[real]], pa.binary())],
                        names=["ordering", "place", "vec_id", "vector"])
    return run


def _score(dim: int, k: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        asks = rows["query"].to_numpy()
        x = np.frombuffer(b"".join(rows["vector"]), np.float64).reshape(-1, dim)
        ids = rows["vec_id"].to_numpy()
        q, qid, v, vid = x[asks], ids[asks], x[~asks], ids[~asks]
        order = np.argsort(vid, kind="stable")
        v, vid = v[order], vid[order]
        out = []
        for i in range(0, len(q), 128) if len(v) else ():
            s = q[i:i + 128] @ v.T
            s[qid[i:i + 128, None] == vid[None, :]] = -np.inf
            n = min(k, len(vid))
            least = np.partition(s, len(vid) - n, axis=1)[:, len(vid) - n]
            a, b = np.nonzero((s >= least[:, None] - 1e-9) & (s > -np.inf))
            exact = np.einsum("ij,ij->i", q[i + a], v[b])  # one order of summing for every place it is found
            best = np.lexsort((vid[b], -exact, a))
            a, b, exact = a[best], b[best], exact[best]
            nth = np.arange(len(a)) - np.searchsorted(a, a)
            # rows that share an id do not push others out
            keep = nth < k + np.bincount(a, minlength=len(s))[a] - np.bincount(
                a[np.append(True, (a[1:] != a[:-1]) | (vid[b][1:] != vid[b][:-1]))], minlength=len(s))[a] if len(a) else []
            out.append(pd.DataFrame({"query_id": qid[i + a][keep], "vec_id": vid[b][keep], "score": exact[keep]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
    return run


def _sides(held: DataFrame, asked: DataFrame) -> DataFrame:
    """Both sides of every cell (ordering and range), dealt into pieces ``v, q`` that one task compares."""
    # a few counts per cell decide how many pieces its two sides are dealt into
    cells = (held.groupBy("ordering", "place").agg(F.ceil(F.count("*") / PIECE).alias("vs"))
             .join(asked.groupBy("ordering", "place").agg(F.ceil(F.count("*") / QUERIES).alias("qs")), ["ordering", "place"]))
    cells = F.broadcast(cut(cells, "cells"))  # at most orderings x ranges rows
    deal = lambda column, n: F.pmod(F.xxhash64(F.lit(n), "vec_id"), F.col(n)).alias(column)
    copies = lambda column, n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)).alias(column)
    return (held.join(cells, ["ordering", "place"])
            .select("ordering", "place", deal("v", "vs"), copies("q", "qs"), "vec_id", "vector", F.lit(False).alias("query"))
            .union(asked.join(cells, ["ordering", "place"])
                   .select("ordering", "place", copies("v", "vs"), deal("q", "qs"), "vec_id", "vector", F.lit(True).alias("query"))))


def nearest(embeddings: DataFrame, is_query: Column, k: int = 20, orderings: int = ORDERINGS, ranges: int = RANGES) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` nearest found, never itself.

    ``is_query`` is a condition on ``vec_id``.  With ``ranges=1`` the search is exact.
    """
    spark = embeddings.sparkSession
    rows = embeddings.where(F.col("vec_id").isNotNull() & usable("embedding")).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    size = F.size("embedding")
    dims = rows.groupBy(size.alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    if dims is None:
        return empty
    dim, n = dims.dim, dims.n
    rows = cut(rows.where(size == dim), "vectors")
    wanted = max(1, min(SAMPLE, SAMPLE_VALUES // dim))
    length = F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v * v)
    sample = rows.where(F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(10**9)) < int(min(1.0, wanted / n) * 10**9))
    fitted = np.array([r[0] for r in sample.select("embedding").limit(2 * wanted).collect()]).reshape(-1, dim)
    if not len(fitted):
        fitted = np.array([r[0] for r in rows.select("embedding").limit(min(1000, wanted)).collect()])
    radius = float(np.sqrt(rows.agg(F.max(length)).first()[0]))
    curves = spark.sparkContext.broadcast(Curves(fitted, radius, ranges, orderings))
    schema = "ordering int, place int, vec_id bigint, vector binary"
    pairs = "query_id bigint, vec_id bigint, score double"

    def best(held: DataFrame, asked: DataFrame) -> DataFrame:
        found = _sides(held, asked).groupBy("ordering", "place", "v", "q").applyInPandas(_score(dim, k), pairs)
        rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)

    held = rows.mapInArrow(_place(curves, False), schema)
    asked = rows.where(is_query).mapInArrow(_place(curves, True), schema)
    found = cut(best(held, asked), "nearest")
    full = found.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"))
    short = cut(rows.where(is_query).join(full, "vec_id", "left_anti"), "nearest-short")
    if short.isEmpty():
        return found
    whole = spark.sparkContext.broadcast(Curves(fitted, radius, 1, 1))  # one range: all vectors
    again = best(rows.mapInArrow(_place(whole, False), schema), short.mapInArrow(_place(whole, True), schema))
    return found.join(full, found["query_id"] == full["vec_id"], "left_semi").union(again)
