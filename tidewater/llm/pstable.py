"""Embedding near-duplicates by Euclidean p-stable hashing.

Normalised vectors whose cosine is c lie sqrt(2 - 2c) apart.  A table quantises
``HASHES`` Gaussian projections, each shifted at random, with one bucket width; vectors
that share all of a table's numbers (and label and dimension) share a bucket, and every
pair in a bucket is checked by its exact cosine.  A pair at cosine 0.93 shares a
bucket in a table with probability 0.32, so 16 tables miss it once in 500; closer pairs
are missed far more rarely.

Equal vectors of a label are one class with a multiplicity.  A pair counts in the first
table it shares, which both sides know from their numbers, so no list of pairs is made
or compared: a bucket returns, per class, its count of links and one link towards
the first class of its component.  A bucket of more than ``TILE`` classes is split and its
parts are compared pairwise in separate tasks.

Null, zero and non-finite vectors and null labels link with nothing.  Vectors of different dimension never
link.  Rows with equal ids, repeated rows included, stay rows of their own and link with each other; null ids are
ignored in a component's smallest id, and a row with a null id is never kept.  A cosine of exactly the threshold
links.  An empty table gives no rows.  Only ``vec_id``, ``embedding`` and ``label`` are read, so
other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut
from .links import Forest, components
from .vectors import matrix, usable

TABLES, HASHES, WIDTH = 16, 7, 2.0
TILE = 2048   # classes compared in one piece
LARGE = 48    # rows of a bucket from which it is compared as a matrix product
SEED = 2024


class Tables:
    """Bucket names of unit vectors of one dimension."""

    def __init__(self, dim: int, seed: int = SEED):
        rng = np.random.default_rng([seed, dim])
        self.lines = rng.normal(size=(dim, TABLES * HASHES))
        self.shift = rng.uniform(0, WIDTH, TABLES * HASHES)
        self.mix = rng.integers(1, 2**63, size=(TABLES, HASHES), dtype=np.int64).astype(np.uint64) | np.uint64(1)

    def names(self, unit: np.ndarray) -> np.ndarray:
        """One 64-bit name per vector and table."""
        cells = np.floor((unit @ self.lines + self.shift) / WIDTH).astype(np.int64).astype(np.uint64)
        mixed = (cells.reshape(len(unit), TABLES, HASHES) * self.mix).sum(axis=2, dtype=np.uint64)
        return (mixed ^ (mixed >> np.uint64(31))).view(np.int64)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _buckets(wide: bool):
    """Bucket rows of classes; ``wide`` rows carry what the comparison needs, one per split."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[int, Tables] = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                rows = batch.filter(pa.array(dims == dim))
                unit = _unit(matrix(rows.column("embedding")))
                names = tables.setdefault(dim, Tables(dim)).names(unit)
                cid = rows.column("cid").to_numpy()
                label = rows.column("label")
                if not wide:
                    for t in range(TABLES):
                        yield pa.RecordBatch.from_arrays(
                            [label, rows.column("dim"), pa.array(np.full(len(cid), t, np.int32)),
                             pa.array(names[:, t].copy()), pa.array(cid)], names=["label", "dim", "t", "bucket", "cid"])
                    continue
                splits = np.ones((len(cid), TABLES), np.int64)
                for i, found in enumerate(rows.column("splits").to_pylist()):
                    for t, n in found or []:
                        splits[i, t] = n
                many = rows.column("m").to_numpy()
                for t in range(TABLES):
                    own = (cid * 2654435761 >> 7) % splits[:, t]
                    at = np.repeat(np.arange(len(cid)), splits[:, t])
                    other = np.arange(len(at)) - np.repeat(np.cumsum(splits[:, t]) - splits[:, t], splits[:, t])
                    for k in range(0, len(at), 4096):
                        i, o = at[k:k + 4096], other[k:k + 4096]
                        yield pa.RecordBatch.from_arrays(
                            [label.take(pa.array(i)), rows.column("dim").take(pa.array(i)),
                             pa.array(np.full(len(i), t, np.int32)), pa.array(names[i, t]),
                             pa.array(np.minimum(own[i], o)), pa.array(np.maximum(own[i], o)), pa.array(own[i]),
                             pa.array(cid[i]), pa.array(many[i]),
                             pa.array([x.tobytes() for x in unit[i]], pa.binary()),
                             pa.array([x[:t].tobytes() for x in names[i]], pa.binary())],
                            names=["label", "dim", "t", "bucket", "lo", "hi", "own", "cid", "m", "unit", "names"])
    return run


def _links(t: int, unit: np.ndarray, names: np.ndarray, group: np.ndarray, part: np.ndarray,
           whole: np.ndarray, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links between rows of the same group, which lie together, in pieces.

    ``part`` is the row's part of a split bucket; ``whole`` says that rows of one part meet here."""
    def new(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those that did not share a bucket in an earlier table."""
        for c in range(0, len(i) if t else 0, 1 << 16):
            met = (names[i[c:c + (1 << 16)]] == names[j[c:c + (1 << 16)]]).any(axis=1)
            i[c:c + (1 << 16)][met] = -1
        return i[i >= 0], j[i >= 0]

    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    sizes = np.diff(np.append(starts, len(group)))
    large = sizes >= LARGE
    for d in range(1, min(LARGE - 1, int(sizes[~large].max(initial=0)))):
        i = np.flatnonzero((group[d:] == group[:-d]) & ~np.repeat(large, sizes)[d:])
        i = i[whole[i] | (part[i] != part[i + d])]
        for k in range(0, len(i), 1 << 14):
            a = i[k:k + (1 << 14)]
            a = a[np.einsum("ij,ij->i", unit[a], unit[a + d]) >= cosine]
            yield new(a, a + d)
    for lo, n in zip(starts[large], sizes[large], strict=True):
        of = slice(lo, lo + n)
        for k in range(lo, lo + n, 256):
            a = np.arange(k, min(k + 256, lo + n))
            close = unit[a] @ unit[of].T >= cosine
            close &= (np.arange(lo, lo + n) > a[:, None]) & (whole[k] | (part[of] != part[a][:, None]))
            i, j = np.nonzero(close)
            yield new(a[i], j + lo)


def _compare(cosine: float):
    """Rows arrive sorted by bucket; the last bucket of a batch waits for the next batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in _and_end(batches):
            if batch is not None:
                rest = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            if rest is None or not rest.num_rows:
                continue
            rest = rest.combine_chunks()
            group = np.zeros(rest.num_rows, np.int64)
            for c in ("dim", "t", "label", "bucket", "lo", "hi"):
                x = rest.column(c).to_numpy()
                group[1:] += x[1:] != x[:-1]
            group = np.cumsum(group > 0)
            ready = rest.num_rows if batch is None else int(np.searchsorted(group, group[-1]))
            if not ready:  # one bucket so far
                continue
            table, rest = rest.slice(0, ready), rest.slice(ready)
            step = [table.column(c).to_numpy() for c in ("dim", "t")]
            cuts = np.flatnonzero(np.append(True, (step[0][1:] != step[0][:-1]) | (step[1][1:] != step[1][:-1])))
            for lo, hi in zip(cuts, [*cuts[1:], ready], strict=True):
                rows = table.slice(lo, hi - lo)
                dim, t = int(step[0][lo]), int(step[1][lo])
                unit = np.frombuffer(b"".join(rows.column("unit").to_pylist()), np.float64).reshape(len(rows), dim)
                names = np.frombuffer(b"".join(rows.column("names").to_pylist()), np.int64).reshape(len(rows), t)
                cid, many = rows.column("cid").to_numpy(), rows.column("m").to_numpy()
                whole = rows.column("lo").to_numpy() == rows.column("hi").to_numpy()
                links, forest = np.zeros(len(cid), np.int64), Forest(len(cid))
                for i, j in _links(t, unit, names, group[lo:hi], rows.column("own").to_numpy(), whole, cosine):
                    if len(i):
                        links += np.bincount(i, weights=many[j], minlength=len(cid)).astype(np.int64)
                        links += np.bincount(j, weights=many[i], minlength=len(cid)).astype(np.int64)
                        forest.link(i, j)
                at = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays([pa.array(cid[at]), pa.array(links[at]), pa.array(cid[forest.root[at]])],
                                                 names=["cid", "links", "root"])
    return run


def _and_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def near_vectors(embeddings: DataFrame, cosine: float = 0.93, tile: int = TILE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    good = usable("embedding") & F.col("label").isNotNull()
    rows = embeddings.select("vec_id", "embedding", "label").withColumn("good", good)
    key = [F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2")]
    keyed = rows.where("good").select("vec_id", "label", "embedding", *key)
    classes = cut(keyed.groupBy("label", "h1", "h2")
                  .agg(F.count("*").alias("m"), F.min("vec_id").alias("least"), F.first("embedding").alias("embedding"))
                  .select("*", F.size("embedding").alias("dim"), F.monotonically_increasing_id().alias("cid")), "classes")
    narrow = classes.select("label", "dim", "embedding", "cid").mapInArrow(
        _buckets(False), "label int, dim int, t int, bucket bigint, cid bigint")
    bucket = ["label", "dim", "t", "bucket"]
    large = (narrow.groupBy(*bucket).agg(F.count("*").alias("n")).where(F.col("n") > tile)
             .withColumn("parts", F.ceil(F.col("n") / tile)))
    splits = (narrow.join(large, bucket).groupBy("cid")
              .agg(F.collect_list(F.struct("t", "parts")).alias("splits")))  # at most one entry a table
    to_compare = classes.join(splits, "cid", "left").select(
        "label", "dim", "embedding", "cid", "m",
        F.transform("splits", lambda s: F.array(s.t.cast("bigint"), s.parts.cast("bigint"))).alias("splits"))
    pieces = to_compare.mapInArrow(
        _buckets(True), "label int, dim int, t int, bucket bigint, lo bigint, hi bigint, own bigint, cid bigint, "
                        "m bigint, unit binary, names binary")
    order = ["dim", "t", "label", "bucket", "lo", "hi"]
    dealt = pieces.repartition(*order).sortWithinPartitions(*order, "cid")
    found = cut(dealt.mapInArrow(_compare(cosine), "cid bigint, links bigint, root bigint"), "vector-links")
    groups = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")), "vectors")
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    named = (classes.select("label", "h1", "h2", "m", "least", "cid").join(counts, "cid", "left")
             .join(groups.withColumnRenamed("node", "cid"), "cid", "left")
             .withColumn("component", F.coalesce("component", "cid")))
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of = named.join(ids, "component").select(
        "label", "h1", "h2", "component_id", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"))
    linked = keyed.select("vec_id", "label", "h1", "h2").join(of, ["label", "h1", "h2"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.col("good")).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
