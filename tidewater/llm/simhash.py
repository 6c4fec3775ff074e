"""SimHash near-duplicates by tiled exact comparison.

Every pair of distinct fingerprints within the radius is found.  Distinct fingerprints
are ordered by the population counts of their eight bytes and cut into tiles.  Two
fingerprints that differ in at most r bits have byte counts that differ by at most
r in sum, so a pair of tiles is compared, by numpy exclusive-or and bit counts, only if
the ranges of their counts come that close; blocks inside a tile are skipped by
the same rule.  A tile pair returns a forest of its links, never its pairs, so
a group of many near copies costs one row for each copy.

The number of tiles is at most ``MAX_TILES`` (the tile grows with the table beyond
that), which bounds the list of tile ranges that every task gets.  The comparison
is exact and so grows with the square of the number of distinct fingerprints.

Words are runs without white space, A-Z in lower case; a text with fewer words
than a shingle is one shingle; null, empty and blank texts have fingerprint zero and
link like any other.  Equal fingerprints are one node.  Null ids are ignored when
the smallest id of a component is taken (null if it has no other).  A bit set in exactly half of the shingles
is 0.  Texts of any length are read whole.  In ``near_duplicates`` repeated rows keep their rows; in ``keep_one``
rows equal in id and text are one document.  An empty table stays empty.  Helper
columns begin with ``__``, so columns may have any other name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Texts, cut, map_texts
from .links import Forest, components
from .tokens import lower_ascii

SEED = 42
TILE = 1 << 14     # fingerprints in a tile
MAX_TILES = 2048
BLOCK = 512        # fingerprints in a block of a tile

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def fingerprint_texts(texts: Texts, words: int) -> np.ndarray:
    """The 64-bit SimHash of each text over its word shingles."""
    data = lower_ascii(texts.data)
    space = _SPACE[data]
    head = np.zeros(len(data) + 1, bool)
    head[texts.offsets] = True
    head = head[:-1]
    begins = ~space
    begins[1:] &= space[:-1] | head[1:]
    if not begins.any():
        return np.zeros(len(texts), np.uint64)
    # every word followed by one space, whatever stood between them
    ends = np.flatnonzero(~space & np.append(space[1:] | head[1:], True)) + 1
    starts = np.flatnonzero(begins)
    owner = np.searchsorted(texts.offsets, starts, "right") - 1
    width = ends - starts
    at = np.cumsum(width + 1) - width - 1
    out = np.full(int(width.sum()) + len(width), 0x20, np.uint8)
    out[np.repeat(at - (np.cumsum(width) - width), width) + np.arange(int(width.sum()))] = data[~space]
    count = np.bincount(owner, minlength=len(texts))
    last = np.cumsum(count)[owner] - 1
    word = np.arange(len(starts))
    first = word == last - count[owner] + 1
    lead = first | (word + words - 1 <= last)
    stop = np.minimum(word + words - 1, last)[lead]
    flat, digest = out.tobytes(), xxhash.xxh64_intdigest
    hashes = np.array([digest(flat[a:b], SEED) for a, b in
                       zip(at[lead].tolist(), (at[stop] + width[stop]).tolist(), strict=True)], np.uint64)
    owner = owner[lead]
    made = np.bincount(owner, minlength=len(texts))
    rows = np.flatnonzero(made)
    ones = np.zeros((len(rows), 64), np.int64)
    step = 1 << 18
    for k in range(0, len(hashes), step):
        bits = np.unpackbits(hashes[k:k + step].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own = owner[k:k + step]
        cuts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        ones[np.searchsorted(rows, own[cuts])] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int64)
    found = np.zeros(len(texts), np.uint64)
    found[rows] = np.packbits(2 * ones > made[rows, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
    return found


def fingerprints(docs: DataFrame, keep: list[str], words: int, out: str = "fingerprint") -> DataFrame:
    """``keep`` and the SimHash of each whole text as a signed 64-bit integer."""
    def start():
        return lambda texts: [fingerprint_texts(texts, words).view(np.int64)]
    return map_texts(docs, "text", keep, [T.StructField(out, T.LongType())], start)


def byte_counts(x: np.ndarray) -> np.ndarray:
    """Population counts of the eight bytes of each fingerprint."""
    return np.bitwise_count(np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8)).astype(np.int16)


def _ranges(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest byte counts, and count of all bits, of some fingerprints."""
    counts = np.column_stack([counts, counts.sum(axis=1)])
    return counts.min(axis=0), counts.max(axis=0)


def _apart(low, high, lows, highs) -> np.ndarray:
    """How many bits at least lie between one range and each of others."""
    gap = np.maximum(np.maximum(lows - high, low - highs), 0)
    return np.maximum(gap[..., :8].sum(axis=-1), gap[..., 8])


def compare_tiles(x: np.ndarray, y: np.ndarray, radius: int, forest: Forest, shift: int) -> None:
    """Link the fingerprints of two tiles; ``shift`` is the place of the first of ``y`` (0: x itself)."""
    cx, cy = byte_counts(x), byte_counts(y)
    blocks = [_ranges(cy[k:k + BLOCK]) for k in range(0, len(y), BLOCK)]
    lows, highs = (np.array(z) for z in zip(*blocks, strict=True))
    for i in range(0, len(x), BLOCK):
        near = np.flatnonzero(_apart(*_ranges(cx[i:i + BLOCK]), lows, highs) <= radius) * BLOCK
        for j in near.tolist() if shift else near[near >= i].tolist():
            close = np.bitwise_count(x[i:i + BLOCK, None] ^ y[None, j:j + BLOCK]) <= radius
            a, b = np.nonzero(close)
            if len(a):
                forest.link(a + i, b + j + shift)


def fingerprint_components(prints: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """``fingerprint, component`` of the distinct fingerprints that link with another."""
    spark = prints.sparkSession
    distinct = cut(prints.select("fingerprint").distinct(), "fingerprints")
    n = distinct.count()
    size = max(tile, -(-n // MAX_TILES))

    def byte(k: int) -> Column:
        return F.bit_count(F.shiftrightunsigned("fingerprint", 8 * k).bitwiseAND(F.lit(255)))

    order = F.concat(*(byte(k).cast("string") for k in range(8)))
    dealt = distinct.withColumn("counts", order).repartitionByRange(max(1, -(-n // size)), "counts", "fingerprint")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, made = np.zeros(0, np.int64), 0
        part = TaskContext.get().partitionId()
        for batch in [*batches, None]:
            rest = rest if batch is None else np.concatenate([rest, batch.column(0).to_numpy()])
            while len(rest) >= 2 * size or (batch is None and len(rest)):
                now, rest = (rest[:size], rest[size:]) if len(rest) >= 2 * size else (rest, rest[:0])
                low, high = _ranges(byte_counts(now))
                yield pa.RecordBatch.from_pydict({
                    "tile": pa.array([part * 1_000_000 + made], pa.int64()), "low": pa.array([low], pa.list_(pa.int16())),
                    "high": pa.array([high], pa.list_(pa.int16())), "prints": pa.array([now.tobytes()], pa.binary())})
                made += 1

    tiles = cut(dealt.sortWithinPartitions("counts", "fingerprint").select("fingerprint")
                .mapInArrow(pack, "tile bigint, low array<smallint>, high array<smallint>, prints binary"), "tiles")
    ranges = tiles.select("tile", "low", "high").orderBy("tile").collect()  # one short row per tile
    if not ranges:
        return distinct.select("fingerprint", F.col("fingerprint").alias("component")).limit(0)
    directory = spark.sparkContext.broadcast((np.array([r.tile for r in ranges]), np.array([r.low for r in ranges]),
                                              np.array([r.high for r in ranges])))

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, lows, highs = directory.value
        for batch in batches:
            for row in batch.to_pylist():
                own, low, high = row["tile"], np.array(row["low"]), np.array(row["high"])
                near = names[_apart(low, high, lows, highs) <= radius]
                for k in range(0, len(near), 64):  # rows of a batch share no memory with the next
                    to = near[k:k + 64]
                    yield pa.RecordBatch.from_pydict({
                        "a": pa.array(np.minimum(to, own), pa.int64()), "b": pa.array(np.maximum(to, own), pa.int64()),
                        "tile": pa.array(np.full(len(to), own), pa.int64()),
                        "prints": pa.array([row["prints"]] * len(to), pa.binary())})

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        parts = [np.frombuffer(p, np.uint64) for p in rows.sort_values("tile")["prints"]]
        every = np.concatenate(parts)
        forest = Forest(len(every))
        if len(parts) == 1:
            compare_tiles(parts[0], parts[0], radius, forest, 0)
        else:
            compare_tiles(parts[0], parts[1], radius, forest, len(parts[0]))
        own, root = forest.links()
        return pd.DataFrame({"a": every[own].view(np.int64), "b": every[root].view(np.int64)})

    pairs = tiles.mapInArrow(pair, "a bigint, b bigint, tile bigint, prints binary")
    # tile pairs are few bytes and much work: a partition for each tile, which adaptive execution leaves alone
    edges = pairs.repartition(len(ranges), "a", "b").groupBy("a", "b").applyInPandas(compare, "a bigint, b bigint")
    return components(edges, "near").select(F.col("node").alias("fingerprint"), "component")


def near_duplicates(docs: DataFrame, words: int, radius: int) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits) and ``component_id`` of every document."""
    prints = cut(fingerprints(docs, ["doc_id"], words), "prints")
    return _labelled(prints, radius).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def _labelled(prints: DataFrame, radius: int) -> DataFrame:
    """``prints`` with ``component_id``: ids meet their fingerprint's component in one join."""
    groups = fingerprint_components(prints, radius)
    smallest = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id"))
    named = smallest.join(groups, "fingerprint", "left").select(
        "fingerprint", "doc_id", F.coalesce("component", "fingerprint").alias("component"))
    ids = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of = cut(named.join(ids, "component").select("fingerprint", "component_id"), "components")
    return prints.join(of, "fingerprint")


def keep_one(docs: DataFrame, words: int, radius: int) -> DataFrame:
    """One document of each component, all its columns: the smallest id, of
    repeated ids the one whose text hashes lowest, of equal rows one.  Documents with a null id
    are compared too; one stays only if no other document of its component has an id."""
    columns = list(docs.columns)
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("__place"))
    prints = cut(fingerprints(docs.withColumn("__place", F.xxhash64("text")), ["doc_id", "__place"], words), "prints")
    groups = fingerprint_components(prints, radius)
    best = prints.groupBy("fingerprint").agg(F.min(place).alias("best"))
    ids = (best.join(groups, "fingerprint", "left")
           .groupBy(F.coalesce("component", "fingerprint").alias("component")).agg(F.min("best").alias("best")))
    stay = ids.select(F.col("best.doc_id").alias("__id"), F.col("best.__place").alias("__of")).distinct()
    found = docs.join(stay, F.col("doc_id").eqNullSafe(F.col("__id")) & F.xxhash64("text").eqNullSafe(F.col("__of")), "left_semi")
    return found.select(*columns).dropDuplicates(["doc_id", "text"])
