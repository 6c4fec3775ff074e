"""Exact deduplication by an index of live digests: a cuckoo filter per bucket over stored content.

Texts are normalised (A-Z to lower case, nothing else) and digested with SHA-256.  Digests are dealt to
buckets by their leading bits; a bucket's ``CuckooIndex`` holds a cuckoo filter (two places of four slots per
digest, 16-bit fingerprints) whose slots point into the bucket's content, the stored digests with the
row that stays and the group's size.  A lookup that misses the filter is a new digest.  A hit is only a
candidate: the stored digest its slot points to is compared in full.  Where an insertion finds no room the
filter grows to twice the slots and is filled again from the stored digests, as a fingerprint alone does not
tell its new place.  Deleting a digest frees its slot and its content row.

Before the shuffle the rows of a digest are combined per part of the written digest table, so a digest comes
to its bucket at most once per part, however many copies it has, and each document looks its
answer up under (digest, part): no step gathers a group's rows.  ``update`` also takes the index of earlier
batches, kept as one row per bucket in the shared folder, and digests to delete from it.

The row that stays is the one with the largest doc_id; of rows that repeat that id the last one written
to the digest table, so exactly one row of a group is kept.  A null id is smaller than every id: it stays only
in a group without ids.  Null and empty texts are equal.  Texts are read whole, at any length; an empty
table gives no rows.  Only ``doc_id`` and ``text`` are read, so further columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Texts, cut, map_texts

SLOTS = 4
KICKS = 64            # rounds of displacement before the filter grows
BUCKET_ROWS = 1 << 18  # digests a bucket is sized for
BATCH = 1 << 14        # digests looked up and inserted at a time


def digests_of(texts: Texts) -> list[bytes]:
    """SHA-256 of every text after lower-casing A-Z."""
    data = texts.data
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    view, at = memoryview(data), texts.offsets.tolist()
    return [hashlib.sha256(view[a:b]).digest() for a, b in zip(at[:-1], at[1:], strict=True)]


class CuckooIndex:
    """Live digests of one bucket: filter slots, and the content they point into.

    Digests are rows of four 64-bit words.  ``best`` holds what is kept of a digest (any int64 columns).
    """

    def __init__(self, width: int, places: int = 64):
        self.places = places
        self.prints = np.zeros((places, SLOTS), np.uint16)  # 0: free
        self.rows = np.zeros((places, SLOTS), np.int64)
        self.digests = np.zeros((0, 4), np.uint64)
        self.best = np.zeros((0, width), np.int64)
        self.live = np.zeros(0, bool)
        self._random = np.random.default_rng(7)

    # places and fingerprints come from words of the digest that dealing to buckets does not use
    def _print(self, digests: np.ndarray) -> np.ndarray:
        return (digests[:, 3] % np.uint64(65535) + np.uint64(1)).astype(np.uint16)

    def _place(self, digests: np.ndarray) -> np.ndarray:
        return (digests[:, 2] & np.uint64(self.places - 1)).astype(np.int64)

    def _other(self, place: np.ndarray, prints: np.ndarray) -> np.ndarray:
        """The second place of a fingerprint; applied twice it gives the first back."""
        mixed = prints.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(17)
        return place ^ (mixed & np.uint64(self.places - 1)).astype(np.int64)

    def _slots(self, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The eight candidate slots of each digest: places and slot numbers."""
        prints, one = self._print(digests), self._place(digests)
        both = np.stack([one, self._other(one, prints)], axis=1)
        return np.repeat(both, SLOTS, axis=1), np.tile(np.arange(SLOTS), 2)[None, :].repeat(len(digests), axis=0)

    def find(self, digests: np.ndarray) -> np.ndarray:
        """Content row of each digest, -1 where it is not live."""
        place, slot = self._slots(digests)
        at, k = np.nonzero(self.prints[place, slot] == self._print(digests)[:, None])  # the filter's hits
        rows = self.rows[place[at, k], slot[at, k]]
        same = (self.digests[rows] == digests[at]).all(axis=1)  # checked against the content
        found = np.full(len(digests), -1, np.int64)
        found[at[same]] = rows[same]
        return found

    def insert(self, digests: np.ndarray, best: np.ndarray) -> np.ndarray:
        """Make digests live that are not; they must differ from each other.  Returns their content rows."""
        rows = np.arange(len(self.digests), len(self.digests) + len(digests))
        self.digests = np.concatenate([self.digests, digests])
        self.best = np.concatenate([self.best, best])
        self.live = np.concatenate([self.live, np.ones(len(digests), bool)])
        full = self.live.sum() > 0.9 * SLOTS * self.places
        if full or not self._settle(self._place(digests), self._print(digests), rows):
            self._grow()
        return rows

    def delete(self, digests: np.ndarray) -> np.ndarray:
        """Take digests out; returns which of them were live."""
        rows = self.find(digests)
        gone = np.unique(rows[rows >= 0])
        if len(gone):
            place, slot = self._slots(self.digests[gone])
            hit = (self.rows[place, slot] == gone[:, None]) & (self.prints[place, slot] != 0)
            self.prints[place[hit], slot[hit]] = 0
            self.live[gone] = False
        return rows >= 0

    def _settle(self, place: np.ndarray, prints: np.ndarray, rows: np.ndarray) -> bool:
        """Put entries into free slots, displacing others in rounds; False if some found none."""
        for turn in range(KICKS):
            for _ in range(2):
                if not len(rows):
                    return True
                order = np.argsort(place, kind="stable")
                place, prints, rows = place[order], prints[order], rows[order]
                first = np.r_[True, place[1:] != place[:-1]]
                rank = np.arange(len(place)) - np.flatnonzero(first)[np.cumsum(first) - 1]
                free = self.prints[place] == 0
                nth = np.cumsum(free, axis=1)
                fits = rank < nth[:, -1]
                slot = np.argmax(nth == (rank + 1)[:, None], axis=1)
                self.prints[place[fits], slot[fits]], self.rows[place[fits], slot[fits]] = prints[fits], rows[fits]
                place, prints, rows = place[~fits], prints[~fits], rows[~fits]
                place = self._other(place, prints)
            # one entry of every full place moves out, one that waits moves in
            seen, first = np.unique(place, return_index=True)
            slot = self._random.integers(0, SLOTS, len(seen))
            out_prints, out_rows = self.prints[seen, slot], self.rows[seen, slot]
            self.prints[seen, slot], self.rows[seen, slot] = prints[first], rows[first]
            prints[first], rows[first], place[first] = out_prints, out_rows, self._other(seen, out_prints)
        return not len(rows)

    def _grow(self) -> None:
        """Twice the places, filled again from the stored digests."""
        while True:
            self.places *= 2
            self.prints = np.zeros((self.places, SLOTS), np.uint16)
            self.rows = np.zeros((self.places, SLOTS), np.int64)
            rows = np.flatnonzero(self.live)
            if len(rows) <= 0.9 * SLOTS * self.places and self._settle(
                    self._place(self.digests[rows]), self._print(self.digests[rows]), rows):
                return

    def state(self) -> list[bytes]:
        """Content of the live digests: what ``load`` builds the same index from."""
        return [np.ascontiguousarray(self.digests[self.live]).tobytes(), np.ascontiguousarray(self.best[self.live]).tobytes()]

    @classmethod
    def load(cls, width: int, digests: bytes | None, best: bytes | None) -> CuckooIndex:
        index = cls(width)
        keys = np.frombuffer(digests or b"", np.uint64).reshape(-1, 4)
        while len(keys) > 0.45 * SLOTS * index.places:
            index.places *= 2
        index.prints, index.rows = np.zeros((index.places, SLOTS), np.uint16), np.zeros((index.places, SLOTS), np.int64)
        if len(keys):
            index.insert(keys, np.frombuffer(best, np.int64).reshape(len(keys), width))
        return index


#: what the index keeps of a digest: no id at all, the id and row that stay, the number of rows
NONE, ID, ROW, SIZE = range(4)


def _better(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """True where the row ``new`` stays rather than ``old``."""
    named, ids = new[:, NONE] < old[:, NONE], new[:, NONE] == old[:, NONE]
    return named | (ids & ((new[:, ID] > old[:, ID]) | ((new[:, ID] == old[:, ID]) & (new[:, ROW] > old[:, ROW]))))


def absorb(index: CuckooIndex, digests: np.ndarray, best: np.ndarray) -> None:
    """Add partial groups to the index: new digests are inserted, known ones merged.

    A digest whose row that stays is superseded keeps its slot and changes its content.
    """
    order = np.lexsort((best[:, ROW], best[:, ID], -best[:, NONE], *digests.T))
    digests, best = digests[order], best[order]
    last = np.r_[(digests[1:] != digests[:-1]).any(axis=1), True]  # of equal digests the row that stays
    totals = np.add.reduceat(best[:, SIZE], np.r_[0, np.flatnonzero(last)[:-1] + 1])
    digests, best = digests[last], best[last].copy()
    best[:, SIZE] = totals
    rows = index.find(digests)
    known = rows >= 0
    if known.any():
        at = rows[known]
        old, new = index.best[at], best[known]
        size = old[:, SIZE] + new[:, SIZE]
        held = np.where(_better(old, new)[:, None], new, old)
        held[:, SIZE] = size
        index.best[at] = held
    if not known.all():
        index.insert(digests[~known], best[~known])


def digest_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, digest, part, row`` of every row, written once: the write fixes parts and rows."""
    field = T.StructField("digest", T.BinaryType())
    made = map_texts(docs, "text", ["doc_id"], [field], lambda: lambda texts: [pa.array(digests_of(texts), pa.binary())])
    return cut(made.withColumn("part", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id()), "digests")


STATE = "bucket int, digests binary, best binary"
_OUT = "bucket int, digest binary, part int, keep_id bigint, keep_row bigint, size bigint, digests binary, best binary"


def _arrays(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    digests = np.frombuffer(b"".join(rows.column("digest").to_pylist()), np.uint64).reshape(-1, 4)
    ids = rows.column("doc_id")
    best = np.stack([ids.is_null().to_numpy().astype(np.int64), ids.fill_null(0).to_numpy(), rows.column("row").to_numpy(),
                     rows.column("n").to_numpy()], axis=1).astype(np.int64)
    return digests, best


def _bucket(deleted: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Work of one bucket: its state and what is new; one row per partial group, and one of state."""
    schema = pa.schema([("bucket", pa.int32()), ("digest", pa.binary()), ("part", pa.int32()), ("keep_id", pa.int64()),
                        ("keep_row", pa.int64()), ("size", pa.int64()), ("digests", pa.binary()), ("best", pa.binary())])

    def run(new: pa.Table, old: pa.Table) -> pa.Table:
        state = old.slice(0, 1).to_pylist()
        bucket = (state[0] if state else new.slice(0, 1).to_pylist()[0])["bucket"]
        index = CuckooIndex.load(4, *((state[0]["digests"], state[0]["best"]) if state else (None, None)))
        if deleted:
            gone = new.filter(new.column("gone"))
            if len(gone):
                index.delete(np.unique(_arrays(gone)[0], axis=0))
            new = new.filter(pc.invert(new.column("gone")))
        digests, best = _arrays(new)
        for k in range(0, len(digests), BATCH):
            absorb(index, digests[k:k + BATCH], best[k:k + BATCH])
        held = index.best[index.find(digests)] if len(digests) else best
        n, nothing = len(new), pa.nulls
        answers = pa.table([
            pa.array(np.full(n, bucket), pa.int32()), new.column("digest").cast(pa.binary()), new.column("part").cast(pa.int32()),
            pa.array(held[:, ID], pa.int64(), mask=held[:, NONE] == 1), pa.array(held[:, ROW], pa.int64()), pa.array(held[:, SIZE], pa.int64()),
            nothing(n, pa.binary()), nothing(n, pa.binary())], schema=schema)
        own = pa.table([pa.array([bucket], pa.int32()), *[nothing(1, t) for t in schema.types[1:6]],
                        *[pa.array([x], pa.binary()) for x in index.state()]], schema=schema)
        return pa.concat_tables([answers, own])

    return run


def buckets_for(rows: int) -> int:
    """Buckets, a power of two, of about ``BUCKET_ROWS`` digests each."""
    return 1 << max(3, (rows // BUCKET_ROWS).bit_length())


def update(rows: DataFrame, buckets: int, index: DataFrame | None = None, deleted: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Take ``rows`` (of ``digest_rows``) into the index after taking out the digests of ``deleted``.

    Returns ``digest, part, keep_id, keep_row, size`` of the groups that ``rows`` touch, and the index with
    them in it (``bucket, digests, best``; None stands for the empty one).  ``buckets`` must stay what it was when
    the index began.  Row numbers of several batches are compared only where ids are equal.
    """
    spark = rows.sparkSession
    best = F.max(F.struct("doc_id", "row")).alias("best")  # nulls are smallest
    new = rows.groupBy("digest", "part").agg(best, F.count(F.lit(1)).alias("n")).select(
        "digest", "part", "best.doc_id", "best.row", "n", F.lit(False).alias("gone"))
    if deleted is not None:
        new = new.union(deleted.select("digest").distinct().select(
            "digest", F.lit(0), F.lit(None).cast("bigint"), F.lit(0).cast("bigint"), F.lit(0).cast("bigint"), F.lit(True)))
    head = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("bigint")
    dealt = new.withColumn("bucket", (head % buckets).cast("int"))
    old = spark.createDataFrame([], STATE) if index is None else index
    out = cut(dealt.groupBy("bucket").cogroup(old.groupBy("bucket")).applyInArrow(_bucket(deleted is not None), _OUT), "cuckoo")
    answers = out.where("digest IS NOT NULL").select("digest", "part", "keep_id", "keep_row", "size")
    return answers, out.where("digest IS NULL").select("bucket", "digests", "best")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row."""
    rows = digest_rows(docs)
    answers, _ = update(rows, buckets_for(rows.count()))
    # most texts are their own group: they need no partner in the join
    groups = answers.where("size > 1").select(F.col("digest").alias("of"), F.col("part").alias("in"), "keep_id", "keep_row", "size")
    joined = rows.join(groups, (F.col("digest") == F.col("of")) & (F.col("part") == F.col("in")), "left")
    alone = F.col("size").isNull()
    return joined.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                         F.coalesce("size", F.lit(1)).cast("bigint").alias("group_size"),
                         (alone | (F.col("row") == F.col("keep_row"))).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE_SQL = """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
           FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM d
"""
