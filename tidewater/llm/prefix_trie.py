"""Prefix trie of rebuilt conversations, read off their sorted order.

A conversation is a sequence of turns; a turn is the 16-byte digest of its role and text, so a sequence is
one binary value whose byte order is the order of its turns.  Equal sequences are one row with their number
of conversations.  The distinct sequences are range-partitioned and sorted.  In the sorted order the members of
a prefix are an interval, bounded where the length of the common prefix (LCP) of two neighbours falls below the
prefix's depth.  Every range keeps its LCPs in a sparse table (minima of runs of 2, 4, 8, ... LCPs);
each candidate prefix binary-searches its left and its right extent in it, independently of all
others: no stack, no walk over the trie.  Members, leaves and bytes of an interval are differences of
prefix sums, its smallest member a minimum from a second sparse table.

A range also knows the LCP to its neighbours' nearest sequences.  A prefix whose interval reaches such a
border with a long enough LCP is *open*: its piece of sums is added to the other ranges' pieces under the
digest of the prefix.  Only prefixes of a range's first and last sequence can be open, so pieces are
few however large the prefix's group is.

Edge rows: a null conv_id is no conversation, its rows take no part; turns are ordered with null first, turns that
tie by the digest of role and text (repeated rows are turns of their own); null role or text is empty.  An
empty table has no root and gives no rows.  Texts are read whole and only their digests and byte lengths are carried.  A
conversation's turn digests (24 bytes a turn) are one row, as a document's text is.  Only ``conv_id, turn,
role, text`` are read, so further columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

WIDTH = 16             # bytes of a turn's digest
RANGE_ROWS = 1 << 16    # distinct sequences, and
RANGE_TURNS = 1 << 20   # turns of them, that one range is sized for
CHUNK = 1 << 16         # ids joined at a time
NO_ENDS = hashlib.sha256(b"").hexdigest()


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id, seq, sizes``: turn digests in order, joined, and the UTF-8 bytes of the turns' texts."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.struct("turn", digest.alias("digest"), F.octet_length(text).cast("bigint").alias("size")).alias("t"))
    every = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))  # null turns first
    return every.select("conv_id", F.unhex(F.array_join(F.transform("t", lambda t: t["digest"]), "")).alias("seq"),
                        F.transform("t", lambda t: t["size"]).alias("sizes"))


def rebuild(own: DataFrame, every: int = 5, heads: int = 9) -> DataFrame:
    """Each conversation c with its first h turns replaced by those of conversation c - c % ``every``.

    h is the unsigned crc32 of the decimal id modulo ``heads``; a donor that has fewer gives all, an absent one none.
    """
    donors = own.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("donor"), F.substring("seq", 1, WIDTH * (heads - 1)).alias("head"), F.slice("sizes", 1, heads - 1).alias("head_sizes"))
    h = (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")
    joined = own.withColumn("h", h).join(donors, F.col("conv_id") - F.col("conv_id") % every == F.col("donor"), "left")
    return joined.selectExpr(
        "conv_id", f"concat(coalesce(substring(head, 1, {WIDTH} * h), X''), substring(seq, {WIDTH} * h + 1)) AS seq",
        "concat(coalesce(slice(head_sizes, 1, h), array()), slice(sizes, h + 1, size(sizes))) AS sizes")


def _id_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (of, conv_id) -> runs of equal ``of``: first id, number, ids joined by commas."""
    for batch in batches:
        of, ids = batch.column(0).to_pylist(), batch.column(1).to_numpy()
        start = [k for k in range(len(of)) if k % CHUNK == 0 or of[k] != of[k - 1]] + [len(of)]
        spans = list(zip(start[:-1], start[1:], strict=True))
        yield pa.RecordBatch.from_pydict({
            "of": pa.array([of[a] for a, _ in spans], pa.binary()), "first": pa.array([ids[a] for a, _ in spans], pa.int64()),
            "n": pa.array([b - a for a, b in spans], pa.int64()),
            "ids": pa.array([",".join(map(str, ids[a:b].tolist())) for a, b in spans], pa.string())})


def _id_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks sorted by (of, first) -> one row per ``of``: smallest id, number, SHA-256 of all ids joined."""
    now, first, n, digest = None, None, 0, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"of": pa.array([now], pa.binary()), "first": pa.array([first], pa.int64()),
                                           "n": pa.array([n], pa.int64()), "ends": pa.array([digest.hexdigest()], pa.string())})

    for batch in batches:
        done = []
        for r in batch.to_pylist():
            if r["of"] != now:
                if now is not None:
                    done.append(row())
                now, first, n, digest = r["of"], r["first"], 0, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(r["ids"].encode())
            n += r["n"]
        if done:
            yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
    if now is not None:
        yield row()


def distinct_sequences(rebuilt: DataFrame) -> DataFrame:
    """``seq, sizes, n, first, ends`` of every distinct sequence: members, smallest member, digest of the members' ids.

    The (sequence, id) pairs are sorted over ranges, so a sequence of many conversations is joined by many tasks.
    """
    rows = rebuilt.withColumn("of", F.unhex(F.sha2("seq", 256)))
    chunks = (rows.select("of", "conv_id").repartitionByRange("of", "conv_id").sortWithinPartitions("of", "conv_id")
              .mapInArrow(_id_chunks, "of binary, first bigint, n bigint, ids string"))
    groups = (chunks.repartition("of").sortWithinPartitions("of", "first")
              .mapInArrow(_id_digests, "of binary, first bigint, n bigint, ends string"))
    named = groups.withColumnRenamed("first", "conv_id")
    return rows.join(named, ["of", "conv_id"]).select("seq", "sizes", "n", F.col("conv_id").alias("first"), "ends")


class SparseTable:
    """Minima of all runs of 2^k neighbours of ``values``."""

    def __init__(self, values: np.ndarray):
        self.n, self.levels = len(values), [values]
        while 2 << (len(self.levels) - 1) <= self.n:
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def least(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Minimum of values[a..b], ends included."""
        out = np.empty(len(a), self.levels[0].dtype)
        level = np.frexp((b - a + 1).astype(np.float64))[1] - 1
        for k, values in enumerate(self.levels):
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(values[a[at]], values[b[at] - (1 << k) + 1])
        return out

    def right(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Steps right of ``at`` over values of ``depth`` or more: the first values are those at ``at``."""
        end = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            values = self.levels[k]
            fits = end + (1 << k) <= self.n
            fits[fits] = values[end[fits]] >= depth[fits]
            end[fits] += 1 << k
        return end

    def left(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Steps left of ``at`` over values of ``depth`` or more: the first value is the one before ``at``."""
        end = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            values = self.levels[k]
            fits = end >= 1 << k
            fits[fits] = values[end[fits] - (1 << k)] >= depth[fits]
            end[fits] -= 1 << k
        return end


def common_prefixes(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """LCP of each sequence with the one before it; ``flat`` holds all turns, two words each."""
    least = np.minimum(length[:-1], length[1:])
    pair = np.repeat(np.arange(len(least)), least)
    turn = np.arange(len(pair)) - np.repeat(np.cumsum(least) - least, least)
    differ = np.flatnonzero((flat[start[pair] + turn] != flat[start[pair + 1] + turn]).any(axis=1))
    which, first = np.unique(pair[differ], return_index=True)
    out = least.copy()
    out[which] = turn[differ[first]]
    return out


def _prefix_keys(seq: bytes) -> list[bytes]:
    """Digest of every prefix of a sequence, the empty one first."""
    digest, keys = hashlib.sha256(), []
    for k in range(0, len(seq) + 1, WIDTH):
        keys.append(digest.copy().digest())
        digest.update(seq[k:k + WIDTH])
    return keys


_NODES = ("range int, key binary, parent_key binary, depth bigint, conv_id bigint, parent_conv_id bigint, n_convs bigint, "
          "n_children bigint, n_leaves bigint, saved_tokens bigint, ends string")
_ARROW = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "string": pa.string()}


def range_nodes(rows: pa.Table, border: pa.Table) -> pa.Table:
    """Nodes and open pieces of one range of sorted distinct sequences."""
    rows = rows.take(np.argsort(np.array(rows.column("seq").to_pylist(), object), kind="stable"))
    seqs, edge = rows.column("seq").to_pylist(), border.to_pylist()[0]
    n, many = len(seqs), rows.column("n").to_numpy()
    first, ends = rows.column("first").to_numpy(), np.array(rows.column("ends").to_pylist(), object)
    length = np.array([len(s) // WIDTH for s in seqs], np.int64)
    start = np.cumsum(length) - length
    flat = np.frombuffer(b"".join(seqs), np.uint64).reshape(-1, 2)
    sizes = rows.column("sizes").combine_chunks().flatten().to_numpy().astype(np.int64)
    sums = np.concatenate([[0], np.cumsum(sizes)])

    def size_upto(i: np.ndarray, d: np.ndarray) -> np.ndarray:
        """Bytes of the first ``d`` turns (none where negative)."""
        return sums[start[i] + np.maximum(d, 0)] - sums[start[i]]

    inner = common_prefixes(flat, start, length)
    before, after = edge["before"], edge["after"]
    lcp = np.concatenate([[before], inner, [after]])  # lcp[i]: with the sequence before i
    table = SparseTable(inner)
    every = np.arange(n)

    # candidates: the prefixes that first appear at a sequence; at the first one, all of its prefixes
    lowest = lcp[:n] + 1
    lowest[0] = 0
    count = length - lowest + 1
    base = np.cumsum(count) - count
    at = np.repeat(every, count)
    depth = np.arange(len(at)) - np.repeat(base - lowest, count)
    left, right = table.left(at, depth), table.right(at, depth)
    open_left, open_right = (left == 0) & (before >= depth), (right == n - 1) & (after >= depth)
    parent_left = table.left(at, depth - 1)
    parent = np.where(depth > 0, base[parent_left] + depth - 1 - lowest[parent_left], -1)

    def total(values: np.ndarray, a: np.ndarray) -> np.ndarray:
        upto = np.concatenate([[0], np.cumsum(values)])
        return upto[right + 1] - upto[a]

    members, whole = total(many, left), size_upto(every, length)
    leaves = total((lcp[1:] < length).astype(np.int64), left)
    # bytes of all members below the parent, less those of the distinct turns
    held = total(many * whole, left) - members * size_upto(left, depth - 1)
    added = whole - size_upto(every, lcp[:n])
    distinct = np.where(open_left, total(added, left), whole[left] - size_upto(left, depth - 1) + total(added, left + 1))
    smallest = SparseTable(first).least(left, right)
    children = np.bincount(parent[~open_left & (depth > 0)], minlength=len(at))

    opened = open_left | open_right
    keys_first, keys_last = _prefix_keys(seqs[0]), _prefix_keys(seqs[-1])
    keys = np.full(len(at) + 1, None, object)  # the last place answers for the root's parent
    for k in np.flatnonzero(opened):
        keys[k] = (keys_first if open_left[k] else keys_last)[depth[k]]
    known = (parent >= 0) & ~opened[parent]
    ended = ~open_left & (depth == length[left])
    columns = {"range": np.full(len(at), edge["range"]), "key": keys[:-1], "parent_key": keys[parent], "depth": depth, "conv_id": smallest,
               "parent_conv_id": pa.array(smallest[parent], pa.int64(), mask=~known), "n_convs": members, "n_children": children,
               "n_leaves": leaves, "saved_tokens": held - distinct, "ends": np.where(ended, ends[left], None)}
    types = [field.split() for field in _NODES.split(", ")]
    return pa.table([pa.array(columns[c], _ARROW[t]) for c, t in types], names=[c for c, _ in types])


def _borders(dealt: DataFrame) -> DataFrame:
    """``range, before, after``: LCP of a range's outer sequences with their neighbours (-1: none); one row per range."""
    outer = dealt.groupBy("range").agg(F.min("seq").alias("low"), F.max("seq").alias("high"))
    order = Window.orderBy("range")  # ranges are few: one for RANGE_ROWS sequences
    beside = outer.select("range", "low", "high", F.lag("high").over(order).alias("prior"), F.lead("low").over(order).alias("next"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def common(a: bytes | None, b: bytes | None) -> int:
            if a is None or b is None:
                return -1
            m = min(len(a), len(b)) // WIDTH
            same = (np.frombuffer(a, np.uint64, 2 * m) == np.frombuffer(b, np.uint64, 2 * m)).reshape(m, 2).all(axis=1)
            return m if same.all() else int(np.argmin(same))

        for batch in batches:
            rows = batch.to_pylist()
            yield pa.RecordBatch.from_pydict({
                "range": pa.array([r["range"] for r in rows], pa.int32()),
                "before": pa.array([common(r["prior"], r["low"]) for r in rows], pa.int64()),
                "after": pa.array([common(r["high"], r["next"]) for r in rows], pa.int64())})

    return beside.mapInArrow(measure, "range int, before bigint, after bigint")


def trie(rebuilt: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """One row per node of the prefix trie of ``rebuilt`` (``conv_id, seq, sizes``, one row per conversation)."""
    distinct = cut(distinct_sequences(rebuilt), "sequences")
    held = distinct.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.size("sizes")), F.lit(0)).alias("turns")).first()
    ranges = max(1, -(-held.rows // range_rows), -(-held.turns // RANGE_TURNS))
    dealt = cut(distinct.repartitionByRange(ranges, "seq").withColumn("range", F.spark_partition_id()), "ranges")
    borders = cut(_borders(dealt), "borders")
    found = cut(dealt.groupBy("range").cogroup(borders.groupBy("range")).applyInArrow(range_nodes, _NODES), "trie-nodes")

    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    pieces = found.where("key IS NOT NULL")
    opened = cut(pieces.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"),
                                           F.first("parent_key").alias("parent_key"), F.max("ends").alias("ends"), *sums), "trie-open")
    # an open parent's smallest member, known to each range that has a piece of it
    named = pieces.select("range", "key").join(opened.select("key", F.col("conv_id").alias("above")), "key")
    closed = found.where("key IS NULL").join(named.withColumnRenamed("key", "parent_key"), ["range", "parent_key"], "left")
    above = opened.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    whole = closed.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above")).select(*columns).unionByName(
        opened.join(above, "parent_key", "left").withColumn("parent_conv_id", F.col("above")).select(*columns))
    return whole.withColumn("ends_sha256", F.coalesce("ends", F.lit(NO_ENDS))).drop("ends")


def prefix_trie(conversations: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The trie of the conversations, rebuilt with their donors' first turns."""
    return trie(cut(rebuild(cut(sequences(conversations), "turns")), "rebuilt"), range_rows)


ORACLE_SQL = """
WITH own AS (
  SELECT conv_id, list(struct_pack(k := k, b := b) ORDER BY turn NULLS FIRST, k) AS t FROM (
    SELECT conv_id, turn, md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
           strlen(coalesce(text, ''))::BIGINT AS b FROM conversations WHERE conv_id IS NOT NULL) GROUP BY conv_id),
headed AS (
  SELECT *, (xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length(conv_id::VARCHAR) + 1),
                 lambda i: [ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
               lambda a, b: xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1))), 4294967295) % 9) AS h FROM own),
rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(d.t[1:o.h], []), o.t[o.h + 1:]) AS t
  FROM headed o LEFT JOIN own d ON d.conv_id = o.conv_id - o.conv_id % 5),
steps AS (SELECT conv_id, t, unnest(range(0, len(t) + 1)) AS depth FROM rebuilt),
nodes AS (
  SELECT depth, array_to_string(list_transform(t[1:depth], lambda x: x.k), '') AS prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(any_value(t[depth].b), 0) AS b,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(t) = depth), '')) AS ends_sha256
  FROM steps GROUP BY ALL HAVING count(*) > 0),
families AS (SELECT left(prefix, 32 * (depth - 1)) AS prefix, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
grown AS (SELECT n.*, coalesce(f.n_children, 0) AS n_children FROM nodes n LEFT JOIN families f USING (prefix, depth)),
subtrees AS (
  SELECT left(prefix, 32 * k) AS prefix, k AS depth, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * b) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS k FROM grown) GROUP BY ALL)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves::BIGINT AS n_leaves,
       s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM grown n JOIN subtrees s USING (prefix, depth)
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = left(n.prefix, 32 * (n.depth - 1))
"""
