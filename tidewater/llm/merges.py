"""Byte-level BPE by merge replay over a body of text.

All distinct pre-tokens of a block of documents are laid out as one array of
symbols.  An inverted index from token rank to the places whose pair makes that
token is filled once; the ranks are then replayed in ascending order, each over
all of its places together, and only the pairs beside a merged place are looked
up again.  Pre-tokens are independent of each other, so replaying block by block
gives the same ids as one replay over the corpus, without moving any text.
A pre-token that is itself a token is that token, as in the public encoder.

Null texts count as empty; empty texts have no ids.  Texts of any length are encoded whole.  Every row is
encoded by itself, so repeated rows keep their rows; an empty table stays empty.  Of the columns only ``text`` and
those in ``keep`` are read; a computed column replaces a kept one of its name.  Equal ranks do not
occur, and of places that make the same token the left one merges first.  The vocabulary
file is read once on the driver (under 1 MB) and broadcast.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import Texts, map_texts
from .pretokens import WordTable


class Vocabulary:
    """Ranks of a ``.tiktoken`` file with the tables the replay needs."""

    def __init__(self, file: bytes):
        self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file.splitlines())}
        size = max(self.rank.values()) + 1
        tokens = [b""] * size
        keys, makes = [], []
        self.early = np.zeros(size, bool)  # a piece of a token that ranks before it
        for token, r in self.rank.items():
            tokens[r] = token
            for k in range(1, len(token)):
                a, b = self.rank.get(token[:k]), self.rank.get(token[k:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    makes.append(r)
                    self.early[[x for x in (a, b) if x > r]] = True
        order = np.argsort(keys)
        self.pair, self.makes = np.array(keys, np.int64)[order], np.array(makes, np.int64)[order]
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def rank_of(self, key: np.ndarray) -> np.ndarray:
        """Rank of the token each pair makes, -1 for none."""
        i = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[i] == key, self.makes[i], -1)

    def encode(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of byte spans, flat, and the count of each."""
        whole = np.array([self.rank.get(data[s:s + n].tobytes(), -1)
                          for s, n in zip(starts.tolist(), lengths.tolist(), strict=True)], np.int64)
        rest = np.flatnonzero(whole < 0)
        parts, many = self.replay(data, starts[rest], lengths[rest])
        counts = np.ones(len(starts), np.int64)
        counts[rest] = many
        ids = np.zeros(counts.sum(), np.int64)
        at = np.cumsum(counts) - counts
        ids[at[whole >= 0]] = whole[whole >= 0]
        ids[np.repeat(at[rest] - (np.cumsum(many) - many), many) + np.arange(len(parts))] = parts
        return ids, counts

    def replay(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Apply every merge, in rank order, to the spans laid end to end."""
        total = int(lengths.sum())
        first = np.cumsum(lengths) - lengths
        sym = np.append(self.byte[data[np.repeat(starts - first, lengths) + np.arange(total)]], -1)
        after, before = np.arange(1, total + 2), np.arange(-1, total)
        after[first + lengths - 1] = total  # the place past the end holds no symbol
        before[first] = -1
        index: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        queue: list[int] = []

        def enter(place: np.ndarray) -> None:
            """Index the pairs that begin at ``place`` by the rank of what they make."""
            key = sym[place] << 32 | sym[after[place]]
            rank = self.rank_of(key)
            real = rank >= 0
            if real.any():
                place, key, rank = place[real], key[real], rank[real]
                order = np.argsort(rank, kind="stable")
                place, key, rank = place[order], key[order], rank[order]
                cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
                for r, p, k in zip(rank[np.append(0, cuts)].tolist(), np.split(place, cuts),
                                   np.split(key, cuts), strict=True):
                    if r not in index:
                        index[r] = []
                        heapq.heappush(queue, r)
                    index[r].append((p, k))

        enter(np.flatnonzero(after[:total] < total))
        while queue:
            r = heapq.heappop(queue)
            found = index.pop(r)
            place, key = found[0] if len(found) == 1 else map(np.concatenate, zip(*found, strict=True))
            live = sym[place] << 32 | sym[after[place]] == key  # a dead place has symbol -1
            place, key = place[live], key[live]
            if not len(place):
                continue
            if len(place) > 1:
                place, at = np.unique(place, return_index=True)
                key = key[at]
                if self.early[r]:  # a new pair may rank before r: one merge per pre-token, then look again
                    word = np.searchsorted(first, place, "right")
                    lead = np.append(True, word[1:] != word[:-1])
                    if not lead.all():
                        index[r] = [(place[~lead], key[~lead])]
                        heapq.heappush(queue, r)
                        place = place[lead]
                else:  # of overlapping pairs the first, third, ... are merged
                    chained = np.append(False, place[1:] == after[place[:-1]])
                    if chained.any():
                        step = np.arange(len(place))
                        place = place[(step - np.maximum.accumulate(np.where(chained, 0, step))) % 2 == 0]
            gone = after[place]
            right = after[gone]
            sym[place], sym[gone] = r, -1
            after[place] = right
            before[right] = place
            left = before[place]
            left = left[left >= 0]
            enter(np.unique(np.concatenate([left, place[right < total]])))
        live = np.flatnonzero(sym[:total] >= 0)
        return sym[live], np.bincount(np.searchsorted(first, live, "right") - 1, minlength=len(first))

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of the ids, one after another."""
        n = self.length[ids]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        return self.bytes[np.repeat(self.start[ids] - (ends - n), n) + np.arange(total)]


_LOADED: dict[str, tuple[Vocabulary, WordTable]] = {}


def _loaded(file: Broadcast) -> tuple[Vocabulary, WordTable]:
    """The vocabulary and the word table of this worker, kept between its tasks."""
    name = hashlib.sha256(file.value).hexdigest()
    if name not in _LOADED:
        vocabulary = Vocabulary(file.value)
        _LOADED[name] = vocabulary, WordTable(vocabulary.encode)
    return _LOADED[name]


def _broadcast(spark: SparkSession, path: str) -> Broadcast:
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode_texts(docs: DataFrame, path: str, keep: list[str], out: str = "ids") -> DataFrame:
    """``keep`` and the token ids of each whole text as ``array<int>``."""
    file = _broadcast(docs.sparkSession, path)

    def start():
        table = _loaded(file)[1]

        def encode(texts: Texts) -> list:
            ids, bounds = table.ids(texts)
            return [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))]
        return encode

    return map_texts(docs, "text", keep, [T.StructField(out, T.ArrayType(T.IntegerType()))], start)


def decode_ids(encoded: DataFrame, path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """``encoded`` with the text that its ids stand for (null ids: null text)."""
    file = _broadcast(encoded.sparkSession, path)
    columns = [c for c in encoded.columns if c != out]
    schema = T.StructType([encoded.schema[c] for c in columns] + [T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _loaded(file)[0]
        for batch in batches:
            texts = [None if x is None else vocabulary.decode(np.array(x, np.int64)).tobytes().decode("utf-8", "replace")
                     for x in batch.column(columns.index(ids)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=columns + [out])

    return encoded.select(*columns).mapInArrow(run, schema)


def digests(docs: DataFrame, path: str, keep: list[str]) -> DataFrame:
    """``keep``, ``n_tokens`` and the SHA-256 of the ids and of the bytes decoded from them."""
    file = _broadcast(docs.sparkSession, path)

    def start():
        vocabulary, table = _loaded(file)

        def digest(texts: Texts) -> list:
            ids, bounds = table.ids(texts)
            raw = memoryview(ids.astype("<u4").tobytes())
            decoded = memoryview(vocabulary.decode(ids).tobytes())
            sizes = np.concatenate([[0], np.cumsum(vocabulary.length[ids])])[bounds].tolist()
            spans = bounds.tolist()
            hex_of = lambda view, cuts, k: [
                hashlib.sha256(view[a * k:b * k]).hexdigest() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            return [np.diff(bounds), pa.array(hex_of(raw, spans, 4)), pa.array(hex_of(decoded, sizes, 1))]
        return digest

    return map_texts(docs, "text", keep, [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                                          T.StructField("decoded_sha256", T.StringType())], start)
