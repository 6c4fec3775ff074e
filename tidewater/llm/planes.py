"""Token-id files by bit-plane shuffling.

Ids of all documents, in ascending id order (null ids last, ties by text), are cut
into blocks of a fixed number of ids.  A block is transposed into planes, the first
holding the lowest byte (or bit) of every id, and so on; each plane is
compressed with zstandard by itself.  High planes are nearly constant and shrink to
almost nothing; low planes no longer interrupt them.

The container is a folder that Spark's own writer commits, so it lives on any file
system Spark writes to and a lost task leaves nothing behind:

* ``chunks/``: one row per block: ``part, chunk, first`` (place of its first id in the
  part), ``n_ids``, ``planes`` (array of compressed planes) and the documents
  that begin in it (``doc_ids, doc_firsts, doc_sizes``);
* ``index/``: the chunk index: ``part, chunk, start`` (place in the whole stream),
  ``n_ids, n_bytes``.

Null and empty texts hold the end id alone.  An empty table gives empty folders.  A text is
cut at the vocabulary's added tokens first, as the library does; what lies between is encoded.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewater.session import scratch_path

from .common import Texts, text_blocks
from .pretokens import WordTable

CHUNK_IDS = 1 << 16
END_ID = 0
LEVEL = 3
CHUNKS = ("part int, chunk int, first bigint, n_ids int, planes array<binary>, "
          "doc_ids array<bigint>, doc_firsts array<bigint>, doc_sizes array<bigint>")


def to_planes(ids: np.ndarray, kind: str = "byte", level: int = LEVEL) -> list[bytes]:
    """The compressed byte or bit planes of a block of 32-bit ids, lowest first."""
    cells = np.ascontiguousarray(ids.astype("<u4")).view(np.uint8).reshape(-1, 4)
    if kind == "bit":
        cells = np.packbits(np.unpackbits(cells, axis=1, bitorder="little"), axis=0, bitorder="little")
    packer = zstandard.ZstdCompressor(level=level)
    return [packer.compress(np.ascontiguousarray(plane).tobytes()) for plane in cells.T]


def from_planes(planes: list[bytes], n_ids: int) -> np.ndarray:
    """The ids of a block; 4 planes are bytes, 32 are bits."""
    opener = zstandard.ZstdDecompressor()
    cells = np.stack([np.frombuffer(opener.decompress(p), np.uint8) for p in planes], axis=1)
    if len(planes) == 32:
        cells = np.packbits(np.unpackbits(cells, axis=0, count=n_ids, bitorder="little"), axis=1, bitorder="little")
    return np.ascontiguousarray(cells).view("<u4").reshape(-1)[:n_ids]


class LibraryEncoder:
    """Encodes distinct pre-tokens with the tokenizers library.

    Pre-tokens that begin with a space and a letter come apart again when they are
    written one after another, so they share calls; others get a call each.
    """

    def __init__(self, file: str):
        self.tokenizer = Tokenizer.from_str(file)
        self.tokenizer.encode_special_tokens = True  # texts are cut at them before (AddedTokens)
        size = self.tokenizer.get_vocab_size()
        special = {i for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special}
        # the alphabet of byte-level vocabularies has one character for each byte
        self.length = np.array([0 if i in special else len(self.tokenizer.id_to_token(i) or "") for i in range(size)])

    def __call__(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        second = data[np.minimum(starts + 1, len(data) - 1)]
        joins = (data[starts] == 0x20) & (lengths > 1) & ((second | 0x20) >= 0x61) & ((second | 0x20) <= 0x7A)
        many = np.zeros(len(starts), np.int64)
        parts: list[np.ndarray] = []
        raw, places = data.tobytes(), []
        together, alone = np.flatnonzero(joins), np.flatnonzero(~joins)
        calls = [together[k:k + 512] for k in range(0, len(together), 512)] + [alone[k:k + 1] for k in range(len(alone))]
        cut = [b"".join(raw[starts[i]:starts[i] + lengths[i]] for i in call).decode() for call in calls]
        for k in range(0, len(calls), 256):
            done = self.tokenizer.encode_batch_fast(cut[k:k + 256], add_special_tokens=False)
            for call, text in zip(calls[k:k + 256], done, strict=True):
                ids = np.array(text.ids, np.int64)
                ends = np.cumsum(self.length[ids])
                at = np.searchsorted(ends, np.cumsum(lengths[call]))
                if len(at) and not np.array_equal(ends[at], np.cumsum(lengths[call])):
                    raise ValueError("a pre-token was not encoded by itself")
                many[call] = np.diff(at, prepend=-1)
                parts.append(ids)
                places.append(call)
        flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        order = np.concatenate(places) if places else np.zeros(0, np.int64)
        ends = np.cumsum(many[order])
        begin = np.zeros(len(starts), np.int64)
        begin[order] = ends - many[order]
        goes = np.cumsum(many)
        return flat[np.repeat(begin - (goes - many), many) + np.arange(len(flat))], many


class AddedTokens:
    """Cuts texts at the vocabulary's added tokens, the leftmost and then the longest first.

    With ``encode_special_tokens`` (the library's switch of that name) special ones are
    ordinary text and only the others cut.
    """

    def __init__(self, file: str, encode_special_tokens: bool):
        found = {i: t for i, t in Tokenizer.from_str(file).get_added_tokens_decoder().items()
                 if not (t.special and encode_special_tokens)}
        if any(t.lstrip or t.rstrip or t.single_word for t in found.values()):
            raise ValueError("added tokens that take spaces or stand between words only are not supported")
        self.ids = {t.content.encode(): i for i, t in found.items()}
        longest = sorted(self.ids, key=len, reverse=True)
        self.pattern = re.compile(b"|".join(map(re.escape, longest))) if longest else None

    def __call__(self, texts: Texts) -> tuple[Texts, np.ndarray, np.ndarray]:
        """The pieces between added tokens, the id after each (a text's last: the end id), and
        the first piece of each text."""
        raw = texts.data.tobytes()
        if self.pattern is None or not self.pattern.search(raw):
            return texts, np.full(len(texts), END_ID), np.arange(len(texts))
        pieces, after, first = [], [], []
        for lo, hi in zip(texts.offsets[:-1].tolist(), texts.offsets[1:].tolist(), strict=True):
            first.append(len(pieces))
            for m in self.pattern.finditer(raw, lo, hi):
                pieces.append(raw[lo:m.start()])
                after.append(self.ids[m[0]])
                lo = m.end()
            pieces.append(raw[lo:hi])
            after.append(END_ID)
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in pieces])]).astype(np.int64)
        return Texts(np.frombuffer(b"".join(pieces), np.uint8), offsets), np.array(after), np.array(first)


_LOADED: dict[int, WordTable] = {}


def _table(file: str) -> WordTable:
    """The word table of this worker, kept between its tasks."""
    name = zlib.crc32(file.encode())
    if name not in _LOADED:
        _LOADED[name] = WordTable(LibraryEncoder(file))
    return _LOADED[name]


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, kind: str = "byte",
                 chunk_ids: int = CHUNK_IDS, encode_special_tokens: bool = True) -> None:
    """Encode every whole text, append the end id, and write the container.

    ``encode_special_tokens`` is the library's switch: false (the library's own default)
    gives a special token's string its id, true encodes it as ordinary text.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        file = spark.sparkContext.broadcast(f.read())  # the vocabulary: under 2 MB

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, added = _table(file.value), AddedTokens(file.value, encode_special_tokens)
        part = TaskContext.get().partitionId()
        rest, begun, first, chunk = [], [], 0, 0  # ids not written yet, documents that begin in them

        def pack(ids: np.ndarray) -> pa.RecordBatch:
            nonlocal first, chunk
            mine = [d for d in begun if d[1] < first + len(ids)]
            del begun[:len(mine)]
            row = {"part": part, "chunk": chunk, "first": first, "n_ids": len(ids), "planes": to_planes(ids, kind),
                   "doc_ids": [d[0] for d in mine], "doc_firsts": [d[1] for d in mine], "doc_sizes": [d[2] for d in mine]}
            first, chunk = first + len(ids), chunk + 1
            return pa.RecordBatch.from_pylist([row], schema=_ARROW)

        for batch in batches:
            at, doc_ids = 0, batch.column(0).to_pylist()
            for block in text_blocks(batch.column(1)):
                pieces, after, of = added(block)
                ids, bounds = table.ids(pieces)
                ids = np.insert(ids, bounds[1:], after)
                sizes = np.add.reduceat(np.diff(bounds) + 1, of)
                begins = first + sum(map(len, rest)) + np.cumsum(sizes) - sizes
                begun += zip(doc_ids[at:at + len(block)], begins.tolist(), sizes.tolist(), strict=True)
                at += len(block)
                rest.append(ids)
                if sum(map(len, rest)) >= chunk_ids:
                    ids = np.concatenate(rest)
                    full = len(ids) // chunk_ids * chunk_ids
                    for k in range(0, full, chunk_ids):
                        yield pack(ids[k:k + chunk_ids])
                    rest = [ids[full:]]
        ids = np.concatenate(rest) if rest else np.zeros(0, np.int32)
        if len(ids):
            yield pack(ids)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    order = [F.col("doc_id").asc_nulls_last()]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    dealt.mapInArrow(encode, CHUNKS).write.parquet(f"{folder}/chunks")
    chunks = spark.read.schema(CHUNKS).parquet(f"{folder}/chunks")
    size = F.aggregate("planes", F.lit(0).cast("bigint"), lambda total, plane: total + F.length(plane))
    index = chunks.select("part", "chunk", "first", "n_ids", size.alias("n_bytes"))
    (index.join(F.broadcast(_part_starts(index)), "part")
     .select("part", "chunk", (F.col("base") + F.col("first")).alias("start"), "n_ids", "n_bytes")
     .write.parquet(f"{folder}/index"))


_ARROW = pa.schema([("part", pa.int32()), ("chunk", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int32()),
                    ("planes", pa.list_(pa.binary())), ("doc_ids", pa.list_(pa.int64())),
                    ("doc_firsts", pa.list_(pa.int64())), ("doc_sizes", pa.list_(pa.int64()))])


def _part_starts(index: DataFrame) -> DataFrame:
    """Where each part begins in the whole stream: one row per write task, so it is
    bounded by the session's shuffle partitions."""
    parts = index.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    return parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files.

    Chunks of a part meet in one task in order and are opened one at a time; a part
    holds what one write task wrote.
    """
    chunks = spark.read.schema(CHUNKS).parquet(f"{folder}/chunks")
    index = spark.read.schema("part int, chunk int, start bigint, n_ids int, n_bytes bigint").parquet(f"{folder}/index")
    based = chunks.join(F.broadcast(index.where("chunk = 0").select("part", F.col("start").alias("base"))), "part")
    ordered = based.repartition("part").sortWithinPartitions("part", "chunk")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_docs: list[list] = []  # [id, start, size, crc, ids seen] of documents begun and not ended
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                raw = memoryview(from_planes(row["planes"], row["n_ids"]).astype("<u4").tobytes())
                at, end, done = row["first"], row["first"] + row["n_ids"], []
                open_docs += [[d, row["base"] + f, n, 0, f] for d, f, n in
                              zip(row["doc_ids"], row["doc_firsts"], row["doc_sizes"], strict=True)]
                for doc in open_docs:  # doc[4]: place in the part of the next id it needs
                    stop = min(doc[1] - row["base"] + doc[2], end)
                    doc[3] = zlib.crc32(raw[(doc[4] - at) * 4:(stop - at) * 4], doc[3])
                    doc[4] = stop
                    if stop == doc[1] - row["base"] + doc[2]:
                        done.append(doc)
                open_docs = [d for d in open_docs if d[4] < d[1] - row["base"] + d[2]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d[i] for d in done], pa.int64()) for i in range(4)],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return ordered.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def read_ids(spark: SparkSession, folder: str, start: int, n: int) -> np.ndarray:
    """A slice of the stream: the chunk index names the few chunks to open."""
    index = spark.read.parquet(f"{folder}/index").where((F.col("start") < start + n) & (F.col("start") + F.col("n_ids") > start))
    chunks = spark.read.schema(CHUNKS).parquet(f"{folder}/chunks").select("part", "chunk", "planes")
    rows = index.join(chunks, ["part", "chunk"]).orderBy("start").collect()
    if not rows:
        return np.zeros(0, np.uint32)
    ids = np.concatenate([from_planes(r.planes, r.n_ids) for r in rows])
    return ids[start - rows[0].start:start - rows[0].start + n]


def token_files(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the container into the shared folder and read every document back from it."""
    folder = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, tokenizer, folder, encode_special_tokens=False)
    return read_tokens(docs.sparkSession, folder)
