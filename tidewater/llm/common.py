"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.session import scratch_path

BLOCK_BYTES = 4 << 20  # text handled by one numpy pass; one longer text is a block of its own


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    """A parquet table of the data folder, pruned to ``columns``."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
    return df.select(*columns) if columns else df


#: Spark's setting to remove a query's shuffle files when it has ended
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: a lost executor re-reads files instead of recomputing,
    and readers see one fixed version of the rows.  The shuffle files of the writing query
    are removed with it, as nothing reads them again.  ``discard`` removes the table.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._cuts = [path]
    return out


def united(frames: list[DataFrame]) -> DataFrame:
    """The union of written tables, which ``discard`` removes together."""
    out = reduce(DataFrame.union, frames)
    out._cuts = [p for f in frames for p in vars(f).get("_cuts", [])]
    return out


def discard(*frames: DataFrame | None) -> None:
    """Remove the tables that ``cut`` wrote for these frames; nothing may read them again."""
    for frame in frames:
        for path in vars(frame).pop("_cuts", []) if frame is not None else []:
            try:
                sc = frame.sparkSession.sparkContext
            except Exception:  # a remote session: the tables stay in the scratch folder
                return
            place = sc._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(sc._jsc.hadoopConfiguration()).delete(place, True)


def held_out(doc_id: str = "doc_id") -> Column:
    """True where crc32 of the id's text leaves 0 modulo 5 (null id: false)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


class Texts:
    """A run of texts of one Arrow column: UTF-8 bytes and row offsets."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Texts]:
    """Cut a string column into runs of rows of about ``limit`` bytes; null counts as empty."""
    if len(column) == 0:
        return
    column = column.cast(pa.large_string()).fill_null("")
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(column))
        lo, hi = offsets[first], offsets[last]
        yield Texts(data[lo:hi], offsets[first:last + 1] - lo)
        first = last


def map_texts(df: DataFrame, text: str, keep: list[str], fields: list[T.StructField],
              start: Callable[[], Callable[[Texts], list]],
              where: Callable[[list], np.ndarray] | None = None) -> DataFrame:
    """Columns ``keep`` of every row with columns computed from its text.

    ``start()`` runs once per task and returns the function from a run of texts
    to one array per field.  ``where`` turns those arrays into a row mask.  A
    computed column replaces a kept one of the same name.
    """
    names = [f.name for f in fields]
    keep = [c for c in keep if c not in names]
    schema = T.StructType([df.schema[c] for c in keep] + fields)
    needed = keep + ([text] if text not in keep else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = start()
        for batch in batches:
            at = 0
            for block in text_blocks(batch.column(needed.index(text))):
                rows = batch.slice(at, len(block))
                at += len(block)
                made = compute(block)
                out = [rows.column(i) for i in range(len(keep))]
                out += [x if isinstance(x, pa.Array) else pa.array(x) for x in made]
                result = pa.RecordBatch.from_arrays(out, names=keep + names)
                yield result if where is None else result.filter(pa.array(where(made)))

    return df.select(*needed).mapInArrow(run, schema)
