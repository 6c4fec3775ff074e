"""Streaming forms of the keyed operators, built on ``transformWithStateInPandas``.

All need the RocksDB state store provider (set by ``tidewater.session``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DoubleType, IntegerType, LongType, ShortType, StringType,
                               StructField, StructType, TimestampType)

from tidewater.session import ROCKSDB_PROVIDER
from tidewater.streaming.processors import (DIM, DIMENSION, MISSING, REC, RECORD, SIDE, EnrichProcessor,
                                            ProcessingTimeWindowProcessor, RunningReduceProcessor,
                                            RunningSumProcessor)

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
SALT, ORDER = "tw_salt", "tw_order"
BUCKETS = 64  # groups of ids of the streaming enrichment, each times the salts
# Tasks one key's records spread over in the streaming enrichment.
SALTS = 4


def _ensure_rocksdb(df: DataFrame) -> None:
    spark = df.sparkSession
    if spark.conf.get(_PROVIDER, "").endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(_PROVIDER, ROCKSDB_PROVIDER)


def _named_key(df: DataFrame, key: str) -> DataFrame:
    """``key`` as a text that is never null: state of a null integer key would
    otherwise be that of another key."""
    c = F.col(key)
    return df.withColumn(key, F.when(c.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), c.cast("string"))))


def _own_key(df: DataFrame, key: str, data_type) -> DataFrame:
    """The inverse of ``_named_key`` on a result."""
    c = F.col(key)
    return df.withColumn(key, F.when(c != "n", c.substr(F.lit(2), F.length(c)).cast(data_type)))


def _exact(df: DataFrame, value: str) -> DataFrame:
    """Integers without nulls, and a flag for the nulls: a null would turn the
    whole column of a batch into doubles on the way to pandas."""
    flagged = df.withColumn(MISSING, F.col(value).isNull())
    if not isinstance(df.schema[value].dataType, (ByteType, ShortType, IntegerType, LongType)):
        return flagged
    return flagged.withColumn(value, F.coalesce(F.col(value), F.lit(0).cast(df.schema[value].dataType)))


#: JSON that gives every value back: microseconds, and the offset of a timestamp
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def stream_enrich(records: DataFrame, dimension: DataFrame, key: str, record_cols, dim_cols,
                  order: str | None = None, clear_buffer: bool = False,
                  salts: int = SALTS, buckets: int = BUCKETS, buffer_ttl_ms: int | None = None) -> DataFrame:
    """Enrich a keyed record stream from a dimension stream with buffering.

    Both inputs are projected to one tagged schema, unioned and grouped by a bucket of
    ids and a salt: each task keeps only its buckets' state instead of a full broadcast copy, and a
    Python call handles a bucket's rows of a micro-batch together.  Records take a salt from a
    hash of their values, so one hot id's records spread over ``salts`` tasks (sized to the skew by
    the caller); every dimension row is copied to all salts, so each group sees the id's current
    value.  ``buckets`` must stay the same over restarts, as the state is kept by bucket.

    ``buffer_ttl_ms`` drops records that have waited so long for their id (by default they wait for
    ever).  It needs a processing-time trigger: such a query does not end under ``availableNow``.
    (For a static dimension use ``tidewater.operators.enrich``.)
    Output: ``key``, ``dim_cols``, ``record_cols``.
    """
    _ensure_rocksdb(records)
    # an inner join never matches a null key
    records, dimension = records.where(F.col(key).isNotNull()), dimension.where(F.col(key).isNotNull())
    record_cols, dim_cols = list(record_cols), list(dim_cols)
    rec_schema = StructType([records.schema[c] for c in record_cols])
    dim_schema = StructType([dimension.schema[c] for c in dim_cols])

    def side(df: DataFrame, tag: int, salt, columns: list[str], own: str) -> DataFrame:
        payload = F.to_json(F.struct(*[F.col(c) for c in columns]), _JSON) if columns else F.lit("{}")
        name = F.col(key).cast("string")
        texts = [payload.alias(c) if c == own else F.lit("").alias(c) for c in (DIM, REC)]
        rank = []
        if order:
            kind = dimension.schema[order].dataType
            rank = [F.col(order).alias(ORDER) if tag == DIMENSION else F.lit(None).cast(kind).alias(ORDER)]
        bucket = F.pmod(F.xxhash64(name), F.lit(buckets)) * salts + salt
        # both sides must give the state key the same (non-null) type on every run
        return df.select(name.alias(key), F.coalesce(bucket.cast("int"), F.lit(0)).alias(SALT), F.lit(tag).alias(SIDE), *texts, *rank)

    hashed = F.pmod(F.xxhash64(*[F.col(c) for c in record_cols]), F.lit(salts)) if record_cols else F.lit(0)
    copies = dimension.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    both = side(records, RECORD, hashed, record_cols, REC).unionByName(side(copies, DIMENSION, F.col(SALT), dim_cols, DIM))
    out = StructType([StructField(c, StringType()) for c in (key, DIM, REC)])
    proc = EnrichProcessor(key, order=ORDER if order else None, clear_buffer=clear_buffer, ttl_ms=buffer_ttl_ms)
    mode = "None" if buffer_ttl_ms is None else "ProcessingTime"
    found = both.groupBy(SALT).transformWithStateInPandas(proc, out, "Append", mode)
    made = found.select(F.col(key).cast(records.schema[key].dataType).alias(key),
                        F.from_json(DIM, dim_schema, _JSON).alias(DIM), F.from_json(REC, rec_schema, _JSON).alias(REC))
    return made.select(key, *[F.col(f"{DIM}.{c}").alias(c) for c in dim_cols], *[F.col(f"{REC}.{c}").alias(c) for c in record_cols])


def _running(df: DataFrame, key: str, order: str, value: str, out: str, emit: str) -> DataFrame:
    _ensure_rocksdb(df)
    integral = isinstance(df.schema[value].dataType, (ByteType, ShortType, IntegerType, LongType))
    total = LongType() if integral else DoubleType()
    if emit == "running":
        schema = StructType([df.schema[order], StructField(key, StringType()), StructField(out, total)])
    else:
        schema = StructType([df.schema[order], StructField("pos", IntegerType()),
                             StructField("op", StringType()), StructField(key, StringType()),
                             StructField(out, total)])
    proc = RunningSumProcessor(key, order, value, out, emit, integral)
    rows = _exact(_named_key(df.select(key, order, value), key), value)
    return _own_key(rows.groupBy(key).transformWithStateInPandas(proc, schema, "Append", "None"), key, df.schema[key].dataType)


def stream_running_sum(df: DataFrame, key: str, order: str, value: str, out: str = "running") -> DataFrame:
    """Exact per-record running sum on a stream (one output row per input row)."""
    return _running(df, key, order, value, out, "running")


def stream_changelog(df: DataFrame, key: str, order: str, value: str, out: str = "s") -> DataFrame:
    """Changelog rows (``+I``/``-U``/``+U``) of ``SUM(value) GROUP BY key``."""
    return _running(df, key, order, value, out, "changelog")


def stream_keyed_reduce(df: DataFrame, key: str, order: str, value: str, fn) -> DataFrame:
    """Streaming keyed reduce with a Python combine function: one row per
    record carrying the key's reduced value so far (``order``, ``key``, ``value``).
    Named reducers need no Python: ``groupBy(key).agg(...)`` in update mode."""
    _ensure_rocksdb(df)
    vtype = df.schema[value].dataType
    schema = StructType([df.schema[order], StructField(key, StringType()), StructField(value, vtype)])
    proc = RunningReduceProcessor(key, order, value, fn, vtype)
    rows = _exact(_named_key(df.select(key, order, value), key), value)
    return _own_key(rows.groupBy(key).transformWithStateInPandas(proc, schema, "Append", "None"), key, df.schema[key].dataType)


def processing_time_window_counts(df: DataFrame, key: str, size_ms: int, value: str | None = None,
                                  out: str = "cnt", buckets: int = BUCKETS) -> DataFrame:
    """Tumbling processing-time windows that fire on the clock, idle input included.

    Sums ``value`` (integers; None counts rows) per key.  Each task adds up its own rows per key
    before the shuffle, so a hot key sends one row per batch of rows; state is kept per bucket of
    keys, and ``buckets`` must stay the same over restarts.  ``streaming.drain_timers`` runs such a query to its end.
    """
    _ensure_rocksdb(df)
    schema = StructType([StructField("window_start", TimestampType()), StructField(key, StringType()),
                         StructField(out, LongType())])
    number = F.lit(1).cast("bigint") if value is None else F.coalesce(F.col(value).cast("bigint"), F.lit(0).cast("bigint"))
    partial = StructType([StructField(key, StringType()), StructField(out, LongType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = pa.table(batch).group_by(key).aggregate([(out, "sum")])
            yield from pa.table({key: sums.column(key), out: sums.column(f"{out}_sum")}).to_batches()

    rows = _named_key(df.select(F.col(key), number.alias(out)), key).mapInArrow(add, partial)
    dealt = rows.withColumn(SALT, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    dealt = dealt.withColumn(SALT, F.coalesce(SALT, F.lit(0)))
    fired = dealt.groupBy(SALT).transformWithStateInPandas(ProcessingTimeWindowProcessor(key, size_ms, out), schema, "Append", "ProcessingTime")
    return _own_key(fired, key, df.schema[key].dataType)
