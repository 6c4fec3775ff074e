"""J1 (batch): enrich records from a dimension keyed by id; J2: latest per key.

The dimension is broadcast only after a row count and then a byte count
prove it small; above the bound the join is a shuffle join, where adaptive
execution splits a skewed key's partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest dimension that is broadcast: rows, then bytes of the projected columns.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 256 * 1024 * 1024

_FIXED_WIDTH = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4,
    T.DateType: 4, T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8,
    T.DecimalType: 16,
}


def _width(field: T.StructField):
    c = F.col(f"`{field.name}`")
    for t, n in _FIXED_WIDTH.items():
        if isinstance(field.dataType, t):
            return F.lit(n)
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0))
    return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))  # nested: text size


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                   max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and its columns hold at
    most ``max_bytes`` bytes.

    The row count of a table scan is answered from parquet footers (only
    per-task counts are shuffled), so a large dimension is turned down
    without reading it; only a dimension within the row bound has its bytes
    summed.
    """
    if df.isStreaming:
        return False
    if df.count() > max_rows:
        return False
    size = df.select(sum((_width(f) for f in df.schema.fields), F.lit(0)).alias("w")) \
        .agg(F.sum("w")).first()[0] or 0
    return size <= max_bytes


def enrich(records: DataFrame, dimension: DataFrame, on: str | list[str], how: str = "inner",
           broadcast: bool | None = None, max_rows: int = BROADCAST_MAX_ROWS,
           max_bytes: int = BROADCAST_MAX_BYTES, latest_by: str | None = None) -> DataFrame:
    """Join ``records`` with ``dimension`` on ``on``.

    ``broadcast=None`` decides by the size check; ``True`` forces the hint,
    ``False`` never hints (Spark and adaptive execution still choose).
    ``latest_by`` keeps only the last dimension row per key by that column
    (a keyed map where later writes win) instead of joining every version.
    """
    if latest_by is not None:
        keys = [on] if isinstance(on, str) else list(on)
        values = [c for c in dimension.columns if c not in keys and c != latest_by]
        dimension = latest_by_key(dimension, keys, latest_by, *values)
    if broadcast is None:
        broadcast = fits_broadcast(dimension, max_rows, max_bytes)
    dim = F.broadcast(dimension) if broadcast else dimension
    return records.join(dim, on, how)


def latest_by_key(df: DataFrame, key, order: str, *values: str) -> DataFrame:
    """The last record per key by ``order`` (last write wins), as a partial
    aggregate: a hot key is reduced inside each task before the shuffle."""
    keys = [key] if isinstance(key, str) else list(key)
    values = values or tuple(c for c in df.columns if c not in keys)
    latest = F.max_by(F.struct(*[F.col(v) for v in values]), F.col(order)).alias("__latest")
    return df.groupBy(*keys).agg(latest).select(*keys, *[F.col(f"__latest.{v}").alias(v) for v in values])
