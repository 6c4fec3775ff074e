"""W1: tumbling windows per key.

Batch and event-time streams group on ``window(time, size)``; a
processing-time stream stamps each row with the clock first.  The result
carries ``window_start`` so rows of different windows stay apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.util import as_col

PROCESSING_TIME = "__proc_time"


def tumbling_aggregate(df: DataFrame, time_col: str, size: str, key, value=None,
                       out: str = "cnt", watermark: str | None = None) -> DataFrame:
    """Sum ``value`` (or count rows when ``value`` is None) per key and window.

    ``watermark`` (streams only) bounds state and lets append mode emit each
    window once it is final.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if watermark is not None:
        df = df.withWatermark(time_col, watermark)
    agg = F.count(F.lit(1)) if value is None else F.sum(as_col(value))
    return (df.groupBy(F.window(time_col, size).alias("__w"), *keys)
            .agg(agg.alias(out))
            .select(F.col("__w.start").alias("window_start"), *keys, out))


def processing_time_window(df: DataFrame, size: str, key, value=None, out: str = "cnt",
                           watermark: str | None = None) -> DataFrame:
    """Tumbling processing-time window on a stream: the row's arrival clock is
    its time, and counts are combined within each task before the shuffle.

    Without ``watermark`` no row is ever dropped: use update mode, where each batch
    emits the windows it changed.  A watermark lets append mode emit a window once
    and forget it, but drops rows whose clock lies further back (a machine
    whose clock is behind), so it must be as long as clocks can differ.
    For windows that must fire on the clock alone use
    ``tidewater.streaming.stateful.processing_time_window_counts``.
    """
    stamped = df.withColumn(PROCESSING_TIME, F.current_timestamp())
    return tumbling_aggregate(stamped, PROCESSING_TIME, size, key, value, out, watermark=watermark)
