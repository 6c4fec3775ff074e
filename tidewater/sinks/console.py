"""K1: print rows, optionally under a label (``print("result1")``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def print_rows(df: DataFrame, label: str | None = None, n: int = 20, truncate: bool = False,
               checkpoint: str | None = None):
    """Batch: ``show``.  Stream: the console sink; returns the running query."""
    if label is not None:
        df = df.select(F.lit(label).alias("label"), "*")
    if df.isStreaming:
        w = df.writeStream.format("console").option("truncate", str(truncate).lower())
        if checkpoint:
            w = w.option("checkpointLocation", checkpoint)
        return w.start()
    df.show(n, truncate=truncate)
    return None
