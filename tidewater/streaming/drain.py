"""Run a streaming DataFrame to the end of its available input and return the
result as a batch DataFrame read from the shared folder.

Results never pass through the driver: executors write them as parquet under
``spark.checkpoint.dir`` next to the query's checkpoint, so a restarted query
resumes from its offsets and state.
"""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import scratch_path

BATCH = "__batch"


def _paths(spark: SparkSession, name: str, path: str | None, checkpoint: str | None):
    base = path or scratch_path(spark, f"stream-{name}")
    return base.rstrip("/") + "/data", checkpoint or base.rstrip("/") + "/checkpoint"


def drain(df: DataFrame, name: str, output_mode: str = "append", *, keys=None,
          path: str | None = None, checkpoint: str | None = None,
          timeout_s: float | None = None) -> DataFrame:
    """Process all available input with ``trigger(availableNow=True)``.

    * ``append``: rows are final when emitted; written by the file sink.
    * ``complete``: every micro-batch holds the whole result; the last one wins.
    * ``update``: micro-batches hold changed rows; with ``keys`` the latest row
      per key is returned (the table the updates describe), else all rows.
    """
    spark = df.sparkSession
    data, ckpt = _paths(spark, name, path, checkpoint)
    w = df.writeStream.option("checkpointLocation", ckpt).trigger(availableNow=True)
    if output_mode == "append":
        q = w.outputMode("append").format("parquet").start(data)
    elif output_mode == "complete":
        def write(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(data)
        q = w.outputMode("complete").foreachBatch(write).start()
    elif output_mode == "update":
        def write(batch: DataFrame, batch_id: int) -> None:
            # overwrite this batch's folder only: a replayed batch rewrites it
            batch.write.mode("overwrite").parquet(f"{data}/{BATCH}={batch_id}")
        q = w.outputMode("update").foreachBatch(write).start()
    else:
        raise ValueError(f"unknown output mode {output_mode!r}")
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError(f"stream {name} did not drain in {timeout_s}s")
    if q.exception():
        raise q.exception()
    schema = df.schema
    try:
        out = spark.read.parquet(data)
    except AnalysisException as e:
        # no batch wrote anything, or the batches that did were empty; every other error stands
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)
    if output_mode == "update":
        if keys:
            keys = [keys] if isinstance(keys, str) else list(keys)
            vals = [c for c in schema.names if c not in keys]
            latest = F.max_by(F.struct(*vals), F.col(BATCH)).alias("__v")
            out = out.groupBy(*keys).agg(latest).select(*keys, *[F.col(f"__v.{v}").alias(v) for v in vals])
        else:
            out = out.drop(BATCH)
    return out.select(*schema.names)


def drain_timers(df: DataFrame, name: str, *, path: str | None = None, checkpoint: str | None = None,
                 every: str = "1 second", timeout_s: float = 600) -> DataFrame:
    """Run a query that fires on the clock until its input is used up and its state is empty.

    ``availableNow`` would stop before the last timers are due, so the query runs with a
    processing-time trigger and is stopped after a batch that read nothing and left no row
    in any state store: every window has been emitted and dropped.  A restart with the same
    ``path`` goes on from the checkpoint.
    """
    spark = df.sparkSession
    data, ckpt = _paths(spark, name, path, checkpoint)
    q = (df.writeStream.option("checkpointLocation", ckpt).trigger(processingTime=every)
         .outputMode("append").format("parquet").start(data))
    end = time.monotonic() + timeout_s
    try:
        while True:
            if q.exception():
                raise q.exception()
            if not q.isActive:
                raise RuntimeError(f"stream {name} was stopped")
            last = q.lastProgress
            if last and last["numInputRows"] == 0 and all(s["numRowsTotal"] == 0 for s in last["stateOperators"]):
                break
            if time.monotonic() > end:
                raise TimeoutError(f"stream {name} still held state after {timeout_s}s")
            time.sleep(0.2)
    finally:
        q.stop()
    return spark.read.schema(df.schema).parquet(data)
