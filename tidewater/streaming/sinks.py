"""Streaming fan-out (T8) and a per-row sink with open/invoke/close hooks (K4)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def fan_out_stream(df: DataFrame, consumers: list[Callable[[DataFrame, int], None]],
                   checkpoint: str, trigger: dict | None = None):
    """One streaming read feeding several consumers: each micro-batch is
    persisted once and handed to every ``consumer(batch, batch_id)``."""
    def each(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for c in consumers:
                c(batch, batch_id)
        finally:
            batch.unpersist()
    w = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


class RowSink:
    """Per-row sink: ``open`` once per task and epoch (connect, prepare a
    statement), ``invoke`` per row, ``close`` at the end (also after an error).
    ``open`` returning False skips an epoch the sink already holds."""

    def open(self, partition_id: int, epoch_id: int) -> bool:
        return True

    def invoke(self, row) -> None:
        raise NotImplementedError

    def close(self, error) -> None:
        pass


class _ForeachWriter:
    def __init__(self, factory: Callable[[], RowSink]):
        self.factory = factory

    def open(self, partition_id, epoch_id):
        self.sink = self.factory()
        return self.sink.open(partition_id, epoch_id)

    def process(self, row):
        self.sink.invoke(row)

    def close(self, error):
        self.sink.close(error)


def row_sink_stream(df: DataFrame, sink_factory: Callable[[], RowSink], checkpoint: str,
                    trigger: dict | None = None):
    """Run ``df`` into a ``RowSink`` created on the executors."""
    w = df.writeStream.option("checkpointLocation", checkpoint).foreach(_ForeachWriter(sink_factory))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def route_stream(df: DataFrame, tags, outputs: dict[str, Callable[[DataFrame, int], None]],
                 checkpoint: str, trigger: dict | None = None):
    """Side outputs on a stream: tag each row (``tidewater.operators.route``)
    and hand each tag's rows of every micro-batch to ``outputs[tag]``; the
    source is read once per batch."""
    from pyspark.sql import functions as F
    from tidewater.operators.rowops import route

    routed = route(df, tags)

    def consumer(tag, fn):
        return lambda b, i: fn(b.filter(F.col(routed.tag_col) == F.lit(tag)).drop(routed.tag_col), i)

    return fan_out_stream(routed.tagged, [consumer(t, f) for t, f in outputs.items()], checkpoint,
                          trigger)


def observed_batches(df: DataFrame, name: str, write: Callable[[DataFrame, int], None],
                     metrics_path: str, checkpoint: str, trigger: dict | None = None):
    """Run ``write`` on every micro-batch with a row counter attached, and
    store each batch's count under ``metrics_path/batch=<id>`` (overwritten
    on replay, so every batch counts once).  The job-wide total is a Spark
    sum over that table."""
    from tidewater.operators.aggregate import observed_count

    def each(batch: DataFrame, batch_id: int) -> None:
        counted, obs = observed_count(batch, name)
        write(counted, batch_id)
        n = int(obs.get[name])  # a missing metric is an error, not zero
        batch.sparkSession.createDataFrame([(n,)], f"{name} bigint").write.mode("overwrite") \
            .parquet(f"{metrics_path}/batch={batch_id}")
    w = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
