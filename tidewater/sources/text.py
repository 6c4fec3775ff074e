"""Unbounded text-line sources: a socket (testing only) or a folder of text
files (the fault-tolerant production form).  Both give one column
``value string``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def text_lines(spark: SparkSession, source: str = "files", *, path: str | None = None,
               host: str = "localhost", port: int = 9999,
               max_files_per_trigger: int | None = None) -> DataFrame:
    if source == "socket":
        # Spark's socket source keeps no offsets and cannot replay: testing only.
        return (spark.readStream.format("socket").option("host", host)
                .option("port", port).load())
    if source != "files":
        raise ValueError(f"unknown text source {source!r}")
    if not path:
        raise ValueError("files source needs a path")
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)
