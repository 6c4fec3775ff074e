"""Kafka topic, value only, decoded as UTF-8 text.

The Kafka connector jar is not bundled with PySpark; ``read_kafka`` needs it
on the classpath (``--packages org.apache.spark:spark-sql-kafka-0-10_2.13``).
``decode_value`` is plain Spark and works on any binary ``value`` column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_options(bootstrap_servers: str, topic: str, group_id: str | None = None,
                  starting_offsets: str = "earliest", **extra: str) -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic,
            "startingOffsets": starting_offsets}
    if group_id:
        opts["kafka.group.id"] = group_id
    opts.update(extra)
    return opts


def read_kafka(spark: SparkSession, bootstrap_servers: str, topic: str,
               group_id: str | None = None, stream: bool = True, **extra: str) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    df = reader.format("kafka").options(**kafka_options(
        bootstrap_servers, topic, group_id, **extra)).load()
    return decode_value(df)


def decode_value(df: DataFrame, column: str = "value") -> DataFrame:
    """Replace the binary ``column`` by its UTF-8 text, keep everything else."""
    return df.withColumn(column, F.decode(F.col(column), "UTF-8"))
