"""Row operators: pair with one (T3), filter (T4), connect + co-map (T5),
side outputs (T6), per-instance rich map (T7), fan-out (T8)."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType



def with_one(df: DataFrame, out: str = "one") -> DataFrame:
    """``word -> (word, 1)``."""
    return df.withColumn(out, F.lit(1))


def drop_value(df: DataFrame, column: str, value) -> DataFrame:
    """Keep rows whose ``column`` differs from ``value`` (null rows are dropped,
    where the reference would fail on them)."""
    return df.filter(F.col(column) != F.lit(value))


def connect_map(first: DataFrame, second: DataFrame, map_first: Column, map_second: Column,
                out: str = "value") -> DataFrame:
    """Two inputs of different types, one mapper each, one output type."""
    return first.select(map_first.alias(out)).unionByName(second.select(map_second.alias(out)))


class Routed:
    """Result of ``route``: the tagged rows plus one DataFrame per tag.

    ``main`` is the main output, which a router that only writes side outputs
    leaves empty.  Batch callers that read several outputs should ``persist``
    ``tagged`` first; streaming callers write all outputs from one
    ``foreachBatch`` so the source is read once.
    """

    def __init__(self, tagged: DataFrame, tag_col: str, tags):
        self.tagged = tagged
        self.tag_col = tag_col
        self.tags = list(tags)

    def output(self, tag: str) -> DataFrame:
        return self.tagged.filter(F.col(self.tag_col) == F.lit(tag)).drop(self.tag_col)

    @property
    def main(self) -> DataFrame:
        return self.tagged.filter(F.lit(False)).drop(self.tag_col)

    def __getitem__(self, tag: str) -> DataFrame:
        return self.output(tag)


def route(df: DataFrame, tags: Mapping[str, Column] | Column, tag_col: str = "tag") -> Routed:
    """Send each row to the first tag whose predicate holds.

    ``tags`` is an ordered mapping ``tag -> predicate`` or a Column computing
    the tag directly.  Rows matching nothing carry a null tag.
    """
    if isinstance(tags, Column):
        return Routed(df.withColumn(tag_col, tags), tag_col, [])
    expr = None
    for name, pred in tags.items():
        expr = F.when(pred, F.lit(name)) if expr is None else expr.when(pred, F.lit(name))
    return Routed(df.withColumn(tag_col, expr), tag_col, tags.keys())


def map_partitions_with_setup(df: DataFrame, setup: Callable[[], object],
                              fn: Callable[[object, pd.DataFrame], pd.DataFrame],
                              schema: StructType | str) -> DataFrame:
    """A rich map: ``setup`` runs once per task (the open hook), ``fn(ctx, batch)``
    maps each Arrow batch of the partition with that context."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ctx = setup()
        for b in batches:
            yield fn(ctx, b)
    return df.mapInPandas(run, schema)


def with_local_count(df: DataFrame, out: str = "local_count", instance: str = "instance") -> DataFrame:
    """Per-instance running count: each parallel task counts only its own rows.

    Adds ``instance`` (the task's partition) and ``out`` (1, 2, ... within it),
    from built-ins that stay in generated code: ``monotonically_increasing_id``
    keeps the record number within the partition in its lower 33 bits.
    Counts of this kind are per instance by design; for a job-wide count use
    ``observed_count``.
    """
    record = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return df.select("*", F.spark_partition_id().cast("bigint").alias(instance),
                     (record + 1).alias(out))


def fan_out(df: DataFrame, *consumers: Callable[[DataFrame], None]) -> None:
    """Feed one batch DataFrame to several consumers, computing it once."""
    df = df.persist()
    try:
        for c in consumers:
            c(df)
    finally:
        df.unpersist()


def fan_out_files(df: DataFrame, outputs: Mapping[str, Column], path: str) -> dict[str, DataFrame]:
    """Write every row to each output whose condition holds, in one pass over ``df``.

    Nothing is kept in memory or computed twice: a row is repeated once per output it goes to, and
    the writer deals the rows to a folder per output under ``path``.  Returns the outputs, read back.
    """
    spark, name = df.sparkSession, "tw_output"
    goes = F.array_compact(F.array(*[F.when(when, F.lit(to)) for to, when in outputs.items()]))
    df.select("*", F.explode(goes).alias(name)).write.partitionBy(name).parquet(path)
    every = spark.read.schema(StructType([*df.schema, StructField(name, StringType())])).parquet(path)
    return {to: every.where(F.col(name) == to).drop(name) for to in outputs}
