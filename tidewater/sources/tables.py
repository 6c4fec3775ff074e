"""Parquet tables, read as batch DataFrames or as file streams.

Reads are lazy and declarative, so Catalyst prunes columns and pushes
filters into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


MAX_FILES = 64  # files of a micro-batch: bounds what one trigger reads


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def table_schema(spark: SparkSession, sf_dir: str, name: str) -> StructType:
    """The table's schema, from its footers at the time of the call."""
    return spark.read.parquet(table_path(sf_dir, name)).schema


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The table projected to ``columns``, so only those are scanned."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def table_stream(spark: SparkSession, sf_dir: str, name: str,
                 max_files_per_trigger: int = MAX_FILES) -> DataFrame:
    """The same table as an unbounded file source, ``max_files_per_trigger`` files
    to a micro-batch.

    The folder may hold several tables, so for a table of one file the stream watches
    the folder and filters on the file name; a table stored as a directory of part files
    is watched directly.
    """
    path = table_path(sf_dir, name)
    reader = spark.readStream.schema(table_schema(spark, sf_dir, name)).option("maxFilesPerTrigger", max_files_per_trigger)
    if _is_dir(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def _is_dir(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a directory, asked of the file system Spark reads it with.
    A path that cannot be reached is an error, not a file."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return where.getFileSystem(conf).getFileStatus(where).isDirectory()
