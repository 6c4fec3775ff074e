"""Bounded in-memory collections (``fromData`` / ``fromElements``).

Only for small literal inputs such as test fixtures; data at scale comes
from ``read_table`` and flows through the same operators.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType, StructType


def from_data(spark: SparkSession, rows: Iterable, schema: StructType | DataType | str) -> DataFrame:
    """DataFrame over literal rows with a declared schema.

    A single atomic type yields one column named ``value``.
    """
    rows = list(rows)
    if isinstance(schema, DataType) and not isinstance(schema, StructType):
        schema = f"value {schema.simpleString()}"
    # atomic elements (a stream of strings, of longs) become one-field rows
    rows = [r if isinstance(r, (tuple, list, dict)) else (r,) for r in rows]
    return spark.createDataFrame(rows, schema)
