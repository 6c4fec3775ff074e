"""Q1-Q3 and the SQL queries built on them (T9 ``UPPER``, A4 ``GROUP BY SUM``).

A table is just a DataFrame; a view makes it visible to ``spark.sql``, which
goes through the same Catalyst optimizer as the DataFrame API.  Views work on
streaming DataFrames too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def as_table(df: DataFrame, *names: str) -> DataFrame:
    """Stream/DataFrame -> table: a single atomic column becomes ``f0``;
    struct-like inputs keep their field names unless ``names`` are given."""
    if names:
        return df.toDF(*names)
    if len(df.columns) == 1:
        return df.toDF("f0")
    return df


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def sql(spark: SparkSession, query: str, **views: DataFrame) -> DataFrame:
    """Run ``query`` after registering ``views`` (name -> DataFrame)."""
    for name, df in views.items():
        register_view(df, name)
    return spark.sql(query)


def sql_upper(spark: SparkSession, df: DataFrame, view: str = "InputTable") -> DataFrame:
    """``SELECT UPPER(f0) AS f0 FROM InputTable`` over a one-column table."""
    return sql(spark, f"SELECT UPPER(f0) AS f0 FROM {view}", **{view: as_table(df)})


def sql_group_sum(spark: SparkSession, df: DataFrame, view: str = "InputTable") -> DataFrame:
    """``SELECT name, SUM(score) AS score FROM InputTable GROUP BY name``."""
    return sql(spark, f"SELECT name, SUM(score) AS score FROM {view} GROUP BY name",
               **{view: as_table(df, "name", "score")})
