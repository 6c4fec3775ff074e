"""Order generator: ``seq -> (id, userId, money, createTime)``.

Each field is a pure function of the row's sequence number, so rows are
independent of the task that makes them and a replay makes the same rows.
Batch: any DataFrame with a sequence column.  Stream: Spark's ``rate``
source, which throttles to ``rows_per_second``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# id is 32 upper-case hex characters; userId and money are uniform in [0, 1000).
ID_HEX_DIGITS = 32
VALUE_RANGE = 1000


def order_columns(seq: Column, create_time: Column | None = None) -> list[Column]:
    h = F.md5(seq.cast("string"))
    cols = [
        F.upper(h).alias("id"),
        (F.conv(F.substring(h, 1, 7), 16, 10).cast("bigint") % VALUE_RANGE).cast("int").alias("userId"),
        (F.conv(F.substring(h, 8, 7), 16, 10).cast("bigint") % VALUE_RANGE).cast("int").alias("money"),
    ]
    if create_time is not None:
        cols.append(create_time.alias("createTime"))
    return cols


def generate_orders(df: DataFrame, seq_col: str, create_time: Column | None = None) -> DataFrame:
    """Batch generator over a sequence column (``seq`` is kept)."""
    seq = F.col(seq_col)
    return df.select(seq.alias("seq"), *order_columns(seq, create_time))


def order_stream(spark: SparkSession, rows_per_second: int = 10, num_partitions: int = 2) -> DataFrame:
    """Rate-limited unbounded order stream; ``createTime`` is epoch millis."""
    src = (spark.readStream.format("rate").option("rowsPerSecond", rows_per_second)
           .option("numPartitions", num_partitions).load())
    return src.select(F.col("value").alias("seq"),
                      *order_columns(F.col("value"), F.unix_millis(F.col("timestamp"))))
