"""K2: row-format text files in date-hour bucket folders.

Rows are written by the executors with Spark's text writer, one folder per
bucket ``yyyy-MM-dd--HH`` (``bucket=<value>``), and the job commit makes
the files visible atomically.  The reference rolls a part file by age,
idleness and size; here files close at the end of each job or micro-batch
(so the trigger interval bounds age and idleness); ``max_records_per_file``
bounds a file's lines, ``write_rolled_text`` its bytes.  Spark chooses the part-file names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.running import running_sums

BUCKET_FORMAT = "yyyy-MM-dd--HH"
BUCKET = "bucket"


def bucketed(df: DataFrame, value: str = "value", bucket_time: str | None = None) -> DataFrame:
    """``value`` (as text) and its ``bucket`` (``yyyy-MM-dd--HH`` of ``bucket_time``,
    or of the processing clock when None)."""
    t = F.current_timestamp() if bucket_time is None else F.col(bucket_time)
    return df.select(F.col(value).cast("string").alias("value"),
                     F.date_format(t, BUCKET_FORMAT).alias(BUCKET))


def write_rolling_text(df: DataFrame, path: str, value: str = "value",
                       bucket_time: str | None = None, max_records_per_file: int = 0,
                       mode: str = "append", files_per_bucket: int | None = None) -> None:
    """Write ``value`` as UTF-8 lines under ``path/bucket=.../``.

    ``bucket_time`` names the timestamp deciding the bucket; None uses the
    processing clock, as the reference does.  By default there is no
    shuffle: each task sorts its own rows by bucket and writes one file per
    bucket it holds, which suits time-ordered input.  ``files_per_bucket=k``
    shuffles rows by ``(bucket, hash(line) % k)`` instead: at most ``k``
    files per bucket, and a bucket holding much of the data still spreads
    over ``k`` tasks (the hash keeps a retried task's rows in place).
    """
    out = bucketed(df, value, bucket_time)
    if files_per_bucket:
        salt = F.pmod(F.xxhash64("value"), F.lit(files_per_bucket))
        out = out.repartition(F.col(BUCKET), salt)
    (out.write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(BUCKET).text(path))


MAX_BYTES = 1 << 30  # the reference's part size
FILE = "file"


def write_rolled_text(df: DataFrame, path: str, value: str = "value", bucket_time: str | None = None,
                      max_bytes: int = MAX_BYTES, mode: str = "append", parts: int | None = None) -> None:
    """Write ``value`` as UTF-8 lines under ``path/bucket=.../file=.../``, no file over ``max_bytes``.

    A line's file is the running sum of its bucket's bytes before it, divided by the limit less the longest
    line, so no file can run over; the sums are taken over ranges, which shares a large bucket among
    tasks.  Lines of more than half the limit get files of their own (numbered from -1 down), the only ones that may exceed it.
    A folder holds one file, written by one task; the job's commit makes all of them visible.
    """
    size = F.octet_length("value").cast("bigint") + 1
    lines = bucketed(df, value, bucket_time).withColumn("tw_size", F.coalesce(size, F.lit(1).cast("bigint")))
    short = F.col("tw_size") * 2 <= max_bytes
    longest = lines.where(short).agg(F.max("tw_size")).first()[0] or 1
    small = F.when(short, F.col("tw_size")).otherwise(0)
    large = F.when(short, 0).otherwise(1)
    summed = running_sums(lines, BUCKET, [], {"tw_sum": small, "tw_large": large}, parts=parts)
    before = F.coalesce("tw_sum_before", F.lit(0))
    number = F.when(short, F.floor(before / (max_bytes - longest + 1))).otherwise(-F.col("tw_large"))
    files = summed.select("value", BUCKET, number.cast("bigint").alias(FILE))
    files.repartition(BUCKET, FILE).write.mode(mode).partitionBy(BUCKET, FILE).text(path)


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def rolling_text_stream(df: DataFrame, path: str, checkpoint: str, value: str = "value",
                        bucket_time: str | None = None, trigger: str | None = "20 seconds",
                        max_records_per_file: int = 0):
    """Streaming form: exactly-once file sink, one set of part files per
    trigger.  ``trigger=None`` processes the available input and stops.

    A folder belongs to one query: Spark's file sink logs batch numbers in it, and a
    second query's batches would count as written already.  That is refused."""
    spark = df.sparkSession
    if _exists(spark, f"{path}/_spark_metadata") and not _exists(spark, f"{checkpoint}/offsets"):
        raise ValueError(f"{path} was written by another query; choose a folder of its own")
    w = (bucketed(df, value, bucket_time).writeStream.format("text")
         .option("checkpointLocation", checkpoint)
         .option("maxRecordsPerFile", max_records_per_file).partitionBy(BUCKET))
    w = w.trigger(processingTime=trigger) if trigger else w.trigger(availableNow=True)
    return w.start(path)


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    """Read the lines back with their bucket (kept as a string)."""
    return spark.read.schema(f"value string, {BUCKET} string").text(path)


def read_rolled(spark: SparkSession, path: str) -> DataFrame:
    """The lines of ``write_rolled_text`` with their bucket and file number."""
    # as text: a folder without files has no partition columns, and lines are the only others the reader takes
    lines = spark.read.schema(f"value string, {BUCKET} string, {FILE} string").text(path)
    return lines.withColumn(FILE, F.col(FILE).cast("bigint"))

