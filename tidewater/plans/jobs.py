"""The reference's programs as jobs: each is a short composition of the
library's sources, operators and sinks, taking its input as a DataFrame
(batch or stream) so the same job runs on literal rows, tables or streams.

Batch jobs return DataFrames; streaming jobs return the started query.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater import operators as ops
from tidewater.functions.rows import parity_tag, prefixed_string
from tidewater.plans import sql as tsql
from tidewater.plans.queries import LONG_PREFIX, STRING_PREFIX
from tidewater.sinks.jdbc import jdbc_insert, jdbc_stream_writer
from tidewater.sinks.rolling_file import write_rolling_text
from tidewater.sinks.upsert import upsert_stream_writer
from tidewater.sources import order_stream, read_kafka
from tidewater.streaming.stateful import processing_time_window_counts, stream_enrich


def word_count(lines: DataFrame, text: str = "value") -> DataFrame:
    """Lines -> words -> (word, 1) -> sum per word.  A stream gives an updating
    table (write it in update or complete mode)."""
    return ops.keyed_sum(ops.with_one(ops.tokenize_words(lines, text)), "word", "one", "cnt")


def char_count(text_df: DataFrame, text: str = "value") -> DataFrame:
    return ops.count_by(ops.tokenize_chars(text_df, text), "char", "cnt")


def filtered_sum_and_reduce(lines: DataFrame, drop: str, text: str = "value"):
    """Words without ``drop``, summed per word two ways: built-in sum and a
    combine function ``(a, b) -> a + b``."""
    pairs = ops.with_one(ops.drop_value(ops.tokenize_words(lines, text), "word", drop))
    return (ops.keyed_sum(pairs, "word", "one", "cnt"),
            ops.keyed_reduce(pairs, "word", "one", lambda a, b: a + b, out="cnt"))


def union_and_connect(words_a: DataFrame, words_b: DataFrame, numbers: DataFrame):
    """Union of two word inputs; and words connected with numbers, each side
    with its own mapper, into one string output."""
    return (ops.union_all(words_a, words_b),
            ops.connect_map(words_a, numbers, prefixed_string("value", STRING_PREFIX),
                            prefixed_string("value", LONG_PREFIX)))


def parity_outputs(numbers: DataFrame, column: str = "value") -> ops.Routed:
    """Numbers routed to ``even`` / ``odd`` side outputs (main output empty)."""
    return ops.route(numbers, parity_tag(column))


def counted_file_copy(lines: DataFrame, path: str, value: str = "value", **sink_opts) -> int:
    """Copy lines into rolling text files in date-hour folders while a
    job-wide counter counts them; returns the counter read after the job."""
    counted, obs = ops.observed_count(lines, "elementCounter")
    write_rolling_text(counted, path, value=value, **sink_opts)
    return int(obs.get["elementCounter"])


def enrich_scores(scores: DataFrame, users: DataFrame, key: str = "id") -> DataFrame:
    """Scores enriched with the user's name.  Batch: checked broadcast join.
    Streams: both inputs streaming, keyed state with buffering."""
    if scores.isStreaming and users.isStreaming:
        rec = [c for c in scores.columns if c != key]
        dim = [c for c in users.columns if c != key]
        return stream_enrich(scores, users, key, rec, dim)
    return ops.enrich(scores, users, key)


def window_word_count(lines: DataFrame, size_ms: int = 5000, text: str = "value") -> DataFrame:
    """Word count per tumbling processing-time window on a stream; windows
    fire on the clock, idle input included."""
    words = ops.tokenize_words(lines, text)
    return processing_time_window_counts(words, "word", size_ms)


def generated_orders_to_jdbc(spark: SparkSession, url: str, table: str, checkpoint: str,
                             rows_per_second: int = 10, num_partitions: int = 2,
                             props: dict | None = None, marker_table: str | None = None,
                             also: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Rate-limited random orders inserted into a database table (createTime
    as a SQL timestamp); ``also`` receives each batch too (e.g. printing)."""
    write = jdbc_stream_writer(url, table, props, marker_table, millis_to_timestamp=("createTime",))

    def each(batch: DataFrame, batch_id: int) -> None:
        batch = batch.drop("seq").persist()
        try:
            write(batch, batch_id)
            if also:
                also(batch, batch_id)
        finally:
            batch.unpersist()

    return (order_stream(spark, rows_per_second, num_partitions).writeStream
            .option("checkpointLocation", checkpoint).foreachBatch(each).start())


def insert_rows(df: DataFrame, url: str, table: str, columns: list[str],
                props: dict | None = None) -> None:
    """Insert only ``columns`` (an id column is left to the database)."""
    jdbc_insert(df.select(*columns), url, table, props=props)


def running_word_count_to_store(lines: DataFrame, client_factory, checkpoint: str,
                                hash_name: str = "WordCount", text: str = "value") -> StreamingQuery:
    """Running word totals written to a keyed store (``HSET WordCount word total``)."""
    counts = ops.count_by(ops.tokenize_words(lines, text), "word", "cnt")
    return (counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
            .foreachBatch(upsert_stream_writer(client_factory, hash_name, "word", "cnt")).start())


def kafka_print(spark: SparkSession, bootstrap_servers: str, topic: str, group_id: str,
                checkpoint: str) -> StreamingQuery:
    """Kafka topic values (text) printed with a label."""
    values = read_kafka(spark, bootstrap_servers, topic, group_id).select("value")
    return (values.select(F.lit("kafka:").alias("label"), "value").writeStream.format("console")
            .option("checkpointLocation", checkpoint).start())


def sql_upper(spark: SparkSession, names: DataFrame) -> DataFrame:
    """``SELECT UPPER(f0) FROM InputTable`` as an insert-only changelog."""
    return ops.changelog_insert_only(tsql.sql_upper(spark, names))


def sql_sum_changelog(spark: SparkSession, rows: DataFrame, order: str, name: str = "name",
                      score: str = "score"):
    """``SELECT name, SUM(score) ... GROUP BY name``: the final table and its
    changelog (``+I``/``-U``/``+U``) for rows fed in ``order``."""
    final = tsql.sql_group_sum(spark, rows.select(name, score))
    log = ops.changelog_sum(rows, name, order, score, out=score, keep=[order])
    return final, log
