"""Registered streaming queries: a table read as a file stream, processed by
the streaming form of an operator, drained with ``availableNow`` into the
shared folder and returned as the result table.  They share the batch
queries' oracles: the drained table must equal the batch answer."""

from __future__ import annotations

import operator
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater import operators as ops
from tidewater.functions.rows import parity_tag, prefixed_string
from tidewater.plans import sql as tsql
from tidewater.plans.oracles import ORACLES
from tidewater.plans.queries import LONG_PREFIX, STRING_PREFIX, WINDOW_SIZE
from tidewater.session import scratch_path
from tidewater.sinks.jdbc import default_url, jdbc_stream_writer, jdbc_upsert_writer, read_jdbc
from tidewater.sinks.rolling_file import read_buckets, rolling_text_stream
from tidewater.sources import decode_value, generate_orders, read_table, table_stream, text_lines
from tidewater.streaming.batched_state import stream_running_batches
from tidewater.streaming.drain import drain, drain_timers
from tidewater.streaming.sinks import observed_batches, route_stream
from tidewater.streaming.stateful import (processing_time_window_counts, stream_changelog, stream_enrich, stream_keyed_reduce,
                                          stream_running_sum)


def _events(spark, sf_dir, *cols) -> DataFrame:
    return table_stream(spark, sf_dir, "events").select(*cols)


def stream_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table_stream(spark, sf_dir, "documents").select("doc_id", "text")
    counts = ops.count_by(ops.tokenize_words(docs, "text", "word"), "word", "cnt")
    # update mode: each batch emits only the words it changed, not the table
    return drain(counts, "word-count", "update", keys="word")


def stream_tumbling_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event-time 5 s windows, update mode; the drained table keeps the latest count
    of each window.  No watermark: no row is too late for the final answer."""
    ev = _events(spark, sf_dir, F.col("ts").cast("timestamp").alias("ts"), "event_type")
    win = ops.tumbling_aggregate(ev, "ts", WINDOW_SIZE, "event_type", out="cnt")
    out = drain(win, "tumbling", "update", keys=["window_start", "event_type"])
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def stream_processing_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processing-time 5 s windows per word, summed over the windows: which window a row
    meets is a matter of the clock, the sum is not."""
    docs = table_stream(spark, sf_dir, "documents").select("text")
    win = ops.processing_time_window(ops.tokenize_words(docs, "text", "word"), WINDOW_SIZE, "word", out="n")
    out = drain(win, "processing-window", "update", keys=["window_start", "word"])
    return out.groupBy("word").agg(F.sum("n").alias("cnt"))


def stream_clock_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5 s windows per word fired by timers, run until every window has fired.

    Which window a row meets is a matter of the clock; per word the totals of the windows, windows that do not start at a
    multiple of 5 s, and windows emitted twice are not.
    """
    docs = table_stream(spark, sf_dir, "documents").select("text")
    fired = processing_time_window_counts(ops.tokenize_words(docs, "text", "word"), "word", 5000, out="n")
    out = drain_timers(fired, "clock-windows")
    return out.groupBy("word").agg(F.sum("n").alias("cnt"), F.count_if(F.unix_millis("window_start") % 5000 != 0).alias("off_grid"),
                                   (F.count("*") - F.count_distinct("window_start")).alias("repeated"))


def stream_upsert_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running word totals of ``documents`` set in a keyed database table over several micro-batches; the end state.

    The URL comes from ``tidewater.jdbc.url``; unset, an in-memory database inside
    the Spark JVM is used, which only that process sees.
    """
    url = spark.conf.get("tidewater.jdbc.url", None) or default_url()
    name, base = f"T_WORDS_{uuid.uuid4().hex[:12].upper()}", scratch_path(spark, "upsert-store")
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    docs.repartition(4, "doc_id").write.parquet(f"{base}/documents")
    lines = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/documents")
    counts = ops.count_by(ops.tokenize_words(lines, "text", "word"), "word", "cnt")
    write = jdbc_upsert_writer(url, name, "word", "cnt", column_types="word VARCHAR(32000)")
    counts.writeStream.outputMode("update").option("checkpointLocation", f"{base}/checkpoint").foreachBatch(write) \
        .trigger(availableNow=True).start().awaitTermination()
    return read_jdbc(spark, url, name)


def stream_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of text files watched line by line, words counted per word."""
    base = scratch_path(spark, "text-lines")
    read_table(spark, sf_dir, "documents", "text").write.text(f"{base}/lines")
    lines = text_lines(spark, path=f"{base}/lines", max_files_per_trigger=64)
    return drain(ops.count_by(ops.tokenize_words(lines, "value", "word"), "word", "cnt"), "text-lines", "update", keys="word")


def stream_jdbc_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events inserted by micro-batch, epoch millis as timestamps, and read back by ranges.

    The URL comes from ``tidewater.jdbc.url``; unset, an in-memory database inside
    the Spark JVM is used, which only that process sees.
    """
    url = spark.conf.get("tidewater.jdbc.url", None) or default_url()
    name = f"T_EVENTS_{uuid.uuid4().hex[:12].upper()}"
    ev = _events(spark, sf_dir, F.col("event_id").alias("EVENT_ID"), F.col("event_type").alias("EVENT_TYPE"),
                 F.unix_millis(F.col("ts").cast("timestamp")).alias("TS"))
    write = jdbc_stream_writer(url, name, marker_table=f"{name}_DONE", millis_to_timestamp=("TS",))
    base = scratch_path(spark, "jdbc")
    ev.writeStream.option("checkpointLocation", f"{base}/checkpoint").foreachBatch(write).trigger(availableNow=True) \
        .start().awaitTermination()
    ids = read_jdbc(spark, url, name).agg(F.min("EVENT_ID").alias("lo"), F.max("EVENT_ID").alias("hi")).first()
    back = read_jdbc(spark, url, name, column="EVENT_ID", low=ids.lo or 0, high=(ids.hi or 0) + 1, parts=4)
    return back.select(F.col("EVENT_ID").cast("bigint").alias("event_id"), F.col("EVENT_TYPE").alias("event_type"),
                       F.unix_millis("TS").alias("ms"))


def stream_enrich_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = table_stream(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("subject"),
        F.col("o_totalprice").alias("score"))
    users = table_stream(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return drain(stream_enrich(scores, users, "id", ["subject", "score"], ["name"]), "enrich", "append")


def stream_changelog_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changelog of sums kept per key in the state store."""
    ev = _events(spark, sf_dir, "event_id", "event_type", "user_id")
    return drain(stream_changelog(ev, "event_type", "event_id", "user_id"), "changelog", "append")


def stream_running_sum_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running sums kept per key in the state store."""
    ev = _events(spark, sf_dir, "event_id", "event_type", "user_id")
    return drain(stream_running_sum(ev, "event_type", "event_id", "user_id"), "running", "append")


def stream_keyed_reduce_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-record reduce with a Python ``(v1, v2) -> v1 + v2``: the running sum."""
    ev = _events(spark, sf_dir, "event_id", "event_type", "user_id")
    red = stream_keyed_reduce(ev, "event_type", "event_id", "user_id", operator.add)
    return drain(red, "reduce", "append").withColumnRenamed("user_id", "running")


def stream_sql_group_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SQL aggregation over a view of a stream (an updating table)."""
    li = table_stream(spark, sf_dir, "lineitem").select(
        "l_returnflag", F.col("l_quantity").cast("bigint"))
    return drain(tsql.sql_group_sum(spark, li, view="StreamInput"), "sql-sum", "update", keys="name")


def stream_sql_upper(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table_stream(spark, sf_dir, "customer").select("c_name")
    return drain(tsql.sql_upper(spark, names, view="StreamNames"), "sql-upper", "append")


def stream_union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _events(spark, sf_dir, F.col("user_id").alias("id"))
    b = table_stream(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"))
    return drain(ops.union_all(a, b), "union", "append")


def stream_connect_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table_stream(spark, sf_dir, "customer").select("c_name")
    keys = table_stream(spark, sf_dir, "orders").select("o_orderkey")
    out = ops.connect_map(names, keys, prefixed_string("c_name", STRING_PREFIX),
                          prefixed_string("o_orderkey", LONG_PREFIX))
    return drain(out, "connect", "append")


def stream_latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir, "event_id", "event_type", "user_id")
    return drain(ops.latest_by_key(ev, "event_type", "event_id", "user_id"), "latest", "update",
                 keys="event_type")


def stream_generate_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    seq = table_stream(spark, sf_dir, "orders").select("o_orderkey")
    return drain(generate_orders(seq, "o_orderkey"), "generate", "append")


def stream_decode_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table_stream(spark, sf_dir, "documents").select(
        "doc_id", F.encode("text", "UTF-8").alias("value"))
    return drain(decode_value(docs).withColumnRenamed("value", "text"), "decode", "append")


def stream_side_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each tag's rows written to its own output from one read of the stream."""
    base = scratch_path(spark, "stream-route")
    tags = ("even", "odd")

    def writer(tag):
        return lambda b, i: b.write.mode("overwrite").parquet(f"{base}/{tag}/batch={i}")

    q = route_stream(_events(spark, sf_dir, "event_id"), parity_tag("event_id"),
                     {t: writer(t) for t in tags}, f"{base}/checkpoint", {"availableNow": True})
    q.awaitTermination()
    return ops.union_all(*[spark.read.parquet(f"{base}/{t}").select("event_id", F.lit(t).alias("tag"))
                           for t in tags])


def stream_observed_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job-wide counter over a stream: per-batch observed counts, summed."""
    base = scratch_path(spark, "stream-observe")
    li = table_stream(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    q = observed_batches(li, "counter", lambda b, i: b.write.format("noop").mode("overwrite").save(),
                         f"{base}/metrics", f"{base}/checkpoint", {"availableNow": True})
    q.awaitTermination()
    return spark.read.parquet(f"{base}/metrics").agg(F.sum("counter").cast("bigint").alias("counter"))


def stream_file_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as text lines through the streaming rolling-file sink."""
    base = scratch_path(spark, "stream-files")
    ev = _events(spark, sf_dir, "event_id", "ts", "event_type")
    lines = ev.select(F.concat_ws(",", F.col("event_id").cast("string"), "event_type").alias("value"),
                      "ts")
    q = rolling_text_stream(lines, f"{base}/data", f"{base}/checkpoint", bucket_time="ts",
                            trigger=None)
    q.awaitTermination()
    return read_buckets(spark, f"{base}/data").select("bucket", "value")


def _split_form(spark, sf_dir, name, emit, out):
    base = scratch_path(spark, f"stream-{name}")
    ev = _events(spark, sf_dir, "event_id", "event_type", "user_id")
    q = stream_running_batches(ev, "event_type", "event_id", "user_id", out, base,
                               f"{base}/checkpoint", emit=emit, trigger={"availableNow": True})
    q.awaitTermination()
    return spark.read.parquet(f"{base}/data").drop("batch")


def stream_changelog_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changelog per micro-batch with heavy keys split across tasks."""
    return _split_form(spark, sf_dir, "changelog-split", "changelog", "s")


def stream_running_sum_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split_form(spark, sf_dir, "running-split", "running", "running")


STREAM_QUERIES = {
    "stream_word_count": stream_word_count,
    "stream_tumbling_count": stream_tumbling_count,
    "stream_processing_window": stream_processing_window,
    "stream_clock_windows": stream_clock_windows,
    "stream_upsert_store": stream_upsert_store,
    "stream_text_lines": stream_text_lines,
    "stream_jdbc_insert": stream_jdbc_insert,
    "stream_enrich": stream_enrich_q,
    "stream_changelog": stream_changelog_q,
    "stream_running_sum": stream_running_sum_q,
    "stream_keyed_reduce": stream_keyed_reduce_q,
    "stream_sql_group_sum": stream_sql_group_sum,
    "stream_sql_upper": stream_sql_upper,
    "stream_union_all": stream_union_all,
    "stream_connect_map": stream_connect_map,
    "stream_latest_by_key": stream_latest_by_key,
    "stream_generate_orders": stream_generate_orders,
    "stream_decode_value": stream_decode_value,
    "stream_side_output": stream_side_output,
    "stream_observed_count": stream_observed_count,
    "stream_file_sink": stream_file_sink,
    "stream_changelog_split": stream_changelog_split,
    "stream_running_sum_split": stream_running_sum_split,
}

STREAM_ORACLES = {
    "stream_word_count": ORACLES["word_count"],
    "stream_tumbling_count": ORACLES["tumbling_count"],
    "stream_processing_window": ORACLES["word_count"],
    "stream_clock_windows": f"SELECT word, cnt, 0::BIGINT AS off_grid, 0::BIGINT AS repeated FROM ({ORACLES['word_count']})",
    "stream_upsert_store": ORACLES["word_count"],
    "stream_text_lines": ORACLES["word_count"].replace("documents)", "(SELECT unnest(string_split(text, chr(10))) AS text, 0 AS doc_id FROM documents))"),
    "stream_jdbc_insert": "SELECT event_id, event_type, epoch_us(ts) // 1000 AS ms FROM events",
    "stream_enrich": ORACLES["broadcast_enrich"],
    "stream_changelog": ORACLES["changelog_sum"],
    "stream_running_sum": ORACLES["running_sum"],
    "stream_keyed_reduce": ORACLES["running_sum"],
    "stream_sql_group_sum": ORACLES["sql_group_sum"],
    "stream_sql_upper": ORACLES["sql_upper"],
    "stream_union_all": ORACLES["union_all"],
    "stream_connect_map": ORACLES["connect_map"],
    "stream_latest_by_key": ORACLES["latest_by_key"],
    "stream_generate_orders": ORACLES["generate_orders"],
    "stream_decode_value": ORACLES["decode_value"],
    "stream_side_output": ORACLES["side_output"],
    "stream_observed_count": ORACLES["observed_count"],
    "stream_file_sink": ORACLES["file_sink_roundtrip"],
    "stream_changelog_split": ORACLES["changelog_sum"],
    "stream_running_sum_split": ORACLES["running_sum"],
}
