"""Registered queries over the driver tables.

Each function takes ``(spark, sf_dir)``, reads whole tables (column pruning
and filters reach the parquet scan) and returns a DataFrame.  The table a
query stands on replaces the reference's literal input; see FIXTURES.md.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater import operators as ops
from tidewater.functions.rows import parity_tag, prefixed_string
from tidewater.plans import sql as tsql
from tidewater.sources import decode_value, generate_orders, read_table

# Fixed values that must equal the reference's.
STRING_PREFIX = "String->String:"
LONG_PREFIX = "Long->String:"
WINDOW_SIZE = "5 seconds"
# The reference drops its most frequent word; on `documents` that word is:
DROPPED_WORD = "the"
PRIME = 1_000_003  # modulus of the combine function of ``keyed_reduce``


def _words(spark, sf_dir, position: bool = False) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return ops.tokenize_words(docs, "text", "word", keep=["doc_id"],
                              position="pos" if position else None)


def tokenize_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _words(spark, sf_dir)


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.count_by(_words(spark, sf_dir), "word", "cnt")


def char_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "text")
    return ops.count_by(ops.tokenize_chars(docs, "text", "char"), "char", "cnt")


def filter_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.count_by(ops.drop_value(_words(spark, sf_dir), "word", DROPPED_WORD), "word", "cnt")


def keyed_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A combine function no built-in aggregate has: a product modulo a prime."""
    ev = read_table(spark, sf_dir, "events", "event_type", "user_id")
    ev = ev.select("event_type", (F.col("user_id").cast("bigint") % 1000 + 1).alias("user_id"))
    return ops.keyed_reduce(ev, "event_type", "user_id", lambda a, b: a * b % PRIME)


def _maps(spark, sf_dir) -> DataFrame:
    """Each event as a linear map x -> (m x + c) modulo the prime: composing them depends on their order."""
    ev = read_table(spark, sf_dir, "events", "event_id", "event_type", "user_id")
    return ev.select("event_id", "event_type", (F.col("user_id").cast("bigint") % 1000 + 1).alias("m"), (F.col("event_id") % 1000).alias("c"))


def _compose(first: tuple, second: tuple) -> tuple:
    return first[0] * second[0] % PRIME, (first[1] * second[0] + second[1]) % PRIME


def ordered_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Composition of all maps of a type in event order: associative, not commutative."""
    return ops.ordered_reduce(_maps(spark, sf_dir), "event_type", "event_id", ["m", "c"], _compose)


def running_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At every event the composition of its type's maps up to it."""
    return ops.running_reduce(_maps(spark, sf_dir), "event_type", "event_id", ["m", "c"], _compose)


def keyed_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", "event_type", "user_id")
    return ops.keyed_reduce(ev, "event_type", "user_id", "sum")


def connect_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = read_table(spark, sf_dir, "customer", "c_name")
    keys = read_table(spark, sf_dir, "orders", "o_orderkey")
    return ops.connect_map(names, keys, prefixed_string("c_name", STRING_PREFIX),
                           prefixed_string("o_orderkey", LONG_PREFIX))


def side_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", "event_id")
    routed = ops.route(ev, parity_tag("event_id"))
    return routed.tagged


def union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.union_all(read_table(spark, sf_dir, "events", "user_id").toDF("id"),
                         read_table(spark, sf_dir, "orders", "o_custkey").toDF("id"))


def observed_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count every mapped ``lineitem`` row with an observed metric, run the job,
    and return the counter read after it."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber")
    counted, obs = ops.observed_count(li, "counter")
    counted.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(int(obs.get["counter"]),)], "counter bigint")


def partition_local_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-instance counters summed over instances (each counts its own rows)."""
    ev = read_table(spark, sf_dir, "events", "event_id")
    local = ops.with_local_count(ev)
    per_instance = local.groupBy("instance").agg(F.max("local_count").alias("n"))
    return per_instance.agg(F.sum("n").cast("bigint").alias("total"))


def sql_upper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tsql.sql_upper(spark, read_table(spark, sf_dir, "customer", "c_name"))


def sql_group_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", "l_returnflag", "l_quantity")
    return tsql.sql_group_sum(spark, li.select("l_returnflag", F.col("l_quantity").cast("bigint")))


def running_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", "event_id", "event_type", "user_id")
    return ops.running_sum(ev, "event_type", "event_id", "user_id", out="running").drop("user_id")


def changelog_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", "event_id", "event_type", "user_id")
    return ops.changelog_sum(ev, "event_type", "event_id", "user_id", out="s", keep=["event_id"])


def changelog_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.changelog_insert_only(sql_upper(spark, sf_dir))


def tumbling_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", "ts", "event_type")
    return ops.tumbling_aggregate(ev, "ts", WINDOW_SIZE, "event_type", out="cnt")


def broadcast_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders (the keyed records) enriched with the customer's name."""
    scores = read_table(spark, sf_dir, "orders", "o_custkey", "o_orderpriority", "o_totalprice") \
        .toDF("id", "subject", "score")
    users = read_table(spark, sf_dir, "customer", "c_custkey", "c_name").toDF("id", "name")
    return ops.enrich(scores, users, "id").select("id", "name", "subject", "score")


def enrich_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders enriched with their customer's latest event by time of arrival.

    The dimension's versions are the events, keyed by ``user_id``; both arrive at their ``ts`` or ``o_orderdate``,
    taken as the day of the month, so that orders come before, between and after the versions of
    their customer: early ones wait and are emitted with each later version.
    """
    day = lambda c: F.dayofmonth(c).cast("bigint") * 10_000_000
    scores = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate").select(
        F.col("o_custkey").alias("id"), (day("o_orderdate") + F.col("o_orderkey") % 10_000_000).alias("arrival"), F.col("o_orderkey").alias("subject"))
    users = read_table(spark, sf_dir, "events", "event_id", "user_id", "ts", "event_type").select(
        F.col("user_id").cast("bigint").alias("id"), (day("ts") + F.col("event_id") % 10_000_000).alias("arrival"),
        F.concat_ws("-", "event_type", "event_id").alias("name"))
    return ops.enrich_in_order(scores, users, "id", "arrival").select("id", "name", "subject", "arrival")


def latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", "event_id", "event_type", "user_id")
    return ops.latest_by_key(ev, "event_type", "event_id", "user_id")


def generate_orders_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One generated order per ``orders`` key, the key as sequence number."""
    return generate_orders(read_table(spark, sf_dir, "orders", "o_orderkey"), "o_orderkey")


def decode_value_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text sent as UTF-8 bytes (a Kafka value) and decoded back."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    as_bytes = docs.select("doc_id", F.encode("text", "UTF-8").alias("value"))
    return decode_value(as_bytes).withColumnRenamed("value", "text")


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-record running word totals, collapsed to the value a keyed upsert
    store (``HSET WordCount word total``) ends with."""
    from tidewater.sinks.upsert import collapse_latest
    w = _words(spark, sf_dir, position=True)
    running = ops.running_sum(w, "word", ["doc_id", "pos"], F.lit(1), out="cnt")
    return collapse_latest(running, "word", ["doc_id", "pos"], "cnt")


def fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read once and written to three outputs: all of them, and those with even and odd ids."""
    from tidewater.session import scratch_path
    ev = read_table(spark, sf_dir, "events", "event_id", "event_type")
    even = F.col("event_id") % 2 == 0
    outputs = ops.fan_out_files(ev, {"all": F.lit(True), "even": even, "odd": ~even}, scratch_path(spark, "fan-out"))
    return ops.union_all(*[df.withColumn("output", F.lit(name)) for name, df in outputs.items()])


def file_sink_rolled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as text lines in hourly folders, rolled at 128 bytes so that the small tables roll too; read back
    with the size of each file."""
    from tidewater.session import scratch_path
    from tidewater.sinks.rolling_file import read_rolled, write_rolled_text
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "event_type")
    lines = ev.select(F.concat_ws(",", F.col("event_id").cast("string"), "event_type").alias("value"), "ts")
    path = scratch_path(spark, "file-sink-rolled")
    write_rolled_text(lines, path, bucket_time="ts", max_bytes=128)
    files = read_rolled(spark, path).groupBy("bucket", "file").agg(F.sum(F.octet_length("value") + 1).alias("size"), F.count("*").alias("n"))
    return files.groupBy("bucket").agg(F.sum("n").alias("lines"), F.sum("size").alias("bytes"),
                                       F.count_if(F.col("size") > 128).alias("files_too_large"))


def file_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as text lines into hourly bucket folders, read back."""
    from tidewater.session import scratch_path
    from tidewater.sinks.rolling_file import read_buckets, write_rolling_text
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "event_type")
    lines = ev.select(F.concat_ws(",", F.col("event_id").cast("string"), "event_type").alias("value"),
                      "ts")
    path = scratch_path(spark, "file-sink")
    write_rolling_text(lines, path, bucket_time="ts")
    return read_buckets(spark, path).select("bucket", "value")


def file_sink_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines with each bucket's rows brought to a few files, read back."""
    from tidewater.session import scratch_path
    from tidewater.sinks.rolling_file import read_buckets, write_rolling_text
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "event_type")
    lines = ev.select(F.concat_ws(",", F.col("event_id").cast("string"), "event_type").alias("value"),
                      "ts")
    path = scratch_path(spark, "file-sink-clustered")
    write_rolling_text(lines, path, bucket_time="ts", files_per_bucket=4)
    return read_buckets(spark, path).select("bucket", "value")


def word_one_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words paired with one, then a keyed sum."""
    return ops.keyed_sum(ops.with_one(_words(spark, sf_dir)), "word", "one", "cnt")


def rich_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map with an open hook: what ``setup`` made once per task is used on every row."""
    ev = read_table(spark, sf_dir, "events", "event_id")

    def number(prefix, batch):
        return batch.assign(value=prefix + batch["event_id"].astype(str))[["value"]]
    return ops.map_partitions_with_setup(ev, lambda: LONG_PREFIX, number, "value string")


def jdbc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``nation`` inserted through the JDBC sink and read back.

    The URL comes from ``tidewater.jdbc.url``; unset, an in-memory Derby
    database inside the Spark JVM is used, which only that process sees.
    """
    from tidewater.sinks.jdbc import default_url, jdbc_insert, read_jdbc
    url = spark.conf.get("tidewater.jdbc.url", None) or default_url()
    table = f"T_NATION_{uuid.uuid4().hex[:12].upper()}"
    rows = read_table(spark, sf_dir, "nation", "n_name", "n_regionkey").toDF("name", "region")
    jdbc_insert(rows, url, table, mode="overwrite")
    return read_jdbc(spark, url, table).select(F.col("NAME").alias("name"),
                                               F.col("REGION").cast("int").alias("region"))


QUERIES = {
    "tokenize_words": tokenize_words,
    "word_count": word_count,
    "char_count": char_count,
    "filter_word_count": filter_word_count,
    "keyed_reduce": keyed_reduce,
    "ordered_reduce": ordered_reduce,
    "running_reduce": running_reduce,
    "enrich_in_order": enrich_in_order,
    "keyed_sum": keyed_sum,
    "connect_map": connect_map,
    "side_output": side_output,
    "union_all": union_all,
    "observed_count": observed_count,
    "partition_local_count": partition_local_count,
    "sql_upper": sql_upper,
    "sql_group_sum": sql_group_sum,
    "running_sum": running_sum,
    "changelog_sum": changelog_sum,
    "changelog_insert_only": changelog_insert_only,
    "tumbling_count": tumbling_count,
    "broadcast_enrich": broadcast_enrich,
    "latest_by_key": latest_by_key,
    "generate_orders": generate_orders_q,
    "decode_value": decode_value_q,
    "upsert_latest": upsert_latest,
    "fan_out": fan_out,
    "file_sink_rolled": file_sink_rolled,
    "file_sink_roundtrip": file_sink_roundtrip,
    "file_sink_clustered": file_sink_clustered,
    "word_one_sum": word_one_sum,
    "rich_map": rich_map,
    "jdbc_roundtrip": jdbc_roundtrip,
}
