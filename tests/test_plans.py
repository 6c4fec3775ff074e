"""Plan shapes that carry the scale properties: pruned scans, partial
aggregation, shuffle counts, broadcast only within the proven bound."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidewater import operators as ops

SF = "/root/testdata/sf0.001"


@pytest.fixture
def static_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def hash_exchanges(p: str) -> int:
    return len(re.findall(r"Exchange hashpartitioning", p))


def test_word_count_prunes_and_pre_aggregates(spark, static_plans):
    p = plan(entry.queries()["word_count"](spark, SF))
    assert "ReadSchema: struct<text:string>" in p
    assert "partial_count" in p and hash_exchanges(p) == 1


def test_running_sum_shuffles_rows_once_after_the_ranges(spark, static_plans):
    ev = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "event_type", "user_id")
    p = plan(ops.running_sum(ev, "event_type", "event_id", "user_id", parts=7))
    # the rows by (key, range) for the window; totals after a map-side partial sum; offsets broadcast
    assert len(re.findall(r"partial_sum\(user_id", p)) == 1
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p and "RoundRobin" not in p


def test_enrich_broadcast_only_within_bound(spark, static_plans):
    orders = spark.read.parquet(f"{SF}/orders.parquet").select(F.col("o_custkey").alias("id"))
    customers = spark.read.parquet(f"{SF}/customer.parquet").select(
        F.col("c_custkey").alias("id"), "c_name")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(ops.enrich(orders, customers, "id"))
        assert "SortMergeJoin" in plan(ops.enrich(orders, customers, "id", max_rows=100))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_latest_by_key_is_partial_aggregate(spark, static_plans):
    p = plan(entry.queries()["latest_by_key"](spark, SF))
    assert "partial_max_by" in p and "Window" not in p


def test_file_sink_needs_no_shuffle(spark, static_plans, tmp_dir):
    from tidewater.sinks.rolling_file import bucketed
    ev = spark.read.parquet(f"{SF}/events.parquet").select(F.col("event_type").alias("value"), "ts")
    assert "Exchange" not in plan(bucketed(ev, bucket_time="ts"))
