"""Inputs the sample tables do not hold: null keys, late rows, outliers, ties,
integers beyond 2**53, broken paths.  Streams must give the batch answer."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tidewater import operators as ops
from tidewater.sources import from_data, table_stream
from tidewater.sources.tables import table_path
from tidewater.streaming import drain, stream_changelog, stream_enrich, stream_keyed_reduce, stream_running_sum
from tidewater.streaming.batched_state import stream_running_batches

BIG = 2**53 + 1


def files(folder, *batches):
    os.makedirs(folder)
    for n, rows in enumerate(batches):
        with open(f"{folder}/{n}.json", "w") as f:
            f.writelines(json.dumps(r) + "\n" for r in rows)
        os.utime(f"{folder}/{n}.json", (1_700_000_000 + n, 1_700_000_000 + n))  # the order they are read in


def stream(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(folder)


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


SCHEMA = "seq bigint, k bigint, v bigint"
BATCHES = [[{"seq": 0, "k": None, "v": 1}, {"seq": 1, "k": 2, "v": None}],
           [{"seq": 2, "k": None, "v": 1}, {"seq": 3, "k": 2, "v": BIG}, {"seq": 4, "k": 0, "v": 5}],
           [{"seq": 5, "k": None, "v": None}, {"seq": 6, "k": 2, "v": 0}, {"seq": 7, "k": None, "v": 1}]]


def everything(spark):
    return from_data(spark, [(r["seq"], r["k"], r["v"]) for b in BATCHES for r in b], SCHEMA)


def test_running_sums_agree_on_nulls_and_big_integers(spark, tmp_dir):
    files(f"{tmp_dir}/in", *BATCHES)
    batch = rows_of(ops.running_sum(everything(spark), "k", "seq", "v", parts=3), "seq", "k", "running")
    assert batch == sorted([(0, None, 1), (1, 2, None), (2, None, 2), (3, 2, BIG), (4, 0, 5), (5, None, 2), (6, 2, BIG),
                            (7, None, 3)], key=repr)
    state = drain(stream_running_sum(stream(spark, f"{tmp_dir}/in", SCHEMA), "k", "seq", "v"), "r", "append")
    assert rows_of(state, "seq", "k", "running") == batch
    stream_running_batches(stream(spark, f"{tmp_dir}/in", SCHEMA), "k", "seq", "v", "running", f"{tmp_dir}/o", f"{tmp_dir}/c",
                           emit="running", trigger={"availableNow": True}).awaitTermination()
    assert rows_of(spark.read.parquet(f"{tmp_dir}/o/data"), "seq", "k", "running") == batch


def test_changelogs_agree_on_nulls(spark, tmp_dir):
    files(f"{tmp_dir}/in", *BATCHES)
    cols = ("seq", "pos", "op", "k", "s")
    batch = rows_of(ops.changelog_sum(everything(spark), "k", "seq", "v", keep=["seq"], parts=2), *cols)
    assert (1, 0, "+I", 2, None) in batch and (3, 0, "-U", 2, None) in batch and (3, 1, "+U", 2, BIG) in batch
    state = drain(stream_changelog(stream(spark, f"{tmp_dir}/in", SCHEMA), "k", "seq", "v"), "c", "append")
    assert rows_of(state, *cols) == batch
    stream_running_batches(stream(spark, f"{tmp_dir}/in", SCHEMA), "k", "seq", "v", "s", f"{tmp_dir}/o", f"{tmp_dir}/c",
                           trigger={"availableNow": True}).awaitTermination()
    assert rows_of(spark.read.parquet(f"{tmp_dir}/o/data"), *cols) == batch


def test_stream_reduce_on_nulls(spark, tmp_dir):
    files(f"{tmp_dir}/in", *BATCHES)
    out = drain(stream_keyed_reduce(stream(spark, f"{tmp_dir}/in", SCHEMA), "k", "seq", "v", lambda a, b: a + b), "d", "append")
    assert {(r.k, r.v) for r in out.where("seq >= 6").collect()} == {(2, BIG), (None, 3)}, rows_of(out, "seq", "k", "v")


def test_enrichment_never_matches_null_ids(spark, tmp_dir):
    files(f"{tmp_dir}/r", [{"id": None, "s": "lost"}, {"id": 0, "s": "a"}], [{"id": 1, "s": "b"}, {"id": None, "s": "lost"}])
    files(f"{tmp_dir}/d", [{"id": 1, "n": "one"}, {"id": None, "n": "none"}], [{"id": 0, "n": "zero"}])
    out = drain(stream_enrich(stream(spark, f"{tmp_dir}/r", "id bigint, s string"), stream(spark, f"{tmp_dir}/d", "id bigint, n string"),
                              "id", ["s"], ["n"]), "e", "append")
    assert rows_of(out, "id", "n", "s") == [(0, "zero", "a"), (1, "one", "b")]


def test_windows_keep_rows_out_of_time_order(spark, tmp_dir):
    files(f"{tmp_dir}/in", [{"ts": "2024-01-02 00:00:01", "k": "a"}], [{"ts": "2024-01-01 00:00:01", "k": "a"}],
          [{"ts": "2023-01-01 00:00:01", "k": "a"}])
    win = ops.tumbling_aggregate(stream(spark, f"{tmp_dir}/in", "ts timestamp, k string"), "ts", "5 seconds", "k")
    assert drain(win, "w", "update", keys=["window_start", "k"]).agg(F.sum("cnt")).first()[0] == 3


def test_reduce_keeps_null_keys_and_exact_integers(spark):
    rows = [("a", 2**53), ("a", 1), ("a", None), ("b", None), (None, 4), (None, 5)] * 3
    out = ops.keyed_reduce(from_data(spark, rows, "k string, v bigint").repartition(4), "k", "v", max, flush_keys=1)
    assert {r.k: r.v for r in out.collect()} == {"a": 2**53, "b": None, None: 5}
    total = ops.keyed_reduce(from_data(spark, [("a", BIG), ("a", None)], "k string, v bigint"), "k", "v", lambda a, b: a + b)
    assert total.first().v == BIG


def test_ranges_stay_even_with_outliers_and_ties(spark):
    rows = [(i if i else 10**12, 1) for i in range(4000)] + [(None, 1)] * 4000
    df = from_data(spark, rows, "seq bigint, v bigint").withColumn("k", F.lit("hot"))
    from tidewater.operators.running import _ranges
    sizes = [r["count"] for r in _ranges(df, ["k", "seq"], 8).groupBy("__part").count().collect()]
    assert max(sizes) < 2 * len(rows) / 8
    assert ops.running_sum(df, "k", "seq", "v", parts=8).agg(F.max("running"), F.count("*")).first()[:] == (8000, 8000)


def test_running_sum_over_a_text_order(spark):
    df = from_data(spark, [("b", 2), ("a", 1), (None, 4)], "o string, v bigint").withColumn("k", F.lit(1))
    assert rows_of(ops.running_sum(df, "k", "o", "v", parts=2), "o", "running") == [("a", 5), ("b", 7), (None, 4)]


def test_missing_table_is_an_error(spark, tmp_dir):
    with pytest.raises(Exception):  # noqa: B017  any error, but no empty stream
        table_stream(spark, tmp_dir, "orders")


def test_directory_table_streams_all_its_files(spark, tmp_dir):
    spark.range(100).repartition(5).write.parquet(table_path(tmp_dir, "events"))
    df = table_stream(spark, tmp_dir, "events", max_files_per_trigger=1)
    assert drain(df, "dir", "append").count() == 100


def test_rewritten_table_shows_its_new_schema(spark, tmp_dir):
    from tidewater.sources import read_table
    for column in ("a", "b"):
        spark.range(3).toDF(column).write.mode("overwrite").parquet(table_path(tmp_dir, "part"))
        assert read_table(spark, tmp_dir, "part").columns == [column]
