"""Sinks and connectors: JDBC (embedded in-memory Derby, this process only),
keyed upsert with an injected client, Kafka value decoding, console."""

import glob
import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from tidewater.sinks import (collapse_latest, jdbc_insert, jdbc_stream_writer, print_rows, read_buckets,
                             read_jdbc, rolling_text_stream, upsert_partitions, write_rolling_text)
from tidewater.sinks.jdbc import default_url
from tidewater.sources import decode_value, from_data, kafka_options


def _create(spark, url, ddl):
    # Spark runs ``sessionInitStatement`` on the connection it opens to read
    spark.read.jdbc(url, "SYSIBM.SYSDUMMY1", properties={
        "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver", "sessionInitStatement": ddl}).count()


def test_g9_insert_database_assigns_id(spark):
    url = default_url(f"t{uuid.uuid4().hex[:8]}")
    _create(spark, url, "CREATE TABLE T_STUDENT (ID INT GENERATED ALWAYS AS IDENTITY, "
                        "NAME VARCHAR(64), AGE INT)")
    students = from_data(spark, [(None, "pupil7", 33)], "id int, name string, age int")
    jdbc_insert(students.select(F.col("name").alias("NAME"), F.col("age").alias("AGE")), url, "T_STUDENT")
    rows = read_jdbc(spark, url, "T_STUDENT").collect()
    assert len(rows) == 1 and rows[0].NAME == "pupil7" and rows[0].AGE == 33 and rows[0].ID >= 1


def test_stream_writer_skips_replayed_batch(spark):
    url = default_url(f"t{uuid.uuid4().hex[:8]}")
    write = jdbc_stream_writer(url, "T_ORDER", marker_table="T_ORDER_BATCHES",
                               millis_to_timestamp=("createTime",))
    batch = from_data(spark, [("A1", 1, 2, 1_700_000_000_000)],
                      "id string, userId int, money int, createTime bigint")
    write(batch, 0)
    write(batch, 0)  # replay of the same micro-batch
    write(batch, 1)
    rows = read_jdbc(spark, url, "T_ORDER").collect()
    assert len(rows) == 2
    assert str(rows[0].createTime).startswith("2023-11-14 22:13:20")


def test_upsert_latest_value_per_key(spark, tmp_dir):
    class FileClient:  # stands in for a Redis client on the executors
        def __init__(self, folder):
            self.path = os.path.join(folder, f"{uuid.uuid4().hex}.log")

        def hset(self, name, field, value):
            with open(self.path, "a") as f:
                f.write(f"{name}\t{field}\t{value}\n")

    updates = from_data(spark, [(0, "a", 1), (1, "b", 1), (2, "a", 2), (3, "a", 3), (4, "b", 2)],
                        "seq int, word string, cnt int")
    latest = collapse_latest(updates, "word", "seq", "cnt")
    upsert_partitions(latest, lambda: FileClient(tmp_dir), "WordCount", "word", "cnt")
    store = {}
    for p in glob.glob(f"{tmp_dir}/*.log"):
        for line in open(p):
            name, field, value = line.rstrip("\n").split("\t")
            store[(name, field)] = value
    assert store == {("WordCount", "a"): "3", ("WordCount", "b"): "2"}


def test_kafka_value_decoding(spark):
    raw = from_data(spark, [(b"hello", 0), ("风急天高".encode(), 1)], "value binary, offset int")
    assert sorted(r.value for r in decode_value(raw).collect()) == sorted(["hello", "风急天高"])
    opts = kafka_options("host:9092", "quickstart-events", "my-group")
    assert opts == {"kafka.bootstrap.servers": "host:9092", "subscribe": "quickstart-events",
                    "startingOffsets": "earliest", "kafka.group.id": "my-group"}


def test_console_label(spark, capsys):
    print_rows(from_data(spark, ["x"], "value string"), label="result1")
    assert "result1" in capsys.readouterr().out


def test_rolling_text_overwrites_and_appends(spark, tmp_dir):
    df = spark.range(40).select(F.col("id").cast("string").alias("value"), F.timestamp_seconds(F.col("id") * 1800).alias("ts"))
    write_rolling_text(df, f"{tmp_dir}/o", bucket_time="ts", max_records_per_file=1)
    write_rolling_text(df.limit(3), f"{tmp_dir}/o", bucket_time="ts")
    assert read_buckets(spark, f"{tmp_dir}/o").count() == 43
    write_rolling_text(df.limit(3), f"{tmp_dir}/o", bucket_time="ts", mode="overwrite", files_per_bucket=2)
    assert read_buckets(spark, f"{tmp_dir}/o").count() == 3


def test_second_stream_query_may_not_share_a_folder(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/0.json", "w") as f:
        f.writelines(json.dumps({"value": str(i), "ts": "2024-01-01 00:00:00"}) + "\n" for i in range(3))
    df = spark.readStream.schema("value string, ts timestamp").json(f"{tmp_dir}/in")
    for _ in range(2):  # the same query may go on
        rolling_text_stream(df, f"{tmp_dir}/out", f"{tmp_dir}/ckpt", bucket_time="ts", trigger=None).awaitTermination()
    with pytest.raises(ValueError):
        rolling_text_stream(df, f"{tmp_dir}/out", f"{tmp_dir}/ckpt2", bucket_time="ts", trigger=None)
    assert read_buckets(spark, f"{tmp_dir}/out").count() == 3


ORDERS = "id string, userId int, money int, createTime bigint"


@pytest.mark.parametrize("broken", [0, 1, 2])
def test_stream_insert_killed_between_its_writes(spark, monkeypatch, broken):
    """A failure before, between or after the copy of the rows and the marker leaves neither; the replay adds each row once."""
    from tidewater.sinks import jdbc
    url = default_url(f"t{uuid.uuid4().hex[:8]}")
    write = jdbc_stream_writer(url, "T_ORDER", marker_table="T_DONE", millis_to_timestamp=("createTime",))
    batches = [from_data(spark, [(f"A{b}{i}", i, b, 1_700_000_000_000) for i in range(50)], ORDERS).repartition(3) for b in range(2)]
    write(batches[0], 0)
    run = jdbc.run_in_transaction

    def killed(spark, url, statements, props=None):
        if len(statements) == 3:  # the publishing transaction
            statements = [*statements[:broken], "INSERT INTO NOWHERE VALUES (1)", *statements[broken:]]
        run(spark, url, statements, props)

    monkeypatch.setattr(jdbc, "run_in_transaction", killed)
    with pytest.raises(Exception, match="NOWHERE"):
        write(batches[1], 1)
    assert read_jdbc(spark, url, "T_ORDER").count() == 50 and read_jdbc(spark, url, "T_DONE").count() == 1
    monkeypatch.undo()
    for batch_id in (1, 1, 0):  # the replay, and batches that are done
        write(batches[batch_id], batch_id)
    rows = read_jdbc(spark, url, "T_ORDER")
    assert rows.count() == rows.select("id").distinct().count() == 100
    assert read_jdbc(spark, url, "T_ORDER_STAGE").count() == 0


def test_stage_rows_written_twice_by_a_lost_task_count_once(spark, monkeypatch):
    from tidewater.sinks import jdbc
    url, insert = default_url(f"t{uuid.uuid4().hex[:8]}"), jdbc.jdbc_insert

    def twice(df, url, table, **kw):
        insert(df, url, table, **kw)
        insert(df.where("TW_ROW % 2 = 0").withColumn("TW_TRY", F.col("TW_TRY") + 1), url, table, **kw)

    monkeypatch.setattr(jdbc, "jdbc_insert", twice)
    jdbc_stream_writer(url, "T_ORDER", marker_table="T_DONE")(from_data(spark, [(f"A{i}", i, i, 0) for i in range(9)], ORDERS), 0)
    assert sorted(r.userId for r in read_jdbc(spark, url, "T_ORDER").collect()) == list(range(9))


def test_jdbc_upsert_over_batches_and_replays(spark):
    from tidewater.sinks import jdbc_upsert_writer
    url = default_url(f"t{uuid.uuid4().hex[:8]}")
    write = jdbc_upsert_writer(url, "T_WORDS", "word", "cnt", order="seq", column_types="word VARCHAR(100)")
    batches = [[(0, "a", 1), (1, "b", 1), (2, "a", 2)], [(3, "c", 1), (4, "a", 3)], []]
    for batch_id in (0, 0, 1, 1, 2):
        write(from_data(spark, batches[batch_id], "seq int, word string, cnt int"), batch_id)
    assert sorted((r.word, r.cnt) for r in read_jdbc(spark, url, "T_WORDS").collect()) == [("a", 3), ("b", 1), ("c", 1)]


def test_rolled_files_keep_the_limit(spark, tmp_dir):
    from tidewater.sinks.rolling_file import read_rolled, write_rolled_text
    rows = [(f"{i}" * (i % 9 + 1), 0 if i % 3 else i * 1800) for i in range(2000)] + [("é" * 300, 0), ("x" * 301, 0), ("", 0), (None, 7200)]
    df = from_data(spark, rows, "value string, s int").select("value", F.timestamp_seconds("s").alias("ts")).repartition(5)
    write_rolled_text(df, f"{tmp_dir}/o", bucket_time="ts", max_bytes=500, parts=6)
    sizes, long = [], 0
    for folder, _, names in os.walk(f"{tmp_dir}/o"):
        parts = [n for n in names if n.endswith(".txt")]
        assert len(parts) <= 1  # one file a folder
        for n in parts:
            size = os.path.getsize(f"{folder}/{n}")
            if size > 500:
                assert "file=-" in folder and len(open(f"{folder}/{n}").read().splitlines()) == 1
                long += 1
            else:
                sizes.append(size)
    assert long == 1 and max(sizes) > 400
    got = read_rolled(spark, f"{tmp_dir}/o")
    assert sorted(r.value for r in got.collect()) == sorted(v or "" for v, _ in rows)
    write_rolled_text(df.limit(0), f"{tmp_dir}/none", bucket_time="ts")
    assert read_rolled(spark, f"{tmp_dir}/none").count() == 0


def test_fan_out_in_one_pass(spark, tmp_dir):
    from tidewater import operators as ops
    df = from_data(spark, [(1, "a"), (2, "b"), (3, None), (None, "d")], "n int, s string")
    out = ops.fan_out_files(df, {"all": F.lit(True), "small": F.col("n") < 3, "none": F.lit(False)}, f"{tmp_dir}/o")
    assert {k: sorted((r.n or 0, r.s or "") for r in v.collect()) for k, v in out.items()} == {
        "all": [(0, "d"), (1, "a"), (2, "b"), (3, "")], "small": [(1, "a"), (2, "b")], "none": []}
