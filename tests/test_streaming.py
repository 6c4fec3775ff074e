"""Streaming forms: stream/batch parity, state across micro-batches, timers."""

import json
import os
import time
import uuid

from pyspark.sql import functions as F

from tidewater import operators as ops
from tidewater.sources import table_stream, text_lines
from tidewater.streaming import (drain, processing_time_window_counts, stream_changelog,
                                 stream_enrich)

SF = "/root/testdata/sf0.001"


def put(folder, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, f"{uuid.uuid4().hex}.json"), "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")


def same(a, b):
    return a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_word_count_parity(spark):
    docs = table_stream(spark, SF, "documents")
    streamed = drain(ops.count_by(ops.tokenize_words(docs, "text"), "word", "cnt"), "wc", "complete")
    batch = ops.count_by(ops.tokenize_words(spark.read.parquet(f"{SF}/documents.parquet"), "text"),
                         "word", "cnt")
    assert same(streamed, batch.select(streamed.columns))


def test_text_file_stream_word_count_update_mode(spark, tmp_dir):
    src = os.path.join(tmp_dir, "lines")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("one two\ntwo three two\nthree\n")
    lines = text_lines(spark, "files", path=src)
    counts = ops.count_by(ops.tokenize_words(lines), "word", "cnt")
    got = {r.word: r.cnt for r in drain(counts, "wc-text", "update", keys="word").collect()}
    assert got == {"one": 1, "two": 3, "three": 2}


def test_tumbling_parity_event_time(spark):
    ev = table_stream(spark, SF, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    win = ops.tumbling_aggregate(ev, "ts", "1 hour", "event_type", watermark="10 minutes")
    streamed = drain(win, "tumble", "update", keys=["window_start", "event_type"])
    batch = ops.tumbling_aggregate(spark.read.parquet(f"{SF}/events.parquet")
                                   .select(F.col("ts").cast("timestamp").alias("ts"), "event_type"),
                                   "ts", "1 hour", "event_type")
    assert same(streamed, batch.select(streamed.columns))


def _enrich_run(spark, base, clear_buffer, steps):
    users_dir, scores_dir = f"{base}/users", f"{base}/scores"
    os.makedirs(users_dir, exist_ok=True)
    os.makedirs(scores_dir, exist_ok=True)
    out = f"{base}/out"
    results = []
    for users, scores in steps:
        if users:
            put(users_dir, users)
        if scores:
            put(scores_dir, scores)
        u = spark.readStream.schema("id int, name string").json(users_dir)
        s = spark.readStream.schema("id int, subject string, score int").json(scores_dir)
        q = stream_enrich(s, u, "id", ["subject", "score"], ["name"], clear_buffer=clear_buffer)
        res = drain(q, "enrich", "append", path=out)
        results.append(sorted(map(tuple, res.collect())))
    return results


SCORES = [{"id": 1, "subject": "art", "score": 41}, {"id": 2, "subject": "maths", "score": 73},
          {"id": 3, "subject": "music", "score": 95}]
USERS = [{"id": 1, "name": "Ada"}, {"id": 2, "name": "Ben"}, {"id": 3, "name": "Cy"}]
G8 = [(1, "Ada", "art", 41), (2, "Ben", "maths", 73), (3, "Cy", "music", 95)]


def test_enrich_scores_before_users_are_buffered(spark, tmp_dir):
    r = _enrich_run(spark, tmp_dir, False, [([], SCORES), (USERS, []),
                                            ([{"id": 1, "name": "Zhang"}], [])])
    assert r[0] == []
    assert r[1] == G8
    # re-sent user: the buffered score is emitted again under the new name
    assert r[2] == sorted(G8 + [(1, "Zhang", "art", 41)])


def test_enrich_clear_buffer(spark, tmp_dir):
    r = _enrich_run(spark, tmp_dir, True, [([], SCORES), (USERS, []),
                                           ([{"id": 1, "name": "Zhang"}], [])])
    assert r[1] == G8 and r[2] == G8


def test_enrich_users_first_not_reemitted(spark, tmp_dir):
    r = _enrich_run(spark, tmp_dir, False, [(USERS, []), ([], SCORES),
                                            ([{"id": 1, "name": "Zhang"}], [])])
    assert r[1] == G8 and r[2] == G8


def test_changelog_across_batches(spark, tmp_dir):
    src, out = f"{tmp_dir}/in", f"{tmp_dir}/out"
    steps = [[{"seq": 0, "name": "Nora", "score": 7}, {"seq": 1, "name": "Omar", "score": 4}],
             [{"seq": 2, "name": "Nora", "score": 31}],
             [{"seq": 3, "name": "Omar", "score": 0}]]
    for rows in steps:
        put(src, rows)
        df = spark.readStream.schema("seq bigint, name string, score bigint").json(src)
        res = drain(stream_changelog(df, "name", "seq", "score", out="score"), "log", "append", path=out)
    got = [f"{r.op}[{r.name},{r.score}]" for r in res.orderBy("seq", "pos").collect()]
    assert got == ["+I[Nora,7]", "+I[Omar,4]", "-U[Nora,7]", "+U[Nora,38]"]


def test_changelog_stream_equals_batch(spark):
    ev = table_stream(spark, SF, "events").select("event_id", "event_type", "user_id")
    streamed = drain(stream_changelog(ev, "event_type", "event_id", "user_id"), "log2", "append")
    batch = ops.changelog_sum(spark.read.parquet(f"{SF}/events.parquet"), "event_type", "event_id",
                              "user_id", keep=["event_id"])
    assert same(streamed, batch.select(streamed.columns))


def test_processing_time_window_fires_on_idle_input(spark, tmp_dir):
    src, out = f"{tmp_dir}/in", f"{tmp_dir}/out"
    put(src, [{"word": w} for w in "a a b a".split()])
    df = spark.readStream.schema("word string").json(src)
    q = (processing_time_window_counts(df, "word", 1000).writeStream.format("parquet")
         .option("checkpointLocation", f"{tmp_dir}/ckpt").trigger(processingTime="200 milliseconds")
         .start(out))
    try:
        deadline = time.time() + 60
        got = {}
        while time.time() < deadline and len(got) < 2:
            time.sleep(1)
            try:
                got = {r.word: r.cnt for r in spark.read.schema(
                    "window_start timestamp, word string, cnt bigint").parquet(out).collect()}
            except Exception:
                pass
        assert got == {"a": 3, "b": 1}
    finally:
        q.stop()


def _wait_rows(spark, schema, path, n, timeout=60):
    deadline = time.time() + timeout
    while time.time() < deadline:
        time.sleep(1)
        try:
            rows = spark.read.schema(schema).parquet(path).collect()
            if len(rows) >= n:
                return rows
        except Exception:
            pass
    return []


def test_rate_limited_order_stream(spark, tmp_dir):
    import re
    from tidewater.sources import order_stream
    q = (order_stream(spark, rows_per_second=10, num_partitions=2).writeStream.format("parquet")
         .option("checkpointLocation", f"{tmp_dir}/ckpt").trigger(processingTime="500 milliseconds")
         .start(f"{tmp_dir}/out"))
    try:
        rows = _wait_rows(spark, "seq bigint, id string, userId int, money int, createTime bigint",
                          f"{tmp_dir}/out", 10)
    finally:
        q.stop()
    assert len(rows) >= 10 and len({r.id for r in rows}) == len(rows)
    assert all(re.fullmatch(r"[0-9A-F]{32}", r.id) and 0 <= r.userId < 1000 and 0 <= r.money < 1000
               and r.createTime > 1_600_000_000_000 for r in rows)


def test_processing_time_window_watermark_form(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    put(src, [{"word": w} for w in "a a b".split()])
    df = spark.readStream.schema("word string").json(src)
    win = ops.processing_time_window(df, "1 second", "word", watermark="0 seconds")
    q = (win.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", f"{tmp_dir}/ckpt").trigger(processingTime="300 milliseconds")
         .start(f"{tmp_dir}/out"))
    try:
        time.sleep(3)
        put(src, [{"word": "c"}])  # a later batch moves the watermark past the first window
        rows = _wait_rows(spark, "window_start timestamp, word string, cnt bigint", f"{tmp_dir}/out", 2)
    finally:
        q.stop()
    got = {r.word: r.cnt for r in rows}
    assert got.get("a") == 2 and got.get("b") == 1


def test_fan_out_and_rolling_text_stream(spark, tmp_dir):
    from tidewater.sinks import read_buckets, rolling_text_stream
    from tidewater.streaming import fan_out_stream
    src = f"{tmp_dir}/in"
    put(src, [{"value": v} for v in ["p1", "p2", "p3", "p4", "q5"] * 2])
    df = spark.readStream.schema("value string").json(src)

    def to_parquet(b, i):
        b.write.mode("append").parquet(f"{tmp_dir}/copy")

    def to_count(b, i):
        b.groupBy().count().write.mode("append").parquet(f"{tmp_dir}/count")

    q = fan_out_stream(df, [to_parquet, to_count], f"{tmp_dir}/ckpt1", {"availableNow": True})
    q.awaitTermination(120)
    assert spark.read.parquet(f"{tmp_dir}/copy").count() == 10
    assert spark.read.parquet(f"{tmp_dir}/count").first()[0] == 10
    q2 = rolling_text_stream(df, f"{tmp_dir}/files", f"{tmp_dir}/ckpt2", trigger="1 second")
    try:
        deadline = time.time() + 60
        n = 0
        while time.time() < deadline and n < 10:
            time.sleep(1)
            try:
                n = read_buckets(spark, f"{tmp_dir}/files").count()
            except Exception:
                pass
    finally:
        q2.stop()
    assert n == 10


def test_row_sink_open_invoke_close(spark, tmp_dir):
    from tidewater.streaming import RowSink, row_sink_stream
    src, out = f"{tmp_dir}/in", f"{tmp_dir}/rows"
    os.makedirs(out)
    put(src, [{"value": i} for i in range(7)])

    class FileRows(RowSink):
        def open(self, partition_id, epoch_id):
            self.f = open(f"{out}/{partition_id}-{epoch_id}-{uuid.uuid4().hex}.txt", "w")
            return True

        def invoke(self, row):
            self.f.write(f"{row.value}\n")

        def close(self, error):
            self.f.close()

    df = spark.readStream.schema("value int").json(src)
    q = row_sink_stream(df, FileRows, f"{tmp_dir}/ckpt", {"availableNow": True})
    q.awaitTermination(120)
    got = sorted(int(x) for p in os.listdir(out) for x in open(f"{out}/{p}").read().split())
    assert got == list(range(7))


def test_enrich_hot_key_spread_over_salts(spark, tmp_dir):
    users_dir, scores_dir = f"{tmp_dir}/users", f"{tmp_dir}/scores"
    put(scores_dir, [{"id": 1, "subject": f"s{i}", "score": i} for i in range(200)]
        + [{"id": 2, "subject": "x", "score": 7}])
    put(users_dir, [{"id": 1, "name": "hot"}, {"id": 2, "name": "cold"}])
    u = spark.readStream.schema("id int, name string").json(users_dir)
    s = spark.readStream.schema("id int, subject string, score int").json(scores_dir)
    res = drain(stream_enrich(s, u, "id", ["subject", "score"], ["name"], salts=4), "hot", "append")
    got = sorted(map(tuple, res.collect()))
    assert got == sorted([(1, "hot", f"s{i}", i) for i in range(200)] + [(2, "cold", "x", 7)])


def test_stream_keyed_reduce_per_record(spark, tmp_dir):
    from tidewater.streaming import stream_keyed_reduce
    src, out = f"{tmp_dir}/in", f"{tmp_dir}/out"
    batches = [[{"seq": 0, "word": "oak", "one": 1}, {"seq": 1, "word": "elm", "one": 1},
                {"seq": 2, "word": "oak", "one": 1}],
               [{"seq": 3, "word": "oak", "one": 1}, {"seq": 4, "word": "elm", "one": 1}]]
    for rows in batches:
        put(src, rows)
        df = spark.readStream.schema("seq bigint, word string, one bigint").json(src)
        res = drain(stream_keyed_reduce(df, "word", "seq", "one", lambda a, b: a + b), "red", "append",
                    path=out)
    got = [(r.seq, r.word, r.one) for r in res.orderBy("seq").collect()]
    assert got == [(0, "oak", 1), (1, "elm", 1), (2, "oak", 2), (3, "oak", 3), (4, "elm", 2)]


def test_stream_observed_count_and_routed_outputs(spark, tmp_dir):
    from tidewater.streaming import route_stream
    src = f"{tmp_dir}/in"
    put(src, [{"value": v} for v in range(1, 11)])
    df = spark.readStream.schema("value int").json(src)
    counted, name = ops.observed_count(df, "elementCounter")
    from tidewater.functions.rows import parity_tag

    def sink(tag):
        return lambda b, i: b.write.mode("append").parquet(f"{tmp_dir}/{tag}")

    q = route_stream(counted, parity_tag("value"), {"even": sink("even"), "odd": sink("odd")},
                     f"{tmp_dir}/ckpt", {"availableNow": True})
    q.awaitTermination(120)
    assert sorted(r.value for r in spark.read.parquet(f"{tmp_dir}/even").collect()) == [2, 4, 6, 8, 10]
    assert sorted(r.value for r in spark.read.parquet(f"{tmp_dir}/odd").collect()) == [1, 3, 5, 7, 9]
    seen = sum(p["observedMetrics"][name]["elementCounter"] for p in q.recentProgress
               if name in p.get("observedMetrics", {}))
    assert seen == 10


def test_enrich_stream_static_join(spark):
    orders = table_stream(spark, SF, "orders").select(
        F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("subject"),
        F.col("o_totalprice").alias("score"))
    customers = spark.read.parquet(f"{SF}/customer.parquet").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    streamed = drain(ops.enrich(orders, customers, "id").select("id", "name", "subject", "score"),
                     "stream-static", "append")
    batch = ops.enrich(spark.read.parquet(f"{SF}/orders.parquet").select(
        F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("subject"),
        F.col("o_totalprice").alias("score")), customers, "id").select("id", "name", "subject", "score")
    assert same(streamed, batch)


def test_enrich_buffer_keeps_integer_values(spark, tmp_dir):
    # scores buffered from a micro-batch whose Arrow batch also carries null
    # (dimension) rows reach pandas as floats; they must come back as integers
    steps = [([(1, "ann")], [(3, "x", 0)] * 4),
             ([], [(1, "x", 0), (4, "x", 0), (3, "x", 0), (1, "x", 0)]),
             ([(1, "ann"), (2, "ann"), (3, "ann")], [])]
    os.makedirs(f"{tmp_dir}/u")
    os.makedirs(f"{tmp_dir}/s")
    for i, (users, scores) in enumerate(steps):
        put(f"{tmp_dir}/u", [{"id": k, "name": n} for k, n in users])
        put(f"{tmp_dir}/s", [{"id": k, "subject": s, "score": v} for k, s, v in scores])
        u = spark.readStream.schema("id int, name string").option("maxFilesPerTrigger", 1).json(f"{tmp_dir}/u")
        s = spark.readStream.schema("id int, subject string, score int").json(f"{tmp_dir}/s")
        res = drain(stream_enrich(s, u, "id", ["subject", "score"], ["name"], salts=2), "ints", "append",
                    path=f"{tmp_dir}/out")
    got = sorted(map(tuple, res.collect()))
    assert got == sorted([(1, "ann", "x", 0)] * 2 + [(3, "ann", "x", 0)] * 5)


def test_table_stream_over_a_directory_table(spark, tmp_dir):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    ev.repartition(3).write.parquet(f"{tmp_dir}/events.parquet")
    streamed = drain(table_stream(spark, tmp_dir, "events", max_files_per_trigger=1)
                     .select("event_id", "event_type"), "dir-table", "append")
    assert same(streamed, ev.select("event_id", "event_type"))


def test_stream_running_sum_of_doubles(spark):
    from tidewater.streaming import stream_running_sum
    ev = table_stream(spark, SF, "events").select("event_id", "event_type", "value")
    streamed = drain(stream_running_sum(ev, "event_type", "event_id", "value"), "dbl", "append")
    batch = ops.running_sum(spark.read.parquet(f"{SF}/events.parquet"), "event_type", "event_id", "value")
    got = {r.event_id: r.running for r in streamed.collect()}
    want = {r.event_id: r.running for r in batch.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 * max(1, abs(want[k])) for k in got)


def test_split_running_batches_replay_is_idempotent(spark, tmp_dir):
    from tidewater.streaming import running_batches
    fn = running_batches("name", "seq", "score", "score", f"{tmp_dir}/out", f"{tmp_dir}/state",
                         parts=3)
    b0 = from_rows(spark, [(0, "Nora", 7), (1, "Omar", 4)])
    b1 = from_rows(spark, [(2, "Nora", 31), (3, "Nora", 0)])
    b2 = from_rows(spark, [(4, "Omar", 5)])
    fn(b0, 0)
    fn(b1, 1)
    fn(b1, 1)  # replayed after a failure: same inputs, same outputs
    fn(b2, 2)
    got = [f"{r.op}[{r.name},{r.score}]" for r in
           spark.read.parquet(f"{tmp_dir}/out").orderBy("seq", "pos").collect()]
    assert got == ["+I[Nora,7]", "+I[Omar,4]", "-U[Nora,7]", "+U[Nora,38]",
                   "-U[Omar,4]", "+U[Omar,9]"]


def from_rows(spark, rows):
    from tidewater.sources import from_data
    return from_data(spark, rows, "seq bigint, name string, score bigint")


def test_clock_windows_hold_each_row_once(spark, tmp_dir):
    """Rows of several batches over several windows: bounds on the grid, sums equal, nothing left in the state."""
    from tidewater.streaming import drain_timers
    rows = [{"word": w, "n": i} for i, w in enumerate("a b a hot hot hot c".split() * 20)] + [{"word": None, "n": 1}]
    for k in range(0, len(rows), 30):
        put(f"{tmp_dir}/in", rows[k:k + 30])
    df = spark.readStream.schema("word string, n int").option("maxFilesPerTrigger", 1).json(f"{tmp_dir}/in")
    out = drain_timers(processing_time_window_counts(df, "word", 1000, "n", out="total"), "clock", every="300 milliseconds")
    got = out.collect()
    want = {}
    for r in rows:
        want[r["word"]] = want.get(r["word"], 0) + r["n"]
    total = {}
    for r in got:
        total[r.word] = total.get(r.word, 0) + r.total
        assert r.window_start.microsecond == 0
    assert total == want
    assert len({(r.word, r.window_start) for r in got}) == len(got)


def test_enrich_buffer_expires(spark, tmp_dir):
    """A record that waits longer than the time to live leaves the state; a later one is released."""
    os.makedirs(f"{tmp_dir}/u")
    os.makedirs(f"{tmp_dir}/s")
    u = spark.readStream.schema("id int, name string").json(f"{tmp_dir}/u")
    s = spark.readStream.schema("id int, subject string").json(f"{tmp_dir}/s")
    joined = stream_enrich(s, u, "id", ["subject"], ["name"], salts=1, buffer_ttl_ms=20_000)
    q = joined.writeStream.format("parquet").option("checkpointLocation", f"{tmp_dir}/c").trigger(processingTime="200 milliseconds").start(f"{tmp_dir}/o")

    def batch(folder, rows):
        """Put rows and wait until a batch has read them."""
        seen = sum(p["numInputRows"] for p in q.recentProgress)
        put(folder, rows)
        end = time.time() + 120
        while sum(p["numInputRows"] for p in q.recentProgress) <= seen and time.time() < end and q.isActive:
            time.sleep(0.2)

    try:
        batch(f"{tmp_dir}/s", [{"id": 1, "subject": "orphan"}])
        time.sleep(25)
        batch(f"{tmp_dir}/s", [{"id": 1, "subject": "later"}, {"id": 2, "subject": "x"}])
        batch(f"{tmp_dir}/u", [{"id": 1, "name": "Ada"}, {"id": 2, "name": "Ben"}])
        got = _wait_rows(spark, "id int, name string, subject string", f"{tmp_dir}/o", 2)
    finally:
        q.stop()
    assert sorted(map(tuple, got)) == [(1, "Ada", "later"), (2, "Ben", "x")]


def test_enrich_values_come_back_exactly(spark, tmp_dir):
    """Types, nulls, microseconds, big integers and newlines of buffered records and of values."""
    import datetime
    rec = [(1, 2**53 + 1, None, 0.1, "a\nb \"\\", datetime.datetime(2024, 1, 1, 1, 2, 3, 456789), True),
           (1, None, 7, float("nan"), None, None, None), (2, -5, 1, float("inf"), "", datetime.datetime(1969, 1, 1), False)]
    schema = "id int, big bigint, small smallint, x double, s string, t timestamp, b boolean"
    spark.createDataFrame(rec, schema).write.parquet(f"{tmp_dir}/r")
    spark.createDataFrame([(1, 2**60 + 1, None), (2, None, "n")], "id int, v bigint, n string").write.parquet(f"{tmp_dir}/d1")
    os.makedirs(f"{tmp_dir}/d")
    r = spark.readStream.schema(schema).parquet(f"{tmp_dir}/r")
    for step in range(2):
        d = spark.readStream.schema("id int, v bigint, n string").parquet(f"{tmp_dir}/d")
        out = drain(stream_enrich(r, d, "id", ["big", "small", "x", "s", "t", "b"], ["v", "n"], salts=3, buckets=2), "exact", "append", path=f"{tmp_dir}/o")
        for name in os.listdir(f"{tmp_dir}/d1") if step == 0 else ():
            os.link(f"{tmp_dir}/d1/{name}", f"{tmp_dir}/d/{name}")
    want = [(i, *dict([(1, (2**60 + 1, None)), (2, (None, "n"))])[i], *rest) for i, *rest in rec]
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, want))
