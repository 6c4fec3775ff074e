"""The reference programs as jobs, end to end on their literal inputs."""

from collections import Counter
import json
import os
import time
import uuid

from tidewater.plans import jobs
from tidewater.sinks.jdbc import default_url, read_jdbc
from tidewater.sources import from_data

LINES = ["red fox runs", "an owl naps", "red owl runs far", "red", "far fox"]
COUNTS = dict(Counter(" ".join(LINES).split()))
NOT_RED = {w: n for w, n in COUNTS.items() if w != "red"}


def test_word_count_jobs(spark):
    lines = from_data(spark, LINES, "value string")
    assert {r.word: r.cnt for r in jobs.word_count(lines).collect()} == COUNTS
    s, r = jobs.filtered_sum_and_reduce(lines, "red")
    assert {x.word: x.cnt for x in s.collect()} == {x.word: x.cnt for x in r.collect()} == NOT_RED


def test_union_connect_parity(spark):
    a = from_data(spark, ["oak", "elm", "fir"], "value string")
    n = from_data(spark, [1, 2, 3], "value bigint")
    u, c = jobs.union_and_connect(a, a, n)
    assert u.count() == 6 and c.count() == 6
    routed = jobs.parity_outputs(from_data(spark, list(range(1, 11)), "value int"))
    assert sorted(r.value for r in routed["even"].collect()) == [2, 4, 6, 8, 10]


def test_counted_file_copy(spark, tmp_dir):
    lines = from_data(spark, ["p1", "p2", "p3", "p4", "q5"] * 2, "value string").repartition(2)
    assert jobs.counted_file_copy(lines, tmp_dir) == 10
    files = [f for _, _, fs in os.walk(tmp_dir) for f in fs if not f.startswith(("_", "."))]
    assert files and all(f.endswith(".txt") for f in files)


def test_enrich_and_sql_jobs(spark):
    users = from_data(spark, [(1, "Ada"), (2, "Ben"), (3, "Cy")], "id int, name string")
    scores = from_data(spark, [(1, "art", 41), (2, "maths", 73), (3, "music", 95)],
                       "id int, subject string, score int")
    out = jobs.enrich_scores(scores, users).select("id", "name", "subject", "score")
    assert sorted(map(tuple, out.collect()))[0] == (1, "Ada", "art", 41)
    names = from_data(spark, ["Nora", "Omar", "Pia"], "value string")
    assert sorted(f"{r.op}[{r.f0}]" for r in jobs.sql_upper(spark, names).collect()) == \
        ["+I[NORA]", "+I[OMAR]", "+I[PIA]"]
    wc = from_data(spark, [(0, "Nora", 7), (1, "Omar", 4), (2, "Nora", 31)],
                   "seq bigint, name string, score bigint")
    final, log = jobs.sql_sum_changelog(spark, wc, "seq")
    assert {r.name: r.score for r in final.collect()} == {"Nora": 38, "Omar": 4}
    assert [f"{r.op}[{r.name},{r.score}]" for r in log.orderBy("seq", "pos").collect()] == \
        ["+I[Nora,7]", "+I[Omar,4]", "-U[Nora,7]", "+U[Nora,38]"]


def test_generated_orders_into_database(spark, tmp_dir):
    url = default_url(f"g{uuid.uuid4().hex[:8]}")
    q = jobs.generated_orders_to_jdbc(spark, url, "T_ORDER", f"{tmp_dir}/ckpt",
                                      rows_per_second=10, marker_table="ORDER_BATCHES")
    try:
        deadline, n = time.time() + 60, 0
        while time.time() < deadline and n < 10:
            time.sleep(1)
            try:
                n = read_jdbc(spark, url, "T_ORDER").count()
            except Exception:
                pass
    finally:
        q.stop()
    rows = read_jdbc(spark, url, "T_ORDER").collect()
    assert len(rows) >= 10 and len({r.id for r in rows}) == len(rows)
    assert all(0 <= r.userId < 1000 and 0 <= r.money < 1000 and r.createTime.year >= 2024 for r in rows)


def test_running_word_count_to_store(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    os.makedirs(src)
    store_dir = f"{tmp_dir}/store"
    os.makedirs(store_dir)

    class FileClient:
        def __init__(self):
            self.path = os.path.join(store_dir, f"{uuid.uuid4().hex}.log")

        def hset(self, name, field, value):
            with open(self.path, "a") as f:
                f.write(json.dumps([time.time_ns(), name, field, value]) + "\n")

    def feed(lines):
        with open(f"{src}/{uuid.uuid4().hex}.txt", "w") as f:
            f.write("\n".join(lines) + "\n")

    from tidewater.sources import text_lines
    for part in (LINES[:2], LINES[2:]):
        feed(part)
        q = jobs.running_word_count_to_store(text_lines(spark, "files", path=src), FileClient,
                                             f"{tmp_dir}/ckpt")
        q.processAllAvailable()
        q.stop()
    writes = sorted(json.loads(line) for p in os.listdir(store_dir) for line in open(f"{store_dir}/{p}"))
    store = {}
    for _, name, field, value in writes:
        store[field] = value
    assert store == {w: str(n) for w, n in COUNTS.items()}


def test_window_word_count_fires(spark, tmp_dir):
    from tidewater.sources import text_lines
    src = f"{tmp_dir}/in"
    os.makedirs(src)
    with open(f"{src}/a.txt", "w") as f:
        f.write("a b a\n")
    counts = jobs.window_word_count(text_lines(spark, "files", path=src), size_ms=1000)
    q = (counts.writeStream.format("parquet").option("checkpointLocation", f"{tmp_dir}/ckpt")
         .trigger(processingTime="200 milliseconds").start(f"{tmp_dir}/out"))
    try:
        deadline, got = time.time() + 60, {}
        while time.time() < deadline and len(got) < 2:
            time.sleep(1)
            try:
                got = {r.word: r.cnt for r in spark.read.schema(
                    "window_start timestamp, word string, cnt bigint").parquet(f"{tmp_dir}/out").collect()}
            except Exception:
                pass
    finally:
        q.stop()
    assert got == {"a": 2, "b": 1}
