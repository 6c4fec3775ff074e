"""Small literal inputs, with answers derived by hand or by plain Python."""

from collections import Counter
import operator
import re

from pyspark.sql import functions as F

from tidewater import operators as ops
from tidewater.functions.rows import parity_tag, prefixed_string
from tidewater.plans import sql as tsql
from tidewater.sources import from_data, generate_orders

LINES = ["red fox runs", "an owl naps", "red owl runs far", "red", "far fox"]
COUNTS = dict(Counter(" ".join(LINES).split()))
NOT_RED = {w: n for w, n in COUNTS.items() if w != "red"}
TEXT = "山高水长，水远山长。" * 3 + "云"


def as_dict(df, k, v):
    return {r[k]: r[v] for r in df.collect()}


def test_g1_word_count(spark):
    lines = from_data(spark, LINES, "value string")
    got = as_dict(ops.count_by(ops.tokenize_words(lines), "word", "cnt"), "word", "cnt")
    assert got == COUNTS


def test_g1_word_count_sum_of_ones(spark):
    lines = from_data(spark, LINES, "value string")
    pairs = ops.with_one(ops.tokenize_words(lines))
    got = as_dict(ops.keyed_sum(pairs, "word", "one", "cnt"), "word", "cnt")
    assert got == COUNTS


def test_g2_characters(spark):
    text = from_data(spark, [TEXT], "value string")
    got = as_dict(ops.count_by(ops.tokenize_chars(text), "char", "cnt"), "char", "cnt")
    assert got == dict(Counter(TEXT))


def test_g3_filter_sum_and_reduce(spark):
    words = ops.drop_value(ops.tokenize_words(from_data(spark, LINES, "value string")), "word", "red")
    pairs = ops.with_one(words)
    assert as_dict(ops.keyed_sum(pairs, "word", "one"), "word", "one") == NOT_RED
    red = ops.keyed_reduce(pairs, "word", "one", lambda a, b: a + b)
    assert as_dict(red, "word", "one") == NOT_RED
    assert as_dict(ops.keyed_reduce(pairs, "word", "one", "sum"), "word", "one") == NOT_RED


def test_g4_union_keeps_duplicates(spark):
    a = from_data(spark, ["oak", "elm", "fir"], "value string")
    b = from_data(spark, ["oak", "elm", "fir"], "value string")
    got = sorted(r.value for r in ops.union_all(a, b).collect())
    assert got == sorted(["oak", "elm", "fir"] * 2)


def test_g5_connect_two_types(spark):
    a = from_data(spark, ["oak", "elm", "fir"], "value string")
    b = from_data(spark, [1, 2, 3], "value bigint")
    out = ops.connect_map(a, b, prefixed_string("value", "String->String:"),
                          prefixed_string("value", "Long->String:"))
    got = sorted(r.value for r in out.collect())
    assert got == sorted(["String->String:oak", "String->String:elm", "String->String:fir",
                          "Long->String:1", "Long->String:2", "Long->String:3"])


def test_g6_side_outputs(spark):
    ds = from_data(spark, list(range(1, 11)) + [-3, None], "value int")
    routed = ops.route(ds, {"even": F.col("value") % 2 == 0, "odd": F.col("value").isNotNull()})
    assert sorted(r.value for r in routed["even"].collect()) == [2, 4, 6, 8, 10]
    assert sorted(r.value for r in routed["odd"].collect()) == [-3, 1, 3, 5, 7, 9]
    assert routed.main.count() == 0
    tagged = ops.route(ds, parity_tag("value")).tagged
    assert {r.value: r.tag for r in tagged.collect()}[-3] == "odd"
    assert tagged.filter(F.col("value").isNull()).first().tag is None


def test_g7_counter_and_file(spark, tmp_dir):
    from tidewater.sinks import read_buckets, write_rolling_text
    data = ["p1", "p2", "p3", "p4", "q5"] * 2
    ds = from_data(spark, data, "value string").repartition(2)
    counted, obs = ops.observed_count(ops.with_local_count(ds), "elementCounter")
    write_rolling_text(counted, tmp_dir)
    assert obs.get["elementCounter"] == 10
    back = read_buckets(spark, tmp_dir)
    assert sorted(r.value for r in back.collect()) == sorted(data)
    assert all(re.fullmatch(r"\d{4}-\d\d-\d\d--\d\d", r.bucket) for r in back.collect())


def test_g7_local_counts_are_per_instance(spark):
    ds = from_data(spark, ["p1", "p2", "p3", "p4", "q5"] * 2, "value string").repartition(2)
    per = ops.with_local_count(ds).groupBy("instance").agg(F.max("local_count").alias("n")).collect()
    assert sum(r.n for r in per) == 10 and all(r.n < 10 for r in per)


def test_g8_enrichment_batch(spark):
    users = from_data(spark, [(1, "Ada"), (2, "Ben"), (3, "Cy")], "id int, name string")
    scores = from_data(spark, [(1, "art", 41), (2, "maths", 73), (3, "music", 95)],
                       "id int, subject string, score int")
    out = ops.enrich(scores, users, "id").select("id", "name", "subject", "score")
    assert sorted(map(tuple, out.collect())) == [(1, "Ada", "art", 41), (2, "Ben", "maths", 73),
                                                 (3, "Cy", "music", 95)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_g8_enrich_above_bound_does_not_hint(spark):
    users = from_data(spark, [(i, f"u{i}") for i in range(10)], "id int, name string")
    assert ops.fits_broadcast(users, 10) and not ops.fits_broadcast(users, 9)


def test_g10_sql_upper_changelog(spark):
    names = from_data(spark, ["Nora", "Omar", "Pia"], "value string")
    out = ops.changelog_insert_only(tsql.sql_upper(spark, names))
    assert sorted(f"{r.op}[{r.f0}]" for r in out.collect()) == ["+I[NORA]", "+I[OMAR]", "+I[PIA]"]


def test_g11_sql_sum_and_changelog(spark):
    rows = [(0, "Nora", 7), (1, "Omar", 4), (2, "Nora", 31)]
    wc = from_data(spark, rows, "seq bigint, name string, score bigint")
    final = tsql.sql_group_sum(spark, wc.select("name", "score"))
    assert as_dict(final, "name", "score") == {"Nora": 38, "Omar": 4}
    log = ops.changelog_sum(wc, "name", "seq", "score", out="score", keep=["seq"])
    got = [f"{r.op}[{r.name},{r.score}]" for r in log.orderBy("seq", "pos").collect()]
    assert got == ["+I[Nora,7]", "+I[Omar,4]", "-U[Nora,7]", "+U[Nora,38]"]


def test_g11_unchanged_total_emits_nothing(spark):
    rows = [(0, "Nora", 7), (1, "Nora", 0), (2, "Nora", 1)]
    wc = from_data(spark, rows, "seq bigint, name string, score bigint")
    log = ops.changelog_sum(wc, "name", "seq", "score", out="score", keep=["seq"])
    got = [f"{r.op}[{r.name},{r.score}]" for r in log.orderBy("seq", "pos").collect()]
    assert got == ["+I[Nora,7]", "-U[Nora,7]", "+U[Nora,8]"]


def test_g12_generated_orders(spark):
    seq = spark.range(0, 5000).withColumnRenamed("id", "n")
    out = generate_orders(seq, "n").collect()
    assert len({r.id for r in out}) == 5000
    assert all(re.fullmatch(r"[0-9A-F]{32}", r.id) for r in out)
    assert all(0 <= r.userId < 1000 and 0 <= r.money < 1000 for r in out)
    assert len({r.userId for r in out}) > 900


def test_keyed_reduce_python_matches_builtin(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").repartition(7)
    a = as_dict(ops.keyed_reduce(ev, "event_type", "user_id", operator.add), "event_type", "user_id")
    b = as_dict(ops.keyed_reduce(ev, "event_type", "user_id", "sum"), "event_type", "user_id")
    assert a == b
    c = as_dict(ops.keyed_reduce(ev, "event_type", "user_id", max, flush_keys=2), "event_type", "user_id")
    assert c == as_dict(ops.keyed_reduce(ev, "event_type", "user_id", "max"), "event_type", "user_id")


def test_broadcast_byte_bound(spark):
    users = from_data(spark, [(i, "x" * 100) for i in range(10)], "id int, name string")
    assert ops.fits_broadcast(users, 10, 10 * 104)
    assert not ops.fits_broadcast(users, 10, 10 * 104 - 1)


def test_keyed_reduce_python_exact_with_nulls(spark):
    big = 2 ** 60
    df = from_data(spark, [("a", big), ("a", None), ("a", 3), ("b", None), ("b", 1)], "k string, v bigint")
    got = {r.k: r.v for r in ops.keyed_reduce(df.repartition(1), "k", "v", lambda x, y: x + y).collect()}
    assert got == {"a": big + 3, "b": 1}


def test_keyed_reduce_named_per_column(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    got = ops.keyed_reduce(ev, "event_type", None, {"user_id": "sum", "event_id": "max"})
    want = ev.groupBy("event_type").agg(F.sum("user_id").alias("user_id"), F.max("event_id").alias("event_id"))
    assert got.exceptAll(want.select(got.columns)).count() == 0 and got.count() == want.count()


def test_enrich_latest_dimension_version_wins(spark):
    users = from_data(spark, [(1, "old", 0), (1, "new", 1), (2, "b", 0)], "id int, name string, v int")
    scores = from_data(spark, [(1, "x", 5), (2, "y", 6)], "id int, subject string, score int")
    out = ops.enrich(scores, users, "id", latest_by="v").select("id", "name", "subject", "score")
    assert sorted(map(tuple, out.collect())) == [(1, "new", "x", 5), (2, "b", "y", 6)]


def test_rich_map_setup_runs_once_per_task(spark):
    import pandas as pd

    def setup():
        from pyspark import TaskContext
        return {"task": TaskContext.get().partitionId(), "seen": 0}

    def step(ctx, b: pd.DataFrame) -> pd.DataFrame:
        ctx["seen"] += len(b)
        return pd.DataFrame({"value": b["value"], "task": ctx["task"], "seen": ctx["seen"]})

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        df = from_data(spark, list(range(20)), "value int").repartition(2)
        out = ops.map_partitions_with_setup(df, setup, step, "value int, task int, seen long").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(r.value for r in out) == list(range(20))
    per_task = {}
    for r in out:
        per_task[r.task] = max(per_task.get(r.task, 0), r.seen)
    assert sum(per_task.values()) == 20 and len(per_task) == 2  # state carried across batches
