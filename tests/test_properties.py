"""Property tests: operators against small pure-Python models of the
reference's per-record semantics, on random inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidewater import operators as ops
from tidewater.sources import from_data

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def java_split_space(s: str) -> list[str]:
    """``String.split(" ")``: no separator -> the whole string; else split and
    drop trailing empty strings."""
    if " " not in s:
        return [s]
    parts = s.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@SETTINGS
@given(st.lists(st.text(alphabet="ab \n", max_size=8), min_size=1, max_size=12))
def test_words_match_java_split(spark, lines):
    df = from_data(spark, list(enumerate(lines)), "id int, value string")
    got = {}
    for r in ops.tokenize_words(df, keep=["id"], position="pos").collect():
        got.setdefault(r.id, []).append((r.pos, r.word))
    for i, line in enumerate(lines):
        assert [w for _, w in sorted(got.get(i, []))] == java_split_space(line)


def changelog_model(rows):
    """Feed (seq, key, value) in seq order to a keyed SUM and record its changelog."""
    totals, out = {}, []
    for seq, key, v in sorted(rows):
        if key not in totals:
            totals[key] = v
            out.append((seq, 0, "+I", key, v))
            continue
        old, new = totals[key], totals[key] + v
        totals[key] = new
        if old != new:
            out += [(seq, 0, "-U", key, old), (seq, 1, "+U", key, new)]
    return sorted(out)


rows_strategy = st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b"]),
                                   st.integers(min_value=-3, max_value=5)),
                         min_size=1, max_size=60)


@SETTINGS
@given(rows_strategy, st.integers(min_value=2, max_value=9))
def test_changelog_matches_model(spark, pairs, parts):
    rows = [(i * 3, k, v) for i, (k, v) in enumerate(pairs)]
    df = from_data(spark, rows, "seq bigint, k string, v bigint")
    got = ops.changelog_sum(df, "k", "seq", "v", out="s", keep=["seq"], parts=parts)
    assert sorted((r.seq, r.pos, r.op, r.k, r.s) for r in got.collect()) == changelog_model(rows)


@SETTINGS
@given(rows_strategy, st.integers(min_value=1, max_value=7))
def test_running_sum_matches_model(spark, pairs, parts):
    rows = [(i, k, v) for i, (k, v) in enumerate(pairs)]
    df = from_data(spark, rows, "seq bigint, k string, v bigint")
    got = ops.running_sum(df, "k", "seq", "v", parts=parts)

    totals, want = {}, []
    for seq, k, v in rows:
        totals[k] = totals.get(k, 0) + v
        want.append((seq, k, totals[k]))
    assert sorted((r.seq, r.k, r.running) for r in got.collect()) == want


def enrich_model(batches):
    """Buffer-and-release enrichment fed batch by batch: within a batch a key's
    new user is applied first (releasing its buffer again), then its scores."""
    user, buffer, out = {}, {}, []
    for users, scores in batches:
        for uid, name in users:
            user[uid] = name
            out += [(uid, name, s, v) for s, v in buffer.get(uid, [])]
        for uid, s, v in scores:
            if uid in user:
                out.append((uid, user[uid], s, v))
            else:
                buffer.setdefault(uid, []).append((s, v))
    return sorted(out)


batch_strategy = st.tuples(
    st.dictionaries(st.integers(1, 3), st.sampled_from(["ann", "bo", "cy"]), max_size=3),
    st.lists(st.tuples(st.integers(1, 4), st.sampled_from(["x", "y"]), st.integers(0, 9)),
             max_size=4))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(batch_strategy, min_size=1, max_size=3))
def test_stream_enrich_matches_model(spark, batches):
    import json
    import os
    import tempfile

    from tidewater.streaming import drain, stream_enrich
    base = tempfile.mkdtemp(prefix="tidewater-prop-")
    os.makedirs(f"{base}/u")
    os.makedirs(f"{base}/s")
    plain = [(sorted(users.items()), scores) for users, scores in batches]
    for i, (users, scores) in enumerate(plain):
        with open(f"{base}/u/{i}.json", "w") as f:
            f.writelines(json.dumps({"id": k, "name": n}) + "\n" for k, n in users)
        with open(f"{base}/s/{i}.json", "w") as f:
            f.writelines(json.dumps({"id": k, "subject": s, "score": v}) + "\n" for k, s, v in scores)
        u = spark.readStream.schema("id int, name string").option("maxFilesPerTrigger", 1).json(f"{base}/u")
        s = spark.readStream.schema("id int, subject string, score int").json(f"{base}/s")
        res = drain(stream_enrich(s, u, "id", ["subject", "score"], ["name"], salts=2), "p", "append",
                    path=f"{base}/out")
    assert sorted(map(tuple, res.collect())) == enrich_model(plain)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows_strategy, st.lists(st.integers(1, 20), min_size=0, max_size=2))
def test_stream_changelog_matches_model(spark, pairs, cuts):
    import json
    import os
    import tempfile

    from tidewater.streaming import drain, stream_changelog
    rows = [(i, k, v) for i, (k, v) in enumerate(pairs)]
    bounds = sorted({c for c in cuts if c < len(rows)}) + [len(rows)]
    base = tempfile.mkdtemp(prefix="tidewater-prop-")
    os.makedirs(f"{base}/in")
    start = 0
    for b, end in enumerate(bounds):
        with open(f"{base}/in/{b}.json", "w") as f:
            f.writelines(json.dumps({"seq": s, "k": k, "v": v}) + "\n" for s, k, v in rows[start:end])
        start = end
        df = spark.readStream.schema("seq bigint, k string, v bigint").json(f"{base}/in")
        res = drain(stream_changelog(df, "k", "seq", "v", out="s"), "cl", "append", path=f"{base}/out")
    got = sorted((r.seq, r.pos, r.op, r.k, r.s) for r in res.collect())
    assert got == changelog_model(rows)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows_strategy, st.lists(st.integers(1, 20), min_size=0, max_size=2),
       st.integers(min_value=2, max_value=6))
def test_split_stream_changelog_matches_model(spark, pairs, cuts, parts):
    import json
    import os
    import tempfile

    from tidewater.streaming.batched_state import stream_running_batches
    rows = [(i, k, v) for i, (k, v) in enumerate(pairs)]
    bounds = sorted({c for c in cuts if c < len(rows)}) + [len(rows)]
    base = tempfile.mkdtemp(prefix="tidewater-prop-")
    os.makedirs(f"{base}/in")
    start = 0
    for b, end in enumerate(bounds):
        with open(f"{base}/in/{b}.json", "w") as f:
            f.writelines(json.dumps({"seq": s, "k": k, "v": v}) + "\n" for s, k, v in rows[start:end])
        start = end
        df = spark.readStream.schema("seq bigint, k string, v bigint").json(f"{base}/in")
        q = stream_running_batches(df, "k", "seq", "v", "s", f"{base}/out", f"{base}/ckpt",
                                   trigger={"availableNow": True}, parts=parts)
        q.awaitTermination()
    res = spark.read.parquet(f"{base}/out/data")
    got = sorted((r.seq, r.pos, r.op, r.k, r.s) for r in res.collect())
    assert got == changelog_model(rows)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 60_000), st.sampled_from(["a", "b", "c"])), min_size=1,
                max_size=40),
       st.sampled_from([1, 5, 7, 60, 3600]))
def test_tumbling_windows_match_model(spark, events, size_s):
    import datetime

    unix = datetime.datetime(1970, 1, 1)
    base = datetime.datetime(2024, 1, 1)
    rows = [(base + datetime.timedelta(milliseconds=ms), k) for ms, k in events]
    df = from_data(spark, rows, "ts timestamp_ntz, k string")
    got = sorted((r.window_start, r.k, r.cnt)
                 for r in ops.tumbling_aggregate(df, "ts", f"{size_s} seconds", "k").collect())
    want = {}
    for ts, k in rows:  # windows are aligned to the Unix epoch
        secs = int((ts - unix).total_seconds() // 1)
        start = unix + datetime.timedelta(seconds=secs - secs % size_s)
        want[(start, k)] = want.get((start, k), 0) + 1
    assert got == sorted((s, k, n) for (s, k), n in want.items())
