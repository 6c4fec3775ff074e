"""State processors hold and emit a bounded number of rows at a time, whatever a key has in a micro-batch."""

import numpy as np
import pandas as pd
from pyspark.sql.types import LongType

from tidewater.streaming import processors as pr

N, FRAME = 300_000, 10_000


class Handle:
    """State kept in dicts, in place of Spark's state store."""

    def __init__(self):
        self.timer_at, self.maps = [], {}

    def getValueState(self, name, schema):  # noqa: N802
        return Value()

    def getMapState(self, name, key, value, ttl=None):  # noqa: N802
        return self.maps.setdefault(name, Map())

    def registerTimer(self, at):  # noqa: N802
        self.timer_at.append(at)

    def getListState(self, name, schema):  # noqa: N802
        return List()


class List:
    def __init__(self):
        self.rows = []

    def appendList(self, rows):  # noqa: N802
        self.rows += rows

    def put(self, rows):
        self.rows = list(rows)

    def get(self):
        return iter(self.rows)

    def clear(self):
        self.rows = []


class Value:
    v = None

    def exists(self):
        return self.v is not None

    def get(self):
        return self.v

    def update(self, v):
        self.v = v


class Map:
    def __init__(self):
        self.d = {}

    def getValue(self, k):  # noqa: N802
        return self.d.get(k)

    def containsKey(self, k):  # noqa: N802
        return k in self.d

    def updateValue(self, k, v):  # noqa: N802
        self.d[k] = v

    def removeKey(self, k):  # noqa: N802
        del self.d[k]


class At:
    def __init__(self, now):
        self.now = now

    def getCurrentProcessingTimeInMs(self):  # noqa: N802
        return self.now

    def getExpiryTimeInMs(self):  # noqa: N802
        return self.now


def frames(columns):
    return (pd.DataFrame({c: v[i:i + FRAME] for c, v in columns.items()}) for i in range(0, len(next(iter(columns.values()))), FRAME))


def shuffled():
    seq = np.random.default_rng(3).permutation(N)
    value = seq * 7 % 11 - 4
    missing = seq % 13 == 0
    whole = pd.Series(np.where(missing, 0, value), index=seq).sort_index().cumsum()
    return {"seq": seq, "k": np.array(["vx"] * N, dtype=object), "v": value, pr.MISSING: missing}, whole.to_numpy()


def test_running_sum_emits_a_bounded_number_of_rows():
    columns, whole = shuffled()
    for emit in ("running", "changelog"):
        proc = pr.RunningSumProcessor("k", "seq", "v", "s", emit)
        proc.init(Handle())
        out = list(proc.handleInputRows(("vx",), frames(columns), None))
        assert max(map(len, out)) <= 2 * (1 << 16)  # -U and +U of each record
        got = pd.concat(out)
        assert proc.total.get() == (int(whole[-1]), True)
        if emit == "running":
            assert got["seq"].tolist() == list(range(N))
            # the first record's value is null, so its total is
            assert got["s"].iloc[0] is pd.NA and (got["s"].iloc[1:].to_numpy(dtype=np.int64) == whole[1:]).all()
        else:
            ups = got[got["op"] == "+U"].set_index("seq")["s"]
            downs = got[got["op"] == "-U"].set_index("seq")["s"]
            moved = np.flatnonzero(np.diff(whole)) + 1
            assert sorted(set(ups.index) | {1}) == sorted(set(moved.tolist()) | {1})
            at = moved[moved > 1]
            assert (ups[at].to_numpy(dtype=np.int64) == whole[at]).all() and (downs[at].to_numpy(dtype=np.int64) == whole[at - 1]).all()
            assert (got["op"] == "+I").sum() == 1


def test_running_reduce_emits_a_bounded_number_of_rows():
    columns, whole = shuffled()
    proc = pr.RunningReduceProcessor("k", "seq", "v", lambda a, b: a + b, LongType())
    proc.init(Handle())
    out = list(proc.handleInputRows(("vx",), frames(columns), None))
    assert max(map(len, out)) <= 1 << 16
    got = pd.concat(out)
    assert got["seq"].tolist() == list(range(N))
    assert (got["v"].iloc[1:].astype("int64").to_numpy() == whole[1:]).all() and proc.acc.get() == (int(whole[-1]),)


def test_clock_window_reads_its_own_rows_in_parts():
    proc, handle = pr.ProcessingTimeWindowProcessor("w", 1000, "n"), Handle()
    proc.init(handle)
    words = np.array([f"v{i % 150_000}" for i in range(N)], dtype=object)
    for now in (500, 1500):  # two open windows
        proc.handleInputRows((0,), frames({"w": words, "n": np.ones(N, dtype=np.int64)}), At(now))
    assert handle.timer_at == [1000, 2000]
    for fires in handle.timer_at:
        out = list(proc.handleExpiredTimer((0,), None, At(fires)))
        assert len(out) > 1 and max(map(len, out)) < 150_000 / 4
        got = pd.concat(out)
        assert got["w"].is_unique and len(got) == 150_000 and (got["n"] == 2).all()
        assert (got["window_start"] == pd.Timestamp(fires - 1000, unit="ms")).all()
    assert not any(m.d for m in handle.maps.values())
