"""Stateful processors for ``transformWithStateInPandas``.

State lives in Spark's state store (RocksDB), checkpointed with the query, so
it survives executor loss and restarts.  Each processor sees one key's rows
of one micro-batch as pandas frames; a key's rows in a batch are bounded by
the source's per-trigger limit (``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger``).
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql.streaming.stateful_processor import (ExpiredTimerInfo, StatefulProcessor,
                                                      StatefulProcessorHandle, TimerValues)
from pyspark.sql.types import (BooleanType, ByteType, DoubleType, FloatType, IntegerType, LongType,
                               ShortType, StringType, StructField, StructType)

from tidewater.functions.rows import INSERT, UPDATE_AFTER, UPDATE_BEFORE

SIDE = "tw_side"  # a leading "__" is renamed on the way into Python
DIMENSION, RECORD = 0, 1
DIM, REC = "tw_dim", "tw_rec"
MISSING = "tw_missing"  # marks rows whose value is null


def _py(v):
    """numpy/pandas scalar -> Python value, NaN/NaT -> None."""
    if v is None or v is pd.NaT:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime()
    return v.item() if hasattr(v, "item") else v


def _coerce(v, dtype):
    """A pandas value as the Python value of Spark type ``dtype``.

    A nullable integer column reaches pandas as float64 whenever its Arrow
    batch holds a null, so integers must be converted back before they are
    written to state (a float in an integer state field would be lost)."""
    v = _py(v)
    if v is None:
        return None
    if isinstance(dtype, (ByteType, ShortType, IntegerType, LongType)):
        return int(v)
    if isinstance(dtype, (FloatType, DoubleType)):
        return float(v)
    if isinstance(dtype, BooleanType):
        return bool(v)
    if isinstance(dtype, StringType):
        return str(v)
    return v


def _rows(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    frames = [f for f in rows if len(f)]
    if len(frames) == 1:
        return frames[0]
    return pd.concat(frames, ignore_index=True) if frames else pd.DataFrame()


#: rows that a processor works on and emits at once
ROWS = 1 << 16


def _in_order(rows: Iterator[pd.DataFrame], order: str, *columns: str) -> Iterator[dict[str, np.ndarray]]:
    """One key's rows sorted by ``order``, ``ROWS`` at a time, as flat columns.

    Of the frames only these columns are held, without the key and as plain arrays where the type has
    one, so a row costs some tens of bytes however many rows a key has in a micro-batch.
    """
    parts: dict[str, list[pd.Series]] = {c: [] for c in (order, *columns)}
    for frame in rows:
        if len(frame):
            for c, held in parts.items():
                held.append(frame[c].copy())  # not a view, which would keep the frame
    if not parts[order]:
        return
    whole = {c: pd.concat(parts.pop(c), ignore_index=True) for c in (order, *columns)}
    by = whole[order]
    at = None if by.is_monotonic_increasing else by.sort_values(kind="stable").index.to_numpy()
    for i in range(0, len(by), ROWS):
        part = slice(i, i + ROWS) if at is None else at[i:i + ROWS]
        yield {c: s.iloc[part].to_numpy() for c, s in whole.items()}


def _nullable(values: np.ndarray, present: np.ndarray, kind: str):
    """A pandas column that is null where ``present`` is false."""
    cls = pd.arrays.IntegerArray if kind == "Int64" else pd.arrays.FloatingArray
    return cls(values, ~present)


class EnrichProcessor(StatefulProcessor):
    """Records of one bucket of ids enriched from a dimension stream.

    A dimension row replaces its id's value (last write wins) and releases the id's
    waiting records under the new value; a record is emitted at once when its
    id has a value, else it waits.  As in the reference, released records stay and are
    emitted again if the id's value is sent again; ``clear_buffer=True`` drops them after
    release.  Within a micro-batch dimension rows are applied first, in ``order``.

    A call handles all of a micro-batch's rows of a bucket: state is touched once per id,
    rows are moved as whole columns.  Values and records are opaque JSON texts here.  Waiting records are
    kept as chunks of lines under (id, chunk number), so that adding to a long list does not
    rewrite it.  ``ttl_ms`` lets chunks expire that long after they were written.
    """

    CHUNK = 1 << 16  # characters a chunk grows to
    ROWS = 1 << 16   # rows of an output frame

    def __init__(self, key: str, order: str | None = None, clear_buffer: bool = False, ttl_ms: int | None = None):
        self.key, self.order, self.clear_buffer, self.ttl = key, order, clear_buffer, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        text, number = StructType([StructField("v", StringType())]), StructType([StructField("n", LongType())])
        by_id = StructType([StructField("id", StringType())])
        by_chunk = StructType([StructField("id", StringType()), StructField("chunk", LongType())])
        self.values = handle.getMapState("dimension", by_id, text)
        self.chunks = handle.getMapState("chunks", by_id, number, self.ttl)
        self.waiting = handle.getMapState("waiting", by_chunk, text, self.ttl)
        self.held = handle.getValueState("held", number)  # ids that ever waited: none, no look-up

    def _lines(self, k: str) -> list[str]:
        """The waiting records of an id, whose chunks are dropped where the buffer is cleared."""
        found, lines = self.chunks.getValue((k,)), []
        for i in range(found[0] if found else 0):
            chunk = self.waiting.getValue((k, i))
            if chunk is not None:  # else expired
                lines += chunk[0].split("\n")
                if self.clear_buffer:
                    self.waiting.removeKey((k, i))
        if found and self.clear_buffer:
            self.chunks.removeKey((k,))
        return lines

    def _wait(self, k: str, lines: list[str]) -> bool:
        """Add records of an id without a value; True if it had none waiting."""
        found = self.chunks.getValue((k,))
        n = found[0] if found else 0
        text = "\n".join(lines)
        if n and self.ttl is None:
            last = self.waiting.getValue((k, n - 1))
            if len(last[0]) < self.CHUNK:
                n, text = n - 1, last[0] + "\n" + text
        self.waiting.updateValue((k, n), (text,))
        self.chunks.updateValue((k,), (n + 1,))
        return not found

    def _frames(self, ids, values, records) -> Iterator[pd.DataFrame]:
        for at in range(0, len(ids), self.ROWS):
            part = slice(at, at + self.ROWS)
            yield pd.DataFrame({self.key: ids[part], DIM: values[part], REC: records[part]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _rows(rows)
        if pdf.empty:
            return
        is_dim = pdf[SIDE].to_numpy() == DIMENSION
        held = self.held.get()
        held, now = (held[0] if held else 0), {}
        if is_dim.any():
            dims = pdf[is_dim]
            if self.order:
                dims = dims.sort_values(self.order, kind="stable")
            ids, texts = dims[self.key].tolist(), dims[DIM].tolist()
            versions: dict[str, list[str]] = {}
            for k, v in zip(ids, texts, strict=True):
                versions.setdefault(k, []).append(v)
            out: tuple[list, list, list] = ([], [], [])
            for k, of in versions.items():
                lines = self._lines(k) if held else []
                for v in (of[:1] if self.clear_buffer else of) if lines else ():
                    out[0].extend([k] * len(lines))
                    out[1].extend([v] * len(lines))
                    out[2].extend(lines)
                now[k] = of[-1]
                self.values.updateValue((k,), (of[-1],))
                if len(out[0]) >= self.ROWS:
                    yield from self._frames(*out)
                    out = ([], [], [])
            yield from self._frames(*out)
        if is_dim.all():
            return
        recs = pdf[~is_dim]
        ids = recs[self.key].to_numpy(dtype=object)
        codes, names = pd.factorize(ids)
        for k in names:
            if k not in now:
                found = self.values.getValue((k,))
                now[k] = found[0] if found else None
        values = np.array([now[k] for k in names], dtype=object)[codes]
        records = recs[REC].to_numpy(dtype=object)
        known = np.array([now[k] is not None for k in names])[codes]
        yield from self._frames(ids[known], values[known], records[known])
        if not known.all():
            early = pd.Series(records[~known]).groupby(codes[~known]).agg(list)
            new = sum(self._wait(names[c], lines) for c, lines in early.items())
            if new:
                self.held.update((held + new,))

    def close(self) -> None:
        pass


class RunningSumProcessor(StatefulProcessor):
    """Per-record running sum of one key, in ``order`` within each batch.

    ``emit='running'``: one ``(order, key, total)`` row per record.
    ``emit='changelog'``: ``+I`` for the key's first record, ``-U``/``+U``
    for a changed total, nothing for an unchanged one.  Null values add
    nothing; the total is null until the first other value, as ``SUM``.  Records of a key must arrive in ``order`` across batches.
    """

    def __init__(self, key: str, order: str, value: str, out: str = "s", emit: str = "changelog",
                 integral: bool = True):
        self.key, self.order, self.value_col, self.out, self.emit = key, order, value, out, emit
        # integer values add up as int64 (bigint), others as float64 (double)
        self.integral = integral
        self.np_type = np.int64 if integral else np.float64

    def init(self, handle: StatefulProcessorHandle) -> None:
        t = LongType() if self.integral else DoubleType()
        self.total = handle.getValueState("total", StructType([StructField("t", t), StructField("any", BooleanType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        k = _py(key[0])
        seen = self.total.exists()
        start, found = self.total.get() if seen else (0, False)
        start, added, total = self.np_type(start), self.np_type(0), None
        for rows_now in _in_order(rows, self.order, self.value_col, MISSING):
            real = ~rows_now[MISSING].astype(bool)
            vals = np.where(real, rows_now[self.value_col], 0).astype(self.np_type)
            # what the batch added before these rows comes first, so that sums do not depend on where rows are cut
            sums = np.cumsum(np.concatenate(([added], vals)))
            before, after = start + sums[:-1], start + sums[1:]
            has = np.logical_or.accumulate(real) | found  # a total exists
            had = np.concatenate(([found], has[:-1]))
            yield from self._emitted(k, rows_now[self.order], before, after, had, has, not seen)
            seen, found, added, total = True, bool(has[-1]), sums[-1], after[-1].item()
        if total is not None:
            self.total.update((total, found))

    def _emitted(self, k, seqs, before, after, had, has, new: bool) -> Iterator[pd.DataFrame]:
        """The rows for records with totals ``before`` and ``after`` them; ``new``: the first is the key's first."""
        kind = "Int64" if self.integral else "Float64"
        if self.emit == "running":
            yield pd.DataFrame({self.order: seqs, self.key: k, self.out: _nullable(after, has, kind)})
            return
        first = np.zeros(len(after), dtype=bool)
        first[0] = new
        same = (before == after) | ((before != before) & (after != after))  # NaN equals NaN, as in SQL
        changed = ~first & ((had != has) | (has & ~same))
        if not first.any() and not changed.any():
            return  # no total changed: nothing to emit (an empty frame does not convert)
        out_seq = np.concatenate([seqs[first], seqs[changed], seqs[changed]])
        pos = np.concatenate([np.zeros(first.sum() + changed.sum(), dtype=np.int32),
                              np.ones(changed.sum(), dtype=np.int32)])
        ops = [INSERT] * int(first.sum()) + [UPDATE_BEFORE] * int(changed.sum()) \
            + [UPDATE_AFTER] * int(changed.sum())
        s = _nullable(np.concatenate([after[first], before[changed], after[changed]]),
                      np.concatenate([has[first], had[changed], has[changed]]), kind)
        yield pd.DataFrame({self.order: out_seq, "pos": pos, "op": ops, self.key: k, self.out: s})

    def close(self) -> None:
        pass


class RunningReduceProcessor(StatefulProcessor):
    """Per-record keyed reduce with a user combine function ``(v1, v2) -> v``:
    the key's first value, then ``fn(acc, v)`` for each later record, one
    output row per record, in ``order`` within each batch."""

    def __init__(self, key: str, order: str, value: str, fn, value_type):
        self.key, self.order, self.value_col, self.fn = key, order, value, fn
        self.value_type = value_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.acc = handle.getValueState("acc", StructType([StructField("v", self.value_type)]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state, n = self.acc.get(), 0
        acc = state[0] if state is not None else None
        for rows_now in _in_order(rows, self.order, self.value_col, MISSING):
            out = []
            for v, missing in zip(rows_now[self.value_col].tolist(), rows_now[MISSING].tolist(), strict=True):
                v = None if missing else _coerce(v, self.value_type)
                if v is not None:
                    acc = v if acc is None else _coerce(self.fn(acc, v), self.value_type)
                out.append(acc)
            n += len(out)
            yield pd.DataFrame({self.order: rows_now[self.order], self.key: _py(key[0]), self.value_col: out})
        if n:
            self.acc.update((acc,))

    def close(self) -> None:
        pass


class ProcessingTimeWindowProcessor(StatefulProcessor):
    """Tumbling processing-time windows of one bucket of keys, fired by timers.

    A batch's rows (``key`` and the count ``out``) fall in the window holding the batch's
    processing time; they are added up and kept as chunks of keys and counts under (window, part of the
    bucket, chunk number).  A timer at the window end sums the window's chunks per key, emits
    ``(window_start, key, total)`` and drops them, whether or not more input arrived.  No more than ``ROWS``
    arriving keys and one of the bucket's ``PARTS`` are held at a time; other windows are not read.
    """

    PARTS = 16

    def __init__(self, key: str, size_ms: int, out: str = "cnt"):
        self.key, self.size, self.out = key, size_ms, out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        start, part, chunk = (StructField(c, LongType()) for c in ("start", "part", "chunk"))
        self.timers = handle.getMapState("timers", StructType([start]), StructType([StructField("set", BooleanType())]))
        self.chunks = handle.getMapState("chunks", StructType([start, part]), StructType([StructField("n", LongType())]))
        self.counts = handle.getMapState("counts", StructType([start, part, chunk]), StructType([StructField("v", StringType())]))

    def _keep(self, start: int, counts: pd.Series) -> None:
        part = (pd.util.hash_array(counts.index.to_numpy(dtype=object), categorize=False) % self.PARTS).astype(np.int64)
        for p, of in counts.groupby(part):
            found = self.chunks.getValue((start, int(p)))
            n = found[0] if found else 0
            self.counts.updateValue((start, int(p), n), (json.dumps([of.index.tolist(), of.tolist()]),))
            self.chunks.updateValue((start, int(p)), (n + 1,))

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        start = now - now % self.size
        held: list[pd.Series] = []
        for frame in rows:
            if not len(frame):
                continue
            if not held and not self.timers.containsKey((start,)):
                self.handle.registerTimer(start + self.size)
                self.timers.updateValue((start,), (True,))
            held.append(frame.groupby(self.key)[self.out].sum())
            if sum(map(len, held)) >= ROWS:
                whole = pd.concat(held).groupby(level=0).sum()
                held = [whole]
                if len(whole) >= ROWS // 2:
                    self._keep(start, whole)
                    held = []
        if held:
            self._keep(start, pd.concat(held).groupby(level=0).sum())
        return iter([])

    def handleExpiredTimer(self, key, timerValues: TimerValues,
                           expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        start = expiredTimerInfo.getExpiryTimeInMs() - self.size
        if not self.timers.containsKey((start,)):
            return
        self.timers.removeKey((start,))
        for part in range(self.PARTS):
            found = self.chunks.getValue((start, part))
            if not found:
                continue
            totals: dict[str, int] = {}
            for i in range(found[0]):
                for k, n in zip(*json.loads(self.counts.getValue((start, part, i))[0]), strict=True):
                    totals[k] = totals.get(k, 0) + n
                self.counts.removeKey((start, part, i))
            self.chunks.removeKey((start, part))
            names, sums = np.array(list(totals), dtype=object), np.array(list(totals.values()), dtype=np.int64)
            for at in range(0, len(names), ROWS):
                yield pd.DataFrame({"window_start": pd.Timestamp(start, unit="ms"), self.key: names[at:at + ROWS], self.out: sums[at:at + ROWS]})

    def close(self) -> None:
        pass


def _pickle_by_value() -> None:
    """Ship these processors by value: the Python runner that initializes a
    stateful query on the driver side does not see ``addPyFile`` includes, so
    it must not need to import this package."""
    import sys
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # pragma: no cover - older cloudpickle: rely on the package being importable
        pass


_pickle_by_value()
