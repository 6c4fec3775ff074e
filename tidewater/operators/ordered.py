"""Keyed operators that respect record order: reduce and running reduce with any associative
combine function (A3, A2), and enrichment by arrival order (J1).

All three deal the rows to ranges of ``(key, order)`` with Spark's sampled bounds, so a key that
holds much of the data is shared by many tasks, and use that a range continues at most one key of
the ranges before it: what crosses a border is one value per range.  Rows that tie in the order are told apart by
a row number that the written ranges fix.  Null is a key of its own and sorts first in the order.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidewater.session import scratch_path

PART, ROW, EDGE = "tw_part", "tw_row", "tw_edge"


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _dealt(df: DataFrame, by: list[str], parts: int | None) -> DataFrame:
    """``df`` in sorted ranges of ``by`` and the row number, with the range's number."""
    order = [*by, ROW]
    numbered = df.withColumn(ROW, F.monotonically_increasing_id())
    dealt = numbered.repartitionByRange(parts, *order) if parts else numbered.repartitionByRange(*order)
    return dealt.sortWithinPartitions(*order).withColumn(PART, F.spark_partition_id())


def _columns(value) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


class _Values:
    """Values of a batch as the combine function takes them: a single column's values, or tuples
    of several columns'.  A null (tuple of nulls) is None and is skipped."""

    def __init__(self, columns: list[str], fields: list[pa.Field], fn: Callable):
        self.columns, self.fields, self.fn, self.one = columns, fields, fn, len(columns) == 1

    def read(self, batch: pa.RecordBatch, names: list[str] | None = None) -> list:
        lists = [batch.column(c).to_pylist() for c in (names or self.columns)]
        if self.one:
            return lists[0]
        return [None if all(x is None for x in row) else row for row in zip(*lists, strict=True)]

    def arrays(self, values: list) -> list[pa.Array]:
        if self.one:
            return [pa.array(values, self.fields[0].type)]
        return [pa.array([None if v is None else v[k] for v in values], f.type) for k, f in enumerate(self.fields)]

    def add(self, held, v):
        return v if held is None else held if v is None else self.fn(held, v)


def _same(a: list[str], b: list[str]) -> Column:
    return functools.reduce(lambda x, y: x & y, [F.col(i).eqNullSafe(F.col(j)) for i, j in zip(a, b, strict=True)])


def ordered_reduce(df: DataFrame, key, order, value, fn: Callable, *, parts: int | None = None) -> DataFrame:
    """One row per key: its values folded with ``fn(earlier, later)`` in ``order``.

    ``fn`` must be associative; it need not be commutative.  ``value`` is a column, or a list of
    columns that ``fn`` takes and returns as tuples.  Every range folds its own rows of a key while
    it streams over them; only the first and the last key of a range can have rows elsewhere, and the
    partials of those are folded in range order (at most two rows per range).  Nulls are skipped; a key
    of nulls only keeps its row, with a null.
    """
    keys, order, columns = _columns(key), _columns(order), _columns(value)
    src = _dealt(df.select(*dict.fromkeys([*keys, *order, *columns])), keys + order, parts)
    schema = T.StructType([*[df.schema[c] for c in keys], T.StructField(PART, T.IntegerType()), T.StructField(EDGE, T.BooleanType()),
                           *[df.schema[c] for c in columns]])
    arrow = to_arrow_schema(schema)
    values = _Values(columns, [arrow.field(c) for c in columns], fn)

    def out(rows: list[tuple]) -> pa.RecordBatch:
        lists = list(zip(*[(*k, p, e) for k, p, e, _ in rows], strict=True))
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(lists, arrow, strict=False)]
                                          + values.arrays([r[3] for r in rows]), schema=arrow)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, part, first = None, None, None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            done, part = [], batch.column(PART)[0].as_py()
            for k, v in zip(zip(*[batch.column(c).to_pylist() for c in keys], strict=True), values.read(batch), strict=True):
                if k != now:
                    if now is not None:
                        done.append((now, part, first, held))
                        first = False
                    now, held = k, None
                held = values.add(held, v)
            if done:
                yield out(done)
        if now is not None:
            yield out([(now, part, True, held)])

    partials = _written(src.mapInArrow(fold, schema), "reduced")
    result = T.StructType([f for f in schema if f.name not in (PART, EDGE)])
    final = to_arrow_schema(result)

    def combine(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by(PART).combine_chunks()
        held = functools.reduce(values.add, values.read(rows), None)
        return pa.table([rows.column(c).slice(0, 1) for c in keys] + values.arrays([held]), schema=final)

    crossing = partials.where(EDGE).groupBy(*keys).applyInArrow(combine, result)
    return partials.where(~F.col(EDGE)).select(*result.names).unionByName(crossing)


def running_reduce(df: DataFrame, key, order, value, fn: Callable, *, out=None, parts: int | None = None) -> DataFrame:
    """Every row with its key's values folded up to and with it: ``fn(earlier, later)`` in ``order``.

    The batch twin of ``streaming.stream_keyed_reduce`` and a segmented prefix scan: each range scans its
    own rows and is written with the result, the last result of each key it shares with a later
    range is folded in range order, and ``fn(what came before, own result)`` is added to the rows of
    keys that began earlier.  ``fn`` must be associative, not commutative.  ``value`` may be a list of columns
    (tuples); ``out`` names the results (default: the value columns are replaced).
    Nulls leave the result as it was; before the first other value it is null.
    """
    keys, order, columns = _columns(key), _columns(order), _columns(value)
    names = columns if out is None else _columns(out)
    src = _dealt(df, keys + order, parts)
    made = [f"tw_value_{k}" for k in range(len(columns))]
    types = [T.StructField(m, df.schema[c].dataType) for m, c in zip(made, columns, strict=True)]
    schema = T.StructType([*src.schema, *types])
    arrow, carried = to_arrow_schema(schema), src.columns
    values = _Values(columns, [arrow.field(m) for m in made], fn)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, None
        for batch in batches:
            results = []
            for k, v in zip(zip(*[batch.column(c).to_pylist() for c in keys], strict=True), values.read(batch), strict=True):
                if k != now:
                    now, held = k, None
                held = values.add(held, v)
                results.append(held)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in carried] + values.arrays(results), schema=arrow)

    scanned = _written(src.mapInArrow(scan, schema), "scanned")
    last = F.max_by(F.struct(*made), F.struct(*order, ROW)).alias("tw_last")
    totals = scanned.groupBy(*keys, PART).agg(last).select(*keys, PART, "tw_last.*")
    # a range continues one key at most, so no more than one row per range is left here
    spans = Window.partitionBy(*keys)
    shared = totals.withColumn("tw_first", F.min(PART).over(spans)).withColumn("tw_final", F.max(PART).over(spans)).where("tw_final > tw_first")
    offset_schema = T.StructType([*[T.StructField(f"tw_of_{k}", df.schema[c].dataType) for k, c in enumerate(keys)],
                                  T.StructField("tw_in", T.IntegerType()),
                                  *[T.StructField(f"tw_before_{k}", t.dataType) for k, t in enumerate(types)]])
    offsets_arrow = to_arrow_schema(offset_schema)

    def prefix(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by(PART).combine_chunks()
        held, before = None, []
        for v in values.read(rows, made):
            before.append(held)
            held = values.add(held, v)
        return pa.table([*[rows.column(c) for c in keys], rows.column(PART), *values.arrays(before)], schema=offsets_arrow)

    offsets = shared.select(*keys, PART, *made).groupBy(*keys).applyInArrow(prefix, offset_schema)
    same = _same(keys, [f"tw_of_{k}" for k in range(len(keys))]) & (F.col(PART) == F.col("tw_in"))
    joined = scanned.join(F.broadcast(offsets), same, "left")
    kept = [c for c in df.columns if c not in names]
    before = [f"tw_before_{k}" for k in range(len(columns))]
    result = T.StructType([*[df.schema[c] for c in kept], *[T.StructField(n, t.dataType) for n, t in zip(names, types, strict=True)]])
    final = to_arrow_schema(result)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = [v if b is None else values.add(b, v)
                     for b, v in zip(values.read(batch, before), values.read(batch, made), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + values.arrays(whole), schema=final)

    return joined.select(*kept, *before, *made).mapInArrow(add, result)


def enrich_in_order(records: DataFrame, dimension: DataFrame, on, order: str, *, clear_buffer: bool = False,
                    parts: int | None = None) -> DataFrame:
    """Records enriched by arrival order, as a keyed stream with buffering would.

    ``order`` is a column of both inputs, the time of arrival; of equal times the dimension row comes first.
    A record takes the latest dimension row of its key before it.  A record that
    has none waits: the first later row of its key releases it, and every later row emits it again
    with the new values, as a buffer that is never emptied does; ``clear_buffer`` emits it once.  Records whose key
    never gets a row, and null keys, are not emitted.

    Both inputs are dealt to ranges of (key, order) together.  The latest row within the range is a
    window per (key, range); the row a range inherits is one per range, hence broadcast.  What waits
    meets its key's dimension rows per range: a hot key's records stay spread over tasks.
    Output: the records' columns, then the dimension's further columns; a dimension column named as a
    record column is refused.
    """
    keys = _columns(on)
    fields = [c for c in dimension.columns if c not in keys and c != order]
    clash = set(fields) & set(records.columns)
    if clash:
        raise ValueError(f"columns of both inputs: {sorted(clash)}")
    records = records.where(functools.reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    rest = [c for c in records.columns if c not in keys and c != order]
    time, row = "tw_order", F.struct(*[F.col(f).alias(f) for f in fields]) if fields else F.struct(F.lit(True).alias("tw_any"))
    dims = dimension.where(functools.reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])).select(
        *keys, F.col(order).alias(time), F.lit(0).alias("tw_side"), row.alias("tw_dim"))
    payload = F.struct(*[F.col(c) for c in rest]) if rest else F.struct(F.lit(True).alias("tw_any"))
    recs = records.select(*keys, F.col(order).alias(time), F.lit(1).alias("tw_side"), payload.alias("tw_rec"))
    both = dims.unionByName(recs, allowMissingColumns=True)
    ranged = _written(_dealt(both, [*keys, time, "tw_side"], parts), "arrivals")

    upto = Window.partitionBy(*keys, PART).orderBy(time, "tw_side", ROW).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.withColumn("tw_latest", F.last("tw_dim", ignorenulls=True).over(upto)).where("tw_side = 1")
    last = F.max_by("tw_dim", F.when(F.col("tw_side") == 0, F.struct(time, ROW))).alias("tw_last")
    ends = ranged.groupBy(*keys, PART).agg(last)
    earlier = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    inherits = ends.select(*[F.col(k).alias(f"tw_of_{i}") for i, k in enumerate(keys)], F.col(PART).alias("tw_in"),
                           F.last("tw_last", ignorenulls=True).over(earlier).alias("tw_inherited")).where("tw_inherited IS NOT NULL")
    same = _same(keys, [f"tw_of_{i}" for i in range(len(keys))]) & (F.col(PART) == F.col("tw_in"))
    latest = local.join(F.broadcast(inherits), same, "left").withColumn("tw_latest", F.coalesce("tw_latest", "tw_inherited"))

    def shown(df: DataFrame, found: str) -> DataFrame:
        columns = {**{k: F.col(k) for k in keys}, order: F.col(time), **{c: F.col(f"tw_rec.{c}") for c in rest}}
        return df.select(*[columns[c].alias(c) for c in records.columns], *[F.col(f"{found}.{f}").alias(f) for f in fields])

    known = latest.where("tw_latest IS NOT NULL")
    waiting = _written(latest.where("tw_latest IS NULL").select(*keys, PART, time, "tw_rec"), "waiting")
    # all of a waiting key's rows come after its waiting records; each range that holds some gets a copy of them
    rows = ranged.where("tw_side = 0")
    if clear_buffer:
        rows = rows.groupBy(*keys).agg(F.min_by("tw_dim", F.struct(time, ROW)).alias("tw_dim"))
    copies = rows.select(*keys, "tw_dim").join(waiting.select(*keys, PART).distinct(), keys)
    released = waiting.join(copies, [*keys, PART])
    return shown(known, "tw_latest").unionByName(shown(released, "tw_dim"))
