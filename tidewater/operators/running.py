"""Running (per-record) keyed aggregates (A2) and changelogs (Q4), batch form.

A streaming keyed ``sum`` emits the updated total for every input record.
On a bounded input that is a running sum per key in record order.  The
obvious ``Window.partitionBy(key)`` puts every row of a key into one task,
which fails when one key holds a large share of the data, so the sum is
computed in two levels:

1. Rows are range-partitioned by ``(key, order)`` and written to the shared
   folder with the number of their partition, which fixes the ranges once.  The
   bounds come from Spark's sample of the data, so partitions are even
   whatever the keys, the spacing of the order values or their type; rows that
   tie are told apart by a row number.
2. Windows run per ``(key, partition)``: no task holds more of a key than one
   partition.
3. The rows of a partition continue at most one key of the partitions before
   it.  That key's earlier total is a prefix sum over per-partition totals: one row per
   partition at most, hence broadcast, and added back by an equi-join.

Results are exact: the ranges change only where rows are processed.  Nulls form
a key of their own, sort first in the order, and add nothing to a sum.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.rows import row_kind_rows
from tidewater.functions.util import as_col
from tidewater.session import scratch_path


def add_sums(a: Column, b: Column) -> Column:
    """SQL-sum addition: null only when both sides are."""
    return F.when(b.isNull(), a).when(a.isNull(), b).otherwise(a + b)


def _ranges(df: DataFrame, by: list[str], parts: int | None) -> DataFrame:
    """``df`` with the range partition ``__part`` by ``by`` and the place ``__at`` in it, written and reread.

    Ranges are written sorted: a key and its order stand in runs, so that the files and the shuffle
    that reads them take less room.
    """
    order = [*by, "__row"]
    numbered = df.withColumn("__row", F.monotonically_increasing_id())
    dealt = numbered.repartitionByRange(parts, *order) if parts else numbered.repartitionByRange(*order)
    dealt = dealt.sortWithinPartitions(*order).drop("__row")
    dealt = dealt.withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id())
    path = scratch_path(df.sparkSession, "ranges")
    dealt.write.parquet(path)
    return df.sparkSession.read.schema(dealt.schema).parquet(path)


def running_sums(df: DataFrame, key, order, values: Mapping[str, object], *, parts: int | None = None,
                 before_suffix: str | None = "_before", count_before: str | None = None) -> DataFrame:
    """Add, per output name, the running ``sum`` of a value over the key's rows
    in ``order`` (current row included).

    ``before_suffix`` also adds the sum over earlier rows only (``name_before``),
    ``count_before`` the number of earlier rows of the key.  ``parts`` is the number
    of ranges (default: the session's shuffle partitions).
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [order] if isinstance(order, str) else list(order)
    vals = {name: as_col(v) for name, v in values.items()}
    tagged = _ranges(df, keys + order, parts)

    # by key first, so that steps after it that group or join on the key reuse the order
    w = Window.partitionBy(*keys, "__part").orderBy("__at")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prior = w.rowsBetween(Window.unboundedPreceding, -1)
    local = tagged.select(
        "*", *[F.sum(v).over(upto).alias(f"__l_{n}") for n, v in vals.items()],
        *[F.sum(v).over(prior).alias(f"__p_{n}") for n, v in vals.items()], F.count(F.lit(1)).over(prior).alias("__p_n"))

    totals = tagged.groupBy(*keys, "__part").agg(
        *[F.sum(v).alias(f"__t_{n}") for n, v in vals.items()], F.count(F.lit(1)).alias("__t_n"))
    earlier = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__part").alias("__of"),
        *[F.sum(f"__t_{n}").over(earlier).alias(f"__o_{n}") for n in vals],
        F.sum("__t_n").over(earlier).alias("__o_n")).where(F.col("__o_n").isNotNull())
    same = F.col("__part") == F.col("__of")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    joined = local.join(F.broadcast(offsets), same, "left")  # one row per range at most

    out = []
    for name in vals:
        out.append(add_sums(F.col(f"__l_{name}"), F.col(f"__o_{name}")).alias(name))
        if before_suffix is not None:
            out.append(add_sums(F.col(f"__p_{name}"), F.col(f"__o_{name}")).alias(name + before_suffix))
    if count_before is not None:
        out.append((F.col("__p_n") + F.coalesce(F.col("__o_n"), F.lit(0))).alias(count_before))
    made = set(vals) | ({n + before_suffix for n in vals} if before_suffix is not None else set())
    made |= {count_before} if count_before is not None else set()
    # an output may reuse an input's name (a sum written over its own column)
    return joined.select(*[joined[c] for c in df.columns if c not in made], *out)


def running_sum(df: DataFrame, key, order, value, out: str = "running", **kw) -> DataFrame:
    """Running sum of ``value`` per ``key`` in ``order``: one row per input row."""
    return running_sums(df, key, order, {out: value}, before_suffix=None, **kw)


def changelog_sum(df: DataFrame, key: str, order, value, out: str = "s",
                  keep=(), **kw) -> DataFrame:
    """Changelog of ``SELECT key, SUM(value) ... GROUP BY key`` fed in ``order``.

    Per input record: ``+I`` with the first total of a new key; ``-U`` old
    total then ``+U`` new total when it changed; nothing when it did not.
    Columns: ``keep``, ``pos`` (0/1 within the record), ``op``, ``key``, ``out``.
    """
    order_cols = [order] if isinstance(order, str) else list(order)
    r = running_sums(df, key, order_cols, {out: value}, count_before="__seen", **kw)
    rows = row_kind_rows(F.col("__seen") == 0, F.col(out + "_before"), F.col(out))
    return (r.select(*[F.col(c) for c in keep], F.col(key), F.explode(rows).alias("__r"))
            .select(*keep, F.col("__r.pos").alias("pos"), F.col("__r.op").alias("op"),
                    F.col(key), F.col("__r.v").alias(out)))


def changelog_insert_only(df: DataFrame, op: str = "op") -> DataFrame:
    """An insert-only table as a changelog: every row is ``+I``."""
    from tidewater.functions.rows import INSERT
    return df.select(F.lit(INSERT).alias(op), "*")
