"""Row-level helpers: parity routing tags, prefixed conversion, changelog rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions.util import as_col

# Row kinds of a changelog, fixed values.
INSERT, UPDATE_BEFORE, UPDATE_AFTER = "+I", "-U", "+U"


def parity_tag(value, even: str = "even", odd: str = "odd") -> Column:
    """``even`` when ``value % 2 == 0``, ``odd`` for every other non-null value
    (negative odd numbers included); null stays untagged."""
    v = as_col(value)
    return F.when(v % 2 == 0, F.lit(even)).when(v.isNotNull(), F.lit(odd))


def prefixed_string(value, prefix: str) -> Column:
    """``prefix + value.toString()``."""
    return F.concat(F.lit(prefix), as_col(value).cast("string"))


def row_kind_rows(is_first: Column, before: Column, after: Column) -> Column:
    """Array of (pos, op, value) structs one input record contributes to a
    changelog: ``+I`` for a key's first record, ``-U``/``+U`` for a changed
    value, nothing when the value is unchanged."""
    def row(pos, op, v):
        return F.struct(F.lit(pos).alias("pos"), F.lit(op).alias("op"), v.alias("v"))
    # no branch matches an unchanged value: the null array explodes to nothing
    return (F.when(is_first, F.array(row(0, INSERT, after)))
            .when(~before.eqNullSafe(after),
                  F.array(row(0, UPDATE_BEFORE, before), row(1, UPDATE_AFTER, after))))
