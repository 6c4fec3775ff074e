"""Filter interaction audit: what every order of a set of filters removes, step by step.

Each document becomes a mask with one bit per filter it fails.  Documents are counted
per part and mask (a *cell*: 32 for five filters), so whatever follows works on few rows.  The
orders are one constant array of the plan, sent to every task with the broadcast task
binary.  A cell folds across it with higher-order functions: ``transform`` walks the
orders, ``aggregate`` walks the steps of one order carrying the filters seen so far, and each
step yields a struct weighted with the cell's counts (600 structs for five filters).
A part's cells are merged by elementwise sums of these arrays.

A duplicate filter (fails if a smaller id anywhere in the table has the same text, removed or
not) needs no row per document: a group of equal texts has one mask, and all its rows fail but
those of its smallest id.  Groups are aggregated per (digest, part) before and after the
shuffle, so a group that holds a third of the table is combined inside the tasks.

Edge rows: a null text counts as empty; a null source is the part ``''``, shared with the empty
source; a row with a null id never fails the duplicate filter, hides no other row and has no labels; rows
that repeat an id with its text count each, and none of them is smaller than another.  Several
labels of an id: one that says 1 is enough; labels without an id or a document are ignored.
Texts of any length are read whole.  An empty table has no part and gives no rows.  Only the
named columns are read, so further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
SPACE = r"[\x20\x09-\x0D]+"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


#: filter letter -> failure condition of (text, words)
TEXT_FILTERS: dict[str, Callable[[Column, Column], Column]] = {
    "A": lambda text, words: F.size(words) < 50,
    "B": lambda text, words: F.size(F.array_distinct(words)).cast("bigint") * 100 < F.size(words).cast("bigint") * 65,
    "C": lambda text, words: (F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))).cast("bigint") * 100
    > F.length(text).cast("bigint") * 5,
    "D": lambda text, words: text.rlike("[#$%&*|]"),
}
DUPLICATE = "E"


def _marked(docs: DataFrame, filters: dict, part: str) -> DataFrame:
    """``doc_id, part, mask, digest`` of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    split = rows.withColumn("words", _words(F.col("text")))
    bits = [F.when(fails(F.col("text"), F.col("words")), 1 << k).otherwise(0) for k, fails in enumerate(filters.values())]
    mask = reduce(lambda a, b: a + b, bits, F.lit(0))
    return split.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest"))


def cells(docs: DataFrame, labels: DataFrame, filters: dict | None = None, part: str = "source") -> DataFrame:
    """``part, mask, n, good, toxic``: document counts per part and set of failed filters.

    Bit k of ``mask`` is the k-th filter; the bit after the last is the duplicate filter.
    """
    filters = TEXT_FILTERS if filters is None else filters
    rows = _marked(docs, filters, part).groupBy("doc_id", "digest", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("of")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")).withColumn("spread", F.lit(0).cast("bigint"))
    # rows without an id match nothing; the second key keeps them out of one task
    rows = rows.withColumn("spread_by", F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(0))
    joined = rows.join(known, (F.col("doc_id") == F.col("of")) & (F.col("spread_by") == F.col("spread")), "left")
    good, toxic = F.coalesce(F.col("good"), F.lit(0)) * F.col("n"), F.coalesce(F.col("toxic"), F.lit(0)) * F.col("n")
    named = F.col("doc_id").isNotNull()
    first = F.min(F.when(named, F.struct("doc_id", "n", good.alias("good"), toxic.alias("toxic"))))
    groups = joined.groupBy("digest", "part", "mask").agg(
        F.sum("n").alias("n"), F.sum(good).alias("good"), F.sum(toxic).alias("toxic"),
        F.sum(F.when(named, 0).otherwise(F.col("n"))).alias("nameless"), first.alias("first"))
    # a digest has one row per part here
    lowest = F.min("first.doc_id").over(Window.partitionBy("digest"))
    leads = groups.withColumn("leads", F.coalesce(F.col("first.doc_id") == lowest, F.lit(False)))

    def lead(c: str) -> Column:
        return F.when(F.col("leads"), F.col(f"first.{c}")).otherwise(0)

    fresh = leads.withColumn("n0", F.col("nameless") + lead("n")).withColumn("g0", lead("good")).withColumn("t0", lead("toxic"))
    both = F.array(F.struct(F.col("mask").alias("mask"), F.col("n0").alias("n"), F.col("g0").alias("good"), F.col("t0").alias("toxic")),
                   F.struct((F.col("mask") + (1 << len(filters))).alias("mask"), (F.col("n") - F.col("n0")).alias("n"),
                            (F.col("good") - F.col("g0")).alias("good"), (F.col("toxic") - F.col("t0")).alias("toxic")))
    cell = fresh.select("part", F.explode(both).alias("cell")).select("part", "cell.*").where("n > 0")
    return cell.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def _step(seen: Column, bit: Column, cell: Column) -> Column:
    """Counts of a cell at the step of filter ``bit``, after the filters in ``seen``."""
    fails, before = cell["mask"].bitwiseAND(bit) != 0, cell["mask"].bitwiseAND(seen) != 0
    removed = fails & ~before
    taken = {"kept": (~fails & ~before, "n"), "removed": (removed, "n"), "redundant": (fails & before, "n"),
             "unique_fails": (cell["mask"] == bit, "n"), "good_lost": (removed, "good"), "toxic_lost": (removed, "toxic")}
    none = F.lit(0).cast("bigint")
    return F.struct(bit.alias("bit"), *[F.when(when, cell[of]).otherwise(none).alias(c) for c, (when, of) in taken.items()])


def fold(cell: Column, orders: Column) -> Column:
    """One struct per order and step, in that sequence, weighted with the counts of ``cell``."""
    def walk(order: Column) -> Column:
        none = F.struct(F.lit(0).alias("seen"), F.array().cast(_STEPS).alias("steps"))

        def add(done: Column, bit: Column) -> Column:
            steps = F.concat(done["steps"], F.array(_step(done["seen"], bit, cell)))
            return F.struct((done["seen"] + bit).alias("seen"), steps.alias("steps"))

        return F.aggregate(order, none, add, lambda done: done["steps"])

    return F.flatten(F.transform(orders, walk))


_STEPS = "array<struct<bit:int," + ",".join(f"{c}:bigint" for c in COUNTS) + ">>"


def audit(cell_counts: DataFrame, letters: str) -> DataFrame:
    """Counts per part, order of ``letters`` and step, with each filter's Shapley sum.

    ``cell_counts`` is the result of ``cells``; bit k of its masks is ``letters[k]``.
    """
    names = list(permutations(range(len(letters))))
    orders = F.array(*[F.array(*[F.lit(1 << k) for k in order]) for order in names])
    spelt = F.array(*[F.lit("".join(letters[k] for k in order)) for order in names])
    parts = cell_counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # one row per mask

    def add(total: Column, cell: Column) -> Column:
        return F.zip_with(total, fold(cell, orders),
                          lambda a, b: F.struct(a["bit"].alias("bit"), *[(a[c] + b[c]).alias(c) for c in COUNTS]))

    zero = F.lit(0).cast("bigint")
    empty = F.struct(F.lit(0).alias("mask"), zero.alias("n"), zero.alias("good"), zero.alias("toxic"))
    merged = parts.select("part", F.aggregate("cells", fold(empty, orders), add).alias("steps"))

    def share_of(bit: int) -> Column:
        return F.aggregate("steps", zero, lambda s, x: s + F.when(x["bit"] == bit, x["removed"]).otherwise(zero))

    removed = [share_of(1 << k) for k in range(len(letters))]
    # a select of its own: beside the generator the shares would be folded for each of its rows
    rows = merged.select("part", F.array(*removed).alias("shares"), "steps").select("part", "shares", F.posexplode("steps").alias("at", "s"))
    width = len(letters)
    bits = F.array(*[F.lit(1 << k) for k in range(width)])
    share = F.get("shares", (F.array_position(bits, F.col("s.bit")) - 1).cast("int"))
    return rows.select("part", F.get(spelt, F.floor(F.col("at") / width).cast("int")).alias("filter_order"),
                       (F.col("at") % width + 1).cast("int").alias("step"), *[F.col(f"s.{c}").alias(c) for c in COUNTS],
                       share.alias("shapley"))


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters ``ABCDE`` over ``docs``, by source."""
    return audit(cells(docs, labels), "".join(TEXT_FILTERS) + DUPLICATE)


ORACLE_SQL = """
WITH words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
known AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
          FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
marked AS (
  SELECT w.part, coalesce(k.good, 0) AS good, coalesce(k.toxic, 0) AS toxic,
         CASE WHEN len(w) < 50 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END
         + CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN w.doc_id > min(w.doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask
  FROM words w LEFT JOIN known k ON w.doc_id = k.doc_id),
cells AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM marked GROUP BY ALL),
letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) t(letter, bit)),
orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (
  SELECT o.filter_order, s.step, l.letter, l.bit,
         coalesce((SELECT sum(p.bit) FROM letters p WHERE instr(o.filter_order, p.letter) < s.step), 0)::INTEGER AS seen
  FROM orders o, (SELECT unnest(range(1, 6)) AS step) s JOIN letters l ON l.letter = substr(o.filter_order, s.step, 1)),
counted AS (
  SELECT part, filter_order, step, letter,
         sum(CASE WHEN mask & (seen | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN mask & seen = 0 AND mask & bit <> 0 THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN mask & seen <> 0 AND mask & bit <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN mask & seen = 0 AND mask & bit <> 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN mask & seen = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM cells, steps GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM counted
"""
