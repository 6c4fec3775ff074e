"""Mixing sources to target weights by cube-method balanced sampling.

Every source gets a target by water-filling, hence a rate: words to take per
word it has.  The whole part of the rate is taken from every document; the
rest is an inclusion probability.  The flight phase moves the probabilities of three
documents at a time along the null space of two constraints, the source's words and its
number of documents, until one of them is 0 or 1; both totals stay exact.
It runs in chunks of a source; the two or fewer documents that a chunk leaves
undecided fly again together, and the last twelve or fewer of a source land on the choice
nearest in words.

Null and empty texts have size 0.  Null sources form one source, last in order.
Equal rows are one unit with a multiplicity, so no chunk can be filled by copies of one row;
its copies differ by at most one.  A source without words has target 0, and its
documents stay once.  Draws follow from hashes of the rows: reruns agree.  Texts of any length are counted
whole.  An empty table has no source and gives no rows.  Only ``doc_id, text, source`` are read, so further
columns may have any name.
"""

from __future__ import annotations

import random
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5   # of all words, taken in sum
MOST = 2.0    # times a source's, or a document's, own size
CHUNK = 4096  # units that fly in one task at a time
LANDING = 10  # units of a source that are kept for the landing


def size_of(text: str = "text") -> Column:
    """Number of words of a text."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
                   most: float = MOST) -> DataFrame:
    """``source, source_size, units, target, rate``, one row for each source.

    ``sizes`` has ``source, size, m`` (multiplicity).  Sources in code-point order, null
    last, take the weights in turn.  Sources whose cap is small for their weight
    are capped first; the others share the rest, in one pass over the running sums.
    The windows see one row per source.
    """
    found = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"), F.count("*").alias("units"))
    turn = F.row_number().over(W.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn % len(weights) + 1).cast("int"))
    caps = found.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    order = W.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(F.lit(0))
    left = F.sum("source_size").over(whole) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = left / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    # the level rises along the order while sources are capped, and falls after the first that is not
    leveled = caps.withColumn("level", level).withColumn("shared", F.max("level").over(whole))
    target = F.least("cap", F.col("shared") * F.col("weight"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(1.0))
    return (leveled.withColumn("target", target).withColumn("rate", rate)
            .select("source", "source_size", "units", "target", "rate"))


def fly(sizes: list[float], chance: list[float], rng: random.Random) -> list[float]:
    """Decide all but two units at most, keeping the sums of chances and of sizes times chances."""
    chance = list(chance)
    open_ = [i for i, p in enumerate(chance) if 1e-9 < p < 1 - 1e-9]
    for i, p in enumerate(chance):
        if not 1e-9 < p < 1 - 1e-9:
            chance[i] = float(round(p))
    hand = open_[:3]
    nxt = 3
    while len(hand) == 3 or (len(hand) == 2 and sizes[hand[0]] == sizes[hand[1]]):
        if len(hand) == 3:
            a, b, c = (sizes[i] for i in hand)
            way = [b - c, c - a, a - b] if not a == b == c else [1.0, -1.0, 0.0]
        else:
            way = [1.0, -1.0]
        up = min((1 - chance[i]) / w if w > 0 else -chance[i] / w for i, w in zip(hand, way, strict=True) if w)
        down = min(chance[i] / w if w > 0 else (chance[i] - 1) / w for i, w in zip(hand, way, strict=True) if w)
        step = up if rng.random() * (up + down) < down else -down
        for i, w in zip(hand, way, strict=True):
            chance[i] += step * w
        stay = []
        for i in hand:
            if 1e-9 < chance[i] < 1 - 1e-9:
                stay.append(i)
            else:
                chance[i] = float(round(chance[i]))
        hand = stay
        while len(hand) < 3 and nxt < len(open_):
            hand.append(open_[nxt])
            nxt += 1
    return chance


def land(sizes: list[float], chance: list[float]) -> list[float]:
    """Settle the open units, ``LANDING`` + 2 at most: of all choices the one nearest in
    words, then in documents, to what their chances stand for."""
    open_ = [i for i, p in enumerate(chance) if 0 < p < 1]
    choice = np.arange(1 << len(open_))[:, None] >> np.arange(len(open_)) & 1
    off = choice - np.array([chance[i] for i in open_])
    words = np.abs(off @ np.array([sizes[i] for i in open_])).round(6)
    best = np.lexsort((np.abs(off.sum(axis=1)).round(6), words))[0]
    for k, i in enumerate(open_):
        chance[i] = float(choice[best, k])
    return chance


def balanced_units(units: DataFrame) -> DataFrame:
    """``units`` (``source, doc_id, size, place, chance, chunks``) with every chance at 0.0 or 1.0.

    Each level flies the open units in chunks of about ``CHUNK``, dealt by hash within the source,
    until every source has one chunk; that level lands.
    """
    columns = ["source", "doc_id", "size", "place", "chance"]
    schema = ", ".join(f"{c} {dict(units.dtypes)[c]}" for c in columns)
    done, level, open_ = [], 0, units

    while True:
        last = (open_.agg(F.max("chunks")).first()[0] or 1) <= 1
        run = _flight(last, level)
        flown = cut(open_.groupBy("source", F.pmod(F.xxhash64(F.lit(level), "place"), "chunks").alias("chunk"))
                    .applyInPandas(run, schema), "flight")
        if last:
            return _all(done + [flown])
        undecided = (F.col("chance") > 0) & (F.col("chance") < 1)
        done.append(flown.where(~undecided))
        rest = flown.where(undecided)
        many = rest.groupBy("source").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
        open_ = rest.join(many.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
        level += 1


def _flight(last: bool, level: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place", kind="stable")
        rng = random.Random(zlib.crc32(f"{level} {key}".encode()))
        sizes, chance = rows["size"].astype(float).tolist(), rows["chance"].tolist()
        flies = max(len(sizes) - LANDING, 0) if last else len(sizes)
        chance[:flies] = fly(sizes[:flies], chance[:flies], rng)
        return rows.assign(chance=land(sizes, chance) if last else chance)[
            ["source", "doc_id", "size", "place", "chance"]]
    return run


def _all(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def unit_copies(docs: DataFrame, **how) -> DataFrame:
    """One row per distinct ``(source, doc_id, size, place)``: its multiplicity ``m``, the copies
    ``base`` of each of its rows, and how many of them (``extra``) get one more."""
    place = F.xxhash64("source", "doc_id", "text")
    sized = docs.select("doc_id", "source", size_of().alias("size"), place.alias("place"))
    units = cut(sized.groupBy("source", "doc_id", "size", "place").agg(F.count("*").alias("m")), "units")
    targets = cut(source_targets(units, **how), "targets")
    of = targets.withColumnRenamed("source", "of")
    rated = units.join(of, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    rated = (rated.withColumn("base", F.floor("rate"))
             .withColumn("wanted", (F.col("rate") - F.col("base")) * F.col("m"))
             .withColumn("extra", F.floor("wanted"))
             .withColumn("chance", F.col("wanted") - F.col("extra"))
             .withColumn("chunks", F.ceil(F.col("units") / CHUNK)))
    rated = cut(rated, "rated")
    chosen = balanced_units(rated.select("source", "doc_id", "size", "place", "chance", "chunks"))
    chosen = chosen.select(*(F.col(c).alias(f"_{c}") for c in ("source", "doc_id", "size", "place", "chance")))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("place", "doc_id", "source", "size")]
    return rated.join(chosen, same).select(
        "source", "doc_id", "size", "place", "m", "source_size", "target",
        F.col("base").cast("int").alias("base"), (F.col("extra") + F.col("_chance")).cast("bigint").alias("extra"))


def mix(docs: DataFrame, **how) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every document."""
    units = unit_copies(docs, **how)
    each = units.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("bigint"), "m")))
    copies = F.col("base") + (F.col("nth") <= F.col("extra")).cast("int")
    return each.select("doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"), copies.alias("copies"))


def _numbered(rows: DataFrame, unit: list[str]) -> DataFrame:
    """``rows`` with ``__nth``, 1, 2, ... among the rows of a unit.

    Rows are written with their partition's number and counted per unit and partition, so a unit of many
    rows is numbered by many tasks: a row's number is its place in its partition after the rows of earlier ones.
    """
    dealt = cut(rows.withColumn("__part", F.spark_partition_id()), "copies")
    counts = dealt.groupBy(*unit, "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = W.partitionBy(*unit).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(*[F.col(c).alias(f"__of{c}") for c in unit], F.col("__part").alias("__of_part"),
                           F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    same = [F.col(c).eqNullSafe(F.col(f"__of{c}")) for c in unit] + [F.col("__part") == F.col("__of_part")]
    place = F.row_number().over(W.partitionBy(*unit, "__part").orderBy("__part"))
    return dealt.withColumn("__at", place).join(starts, same).withColumn("__nth", F.col("__at") + F.col("__start"))


def take_mix(docs: DataFrame, **how) -> DataFrame:
    """The documents of the mix, all their columns, each as often as it is taken.

    Helper columns begin with ``__``, so columns may have any other name; an empty table stays empty.
    """
    columns = list(docs.columns)
    units = unit_copies(docs, **how).select(F.col("doc_id").alias("__id"), F.col("source").alias("__source"),
                                            *[F.col(c).alias(f"__{c}") for c in ("m", "base", "extra")], F.col("place").alias("__unit"))
    placed = docs.withColumn("__place", F.xxhash64("source", "doc_id", "text"))
    joined = placed.join(units, (F.col("__place") == F.col("__unit")) & F.col("doc_id").eqNullSafe(F.col("__id"))
                         & F.col("source").eqNullSafe(F.col("__source")))
    even = (F.col("__extra") == 0) | (F.col("__extra") == F.col("__m"))
    plain = joined.where(even).withColumn("__copies", F.col("__base") + (F.col("__extra") > 0).cast("int"))
    split = _numbered(joined.where(~even), ["__unit", "__id", "__source"])
    split = split.withColumn("__copies", F.col("__base") + (F.col("__nth") <= F.col("__extra")).cast("int"))
    every = plain.select(*columns, "__copies").unionByName(split.select(*columns, "__copies")).where("__copies > 0")
    return every.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*columns)
