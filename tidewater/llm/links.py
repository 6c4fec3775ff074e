"""Connected components of a link table, also as links are added, and forests of links inside one task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, discard


def components(edges: DataFrame, name: str = "links") -> DataFrame:
    """``node, component`` of every node of the links ``(a, b)``; the component is one of its nodes.

    Rounds of contraction, with built-in functions only.  In each, every node points at
    the neighbour that comes first in that round's hash order, pointers are
    followed twice, and links are rewritten to what their ends point at.  A dense group
    shrinks to one node in a round or two and its links vanish.  Each group-by is a
    minimum, so a hub is combined before the shuffle.  Links with a null end are
    ignored; an empty table has no component.  What the rounds write is removed.
    """
    ordered = lambda a, b: (F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    left = cut(edges.where(F.col("a") != F.col("b")).select(*ordered("a", "b")).distinct(), name)
    labels = left.select(F.col("a").alias("node"), F.col("b").alias("component")).limit(0)
    k, ups = 0, []
    while not left.isEmpty():
        both = left.select(F.col("a").alias("node"), F.col("b").alias("other")).union(
            left.select(F.col("b").alias("node"), F.col("a").alias("other")))
        place = lambda c, k=k: F.struct(F.xxhash64(F.lit(k), c).alias("place"), F.col(c).alias("node"))
        first = both.groupBy("node").agg(F.min(place("other")).alias("first"))
        up = first.select("node", F.least("first", place("node"))["node"].alias("up"))
        up = cut(up.join(up.select(F.col("node").alias("up"), F.col("up").alias("upper")), "up").select("node", "upper"), name)
        ups.append(up)
        if k:
            labels = (labels.join(up.select(F.col("node").alias("component"), "upper"), "component", "left")
                      .select("node", F.coalesce("upper", "component").alias("component")))
        else:
            labels = up.select("node", F.col("upper").alias("component"))
        ends = (left.join(up.select(F.col("node").alias("a"), F.col("upper").alias("ua")), "a")
                .join(up.select(F.col("node").alias("b"), F.col("upper").alias("ub")), "b"))
        last, left = left, cut(ends.where(F.col("ua") != F.col("ub")).select(*ordered("ua", "ub")).distinct(), name)
        discard(last)
        k += 1
    labels = cut(labels, name)
    discard(left, *ups)
    return labels


def extended(groups: DataFrame, edges: DataFrame, name: str = "links") -> DataFrame:
    """``components`` of the links that ``groups`` came from and ``edges`` together.

    Only links between different groups are contracted, so a few links take few rounds, however many nodes there are.
    """
    of = lambda c: groups.select(F.col("node").alias(c), F.col("component").alias(f"{c}_group"))
    ends = edges.join(of("a"), "a", "left").join(of("b"), "b", "left")
    more = components(ends.select(F.coalesce("a_group", "a").alias("a"), F.coalesce("b_group", "b").alias("b")), name)
    known = groups.join(more.select(F.col("node").alias("component"), F.col("component").alias("upper")), "component", "left")
    new = more.join(groups.select("node"), "node", "left_anti").select("node", "component")
    out = cut(known.select("node", F.coalesce("upper", "component").alias("component")).union(new), name)
    discard(more)
    return out


class Forest:
    """Components among ``n`` places of one task, fed with batches of links."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        a, b = self.root[a], self.root[b]
        while (a != b).any():
            pairs = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)], axis=1)[a != b], axis=0)
            high, first = np.unique(pairs[:, 0], return_index=True)
            up = np.arange(len(self.root))
            up[high] = pairs[first, 1]  # the smallest partner; pointers only go down
            while (up[up] != up).any():
                up = up[up]
            self.root = up[self.root]
            a, b = up[pairs[:, 0]], up[pairs[:, 1]]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """A link from every place to the first place of its component, where they differ."""
        own = np.flatnonzero(self.root != np.arange(len(self.root)))
        return own, self.root[own]
