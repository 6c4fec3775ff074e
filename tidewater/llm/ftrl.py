"""Follow-the-regularised-leader (proximal) updates on hashed sparse features."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, held_out

BITS = 18          # 2**18 weights: a model is 1 MB whatever the corpus
TRAIN_ROWS = 12_000  # bound of the labelled sample a classifier is fitted on
SHARDS = 4         # learners whose states are averaged after each round
SHARD_ROWS = 3_000  # documents a learner goes through in a round; a smaller shard is repeated
ROUNDS = 3


class Learner:
    """Per-coordinate state ``z``, ``n``; the last slot is the intercept."""

    def __init__(self, z: np.ndarray, n: np.ndarray, alpha: float, l1: float, l2: float, beta: float = 1.0):
        self.z, self.n = z, n
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, slots: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[slots], self.n[slots]
        w = (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def update(self, slots: np.ndarray, w: np.ndarray, gradient: np.ndarray) -> None:
        """One step on distinct ``slots`` whose weights are ``w``."""
        n = self.n[slots]
        grown = n + gradient * gradient
        self.z[slots] += gradient - (np.sqrt(grown) - np.sqrt(n)) / self.alpha * w
        self.n[slots] = grown


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Texts to learn from: ``(shard, y, text)``, about ``train_rows`` rows at most.

    Ids held out, null ids and null labels are left out; several labels of one id
    count as their largest.  Which ids are taken follows from a hash of the id, so
    every run takes the same.  The id list is bounded by ``train_rows``, hence the
    broadcast; the documents are scanned once and never shuffled.
    """
    known = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out())
             .groupBy("doc_id").agg((F.max(label) > 0).cast("int").alias("y")))
    known = cut(known, "labels")
    n = known.count()
    share = min(1.0, train_rows / max(1, n))
    place = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(10**9))
    chosen = known.where(place < int(share * 10**9))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    shards = SHARDS if share * n >= SHARDS * SHARD_ROWS / 2 else 1
    shard = F.pmod(F.xxhash64(F.lit("shard"), "doc_id"), F.lit(shards)).cast("int")
    return cut(rows.select(shard.alias("shard"), "y", F.coalesce("text", F.lit("")).alias("text"),
                           F.xxhash64("doc_id").alias("place")), "sample")


def _shard_learner(train, start, seed: int, even: bool, alpha: float, l1: float, l2: float):
    """The function that carries one shard's rows through one round."""
    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        z, n = (x.astype(np.float64) for x in start.value)
        learner = Learner(z, n, alpha, l1, l2)
        order = seed * SHARDS + int(rows["shard"].iloc[0]) if even else seed
        rows = rows.sort_values(["place", "text"]).sample(frac=1.0, random_state=order)
        train(learner, rows, max(1, SHARD_ROWS // len(rows)))
        return pd.DataFrame({"z": [learner.z.astype(np.float32).tobytes()],
                             "n": [learner.n.astype(np.float32).tobytes()]})
    return learn


def fit(sample: DataFrame, train: Callable[[Learner, pd.DataFrame, int], None], alpha: float = 0.1,
        l1: float = 0.5, l2: float = 1.0, bits: int = BITS, rounds: int = ROUNDS, even: bool = False) -> np.ndarray:
    """Weights learnt by iterative parameter mixing: each shard continues from the
    averaged state, and only ``SHARDS`` fixed-size states reach the driver per round.

    With ``even`` each of the ``SHARDS`` learners has about ``SHARD_ROWS`` rows: those of a smaller sample are dealt to
    several learners, at most to all.  Else a learner has its shard, and a sample of less than
    ``SHARDS * SHARD_ROWS / 2`` rows is one shard.  Fewer than ``SHARD_ROWS`` rows are gone through several times a round.
    """
    size = (1 << bits) + 1
    if even:
        times = min(SHARDS, max(1, round(SHARDS * SHARD_ROWS / max(1, sample.count()))))
        shard = F.pmod(F.xxhash64(F.lit("deal"), "place"), F.lit(SHARDS)).cast("int")
        sample = sample.withColumn("shard", F.explode(F.array(*[(shard + k) % SHARDS for k in range(times)])))
    z, n = np.zeros(size), np.zeros(size)
    for k in range(rounds):
        start = sample.sparkSession.sparkContext.broadcast((z.astype(np.float32), n.astype(np.float32)))

        learn = _shard_learner(train, start, k, even, alpha, l1, l2)
        states = sample.groupBy("shard").applyInPandas(learn, "z binary, n binary").collect()
        if not states:  # no labelled row: the weights stay zero
            break
        z = np.mean([np.frombuffer(s.z, np.float32) for s in states], axis=0, dtype=np.float64)
        n = np.mean([np.frombuffer(s.n, np.float32) for s in states], axis=0, dtype=np.float64)
    return Learner(z, n, alpha, l1, l2).weights(slice(None)).astype(np.float32)
