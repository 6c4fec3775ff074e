"""Quality classifier: logistic regression on hashed word n-grams, fitted with
follow-the-regularised-leader updates and scored as sparse dot products.

Features of a text are the one- and two-grams of its tokens (case kept, runs of marks
are tokens) and of the tokens' shapes, each with the value 1/sqrt(number of grams).  A null or empty text has no
gram and scores the intercept alone.  With no usable label every score is 0.5.

Texts of any length are scored whole.  Every row is scored by itself, so repeated rows and ids keep their
rows and equal texts have equal scores; a score of exactly ``THRESHOLD`` counts as 1.  An empty table gives
no rows.  Only ``doc_id`` and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Texts, held_out, map_texts, text_blocks
from .ftrl import BITS, Learner, fit, labelled_sample
from .tokens import Tokens, ngram_slots

THRESHOLD = 0.3

_SHAPE = np.uint64(0xD6E8FEB86659FD93)
_KIND = np.zeros(256, np.int64)  # other bytes 0, lower-case and non-ASCII 1, upper-case 2, digit 3
_KIND[0x61:0x7B] = _KIND[0x80:] = 1
_KIND[0x41:0x5B] = 2
_KIND[0x30:0x3A] = 3


def _grams(texts: Texts, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash slots of the grams of all texts, and the text of each.

    Grams run over the tokens and over their shapes: the kind of the first two
    bytes, the length, and whether the token repeats one of the two before it.
    """
    tokens = Tokens(texts, lower=False)
    if not len(tokens.start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = _KIND[tokens.data[tokens.start]]
    second = _KIND[tokens.data[np.minimum(tokens.start + 1, tokens.end - 1)]]
    again = np.zeros(len(first), np.int64)
    for back in (1, 2):
        again[back:] |= (tokens.hash[back:] == tokens.hash[:-back]) & (tokens.text[back:] == tokens.text[:-back])
    shape = (np.minimum(tokens.end - tokens.start, 15) * 2 + again) * 16 + first * 4 + second
    words, owner = ngram_slots(tokens.hash, tokens.text, bits)
    shapes, owner_too = ngram_slots((shape.astype(np.uint64) + np.uint64(1)) * _SHAPE, tokens.text, bits)
    return np.concatenate([words, shapes]), np.concatenate([owner, owner_too])


def _train(learner: Learner, rows: pd.DataFrame, epochs: int = 1, bits: int = BITS) -> None:
    """Passes over documents, one update each."""
    y, bags = rows["y"].to_numpy(), []
    for texts in text_blocks(pa.array(rows["text"], pa.large_string())):
        slots, owner = _grams(texts, bits)
        order = np.argsort(owner, kind="stable")
        for grams in np.split(slots[order], np.cumsum(np.bincount(owner, minlength=len(texts)))[:-1]):
            at, times = np.unique(grams, return_counts=True)
            bags.append((np.append(at, 1 << bits), np.append(times / np.sqrt(max(len(grams), 1)), 1.0)))
    rng = np.random.default_rng(len(bags))
    for _ in range(epochs):
        for i in rng.permutation(len(bags)):
            at, x = bags[i]
            w = learner.weights(at)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            learner.update(at, w, (p - y[i]) * x)


def train_quality(docs: DataFrame, labels: DataFrame, label: str = "quality") -> np.ndarray:
    """Weights fitted on a bounded sample of the labelled documents not held out."""
    return fit(labelled_sample(docs, labels, label), _train)


def score_quality(docs: DataFrame, weights: np.ndarray, keep: list[str], out: str = "score") -> DataFrame:
    """``keep`` and the probability of label 1 of every whole text."""
    model = docs.sparkSession.sparkContext.broadcast(weights)
    bits = int(np.log2(len(weights) - 1))

    def start():
        w = model.value

        def score(texts: Texts) -> list:
            slots, owner = _grams(texts, bits)
            total = np.bincount(owner, weights=w[slots], minlength=len(texts))
            grams = np.bincount(owner, minlength=len(texts))
            s = total / np.sqrt(np.maximum(grams, 1)) + w[-1]
            return [1 / (1 + np.exp(-np.clip(s, -35, 35)))]
        return score

    return map_texts(docs, "text", keep, [T.StructField(out, T.DoubleType())], start)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document, held-out ids included."""
    scored = score_quality(docs, train_quality(docs, labels), ["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
