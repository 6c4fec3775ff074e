"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  A sentence's score ``s`` is linear in its hashed one- and two-word grams and
word stems; its probability is ``1 - exp(-h)`` with

    h = log 2 * (max(0, softplus(s) - FLOOR) / log 2) ** SHARP

and a document's is the noisy-or of its different sentences, ``1 - exp(-sum of h)``.  The same formula is
fitted and scored.  It is 0 for a sentence whose logistic ``p = sigmoid(s)`` is below ``OFFENDING`` and rises steeply after
it, so the many sentences of a long clean text add up to nothing, while one toxic sentence rejects a document of any
length.  A gram that fewer than
``MIN_DOCS`` documents of the sample have weighs nothing.  Only document labels are given: the gradient of the document's log loss reaches each
sentence through the noisy-or (of plain logistics while all sentences are below the floor, where the formula is flat),
and the sentence scores then say where the offence is.

A null or empty text has no sentence and scores 0.  Texts of any length are scored whole.  Equal rows get equal scores;
a score equal to the threshold counts as toxic.  An empty table gives no rows; with no usable label every
sentence has the prior's score, and every document 0.  Rows with a null id are scored, never learnt from.  Columns may have any name
but ``__toxicity`` and ``__toxicity_spans`` in ``drop_toxic``; ``score_toxicity`` replaces a kept column that has a result's name.
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
from .tokens import Tokens, ngram_slots, stem_hashes

THRESHOLD = 0.5   # of a document
OFFENDING = 0.25  # of a sentence reported as offending
MIN_DOCS = 3      # of a shard, that have a gram before it is learnt from
PRIOR = -5.0      # log odds of a sentence with no known gram
FLOOR = -float(np.log1p(-OFFENDING))  # softplus(s) where sigmoid(s) = OFFENDING
SHARP = 4.0       # power of what a sentence has beyond the floor

_END = np.zeros(256, bool)
_END[[ord(c) for c in ".!?\n"]] = True


class Sentences:
    """Sentences of a run of texts: text, byte span and hash slots of each, and whether it is new in its text."""

    def __init__(self, texts: Texts, bits: int):
        tokens = Tokens(texts, lower=True)
        ends = np.cumsum(_END[tokens.data], dtype=np.int64)
        place = ends[tokens.start] - _END[tokens.data[tokens.start]] if len(tokens.start) else np.zeros(0, np.int64)
        new = np.ones(len(place), bool)
        new[1:] = (place[1:] != place[:-1]) | (tokens.text[1:] != tokens.text[:-1])
        number = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(place)) - 1
        self.text = tokens.text[first]
        self.start = tokens.start[first]
        self.end = tokens.end[last] if len(place) else tokens.end
        nth = np.arange(len(number)) - first[number]
        whole = np.add.reduceat(tokens.hash * (2 * nth + 1).astype(np.uint64), first) if len(first) else tokens.hash
        # a sentence that its text has had before is no new evidence
        order = np.lexsort((np.arange(len(first)), whole, self.text))
        self.fresh = np.ones(len(first), bool)
        self.fresh[order[1:]] = (whole[order][1:] != whole[order][:-1]) | (self.text[order][1:] != self.text[order][:-1])
        grams, owner = ngram_slots(tokens.hash, number, 64)
        stems, at = stem_hashes(tokens)
        self.grams = np.concatenate([grams.view(np.uint64), stems])
        self.slots = (self.grams >> np.uint64(64 - bits)).astype(np.int64)
        self.owner = np.concatenate([owner, number[at]])

    def __len__(self) -> int:
        return len(self.text)


def _sigmoid(s: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(s, -30, 30)))


def hazards(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``h`` of sentences with the scores ``s``, and its derivative."""
    s = np.clip(s, -30, 30)
    over = np.maximum(0, np.logaddexp(0, s) - FLOOR) / np.log(2)
    return np.log(2) * over ** SHARP, SHARP * over ** (SHARP - 1) * _sigmoid(s)


def _train(learner: Learner, rows: pd.DataFrame, epochs: int = 1) -> None:
    """Passes over documents; grams of fewer than ``MIN_DOCS`` of them teach nothing general
    (a label could be explained by any word that only its document has)."""
    y, bags = rows["y"].to_numpy(), []
    bits = int(np.log2(len(learner.z) - 1))
    seen = np.zeros(1 << bits, np.int64)
    for texts in text_blocks(pa.array(rows["text"], pa.large_string())):
        found = Sentences(texts, bits)
        owner_text = found.text[found.owner]
        order = np.argsort(owner_text, kind="stable")
        cuts = np.cumsum(np.bincount(owner_text, minlength=len(texts)))[:-1]
        fresh = np.split(found.fresh, np.cumsum(np.bincount(found.text, minlength=len(texts)))[:-1])
        for grams, owner, new in zip(np.split(found.slots[order], cuts), np.split(found.owner[order], cuts), fresh, strict=True):
            at, gram = np.unique(grams, return_inverse=True)
            seen[at] += 1
            bags.append((at, gram, owner - owner.min() if len(owner) else owner, new))
    for i, (at, gram, owner, new) in enumerate(bags):
        common = seen[at] >= MIN_DOCS
        place = np.cumsum(common) - 1
        stay = common[gram]
        bags[i] = np.append(at[common], 1 << bits), place[gram[stay]], owner[stay], new
    rng = np.random.default_rng(len(bags))
    for _ in range(epochs):
        for i in rng.permutation(len(bags)):
            at, gram, owner, new = bags[i]
            if not len(new):
                continue
            w = learner.weights(at)
            s = np.bincount(owner, weights=w[gram], minlength=len(new)) + w[-1] + PRIOR
            h, g = hazards(s)
            if y[i] and (h * new).sum() < 1e-6:  # flat here: the plain noisy-or says which sentences to raise
                h, g = np.logaddexp(0, s), _sigmoid(s)
            g = g * new
            if y[i]:
                g = -g / max(np.expm1(min((h * new).sum(), 50.0)), 1e-12)
            step = np.append(np.bincount(gram, weights=g[owner], minlength=len(at) - 1), g.sum())
            learner.update(at, w, np.clip(step, -2, 2))


def _scores(found: Sentences, weights: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Scores of sentences; a gram that is not ``known`` weighs nothing, whatever its slot's weight."""
    w = weights[found.slots].astype(np.float64)
    heavy = np.flatnonzero(w)
    grams = found.grams[heavy]
    w[heavy[np.append(known, 0)[np.searchsorted(known, grams)] != grams]] = 0
    return np.bincount(found.owner, weights=w, minlength=len(found)) + weights[-1] + PRIOR


def _known(sample: DataFrame, weights: np.ndarray) -> np.ndarray:
    """Sorted hashes of the grams that ``MIN_DOCS`` documents of the sample have, in slots with a weight.

    Bounded by the sample.  Without it the words of a long text in another
    vocabulary would meet learnt slots by chance.
    """
    model = sample.sparkSession.sparkContext.broadcast(weights)
    bits = int(np.log2(len(weights) - 1))

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in text_blocks(batch.column(0)):
                found = Sentences(texts, bits)
                heavy = model.value[found.slots] != 0
                text, gram = found.text[found.owner[heavy]], found.grams[heavy]
                order = np.lexsort((gram, text))
                text, gram = text[order], gram[order]
                new = np.append(True, (text[1:] != text[:-1]) | (gram[1:] != gram[:-1]))[:len(gram)]
                made, n = np.unique(gram[new], return_counts=True)
                yield pa.RecordBatch.from_pydict({"gram": made.view(np.int64), "n": n})

    counted = sample.select("text").mapInArrow(grams, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    rows = counted.where(F.col("n") >= MIN_DOCS).select("gram").collect()
    return np.sort(np.array([r.gram for r in rows], np.int64).view(np.uint64))


def train_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> tuple[np.ndarray, np.ndarray]:
    """Sentence weights fitted from document labels on a bounded sample not held out, and the known grams.

    Rows of a small sample go to several learners, to each in an order of its own: the mean of learners scores
    unseen sentences more evenly than one does.
    """
    sample = labelled_sample(docs, labels, label)
    weights = fit(sample, _train, alpha=1.0, l1=1.0, l2=0.1, even=True)
    return weights, _known(sample, weights)


def score_toxicity(docs: DataFrame, trained: tuple[np.ndarray, np.ndarray], keep: list[str], out: str = "score",
                   below: float | None = None) -> DataFrame:
    """``keep``, the document's probability and its offending sentences.

    ``<out>_spans`` holds ``start:end`` of each offending sentence, in code points,
    comma-joined.  ``below`` keeps only the rows that score less than it.
    """
    model = docs.sparkSession.sparkContext.broadcast(trained)
    bits = int(np.log2(len(trained[0]) - 1))

    def start():
        weights, known = model.value

        def score(texts: Texts) -> list:
            found = Sentences(texts, bits)
            h, _ = hazards(_scores(found, weights, known))
            total = np.bincount(found.text, weights=h * found.fresh, minlength=len(texts))
            at = np.flatnonzero(h > 0)
            spans: list[list[str]] = [[] for _ in range(len(texts))]
            if len(at):
                points = np.cumsum((texts.data & 0xC0) != 0x80)
                before = lambda b: points[b - 1] if b else 0
                for i in at:
                    base = before(texts.offsets[found.text[i]])
                    spans[found.text[i]].append(f"{before(found.start[i]) - base}:{before(found.end[i]) - base}")
            return [-np.expm1(-total), pa.array([",".join(x) for x in spans], pa.string())]
        return score

    where = None if below is None else lambda made: made[0] < below
    fields = [T.StructField(out, T.DoubleType()), T.StructField(f"{out}_spans", T.StringType())]
    return map_texts(docs, "text", keep, fields, start, where)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted, spans`` for every document."""
    scored = score_toxicity(docs, train_toxicity(docs, labels), ["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
                         F.col("score_spans").alias("spans"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score below the threshold, all their columns."""
    keep = list(docs.columns)
    return score_toxicity(docs, train_toxicity(docs, labels), keep, "__toxicity", THRESHOLD).select(*keep)
