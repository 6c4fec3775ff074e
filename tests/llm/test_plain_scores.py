"""Scores of the two classifiers against plain loops over tokens with the fitted weights."""

import math
import re

import pytest

from tidewater.llm import quality, toxicity
from tidewater.llm.ftrl import BITS

SF = "/root/testdata/sf0.001"
FULL, A, B, SHAPE = (1 << 64) - 1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93
TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\x09-\x0d\x20]+")
ODD = [(-1, None), (-2, ""), (-3, " \n\t"), (-4, "one. " * 700 + "Two!? three"), (-5, "Ünï 中文 🙂 12:::::x"), (-6, "word"), (-6, "word")]


def _hash(token, seed=0):
    mul, h = (A, B)[seed], (len(token) + seed + 1) * (B, A)[seed] & FULL
    for k in range(0, len(token), 8):
        x = h ^ int.from_bytes(token[k:k + 8], "little")
        x = (x ^ x >> 32) * mul & FULL
        h = x ^ x >> 29
    return h


def _grams(hashes):
    grams = [h * A & FULL for h in hashes]
    for a, b in zip(hashes, hashes[1:], strict=False):
        p = (a * A & FULL) ^ (b + B & FULL)
        grams.append((p ^ p >> 31) * B & FULL)
    return grams


def _toxicity(text, trained):
    w, known = trained[0], set(trained[1].tolist())
    data = re.sub(rb"[A-Z]", lambda m: m[0].lower(), text.encode())
    bags = {}
    for m in TOKEN.finditer(data):
        bags.setdefault(len(re.findall(rb"[.!?\n]", data[:m.start()])), []).append(m[0])
    lost = 0.0
    for bag in {tuple(b) for b in bags.values()}:
        grams = _grams([_hash(t) for t in bag])
        grams += [_hash(t[:k], 1) for k in (4, 5) for t in bag if len(t) > k and t[0] >= 0x30]
        s = sum(float(w[g >> 64 - BITS]) for g in grams if g in known) + float(w[-1]) + toxicity.PRIOR
        over = math.log1p(math.exp(min(s, 30))) + math.log(0.75)
        lost += math.log(2) * (max(0, over) / math.log(2)) ** 4
    return 1 - math.exp(-lost)


def _quality(text, w):
    kind = lambda c: 3 if 0x30 <= c <= 0x39 else 2 if 0x41 <= c <= 0x5A else 1 if 0x61 <= c <= 0x7A or c >= 0x80 else 0
    tokens = TOKEN.findall(text.encode())
    shapes = [((min(len(t), 15) * 2 + (t in tokens[max(0, i - 2):i])) * 16 + kind(t[0]) * 4 + kind(t[min(1, len(t) - 1)]) + 1) * SHAPE & FULL
              for i, t in enumerate(tokens)]
    slots = [g >> 64 - BITS for g in _grams([_hash(t) for t in tokens]) + _grams(shapes)]
    return 1 / (1 + math.exp(-sum(float(w[i]) for i in slots) / math.sqrt(max(1, len(slots))) - float(w[-1])))


@pytest.mark.parametrize("plain, train, score", [(_toxicity, toxicity.train_toxicity, toxicity.score_toxicity),
                                                 (_quality, quality.train_quality, quality.score_quality)])
def test_scores_equal_plain_loops(spark, plain, train, score):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.select("doc_id", "text").union(spark.createDataFrame(ODD, "doc_id bigint, text string"))
    weights = train(docs, labels)
    out = score(docs, weights, ["doc_id", "text"]).collect()
    assert len(out) == docs.count() and len({round(r.score, 6) for r in out}) > 10
    for r in out:
        assert r.score == pytest.approx(plain(r.text or "", weights), rel=1e-6, abs=1e-9), r.doc_id
