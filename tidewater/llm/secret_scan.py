"""Secret scan: fixed patterns, and a battery of randomness tests on long tokens.

A token is a run of at least ``LEAST`` characters of the base64 alphabets.  Its
encoding is the smallest alphabet it fits, and three tests ask whether it looks uniform
in it: chi-squared of the symbol counts, the number of runs above and below the
middle symbol, and the serial correlation of neighbours.  Fisher's method joins the
three p-values.

What prose would score comes from the corpus: a Markov chain over the letter pairs
counted in all documents, written in the alphabet (with a capital in front where it has
both cases; letters it lacks folded onto its symbols), gives the null distribution of the
joined value for each alphabet and length (a normal fit on a log scale, so that rare
secrets can be told from many words).  A token's p-value is the chance that
prose looks at least as random.  Benjamini and Hochberg's rule at ``FDR``, by itself in
each band of lengths since short tokens carry less evidence, decides which tokens are
reported.  Runs of digits alone are no candidates, and a token inside a
pattern's span is not reported again.

Null and empty texts have no span.  Offsets are code points, end exclusive.  Texts of any length
are scanned whole.  Every row is scanned by itself, so repeated rows keep their rows, and each counts in the letter pairs and
in the step-up rule; tokens of equal p-value are reported together or not at all.  An empty table gives no
rows.  Only ``doc_id`` and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, text_blocks
from .tokens import lower_ascii

# fixed values: the base patterns and their least lengths
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 8, 16, 32
KINDS = ("assign", "access", "hex", "random")

KEYS = (b"passw", b"secret", b"token", b"apikey", b"api_key")
LEAST = 16
TOKEN = re.compile(rb"[A-Za-z0-9+/_-]{%d,}" % LEAST)
BANDS = (16, 18, 20, 22, 24, 28, 32, 36, 40, 48, 64, 96, 128, 256, 512)
FDR = 0.05
DRAWS = 1000  # prose strings simulated for each alphabet and band

_DIGIT, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = tuple((name, {ord(c): i for i, c in enumerate(symbols)}) for name, symbols in (
    ("hex", _DIGIT + "abcdef"), ("HEX", _DIGIT + "ABCDEF"), ("lower", _LOWER), ("upper", _UPPER),
    ("base32", _UPPER + "234567"), ("lower36", _DIGIT + _LOWER), ("upper36", _DIGIT + _UPPER),
    ("letters", _UPPER + _LOWER), ("base62", _UPPER + _LOWER + _DIGIT),
    ("base64", _UPPER + _LOWER + _DIGIT + "+/"), ("base64url", _UPPER + _LOWER + _DIGIT + "-_"),
    ("mixed", _UPPER + _LOWER + _DIGIT + "+/-_")))


def encoding(token: bytes) -> int:
    """Number of the first alphabet that has every character; -1 for digits alone."""
    if token.isdigit():
        return -1
    used = set(token)
    return next(i for i, (_, place) in enumerate(ALPHABETS) if used <= place.keys())


def _normal_tail(z: float) -> float:
    return math.erfc(z / math.sqrt(2)) / 2


def randomness(codes: list[int], k: int) -> float:
    """Joined p-value of the three tests that ``codes`` are uniform over ``k`` symbols."""
    n = len(codes)
    counts: dict[int, int] = defaultdict(int)
    for c in codes:
        counts[c] += 1
    x, df = sum(v * v for v in counts.values()) * k / n - n, k - 1
    spread = 2 / (9 * df)
    uniform = _normal_tail(((max(x, 0.0) / df) ** (1 / 3) - (1 - spread)) / math.sqrt(spread))
    high = [2 * c >= k for c in codes]
    a = sum(high)
    b = n - a
    runs = 1 + sum(u != v for u, v in zip(high[:-1], high[1:], strict=True))
    mean = 1 + 2 * a * b / n
    var = (mean - 1) * (mean - 2) / (n - 1)
    alternates = 2 * _normal_tail(abs(runs - mean) / math.sqrt(var)) if var > 0 else 1e-12
    mid = sum(codes) / n
    power = sum((c - mid) ** 2 for c in codes)
    serial = sum((u - mid) * (v - mid) for u, v in zip(codes[:-1], codes[1:], strict=True))
    follows = 2 * _normal_tail(abs(serial / power * n + 1) / math.sqrt(n)) if power else 1e-12
    half = -sum(math.log(max(p, 1e-300)) for p in (uniform, alternates, follows))
    return math.exp(-half) * (1 + half + half * half / 2)


def band(n: int) -> int:
    """The greatest band not above a length."""
    return max(b for b in BANDS if b <= n)


def base_spans(data: bytes, low: bytes) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, float]]]:
    """Spans ``(start, kind, end)`` of the patterns in one text and its candidates
    ``(start, end, alphabet, joined p-value)``."""
    spans, candidates = [], []
    for m in TOKEN.finditer(data):
        token, at = m[0], m.start()
        spans += [(at + x.start(), 1, at + x.end()) for x in ACCESS.finditer(token) if len(x[0]) >= LEAST_ACCESS]
        spans += [(at + x.start(), 2, at + x.end()) for x in HEX.finditer(token) if len(x[0]) >= LEAST_HEX]
        kind = encoding(token)
        if kind >= 0:
            place = ALPHABETS[kind][1]
            candidates.append((at, m.end(), kind, randomness([place[c] for c in token], len(place))))
    ascii_only = data.isascii()
    if not ascii_only and (spans or candidates):  # byte offsets to code points
        raw = np.frombuffer(data, np.uint8)
        before = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)]).tolist()
        spans = [(before[s], k, before[e]) for s, k, e in spans]
        candidates = [(before[s], before[e], k, p) for s, e, k, p in candidates]
    if any(k in low for k in KEYS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(data.decode("utf-8", "surrogatepass"))
                  if len(m[2]) >= LEAST_ASSIGN]
    return sorted(spans), candidates


def _join(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


_SCANNED = ("doc_id bigint, base array<struct<start:int,kind:int,end:int>>, "
            "candidates array<struct<start:int,end:int,alphabet:int,p:double>>, pairs array<bigint>")
_SCANNED_ARROW = pa.schema([
    ("doc_id", pa.int64()),
    ("base", pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))),
    ("candidates", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("alphabet", pa.int32()), ("p", pa.float64())]))),
    ("pairs", pa.list_(pa.int64()))])


def _letter_pairs(low: np.ndarray) -> np.ndarray:
    """Counts of neighbouring letters a-z, 26 x 26."""
    letter = low.astype(np.int64) - 0x61
    letter[(letter < 0) | (letter > 25)] = -1
    both = (letter[:-1] >= 0) & (letter[1:] >= 0)
    return np.bincount(letter[:-1][both] * 26 + letter[1:][both], minlength=676)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per text, and one with the letter pairs of each block of texts."""
    for batch in batches:
        at, ids = 0, batch.column(0).to_pylist()
        for block in text_blocks(batch.column(1)):
            low = lower_ascii(block.data)
            raw, raw_low, cuts = block.data.tobytes(), low.tobytes(), block.offsets.tolist()
            rows = []
            for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                spans, found = base_spans(raw[a:b], raw_low[a:b])
                rows.append({"doc_id": ids[at + i], "pairs": None,
                             "base": [{"start": s, "kind": k, "end": e} for s, k, e in spans],
                             "candidates": [{"start": s, "end": e, "alphabet": k, "p": p} for s, e, k, p in found]})
            rows.append({"doc_id": None, "base": [], "candidates": [], "pairs": _letter_pairs(low).tolist()})
            yield pa.RecordBatch.from_pylist(rows, schema=_SCANNED_ARROW)
            at += len(block)


class Null:
    """How simulated prose scores, for each alphabet and band asked for: mean and spread."""

    def __init__(self, pairs: np.ndarray, strata: list[tuple[int, int]], seed: int = 11):
        follow = pairs.reshape(26, 26).astype(float) + 1
        steps = np.cumsum(follow / follow.sum(axis=1, keepdims=True), axis=1)
        first = np.cumsum(follow.sum(axis=1) / follow.sum())
        self.values = {}
        for alphabet, length in strata:
            place = ALPHABETS[alphabet][1]
            lower = [place.get(ord(c), place.get(ord(c.upper()), i % len(place))) for i, c in enumerate(_LOWER)]
            upper = [place.get(ord(c.upper()), code) for c, code in zip(_LOWER, lower, strict=True)]
            rng = np.random.default_rng([seed, alphabet, length])
            codes = np.zeros((DRAWS, length), np.int64)
            codes[:, 0] = np.searchsorted(first, rng.random(DRAWS)).clip(0, 25)
            for j in range(1, length):
                codes[:, j] = (steps[codes[:, j - 1]] < rng.random((DRAWS, 1))).sum(axis=1).clip(0, 25)
            prose = np.array(lower)[codes]
            prose[:, 0] = np.array(upper)[codes[:, 0]]  # words are seen with a capital where the alphabet has one
            scores = [_score(randomness(c, len(place))) for c in prose.tolist()]
            self.values[alphabet, length] = float(np.mean(scores)), float(np.std(scores)) + 1e-9

    def p_value(self, alphabet: int, length: int, p: float) -> float:
        """Chance that prose looks at least as random, rounded up to a hundredth of a decade."""
        mean, spread = self.values[alphabet, band(length)]
        tail = max(_normal_tail((mean - _score(p)) / spread), 1e-30)
        return 10 ** (math.ceil(math.log10(tail) * 100) / 100)


def _score(p: float) -> float:
    """Evidence against uniformity, on a scale where prose is about normal."""
    return math.log(max(-math.log(max(p, 1e-300)), 1e-3))


def thresholds(found: pd.DataFrame, rate: float = FDR) -> dict[int, float]:
    """Per band of lengths, the greatest p-value that the step-up rule lets through.
    ``found`` has ``band, p, n``: how many tokens of a band have each p-value."""
    limits = {}
    for of, rows in found.groupby("band"):
        rows = rows.sort_values("p")
        passed = rows["p"].to_numpy() <= rate * rows["n"].cumsum().to_numpy() / rows["n"].sum()
        limits[int(of)] = float(rows["p"].to_numpy()[passed].max()) if passed.any() else -1.0
    return limits


def find_secrets(docs: DataFrame, rate: float = FDR) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` of every document."""
    spark = docs.sparkSession
    scanned = cut(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(_scan, _SCANNED), "secrets")
    counts = scanned.where("pairs IS NOT NULL").select(F.posexplode("pairs").alias("at", "n"))
    pairs = np.zeros(676, np.int64)
    for r in counts.groupBy("at").agg(F.sum("n").alias("n")).collect():  # 676 numbers
        pairs[r["at"]] = r["n"]
    rows = scanned.where("pairs IS NULL")
    tokens = rows.select(F.explode("candidates").alias("c")).select(
        "c.alphabet", (F.col("c.end") - F.col("c.start")).alias("length"), "c.p")
    of = F.lit(BANDS[0])
    for b in BANDS[1:]:
        of = F.when(F.col("length") >= b, F.lit(b)).otherwise(of)
    strata = [tuple(r) for r in tokens.select("alphabet", of.alias("band")).distinct().collect()]  # alphabets x bands at most
    null = spark.sparkContext.broadcast(Null(pairs, sorted(strata)))

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, n, p = (batch.column(i).to_pylist() for i in range(3))
            yield pa.RecordBatch.from_arrays(
                [pa.array([band(x) for x in n], pa.int32()),
                 pa.array([null.value.p_value(*x) for x in zip(a, n, p, strict=True)], pa.float64())], names=["band", "p"])

    found = (tokens.mapInArrow(values, "band int, p double").groupBy("band", "p").agg(F.count("*").alias("n"))
             .toPandas())  # at most bands x 3,001 rows
    limits = thresholds(found, rate)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = defaultdict(list)
            for base, candidates in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                spans = [(s["start"], s["kind"], s["end"]) for s in base]
                more = [(c["start"], 3, c["end"]) for c in candidates
                        if null.value.p_value(c["alphabet"], c["end"] - c["start"], c["p"]) <= limits[band(c["end"] - c["start"])]
                        and not any(s <= c["start"] and c["end"] <= e for s, _, e in spans)]
                for kind in range(3):
                    made[kind].append(sum(k == kind for _, k, _ in spans))
                made["sha"].append(hashlib.sha256(_join(spans).encode()).hexdigest())
                made["spans"].append(_join(sorted(spans + more)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(made[k], pa.int64()) for k in range(3)),
                 pa.array(made["sha"], pa.string()), pa.array(made["spans"], pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return rows.select("doc_id", "base", "candidates").mapInArrow(
        finish, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")
