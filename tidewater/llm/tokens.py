"""Tokens of many texts at once, as numpy arrays over their UTF-8 bytes."""

from __future__ import annotations

import numpy as np
import xxhash

from .common import Texts

SPACE, WORD, MARK = 0, 1, 2
LONG = 1024  # bytes from which a token is hashed on its own

_CLASS = np.full(256, MARK, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = SPACE
for _lo, _hi in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    _CLASS[_lo:_hi] = WORD
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_LOW_BYTES = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], np.uint64)
_STIR = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, other bytes as they are."""
    return _LOWER[data]


def hash_spans(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each byte span, eight bytes at a time over all spans."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    mul = _STIR[seed & 1]
    h = (lengths.astype(np.uint64) + np.uint64(seed + 1)) * _STIR[1 - (seed & 1)]
    live = np.flatnonzero(lengths <= LONG)
    at, left = starts[live], lengths[live]
    while len(live):
        x = h[live] ^ (words[at] & _LOW_BYTES[np.minimum(left, 8)])
        x = (x ^ (x >> np.uint64(32))) * mul
        h[live] = x ^ (x >> np.uint64(29))
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(lengths > LONG):
        h[i] = xxhash.xxh64_intdigest(data[starts[i]:starts[i] + lengths[i]].tobytes(), seed)
    return h


class Tokens:
    """Word runs (letters, digits, non-ASCII) and mark runs (other bytes) of a run of texts."""

    def __init__(self, texts: Texts, lower: bool):
        data = lower_ascii(texts.data) if lower else texts.data
        kind = _CLASS[data]
        cuts = np.ones(len(data), bool)
        cuts[1:] = kind[1:] != kind[:-1]
        cuts[texts.offsets[:-1][texts.offsets[:-1] < len(data)]] = True
        starts = np.flatnonzero(cuts)
        ends = np.append(starts[1:], len(data))
        real = kind[starts] != SPACE
        self.start, self.end = starts[real], ends[real]
        self.text = np.searchsorted(texts.offsets, self.start, "right") - 1
        self.hash = hash_spans(data, self.start, self.end - self.start)
        self.data = data


def stem_hashes(tokens: Tokens, sizes: tuple[int, ...] = (4, 5)) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the leading bytes of longer words, and the token each is of."""
    made, at = [], []
    length = tokens.end - tokens.start
    for k in sizes:
        i = np.flatnonzero((length > k) & (tokens.data[tokens.start] >= 0x30 if len(length) else False))
        made.append(hash_spans(tokens.data, tokens.start[i], np.full(len(i), k), seed=1))
        at.append(i)
    return np.concatenate(made), np.concatenate(at)


def ngram_slots(hashes: np.ndarray, bag: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash slots of the one- and two-token grams inside each bag, and their bags."""
    pair = (hashes[:-1] * _STIR[0]) ^ (hashes[1:] + _STIR[1])
    pair = ((pair ^ (pair >> np.uint64(31))) * _STIR[1])[bag[1:] == bag[:-1]]
    shift = np.uint64(64 - bits)
    slots = np.concatenate([(hashes * _STIR[0]) >> shift, pair >> shift]).astype(np.int64)
    return slots, np.concatenate([bag, bag[1:][bag[1:] == bag[:-1]]])
