"""Pre-token boundaries of byte-level BPE for many texts at once, and a table of
the pre-tokens a worker has already encoded.

The boundaries are those of the pattern (fixed value, the public byte-level one)

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

found as array operations over the code points' classes.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import numpy as np
import regex

from .common import Texts
from .tokens import hash_spans

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
CACHE_WORDS = 1_000_000  # pre-tokens a worker remembers before it starts afresh


@functools.cache
def _classes() -> np.ndarray:
    """The class of every code point."""
    table = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, range(0x110000)))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, every):
            table[m.start():m.end()] = kind
    return table


def piece_starts(texts: Texts) -> np.ndarray:
    """Byte offsets at which the pattern's matches begin; each ends where the next begins."""
    data = texts.data
    if not len(data):
        return np.zeros(0, np.int64)
    points = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), "<u4")
    byte_of = np.flatnonzero((data & 0xC0) != 0x80) if len(points) < len(data) else None
    kind = _classes()[points]
    n = len(points)
    opens = np.zeros(n + 3, bool)  # a text begins here; the end counts as one
    at = texts.offsets if byte_of is None else np.searchsorted(byte_of, texts.offsets)
    opens[at] = True
    opens[n:] = True
    begins = opens.copy()
    begins[1:n] |= kind[1:] != kind[:-1]
    # the last space before another run joins it if it is U+0020, else it stands alone
    run = np.flatnonzero(begins[:n] & (kind != SPACE) & ~opens[:n])
    run = run[kind[run - 1] == SPACE]
    begins[run - 1] = True
    begins[run[points[run - 1] == 0x20]] = False
    # contractions: an apostrophe that is a run of its own, then the fixed letters
    quote = np.flatnonzero(begins[:n] & (points == 0x27))
    quote = quote[~opens[quote + 1]]
    quote = quote[kind[quote + 1] == LETTER]
    if len(quote):
        first = points[quote + 1]
        second = np.where(opens[quote + 2], 0, points[np.minimum(quote + 2, n - 1)])
        short = np.isin(first, [ord(c) for c in "stmd"])
        long = np.zeros(len(quote), bool)
        for a, b in ("re", "ve", "ll"):
            long |= (first == ord(a)) & (second == ord(b))
        for found, size in ((quote[short], 2), (quote[long], 3)):
            begins[found + 1] = False
            rest = found[~opens[found + size]] + size
            begins[rest[kind[rest] == LETTER]] = True
    starts = np.flatnonzero(begins[:n])
    return starts if byte_of is None else byte_of[starts]


class WordTable:
    """Token ids of pre-tokens, remembered per worker and filled by ``encode``.

    ``encode(data, starts, lengths)`` returns the ids of the given spans, flat, and
    how many each has.  Pre-tokens are known by two independent 64-bit hashes.
    """

    def __init__(self, encode: Callable):
        self.encode = encode
        self._clear()

    def _clear(self) -> None:
        self.key = self.check = np.zeros(0, np.uint64)
        self.at = self.n = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def ids(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, flat, and where each text's ids begin (one more at the end)."""
        starts = piece_starts(texts)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        lengths = np.diff(np.append(starts, len(texts.data)))
        key, check = (hash_spans(texts.data, starts, lengths, seed) for seed in (0, 1))
        word, first, which = np.unique(key, return_index=True, return_inverse=True)
        while (check[first][which] != check).any():  # two pre-tokens share a hash: mix in the other
            key = key * np.uint64(0x9E3779B97F4A7C15) + check
            word, first, which = np.unique(key, return_index=True, return_inverse=True)
        at, n = self._look_up(texts.data, word, check[first], starts[first], lengths[first])
        at, n = at[which], n[which]
        ends = np.cumsum(n)
        ids = self.flat[np.repeat(at - (ends - n), n) + np.arange(ends[-1])]
        piece = np.searchsorted(starts, texts.offsets)
        return ids, np.concatenate([[0], ends])[piece]

    def _look_up(self, data, word, check, starts, lengths) -> tuple[np.ndarray, np.ndarray]:
        if len(self.key) > CACHE_WORDS:
            self._clear()
        place = np.searchsorted(self.key, word)
        known = np.zeros(len(word), bool)
        inside = place < len(self.key)
        known[inside] = ((self.key[place[inside]] == word[inside])
                         & (self.check[place[inside]] == check[inside]))
        at, n = np.zeros(len(word), np.int64), np.zeros(len(word), np.int64)
        at[known], n[known] = self.at[place[known]], self.n[place[known]]
        new = np.flatnonzero(~known)
        if len(new):
            flat, many = self.encode(data, starts[new], lengths[new])
            n[new] = many
            at[new] = len(self.flat) + np.cumsum(many) - many
            self.flat = np.concatenate([self.flat, flat.astype(np.int32)])
            fresh = new[~(inside[new] & (np.append(self.key, 0)[place[new]] == word[new]))]
            for name, values in (("key", word), ("check", check), ("at", at), ("n", n)):
                setattr(self, name, np.insert(getattr(self, name), place[fresh], values[fresh]))
        return at, n
