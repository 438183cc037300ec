"""Hashes of words and of runs of words, for whole Arrow batches at once.

Words are runs of bytes other than ASCII white space, A-Z lower-cased.  A
hash is a polynomial over the word's bytes modulo 2**64, taken from prefix
sums, so that texts of any length are hashed without a loop over words.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@lru_cache(1)
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_powers: dict[str, np.ndarray] = {}


def _power(base: int, count: int) -> np.ndarray:
    have = _powers.get(str(base))
    if have is None or len(have) < count:
        have = np.full(max(count, 1 << 20), base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        _powers[str(base)] = have
    return have[:count]


class Words:
    """The words of some texts: where they are, which text each is of, and their hashes."""

    def __init__(self, texts: list[str | None]):
        raw = [(t or "").encode() for t in texts]
        lengths = np.array([len(r) + 1 for r in raw], np.int64)
        data = np.frombuffer(b" " + b" ".join(raw).lower() + b" ", np.uint8)
        black = ~_WHITE[data]
        change = np.flatnonzero(black[1:] != black[:-1]) + 1
        self.starts, self.ends = change[::2], change[1::2]
        self.text = np.searchsorted(np.cumsum(lengths), self.starts - 1, side="right")
        #: First word of each text, and the end.
        self.firsts = np.searchsorted(self.text, np.arange(len(raw) + 1))
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_byte_values()[data] * _power(_BASE, len(data)), out=self._sums[1:])
        self._undo = _power(_INVERSE, len(data) + 1)

    def hashes(self, most: int | None = None) -> np.ndarray:
        """Of the whole words, or of their first ``most`` bytes."""
        ends = self.ends if most is None else np.minimum(self.ends, self.starts + most)
        return mix((self._sums[ends] - self._sums[self.starts]) * self._undo[self.starts])

    def shingles(self, size: int) -> list[np.ndarray]:
        """For each text the sorted distinct hashes of its runs of ``size`` words.

        A text of fewer words has one, of all its words; one without words has none.
        """
        words = self.hashes()
        weights = mix(np.arange(1, size + 1, dtype=np.uint64))
        runs = np.zeros(max(len(words) - size + 1, 0), np.uint64)
        for i in range(size):
            runs += mix(words[i : i + len(runs)] + weights[i])* weights[i]
        runs = mix(runs)
        out = []
        for a, b in zip(self.firsts[:-1].tolist(), self.firsts[1:].tolist()):
            if b - a >= size:
                out.append(np.unique(runs[a : b - size + 1]))
            elif b > a:
                own = mix(words[a:b] + weights[: b - a]) * weights[: b - a]
                out.append(mix(own.sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)))
            else:
                out.append(runs[:0])
        return out


def shingle_sets(texts: list[str | None], size: int, limit: int = 1 << 20) -> list[np.ndarray]:
    """``Words(texts).shingles(size)``, about ``limit`` characters at a time."""
    out, start, held = [], 0, 0
    for i, text in enumerate(texts):
        held += len(text or "")
        if held >= limit or i + 1 == len(texts):
            out += Words(texts[start : i + 1]).shingles(size)
            start, held = i + 1, 0
    return out
