"""Hashes of words and of word sequences, computed for many texts at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd

_ROUND = np.random.default_rng(20260101)
#: Random odd multipliers: a sequence hash is the sum of word hash times multiplier of its place.
PLACES = _ROUND.integers(0, 1 << 63, size=(2, 64), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of a list of texts: all in one row, text ``i`` at ``bounds[i]:bounds[i + 1]``."""

    words: list[bytes]
    bounds: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes]) -> Words:
        """``bytes.split`` parts at exactly the space and the control characters 9 to 13."""
        words: list[bytes] = []
        bounds = [0]
        for text in texts:
            words += text.split()
            bounds.append(len(words))
        return cls(words, np.array(bounds, dtype=np.int64))

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def hashes(self) -> np.ndarray:
        out = np.empty(len(self.words), dtype=object)
        out[:] = self.words
        return pd.util.hash_array(out, categorize=False)

    def owners(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts())


def grams(hashes: np.ndarray, n: int, family: int = 0) -> np.ndarray:
    """Hash of the ``n`` words from each place on (also across texts; see :func:`starts`)."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(size, dtype=np.uint64)
    for i in range(n):
        total += hashes[i : i + size] * PLACES[family][i]
    return mixed(total)


def starts(bounds: np.ndarray, n: int) -> np.ndarray:
    """Whether ``n`` words of one text begin at each place."""
    size = int(bounds[-1]) - n + 1
    if size <= 0:
        return np.empty(0, dtype=bool)
    ends = np.repeat(bounds[1:], np.diff(bounds))[:size]
    return np.arange(size) + n <= ends


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
