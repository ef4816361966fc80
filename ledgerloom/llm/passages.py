"""Word sequences of a small query set, found in many texts: a vocabulary and codes of word n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np

WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of letters, digits and underscores; none for null."""
    return WORD.findall(text.lower()) if text else []


class Vocabulary(dict):
    """Word to number for the words of the query set; any other word is -1."""

    def __init__(self, sequences: Iterable[list[str]]):
        super().__init__({w: i for i, w in enumerate(sorted({w for s in sequences for w in s}))})

    def __missing__(self, word: str) -> int:
        return -1

    def ids(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def gram_codes(self, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the n-grams made of known words only, and their positions. Holds while size^n is below 2^63."""
        base = len(self) + 1
        if base**n >= 1 << 63:
            raise ValueError("the query set has too many words for n-grams of this length: use smaller blocks")
        count = len(ids) - n + 1
        if count <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        known = ids >= 0
        whole = known[:count].copy()
        for k in range(1, n):
            whole &= known[k : count + k]
        at = np.flatnonzero(whole)
        codes = ids[at].copy()
        for k in range(1, n):
            codes = codes * base + ids[at + k]
        return codes, at


def lookup(ordered: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``codes`` are in the sorted array, and where."""
    if not len(ordered) or not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(ordered, codes), len(ordered) - 1)
    hit = np.flatnonzero(ordered[at] == codes)
    return hit, at[hit]
