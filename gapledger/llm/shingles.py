"""Hashed shingles of words, whole texts at a time.

Words are runs of word characters of the lower-cased text. A text of at least five
words has a shingle at each word that begins five; a shorter one has one shingle of
all its words; one without words has none.
"""

from __future__ import annotations

import re

import numpy as np

from gapledger.llm.workers import BoundedMemo, worker_memo

WORDS = 5
_WORD = re.compile(r"\w+")
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers (the SplitMix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(BoundedMemo):
    def make(self, word: str) -> int:
        import xxhash

        return xxhash.xxh3_64_intdigest(word)


class WordReader:
    """Words and shingles as 64-bit hashes; remembers the hashes of words."""

    def __init__(self) -> None:
        self.hashes = worker_memo("word_hashes", lambda: _WordHashes(400_000))

    def words(self, text: str) -> np.ndarray:
        self.hashes.turn()
        found = _WORD.findall(text.lower())
        return np.fromiter(map(self.hashes.__getitem__, found), np.uint64, len(found))


def shingles(words: np.ndarray, size: int = WORDS) -> np.ndarray:
    """Hash of each run of ``size`` words; of all of them if there are fewer."""
    size = min(size, len(words))
    if not size:
        return np.zeros(0, np.uint64)
    count = len(words) - size + 1
    joined = np.full(count, size, np.uint64)
    for i in range(size):
        joined = joined * _MULTIPLY + words[i : i + count]
    return mix(joined)


def as_set(values: np.ndarray) -> np.ndarray:
    """Sorted hashes of (value, which repeat of it): sets of these compare as multisets do."""
    values = np.sort(values)
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, np.int64)
    counts = np.diff(np.r_[first, len(values)])
    repeat = np.arange(len(values)) - np.repeat(first, counts)
    return np.sort(mix(values + repeat.astype(np.uint64) * _MULTIPLY))


def jaccard(one: np.ndarray, other: np.ndarray) -> float:
    """Weighted Jaccard similarity of two multisets given by ``as_set``; 0 if either is empty."""
    if not len(one) or not len(other):
        return 0.0
    both = np.concatenate([one, other])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return common / (len(both) - common)
