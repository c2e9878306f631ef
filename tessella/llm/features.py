"""Hashed sparse features of whole texts, many texts at once.

Each function takes bytes and offsets of texts and returns (text, feature) pairs as arrays, features below ``2**bits``.
"""

from __future__ import annotations

import numpy as np

from tessella.llm import hashing
from tessella.llm.hashing import mix, prefix, spans

BITS = 18

# what a byte looks like: letters by case, digits, letters beyond ASCII, all else as it is
_LOOK = np.arange(256, dtype=np.uint8)
_LOOK[ord("a") : ord("z") + 1] = _LOOK[128:] = ord("a")
_LOOK[ord("A") : ord("Z") + 1] = ord("A")
_LOOK[ord("0") : ord("9") + 1] = ord("0")


class Words(hashing.Words):
    """Words under a polynomial hash: what collides shares a feature, as very many words do anyway."""

    def hashes(self, seed: int = 0) -> np.ndarray:
        return spans(prefix(self.data.astype(np.uint64) + np.uint64(1)), self.start, self.end)


def _feature(hashes: np.ndarray, family: int, bits: int) -> np.ndarray:
    return (mix(hashes + np.uint64(family * 0x51ED270B)) >> np.uint64(64 - bits)).astype(np.int64)


def shapes(words: Words, data: np.ndarray) -> np.ndarray:
    """A hash of each word's look, runs of one kind of character taken as one."""
    look = _LOOK[data]
    new = np.ones(len(look), bool)
    new[1:] = look[1:] != look[:-1]
    new[words.start] = True
    place = np.concatenate([[0], np.cumsum(new)])
    sums = prefix(look[new].astype(np.uint64) + np.uint64(1))
    return spans(sums, place[words.start], place[words.end])


def word_features(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Single words."""
    words = Words(data, offsets)
    return words.owner(), _feature(words.hash, 1, bits)


def stem_features(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Single words, and the first four and five bytes of longer ones."""
    words = Words(data, offsets)
    owner, sums = words.owner(), prefix(data.astype(np.uint64) + np.uint64(1))
    texts, found = [owner], [_feature(words.hash, 1, bits)]
    for size in (4, 5):
        longer = words.end - words.start > size
        texts.append(owner[longer])
        found.append(_feature(spans(sums, words.start[longer], words.start[longer] + size), size, bits))
    return np.concatenate(texts), np.concatenate(found)


def style_features(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Single words, and runs of two and of three word looks, in which a word that repeats the one before
    it is a look of its own."""
    words = Words(data, offsets)
    owner = words.owner()
    if not len(owner):
        return owner, np.zeros(0, np.int64)
    look = shapes(words, data)
    again = np.zeros(len(owner), bool)
    again[1:] = (words.hash[1:] == words.hash[:-1]) & (owner[1:] == owner[:-1])
    look[again] = np.uint64(1)
    texts, found = [owner], [_feature(words.hash, 1, bits)]
    for size in (2, 3):
        same = owner[size - 1 :] == owner[: len(owner) - size + 1]
        sums = prefix(look)
        first = np.flatnonzero(same)
        texts.append(owner[first])
        found.append(_feature(spans(sums, first, first + size), size, bits))
    return np.concatenate(texts), np.concatenate(found)


def distinct(text: np.ndarray, feature: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each (text, feature) once, in order, with the number of times that it occurred."""
    both, count = np.unique((text << bits) | feature, return_counts=True)
    return both >> bits, both & ((1 << bits) - 1), count
