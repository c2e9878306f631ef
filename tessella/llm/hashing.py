"""Words of many texts at once, as arrays: where they are, their 64-bit hashes, and hashes of runs of words.

A word's hash is the mixed sum of one mixed value for each eight bytes and their place, so no algebra of the bytes can make
words collide; a run's hash is built by doubling, each step mixing two halves in order. Both take a seed: two
seeds give independent hashes, 128 bits together. ``prefix`` and ``spans`` are polynomials modulo 2**64, for runs of bytes
that only choose one of few features.
"""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept between calls."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        size = 1 << max(16, int(n).bit_length())
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 1 << 23:
            _powers[int(base)] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a one-to-one map)."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def prefix(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(BASE, len(values)), out=out[1:])
    return out


def spans(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed hashes of the runs ``start`` (inclusive) to ``end`` (exclusive) of what was summed."""
    return mix((sums[end] - sums[start]) * powers(_INVERSE, len(sums))[start])


_MASKS = np.array([0] + [(1 << 8 * k) - 1 for k in range(1, 9)], np.uint64)
_PLACE, _LENGTH, _FIRST = (np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB))


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """A hash of the bytes of each word."""
    if not len(start):
        return np.zeros(0, np.uint64)
    # eight bytes from any place on; beyond the end of the data stand zeros
    wide = np.ndarray((len(data) + 1,), "<u8", np.append(data, np.zeros(8, np.uint8)).tobytes(), 0, (1,))
    number = (end - start + 7) >> 3
    first = np.cumsum(number) - number
    word = np.repeat(np.arange(len(start)), number)
    place = np.arange(len(word)) - first[word]
    at = start[word] + 8 * place
    values = wide[at] & _MASKS[np.minimum(end[word] - at, 8)]
    salt = mix(np.array([seed + 1], np.uint64))
    blocks = mix(mix(values ^ salt) + place.astype(np.uint64) * _PLACE)
    return mix(np.add.reduceat(blocks, first) + (end - start).astype(np.uint64) * _LENGTH)


def run_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` neighbours, in order."""
    if size < 1 or len(hashes) < size:
        return np.zeros(0, np.uint64)
    n, out, taken, level, width = len(hashes) - size + 1, None, 0, mix(hashes ^ _LENGTH), 1
    parts = []  # the runs of 1, 2, 4, ... neighbours that make up ``size``
    while width <= size:
        if size & width:
            parts.append((width, level))
        if 2 * width <= size:
            level = mix(level[:-width] * _FIRST + level[width:])
        width *= 2
    for width, level in reversed(parts):
        piece = level[taken : taken + n]
        out = piece.copy() if out is None else mix(out * _FIRST + piece)
        taken += width
    return mix(out + np.uint64(size * int(_PLACE) % (1 << 64)))


class Words:
    """The words (runs of bytes other than ASCII white space) of texts given as bytes and offsets.

    ``start`` and ``end`` are byte positions, ``bounds[d]:bounds[d + 1]`` are the words of text ``d`` and
    ``hash`` holds one hash per word.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        letters = ~_SPACE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before = np.empty(len(data), bool)
        after = np.empty(len(data), bool)
        if len(data):
            before[0] = after[-1] = False
            before[1:], after[:-1] = letters[:-1], letters[1:]
        self.start = np.flatnonzero(letters & (~before | edge[:-1]))
        self.end = np.flatnonzero(letters & (~after | edge[1:])) + 1
        self.bounds = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.bounds)
        self.data = data
        self.hash = self.hashes()

    def hashes(self, seed: int = 0) -> np.ndarray:
        return word_hashes(self.data, self.start, self.end, seed)

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.count)), self.count)

    def runs(self, size: int, whole_short: bool = False, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, first word, text) of every run of ``size`` words within one text. With ``whole_short`` a text
        of fewer words (but at least one) gives the run of all its words. ``hashes``: those of the words, if others."""
        own = self.hash if hashes is None else hashes
        number = np.maximum(self.count - size + 1, 0)
        short = (self.count > 0) & (self.count < size) if whole_short else np.zeros(len(number), bool)
        number[short] = 1
        text = np.repeat(np.arange(len(number)), number)
        first = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number) + self.bounds[:-1][text]
        whole = ~short[text]
        out = np.zeros(len(text), np.uint64)
        out[whole] = run_hashes(own, size)[first[whole]] if whole.any() else 0
        for k in range(1, size) if short.any() else ():
            at = np.flatnonzero(~whole & (self.count[text] == k))
            if len(at):
                out[at] = run_hashes(own, k)[first[at]]
        return out, first, text
