"""64-bit hashes of word shingles for many texts at once, on the UTF-8 bytes.

A word is a longest run of bytes other than ASCII white space, with A-Z in lower
case.  A shingle is ``width`` words in a row; a text with fewer words has the
whole sequence as its only shingle, a text without words has none.
"""

from __future__ import annotations

import numpy as np

_PIECE = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which each output bit depends on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(_PIECE, 1 << max(0, (n - 1).bit_length()))
    if size not in _POWERS:
        made = tuple(np.concatenate(([np.uint64(1)], np.cumprod(np.full(size - 1, b, np.uint64)))) for b in (_BASE, _INVERSE))
        if size > _PIECE:
            return made
        _POWERS[size] = made
    return _POWERS[size]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word in order, and the number of words before each text (one more entry: all)."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    space = _SPACE[data]
    before = np.empty(len(data), bool)
    before[1:] = space[:-1]
    inner = offsets[offsets < len(data)]
    before[0] = True
    before[inner] = True
    starts = np.flatnonzero(before & ~space)
    after = np.empty(len(data), bool)
    after[:-1] = space[1:]
    after[-1] = True
    after[inner[inner > 0] - 1] = True
    ends = np.flatnonzero(after & ~space) + 1
    hashes = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):  # whole words of about one piece at a time
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + _PIECE, "right")))
        origin = starts[first]
        part = _LOWER[data[origin:ends[last - 1]]].astype(np.uint64) + np.uint64(1)
        up, down = _powers(len(part) + 1)
        part *= up[:len(part)]
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(part, out=sums[1:])
        a, b = starts[first:last] - origin, ends[first:last] - origin
        hashes[first:last] = mix((sums[b] - sums[a]) * down[a] + mix((b - a).astype(np.uint64)))
        first = last
    return hashes, np.searchsorted(starts, offsets)


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each shingle in order, repeats included, and the number of shingles before each text."""
    words, at = word_hashes(data, offsets)
    counts = np.diff(at)
    made = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    bounds = np.concatenate(([0], np.cumsum(made)))
    out = np.empty(int(bounds[-1]), np.uint64)
    if len(words) >= width:
        rolled = np.zeros(len(words) - width + 1, np.uint64)
        for j in range(width):
            rolled = rolled * _STEP + words[j:j + len(rolled)]
        long = np.flatnonzero(counts >= width)
        # positions of words that start a whole shingle
        take = np.repeat(at[long] - bounds[long], made[long]) + ranges(bounds[long], made[long])
        out[ranges(bounds[long], made[long])] = mix(rolled[take])
    for n in range(1, width):
        short = np.flatnonzero(counts == n)
        if len(short):
            rolled = np.zeros(len(short), np.uint64)
            for j in range(n):
                rolled = rolled * _STEP + words[at[short] + j]
            out[bounds[short]] = mix(rolled + np.uint64(n))
    return out, bounds


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    return np.arange(total) + np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
