"""Words and shingles of many texts at once, as 64-bit hashes.

A word is a run of bytes other than space and the bytes 9 to 13. Its hash is a
polynomial over a fixed random table of byte values, taken from running sums, so
that the cost is per byte and not per word. Two of n different words or shingles
share a 64-bit hash with a chance of about n*n / 3.7e19.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Odd constants; any would do, but results stay the same only with the same ones.
BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
_TABLE = np.random.default_rng(20_240_917).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse."""
    ascending = np.multiply.accumulate(np.full(n, BASE, dtype=np.uint64))
    inverse = np.multiply.accumulate(np.full(n, pow(BASE, -1, 1 << 64), dtype=np.uint64))
    return ascending, inverse


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text number) of every word. ``data`` has white space after each text."""
    white = WHITE[data]
    edge = np.flatnonzero(white[1:] != white[:-1]) + 1
    if len(data) and not white[0]:
        edge = np.concatenate([[0], edge])
    if len(edge) % 2:
        edge = np.append(edge, len(data))
    starts, ends = edge[0::2], edge[1::2]
    return starts, ends, np.searchsorted(bounds, starts, side="right") - 1


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    # Pieces of usual size share the same powers.
    size = 1 << max(len(data).bit_length(), 20)
    ascending, inverse = _powers(size)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_TABLE[data] * ascending[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def shingles(words: np.ndarray, text: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of every run of ``size`` words; a text with fewer words has one run, all of it."""
    if not len(words):
        return words, text
    first = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
    count = np.diff(np.append(first, len(text)))
    ends_at = np.repeat(first + count, count)
    code = np.zeros(len(words), dtype=np.uint64)
    place = np.arange(len(words))
    for k in range(size):
        inside = place + k < ends_at
        cell = words[np.where(inside, place + k, 0)] * np.uint64((BASE * (2 * k + 3)) & _MASK | 1)
        code += np.where(inside, cell + np.uint64(k + 1), np.uint64(0))
    full = place + size <= ends_at
    # Of a short text, the run that begins at its first word.
    full[first[count < size]] = True
    return mixed(code[full]), text[full]
