"""Prefix polynomial hashes of many texts at once.

With a code point c at place j counted as (c + 1) * BASE**j, the sums over all
prefixes, modulo a prime, answer for any span what its hash is: the difference of two
sums, divided by the power where the span begins. Equal spans have equal hashes
wherever they stand; two different ones agree under both bases with a chance of about
length**2 / 2**62. Since a span can be equal only if its beginnings are, the longest
common extension of two places is found by binary search over the length.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from lakeferry.llm.words import mixed

PRIME = np.uint64(2**31 - 1)
_SHIFT = np.uint64(31)
#: Any numbers below the prime would do; fingerprints agree only with the same ones.
BASES = (1_147_483_647 // 3, 1_833_764_059)


def _modulo(x: np.ndarray) -> np.ndarray:
    """x modulo 2**31 - 1, for x below 2**63."""
    x = (x & PRIME) + (x >> _SHIFT)
    x = (x & PRIME) + (x >> _SHIFT)
    return np.where(x >= PRIME, x - PRIME, x)


@lru_cache(maxsize=2)
def _powers(base: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of ``base`` and of its inverse from 0 to 2**bits, 32 bits each."""
    out = []
    for x in (base, pow(base, -1, int(PRIME))):
        powers = np.ones(1, dtype=np.uint64)
        while len(powers) <= 1 << bits:
            powers = np.concatenate([powers, _modulo(powers * np.uint64(pow(x, len(powers), int(PRIME))))])
        out.append(powers.astype(np.uint32))
    return tuple(out)


class PrefixHashes:
    """Prefix sums of some texts, one after the other; ``first`` and ``last`` bound each."""

    def __init__(self, texts: list[str]):
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        self.last = np.cumsum(lengths)
        self.first = self.last - lengths
        self.lengths = lengths
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        # At least 19 bits, so that pieces of usual size share the same powers.
        bits = max(19, len(points).bit_length())
        self.sums, self.inverse = [], []
        for base in BASES:
            ascending, inverse = _powers(base, bits)
            sums = np.zeros(len(points) + 1, dtype=np.uint32)
            terms = _modulo((points + np.uint64(1)) * ascending[: len(points)])
            sums[1:] = _modulo(np.cumsum(terms, dtype=np.uint64))
            self.sums.append(sums)
            self.inverse.append(inverse)

    def spans(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """62-bit hashes of the spans [start, stop) of the joint texts."""
        out = np.zeros(len(start), dtype=np.uint64)
        for sums, inverse in zip(self.sums, self.inverse):
            between = sums[stop].astype(np.uint64) + PRIME - sums[start]
            out = (out << _SHIFT) | _modulo(_modulo(between) * inverse[start].astype(np.uint64))
        return out

    def runs(self, size: int) -> np.ndarray:
        """62-bit hashes of the spans of ``size`` at every place of the joint texts."""
        n = max(len(self.sums[0]) - size, 0)
        out = np.zeros(n, dtype=np.uint64)
        for sums, inverse in zip(self.sums, self.inverse):
            between = sums[size : size + n].astype(np.uint64) + PRIME - sums[:n]
            out = (out << _SHIFT) | _modulo(_modulo(between) * inverse[:n])
        return out


def common_start(a: PrefixHashes, at: np.ndarray, b: PrefixHashes, bt: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Lengths of the longest spans, ``most`` at most, that are equal in ``a`` from ``at`` on and in ``b`` from ``bt`` on."""
    return _longest(most, lambda n: a.spans(at, at + n) == b.spans(bt, bt + n))


def common_end(a: PrefixHashes, at: np.ndarray, b: PrefixHashes, bt: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Lengths of the longest equal spans that end before ``at`` in ``a`` and before ``bt`` in ``b``."""
    return _longest(most, lambda n: a.spans(at - n, at) == b.spans(bt - n, bt))


def _longest(most: np.ndarray, equal) -> np.ndarray:
    """Binary search of the greatest length that is equal, for all rows at once."""
    low, high = np.zeros(len(most), dtype=np.int64), most.astype(np.int64)
    while (low < high).any():
        middle = (low + high + 1) // 2
        same = equal(middle)
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    return low


def short(hashes: np.ndarray) -> np.ndarray:
    """32 bits of 62-bit hashes."""
    return (mixed(hashes) >> np.uint64(32)).astype(np.uint32)
