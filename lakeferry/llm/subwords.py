"""Character n-grams of many texts at once, as hashed bucket numbers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that end a word: white space and sentence marks. Symbols inside a word
#: ("st*pid", "id1ot") stay, so that misspellings keep their other n-grams.
_SEPARATORS = b" \t\n\x0b\x0c\r.,;:!?\"'()[]{}|<>"
SEPARATES = np.zeros(256, dtype=bool)
SEPARATES[list(_SEPARATORS)] = True

#: Bytes worked on at once; several arrays of 8 bytes each are held for every one of them.
CHUNK_BYTES = 300_000


def spaced_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased texts in one byte array, a space before and after each; their bounds."""
    edge, space = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
    lowered = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), edge))
    padded = pc.binary_join_element_wise(edge, lowered, edge, space)
    _, offsets, data = padded.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[padded.offset : padded.offset + len(padded) + 1]
    return np.frombuffer(data, dtype=np.uint8)[: bounds[-1]], bounds


def chunks(texts: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``spaced_bytes`` in pieces of whole texts of about ``size`` bytes; only a piece is copied at a time."""
    for piece in sliced(texts, size):
        data, bounds = spaced_bytes(piece)
        yield data[bounds[0] : bounds[-1]], bounds - bounds[0]


def sliced(texts: pa.Array, size: int) -> Iterator[pa.Array]:
    """``texts`` in slices of about ``size`` bytes, a text of more alone.

    Cast before they are cut: Arrow's kernels for ASCII read a slice that is cast
    afterwards from the wrong place.
    """
    texts = texts.cast(pa.large_string())
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield texts.slice(start, stop - start)
        start = stop


def buckets(data: np.ndarray, sizes: tuple[int, ...], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram length: (start positions, bucket numbers).

    An n-gram lies within a word and may take in the separator on either side,
    written as a space, so that beginnings and ends of words differ from middles.
    """
    apart = SEPARATES[data]
    symbols = np.where(apart, np.uint8(32), data).astype(np.uint32)
    passed = np.concatenate([[0], np.cumsum(apart, dtype=np.int32)])
    code = symbols[: max(len(data) - 1, 0)]
    n = 1
    for size in sizes:
        while n < size:
            n += 1
            m = max(len(data) - n + 1, 0)
            code = code[:m] * np.uint32(0x01000193) + symbols[n - 1 : n - 1 + m] + np.uint32(n)
        m = len(code)
        # No separator strictly inside, and not only separators.
        inside = passed[size - 1 : size - 1 + m] - passed[1 : 1 + m]
        at = np.flatnonzero(inside == 0)
        mixed = (code[at] ^ (code[at] >> np.uint32(15))) * np.uint32(0x9E3779B1)
        yield at, (mixed >> np.uint32(32 - bits)).astype(np.int64)
