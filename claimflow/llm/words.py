"""Vectorised word hashing of text columns inside Arrow tasks.

Words are maximal runs of ``[^\\x20\\x09-\\x0D]``, as bytes of the UTF-8 text.
Each word gets a 64-bit hash of its bytes (a polynomial over random byte
values, mixed at the end), for a whole slice of texts at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE = 1 << 20  # bytes of text hashed at once
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_RNG = np.random.Generator(np.random.PCG64(20240607))
_VALUES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWERED = _VALUES.copy()
_LOWERED[65:91] = _VALUES[97:123]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE, SLICE), _powers(_INVERSE, SLICE)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit (splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words(NamedTuple):
    lo: int                # texts lo..hi of the column
    hi: int
    hashes: np.ndarray     # uint64, one per word, in order
    first: np.ndarray      # hi - lo + 1 word offsets: where each text's words begin
    starts: np.ndarray     # byte offsets of the words in ``data``
    ends: np.ndarray
    data: np.ndarray       # the column's bytes


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), ends


def word_hashes(texts: pa.Array, lower: bool = False) -> Iterator[Words]:
    """Word hashes of a string column, a slice of texts (about 1 MB) at a time.

    A longer text is a slice of its own and is hashed in pieces that are cut
    between words, so that temporary arrays stay small.
    """
    data, offsets = text_bytes(texts)
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + SLICE, "right")) - 1)
        parts = [_hash(data, a, b, offsets[lo:hi + 1], lower)
                 for a, b in _pieces(data, int(offsets[lo]), int(offsets[hi]))]
        if parts:
            hashes, starts, ends = (np.concatenate(x) for x in zip(*parts, strict=True))
        else:
            hashes, starts, ends = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        yield Words(lo, hi, hashes, np.searchsorted(starts, offsets[lo:hi + 1]), starts, ends, data)
        lo = hi


def _pieces(data: np.ndarray, a: int, b: int) -> Iterator[tuple[int, int]]:
    while a < b:
        cut = b
        if b - a > SLICE:
            at = np.flatnonzero(_SPACE[data[a:a + SLICE]])
            if len(at):
                cut = a + int(at[-1]) + 1
            else:  # one word longer than a slice
                step = a + SLICE
                while step < b and not len(at := np.flatnonzero(_SPACE[data[step:min(step + SLICE, b)]])):
                    step += SLICE
                cut = step + int(at[0]) + 1 if step < b else b
        yield a, cut
        a = cut


def _hash(data: np.ndarray, a: int, b: int, offsets: np.ndarray,
          lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    piece = data[a:b]
    inside = ~_SPACE[piece]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > a) & (offsets < b)] - a  # a text's start also starts a word
    begins[cuts] |= inside[cuts]
    ends[cuts - 1] |= inside[cuts - 1]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends)
    up, down = (_UP, _DOWN) if len(piece) <= SLICE else (
        _powers(_BASE, len(piece)), _powers(_INVERSE, len(piece)))
    total = (_LOWERED if lower else _VALUES)[piece]
    total *= up[:len(piece)]
    np.cumsum(total, out=total)
    before = np.where(first > 0, total[first - 1], np.uint64(0))
    hashes = (total[last] - before) * down[first]
    return mix(hashes + (last - first).astype(np.uint64)), first + a, last + 1 + a
