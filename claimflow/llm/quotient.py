"""Counting quotient filters of packed word-id n-grams, lossless.

An n-gram of word ids is packed into limbs of at most 64 bits, as many whole ids
in each as fit.  A permutation that can be undone spreads the n-grams evenly over
the values of the first limb.  Its highest bits say which shard counts the n-gram,
the next ones are the quotient, and what is left of it, together with the other
limbs, is the remainder, stored in full: so nothing is lost and every counter can
be turned back into its words.  A filter is a sequence of bytes, sorted by
(quotient, remainder): the number of remainders of each quotient in unary (two
bits or so per counter), the remainders in whole bytes and the counters, one byte
each unless they are large.  Filters of one shard are merged by merging their
sorted counters.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

_MULTIPLIERS = tuple(np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_INVERSES = tuple(np.uint64(pow(int(x), -1, 1 << 64)) for x in _MULTIPLIERS)
_SALT = np.uint64(0x9E3779B97F4A7C15)
LARGE = 255      # a counter of one byte that says that the counter is stored whole


class Layout(NamedTuple):
    """How n-grams of ``words`` ids below ``2 ** bits`` are packed."""

    words: int
    bits: int

    @property
    def limbs(self) -> list[int]:
        """Number of ids in each limb."""
        most = max(64 // self.bits, 1)
        return [min(most, self.words - lo) for lo in range(0, self.words, most)]

    @property
    def widths(self) -> list[int]:
        return [n * self.bits for n in self.limbs]


def _mask(width: int) -> np.uint64:
    return np.uint64((1 << width) - 1)


def _stir(x: np.ndarray, width: int) -> np.ndarray:
    """A permutation of the numbers of ``width`` bits."""
    mask, half = _mask(width), np.uint64(width // 2 + 1)
    for m in _MULTIPLIERS:
        if width > 1:
            x = x ^ (x >> half)
        x = (x * m) & mask
    return x ^ (x >> half) if width > 1 else x


def _unstir(x: np.ndarray, width: int) -> np.ndarray:
    # a shift by more than half the width undoes itself
    mask, half = _mask(width), np.uint64(width // 2 + 1)
    if width > 1:
        x = x ^ (x >> half)
    for m in reversed(_INVERSES):
        x = (x * m) & mask
        if width > 1:
            x = x ^ (x >> half)
    return x


def _spread(others: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(others[0]), np.uint64)
    for x in others:
        out = _stir((out ^ x) + _SALT, 64)
    return out


def pack(ids: list[np.ndarray], layout: Layout) -> list[np.ndarray]:
    """The permuted limbs of n-grams, given one array of ids per place."""
    limbs, at = [], 0
    for n in layout.limbs:
        limb = ids[at].astype(np.uint64)
        for k in range(1, n):
            limb = (limb << np.uint64(layout.bits)) | ids[at + k].astype(np.uint64)
        limbs.append(limb)
        at += n
    width = layout.widths[0]
    if len(limbs) > 1:  # the other limbs decide, too, where an n-gram goes
        limbs[0] = limbs[0] ^ (_spread(limbs[1:]) & _mask(width))
    limbs[0] = _stir(limbs[0], width)
    return limbs


def unpack(limbs: list[np.ndarray], layout: Layout) -> list[np.ndarray]:
    """The ids again, one array per place."""
    width = layout.widths[0]
    first = _unstir(limbs[0], width)
    if len(limbs) > 1:
        first = first ^ (_spread(limbs[1:]) & _mask(width))
    out = []
    for limb, n in zip([first, *limbs[1:]], layout.limbs, strict=True):
        out += [(limb >> np.uint64(layout.bits * (n - 1 - k))) & _mask(layout.bits) for k in range(n)]
    return out


def counted(limbs: list[np.ndarray], counts: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted distinct keys and their counts; equal keys are added up.

    Sorts by the first limb, which tells nearly all keys apart; only where it does not
    the others are sorted, too.  Runs that are sorted already are merged.
    """
    n = len(limbs[0])
    if not n:
        return limbs, np.zeros(0, np.int64)
    if len(limbs) == 1 and counts is None:
        keys = np.sort(limbs[0])
        edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return [keys[edge]], np.diff(np.append(edge, n))
    order = np.argsort(limbs[0], kind="stable")
    ordered = [x[order] for x in limbs]
    first = ordered[0]
    new = np.concatenate([[True], first[1:] != first[:-1]])
    differs = np.zeros(n, bool)
    for x in ordered[1:]:
        differs[1:] |= ~new[1:] & (x[1:] != x[:-1])
    if differs.any():
        order = np.lexsort(limbs[::-1])
        ordered = [x[order] for x in limbs]
        new = np.zeros(n, bool)
        new[0] = True
        for x in ordered:
            new[1:] |= x[1:] != x[:-1]
    edge = np.flatnonzero(new)
    sums = np.diff(np.append(edge, n)) if counts is None else np.add.reduceat(counts[order], edge)
    return [x[edge] for x in ordered], sums


def encode(limbs: list[np.ndarray], counts: np.ndarray, layout: Layout, shard_bits: int) -> bytes:
    """The filter of sorted distinct keys of one shard (equal in the highest ``shard_bits`` bits)."""
    n, width = len(counts), layout.widths[0] - shard_bits
    quotient_bits = min(max(n - 1, 1).bit_length(), width, 40)
    rest_bits = width - quotient_bits
    inside = limbs[0] & _mask(width)
    quotients = (inside >> np.uint64(rest_bits)).astype(np.int64) if rest_bits < 64 else np.zeros(n, np.int64)
    unary = np.zeros(n + (1 << quotient_bits), bool)
    unary[quotients + np.arange(n)] = True
    remainders = [inside & _mask(rest_bits), *limbs[1:]]
    small = np.minimum(counts, LARGE).astype(np.uint8)
    parts = [np.array([n, quotient_bits], np.int64).tobytes(), np.packbits(unary).tobytes()]
    for x, bits in zip(remainders, [rest_bits, *layout.widths[1:]], strict=True):
        parts.append(np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(n, 8)[:, :-(-bits // 8)]).tobytes())
    return b"".join([*parts, small.tobytes(), counts[small == LARGE].astype(np.int64).tobytes()])


def decode(blob: bytes, layout: Layout, shard_bits: int, shard: int) -> tuple[list[np.ndarray], np.ndarray]:
    """(keys, counts) of a filter."""
    n, quotient_bits = np.frombuffer(blob, np.int64, 2).tolist()
    width = layout.widths[0] - shard_bits
    rest_bits, at = width - quotient_bits, 16
    size = -(-(n + (1 << quotient_bits)) // 8)
    places = np.flatnonzero(np.unpackbits(np.frombuffer(blob, np.uint8, size, at), count=n + (1 << quotient_bits)))
    at += size
    limbs = []
    for bits in [rest_bits, *layout.widths[1:]]:
        wide = -(-bits // 8)
        bytes_ = np.zeros((n, 8), np.uint8)
        bytes_[:, :wide] = np.frombuffer(blob, np.uint8, n * wide, at).reshape(n, wide)
        limbs.append(bytes_.view("<u8").reshape(n).astype(np.uint64))
        at += n * wide
    quotients = (places - np.arange(n)).astype(np.uint64)
    if rest_bits < 64:
        limbs[0] |= quotients << np.uint64(rest_bits)
    if shard_bits and width < 64:
        limbs[0] |= np.uint64(shard) << np.uint64(width)
    counts = np.frombuffer(blob, np.uint8, n, at).astype(np.int64)
    at += n
    counts[counts == LARGE] = np.frombuffer(blob, np.int64, -1, at)
    return limbs, counts


def merge(filters: list[tuple[list[np.ndarray], np.ndarray]]) -> tuple[list[np.ndarray], np.ndarray]:
    """One sorted set of counters from several."""
    limbs = [np.concatenate(xs) for xs in zip(*(f[0] for f in filters), strict=True)]
    return counted(limbs, np.concatenate([f[1] for f in filters]))
