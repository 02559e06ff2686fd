"""Counting quotient filters over packed n-grams: exact, compact counters that merge like sorted lists.

An n-gram is packed from the ids of its words, ``bits`` bits each, and permuted by rounds that can be undone.
The upper bits of the permuted number, its quotient, name a run; the rest, its remainder, is stored in full. A
filter lists its runs in order and the remainders of a run in order, so a quotient is not stored but follows from the
lengths of the runs before it, equal n-grams meet when two filters are merged, and no two n-grams are ever mixed up.
The permutation spreads n-grams evenly over the quotients, whatever words are common.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ROUNDS = 2
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_FACTORS = np.random.default_rng(12).integers(0, 2**63, size=(ROUNDS, 3), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Counts from here on stand in a list of their own.
_LARGE = 255


@dataclass(frozen=True)
class Shape:
    """``words`` ids of ``bits`` bits each, ``quotient`` bits name the run, of which the first ``spread`` the range; whole bytes."""

    words: int
    bits: int
    quotient: int
    spread: int

    @property
    def mask(self) -> np.uint64:
        return np.uint64((1 << self.bits) - 1)


def _stir(columns: list[np.ndarray], k: int, turn: int) -> np.ndarray:
    x = np.zeros(len(columns[0]), dtype=np.uint64)
    for j, column in enumerate(columns):
        if j != k:
            x = (x ^ column) * _FACTORS[turn, j]
            x = (x ^ (x >> np.uint64(30))) * _MIX[0]
            x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def permuted(columns: list[np.ndarray], shape: Shape) -> list[np.ndarray]:
    """The permuted n-grams, column by column; ``restored`` undoes it."""
    columns = list(columns)
    for turn in range(ROUNDS):
        for k in reversed(range(shape.words)):
            columns[k] = (columns[k] + _stir(columns, k, turn)) & shape.mask
    return columns


def restored(columns: list[np.ndarray], shape: Shape) -> list[np.ndarray]:
    columns = list(columns)
    for turn in reversed(range(ROUNDS)):
        for k in range(shape.words):
            columns[k] = (columns[k] - _stir(columns, k, turn)) & shape.mask
    return columns


@dataclass
class Filter:
    """Distinct permuted n-grams in order, with their counts."""

    columns: list[np.ndarray]
    counts: np.ndarray

    def __len__(self) -> int:
        return len(self.counts)


def filter_of(columns: list[np.ndarray], shape: Shape) -> Filter:
    """The filter of n-grams that are not yet permuted, repeats included."""
    return merged([Filter(permuted(columns, shape), np.ones(len(columns[0]), dtype=np.int64))], shape)


def merged(filters: list[Filter], shape: Shape) -> Filter:
    """One filter with the sums of the counts."""
    columns = [np.concatenate([f.columns[k] for f in filters]) for k in range(shape.words)]
    counts = np.concatenate([f.counts for f in filters])
    if not len(counts):
        return Filter(columns, counts)
    lead = columns[0] << np.uint64(64 - shape.bits)
    if shape.bits < 64:
        behind = 64 - shape.bits
        more = columns[1] >> np.uint64(shape.bits - behind) if behind < shape.bits else columns[1] << np.uint64(behind - shape.bits)
        lead |= more
    order = np.argsort(lead, kind="stable")
    lead = lead[order]
    new = lead[1:] != lead[:-1]
    differs = np.any([(c := column[order])[1:] != c[:-1] for column in columns], axis=0)
    if (differs & ~new).any():  # n-grams that agree in their first 64 bits
        order = np.lexsort(columns[::-1])
        differs = np.any([(c := column[order])[1:] != c[:-1] for column in columns], axis=0)
    starts = np.concatenate([[0], np.flatnonzero(differs) + 1])
    return Filter([column[order][starts] for column in columns], np.add.reduceat(counts[order], starts))


def ranges(held: Filter, shape: Shape) -> list[tuple[int, Filter]]:
    """The parts of a filter that lie in one range of quotients each, with the number of the range."""
    place = held.columns[0] >> np.uint64(shape.bits - shape.spread)
    cuts = np.flatnonzero(place[1:] != place[:-1]) + 1
    bounds = [0, *cuts.tolist(), len(held)] if len(held) else []
    return [
        (int(place[a]), Filter([c[a:b] for c in held.columns], held.counts[a:b]))
        for a, b in zip(bounds, bounds[1:], strict=False)
    ]


def _bytes(column: np.ndarray, size: int) -> np.ndarray:
    return column.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]


def packed(part: Filter, shape: Shape) -> tuple[bytes, bytes, bytes, bytes]:
    """Lengths of the runs of one range, remainders, counts of one byte, and the counts that need more."""
    low = shape.bits - shape.quotient
    inner = (part.columns[0] >> np.uint64(low)) & np.uint64((1 << (shape.quotient - shape.spread)) - 1)
    lengths = np.bincount(inner.astype(np.int64), minlength=1 << (shape.quotient - shape.spread))
    first = part.columns[0] & np.uint64((1 << low) - 1)
    remainders = [_bytes(first, low // 8)] + [_bytes(c, shape.bits // 8) for c in part.columns[1:]]
    large = part.counts >= _LARGE
    return (
        lengths.astype("<u2" if lengths.max() < 1 << 16 else "<u4").tobytes(),
        np.concatenate(remainders, axis=1).tobytes(),
        np.minimum(part.counts, _LARGE).astype(np.uint8).tobytes(),
        part.counts[large].astype("<i8").tobytes(),
    )


def unpacked(place: int, lengths: bytes, remainders: bytes, small: bytes, large: bytes, shape: Shape) -> Filter:
    """The part of range ``place`` that ``packed`` wrote."""
    runs, low = 1 << (shape.quotient - shape.spread), shape.bits - shape.quotient
    sizes = np.frombuffer(lengths, "<u2" if len(lengths) == 2 * runs else "<u4")
    quotients = np.repeat(np.arange(runs, dtype=np.uint64), sizes) | np.uint64(place << (shape.quotient - shape.spread))
    widths = [low // 8] + [shape.bits // 8] * (shape.words - 1)
    table = np.frombuffer(remainders, np.uint8).reshape(len(quotients), sum(widths))
    columns, at = [], 0
    for width in widths:
        wide = np.zeros((len(quotients), 8), dtype=np.uint8)
        wide[:, :width] = table[:, at : at + width]
        columns.append(wide.view("<u8").ravel().astype(np.uint64))
        at += width
    columns[0] |= quotients << np.uint64(low)
    counts = np.frombuffer(small, np.uint8).astype(np.int64)
    counts[counts == _LARGE] = np.frombuffer(large, "<i8")
    return Filter(columns, counts)
