"""Static 3-wise binary fuse filters with 8-bit fingerprints (Graf and Lemire, 2022), in numpy.

A filter is built once from a fixed set of distinct 64-bit keys and never changed. It knows all
of its keys; of other keys it lets one in 256 through.
"""

from __future__ import annotations

import math
import struct

import numpy as np

_HEAD = struct.Struct("<QII")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _shape(n: int) -> tuple[int, int]:
    """Length of a segment, a power of two, and the number of segments that a key can start in."""
    if n < 2:
        return 4, 1
    length = min(1 << 18, 1 << int(math.log(n) / math.log(3.33) + 2.25))
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n))
    return length, max(1, math.ceil(n * factor / length) - 2)


def _slots(keys: np.ndarray, seed: int, length: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The three slots of each key, in three segments in a row, and its fingerprint."""
    h = _mix(keys + np.uint64(seed))
    start = ((h >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
    base, inner = start * np.uint64(length), np.uint64(length - 1)
    other = _mix(h ^ np.uint64(0x9E3779B97F4A7C15))
    places = np.stack(
        [
            base + (other & inner),
            base + np.uint64(length) + ((other >> np.uint64(20)) & inner),
            base + np.uint64(2 * length) + ((other >> np.uint64(40)) & inner),
        ]
    ).astype(np.int64)
    return places, (h ^ (h >> np.uint64(32))).astype(np.uint8)


def build(keys: np.ndarray) -> bytes:
    """The filter of distinct uint64 keys, as bytes."""
    length, segments = _shape(len(keys))
    size = (segments + 2) * length
    for seed in range(1, 1000):
        places, marks = _slots(keys, seed, length, segments)
        rounds = _peel(places, size)
        if rounds is not None:
            break
    else:
        raise ValueError("keys are not distinct")
    table = np.zeros(size, np.uint8)
    for keys_of, slots in reversed(rounds):
        own = table[places[:, keys_of]]
        table[slots] = marks[keys_of] ^ own[0] ^ own[1] ^ own[2] ^ table[slots]
    return _HEAD.pack(seed, length, segments) + table.tobytes()


def _peel(places: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Rounds of keys that each have a slot of their own once the earlier rounds are gone."""
    n = places.shape[1]
    flat, ids = places.ravel(), np.tile(np.arange(n), 3)
    count = np.bincount(flat, minlength=size)
    held = np.zeros(size, np.int64)
    np.add.at(held, flat, ids)
    rounds, left = [], n
    single = np.flatnonzero(count == 1)
    while len(single):
        found, first = np.unique(held[single], return_index=True)
        rounds.append((found, single[first]))
        left -= len(found)
        gone = places[:, found].ravel()
        np.subtract.at(count, gone, 1)
        np.subtract.at(held, gone, np.tile(found, 3))
        near = np.unique(gone)
        single = near[count[near] == 1]
    return rounds if left == 0 else None


def contains(filter_bytes: bytes, keys: np.ndarray) -> np.ndarray:
    """Which uint64 keys may be in the set."""
    seed, length, segments = _HEAD.unpack_from(filter_bytes)
    table = np.frombuffer(filter_bytes, np.uint8, offset=_HEAD.size)
    places, marks = _slots(keys, seed, length, segments)
    found = table[places]
    return (found[0] ^ found[1] ^ found[2]) == marks
