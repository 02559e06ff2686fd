"""Periodic runs of words: maximal pairs of matches, enumerated on the tree of LCP intervals.

A maximal pair is two places of a text at which the same words stand, that differ in the word before and in the
word behind. If they are not farther apart than their match is long, the stretch from the first place to the end of
the second match repeats with that distance and cannot be extended. Its smallest period is that distance exactly if the
match stands nowhere between the two places. So the runs are the maximal pairs of neighbouring places whose
distance meets the length constraints; nothing is extended or compared afterwards.

An LCP interval holds all places of one match. The intervals are built bottom-up over the sorted suffixes; the merging
of their place lists is then undone in reverse, on one linked list in text order, so each place leaves a list
only when it is in a smaller child. A place that leaves is paired with its neighbours if they are in other children
(the words behind differ) and of another class of left words (the words before differ).

A run has a match of at least six words. Suffixes that begin with six words found once in their document are left
out before sorting, by a hash that can only keep too many. The documents of a slice are worked together;
a word's number differs between documents, so no match crosses them.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geomosaic.llm.common import slices

MIN_LENGTH = 12
#: The shortest match of a run: its length less its period, which is half its length at most.
MATCH = MIN_LENGTH // 2

_rng = np.random.default_rng(13)
_FACTORS = _rng.integers(0, 2**63, size=MATCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Numbers(dict):
    """Words numbered as they are first seen."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def _candidates(ids: np.ndarray) -> np.ndarray:
    """Places at which ``MATCH`` words begin that stand elsewhere too, and some more."""
    x = ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    size = len(ids) - MATCH + 1
    hashes = np.zeros(size, dtype=np.uint64)
    for k in range(MATCH):
        hashes += x[k : k + size] * _FACTORS[k]
    in_order = np.sort(hashes)
    again = in_order[1:][in_order[1:] == in_order[:-1]]
    if not len(again):
        return np.empty(0, dtype=np.int64)
    place = np.minimum(np.searchsorted(again, hashes), len(again) - 1)
    return np.flatnonzero(again[place] == hashes)


def _sorted_suffixes(ids: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes that share ``MATCH`` words with a neighbour, sorted, and the words each shares with the next one.

    Prefix doubling. A comparison that is still open stands at most ``MATCH`` words behind a place of
    ``found``, so these places are ranked as well.
    """
    n = len(ids)
    words = np.append(ids, -1 - np.arange(2 * MATCH))  # what follows the end is like nothing else
    near = np.zeros(n + MATCH + 1, dtype=bool)
    for k in range(MATCH + 1):
        near[found + k] = True
    places = np.flatnonzero(near[:n])
    order = np.lexsort([words[places + k] for k in reversed(range(MATCH))])
    columns = [words[places[order] + k] for k in range(MATCH)]
    differs = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    index = np.full(n + 1, -1, dtype=np.int64)
    index[places] = np.arange(len(places))
    ranks, length = [], MATCH
    while True:
        rank = np.empty(len(places), dtype=np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(differs)])
        ranks.append(rank)
        if differs.all():
            break
        behind = index[np.minimum(places + length, n)]
        key = rank * (len(places) + 1) + np.where(behind < 0, len(places), rank[behind])
        order = np.argsort(key, kind="stable")
        differs = key[order][1:] != key[order][:-1]
        length *= 2
    first, second = places[order][:-1], places[order][1:]
    shared = np.zeros(len(first), dtype=np.int64)
    for level in reversed(range(len(ranks))):
        a, b = index[np.minimum(first + shared, n)], index[np.minimum(second + shared, n)]
        same = (a >= 0) & (b >= 0) & (ranks[level][a] == ranks[level][b])
        shared += np.where(same, MATCH << level, 0)
    going = np.ones(len(first), dtype=bool)
    for _ in range(MATCH - 1):
        going &= words[np.minimum(first + shared, n)] == words[np.minimum(second + shared, n + 1)]
        shared += going
    long = np.concatenate([[0], np.where(shared >= MATCH, shared, 0), [0]])
    keep = (long[1:] > 0) | (long[:-1] > 0)
    return places[order][keep], long[1:][keep]


def _intervals(shared: list[int]) -> list[tuple[int, int, int, list[tuple[int, int]]]]:
    """LCP intervals (length, first, last, children) of sorted suffixes, every child before its parent.

    ``shared`` has the words that each suffix shares with the next, 0 at the end of a group. Children are (first, last).
    """
    made, stack = [], []
    for k, words in enumerate(shared):
        first, child = k, (k, k)
        while stack and stack[-1][0] > words:
            length, first, children = stack.pop()
            children.append(child)
            child = (first, k)
            made.append((length, first, k, children))
        if not words:
            continue
        if stack and stack[-1][0] == words:
            stack[-1][2].append(child)
        else:
            stack.append((words, first, [child]))
    return made


def runs_of(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of at least ``MIN_LENGTH`` in a sequence of non-negative numbers, by start, then period."""
    found = _candidates(ids) if len(ids) >= MIN_LENGTH else ()
    if not len(found):
        return (np.empty(0, dtype=np.int64),) * 3
    suffixes, shared = _sorted_suffixes(ids, found)
    left = np.append(-1, ids)[suffixes].tolist()
    place, tree = suffixes.tolist(), _intervals(shared.tolist())
    before, after = [-1] * len(place), [-1] * len(place)

    def chain(first: int, last: int) -> None:
        """One list of these suffixes in text order."""
        members = sorted(range(first, last + 1), key=place.__getitem__)
        for a, b in zip(members, members[1:], strict=False):
            after[a], before[b] = b, a
        before[members[0]] = after[members[-1]] = -1

    runs, heads = [], set()
    for length, first, last, children in reversed(tree):
        if (first, last) not in heads:
            chain(first, last)
        low, high = largest = max(children, key=lambda c: c[1] - c[0])
        heads.add(largest)
        for child in children:
            if child is largest:
                continue
            a, b = child
            for k in range(a, b + 1):
                for x, y in ((before[k], k), (k, after[k])):
                    if x < 0 or y < 0 or (y == k and not low <= x <= high):
                        continue  # a pair of two small children is seen from its first place
                    if a <= x <= b and a <= y <= b or left[x] == left[y]:
                        continue
                    period = place[y] - place[x]
                    if period <= length and period + length >= MIN_LENGTH:
                        runs.append((place[x], period + length, period))
        for child in children:
            if child is not largest:
                for k in range(child[0], child[1] + 1):
                    p, s = before[k], after[k]
                    if p >= 0:
                        after[p] = s
                    if s >= 0:
                        before[s] = p
    runs.sort(key=lambda r: (r[0], r[2]))
    return tuple(np.array(runs, dtype=np.int64).reshape(-1, 3).T)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of each row of ``docs`` (doc_id, text, ...).

    ``runs`` is an array of (start, length, period) by start, then period. ``collapsed`` has the words, joined by one
    space, without those that a run holds behind its first period. Null text counts as empty: no words, no runs, an empty
    text. Rows of one id each give a row; a null id stays null. Other columns are ignored, whatever
    their names. An empty table gives an empty result.
    """

    def work(batches):
        for part, texts in slices(batches, "text"):
            words = [t.split() for t in texts]
            numbers = Numbers()
            ids = [np.fromiter(map(numbers.__getitem__, w), np.int64, len(w)) for w in words]
            firsts = np.cumsum([0] + [len(w) for w in words])
            own = np.concatenate(ids) + np.repeat(np.arange(len(words)), np.diff(firsts)) * max(len(numbers), 1)
            start, length, period = runs_of(own)
            doc = np.searchsorted(firsts, start, side="right") - 1
            edges = np.zeros(len(own) + 1, dtype=np.int64)
            np.add.at(edges, start + period, 1)
            np.add.at(edges, start + length, -1)
            kept = np.cumsum(edges)[:-1] == 0
            for k in np.unique(doc).tolist():
                words[k] = compress(words[k], kept[firsts[k] : firsts[k + 1]].tolist())
            structs = pa.StructArray.from_arrays(
                [pa.array(start - firsts[doc]), pa.array(length), pa.array(period)], fields=list(_RUN)
            )
            ends = np.searchsorted(doc, np.arange(len(words) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(np.diff(firsts)),
                    pa.ListArray.from_arrays(pa.array(ends), structs),
                    pa.array([b" ".join(w) for w in words], pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return slim.mapInArrow(work, schema)
