"""A minimal acyclic transducer from words to lists of token ids, as flat arrays in one file.

Words that end alike share states. An edge's output is the number of words that come before those
through it; the outputs along a path add up to the word's place in sorted order, and the place
names its ids. The file is mapped into memory, so the workers of a machine share one copy,
and many words are looked up at once, a byte at a time.
"""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<4q")


def compile_words(words: dict[bytes, list[int]]) -> bytes:
    """The file of non-empty words and their ids."""
    order = sorted(words)
    starts, edges, final = _automaton(order)
    lengths = np.array([len(words[w]) for w in order], np.int64)
    ids = np.array([i for w in order for i in words[w]], np.int64)
    keys = np.array([k for k, _, _ in edges], np.int64)
    targets = np.array([t for _, t, _ in edges], np.int64)
    outputs = np.array([o for _, _, o in edges], np.int64)
    head = _HEAD.pack(starts, len(final), len(order), len(edges))
    parts = (np.array(final, np.int64), keys, targets, outputs, np.append(0, np.cumsum(lengths)), ids)
    return head + b"".join(p.astype("<i8").tobytes() for p in parts)


def _automaton(order: list[bytes]):
    """Start state, sorted edges (state * 256 + byte, target, output) and final flags of the minimal automaton.

    Words come in sorted order, so a state is complete when a word leaves it behind; it
    is then replaced by an equal one if there is any (Daciuk and others, 2000).
    """
    register: dict[tuple, int] = {}
    done: list[tuple[bool, tuple]] = []

    def settle(state: list) -> int:
        sign = (state[0], tuple(state[1]))
        if sign not in register:
            register[sign] = len(done)
            done.append(sign)
        return register[sign]

    def close(path: list, depth: int) -> None:
        while len(path) > depth + 1:
            child = settle(path.pop()[1])
            parent = path[-1][1]
            parent[1][-1] = (parent[1][-1][0], child)

    path: list[tuple[int, list]] = [(-1, [False, []])]
    before = b""
    for word in order:
        common = 0
        while common < min(len(word), len(before)) and word[common] == before[common]:
            common += 1
        close(path, common)
        for byte in word[common:]:
            path[-1][1][1].append((byte, -1))
            path.append((byte, [False, []]))
        path[-1][1][0] = True
        before = word
    close(path, 0)
    start = settle(path[0][1])

    counts = [0] * len(done)
    edges = []
    for state, (is_final, out) in enumerate(done):  # a state is settled after its targets
        below = int(is_final)
        for byte, target in out:
            edges.append((state * 256 + byte, target, below))
            below += counts[target]
        counts[state] = below
    return start, sorted(edges), [is_final for is_final, _ in done]


class Lexicon:
    """A compiled file, mapped into memory."""

    def __init__(self, path: str):
        flat = np.memmap(path, "<i8", "r")
        self.start, n_states, n_words, n_edges = (int(x) for x in flat[:4])
        ends = np.cumsum([4, n_states, n_edges, n_edges, n_edges, n_words + 1])
        parts = [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        self.final, self.keys, self.targets, self.outputs, self.starts = parts
        self.ids = flat[ends[-1] :]

    def places(self, words: list[bytes]) -> np.ndarray:
        """The place of each word, -1 where the lexicon lacks it."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        first = np.cumsum(sizes) - sizes
        place, state = np.zeros(len(words), np.int64), np.full(len(words), self.start)
        live = np.flatnonzero(sizes > 0) if len(self.keys) else np.empty(0, np.int64)
        found = np.full(len(words), -1)
        depth = 0
        while len(live):
            key = state[live] * 256 + flat[first[live] + depth]
            edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[edge] == key
            live, edge = live[hit], edge[hit]
            place[live] += self.outputs[edge]
            state[live] = self.targets[edge]
            depth += 1
            over = sizes[live] == depth
            ended = live[over]
            ended = ended[self.final[state[ended]] == 1]
            found[ended] = place[ended]
            live = live[~over]
        return found

    def ids_of(self, place: int) -> bytes:
        """The ids of the word at a place, as unsigned 32-bit integers."""
        return self.ids[self.starts[place] : self.starts[place + 1]].astype(np.uint32).tobytes()
