"""Order-preserving packing of documents into token sequences by dynamic programming.

The documents of a task, in their order, are one stream of tokens. It is cut into windows of at most
``MAX_TOKENS``, at ends of documents (free), at ends of sentences, or, where a sentence is long,
inside it (each at a penalty in tokens), so that padding plus penalties are least. The cost of a
window is linear in its length, so the best start of the window that ends at a cut is the front of a
monotone queue, and every cut enters and leaves the queue once.

Nothing is shuffled. A task holds about ``BLOCK_TOKENS`` at a time: it decides on their windows,
keeps what follows the last sure cut, and goes on. The last window of a task is dealt out in powers of two, which
need no padding, where that costs less than padding it.
"""

from __future__ import annotations

import functools
import os
import re
from collections import deque
from itertools import chain, compress, repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.normalizers import Sequence
from tokenizers.pre_tokenizers import WhitespaceSplit

from geomosaic.llm.bpe_words import BYTE_SIGNS, covered
from geomosaic.llm.common import slices

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
MAX_TOKENS = 4096
BLOCK_TOKENS = 1 << 19
#: What a cut costs, in tokens of padding.
SENTENCE_CUT, INNER_CUT = 24, 96
#: Tokens of a sentence after which it may be cut inside.
STRIDE = 256
#: Distinct words, or pieces of words, that a task remembers before it starts anew.
MOST_WORDS = 400_000

#: Whether a byte is the last letter of a word that ends a sentence.
_STOPS = np.isin(np.arange(256), list(b".!?"))
#: Characters that normalizing only lower-cases, one by one: printable ASCII and composed Latin letters.
_PLAIN = re.compile("[!-~\u00c0-\u012f\u0131-\u017e]+")
_PLAIN_LINE = re.compile("[ -~\u00c0-\u012f\u0131-\u017e]+")
_L = covered(r"\p{L}", 0x180)
#: How the tokenizer cuts plain words in lower case (fixed rule), and the spaces between them.
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[0-9]|[^{_L}0-9 ]+| ")


#: The tokenizer's sign of each byte; a space stays one.
_SIGNS = {b: BYTE_SIGNS[b] for b in range(256)} | {32: " "}
#: How it marks the last token of a piece.
_LAST = "</w>"


class _Table:
    """The ids of each key met so far, one after another in a flat table."""

    def __init__(self):
        self.places: dict = {}
        self.ids, self.ends = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def add(self, keys: list, ids: np.ndarray, sizes: np.ndarray) -> None:
        first = len(self.ends) - 1
        self.places.update(zip(keys, range(first, first + len(keys)), strict=True))
        self.ids = np.concatenate([self.ids, ids])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])

    def find(self, keys: list) -> np.ndarray:
        """The place of each key, -1 of those not met."""
        return np.fromiter(map(self.places.get, keys, repeat(-1)), np.int64, len(keys))

    def spread(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the keys at these places, laid end to end, and how many each has."""
        first = self.ends[places]
        sizes = self.ends[places + 1] - first
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.arange(total) + np.repeat(first - ends + sizes, sizes)], sizes


class Encoder:
    """Ids of a text and the places where its sentences end.

    This tokenizer drops white space and merges nothing across it, so a word is encoded once and then looked up.
    The new words of a slice that are plain letters and signs are cut all at once, by the same rule as the tokenizer's;
    their new pieces are merged by its model, again all at once. The tokenizer itself takes all other words.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.merger = Tokenizer.from_file(path), Tokenizer.from_file(path)
        for one in (self.tokenizer, self.merger):
            one.no_truncation()
            one.no_padding()
        self.merger.normalizer, self.merger.pre_tokenizer = Sequence([]), WhitespaceSplit()
        signs = self.merger.get_vocab()
        self.last = np.zeros(max(signs.values()) + 1, bool)
        self.last[[i for sign, i in signs.items() if sign.endswith(_LAST)]] = True
        self.words, self.pieces, self.stops = _Table(), _Table(), b""

    def __call__(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text, its ids with the end id, and the token counts at which a sentence ends, the last included."""
        if len(self.words.places) > MOST_WORDS:
            self.words, self.stops = _Table(), b""
        if len(self.pieces.places) > MOST_WORDS:
            self.pieces = _Table()
        split = [text.split() for text in texts]
        lengths = np.fromiter(map(len, split), np.int64, len(split))
        words = list(chain.from_iterable(split))
        places = self.words.find(words)
        missing = places < 0
        if missing.any():
            again = list(compress(words, missing.tobytes()))
            self._learn(list(dict.fromkeys(again)))
            places[missing] = self.words.find(again)
        ids, sizes = self.words.spread(places)
        ends = np.cumsum(sizes)
        bounds = np.append(0, ends)[np.append(0, np.cumsum(lengths))]  # of each text in the ids
        totals = np.diff(bounds)
        stops = np.flatnonzero(np.frombuffer(self.stops, bool)[places])
        of = np.repeat(np.arange(len(split)), lengths)[stops]
        at = ends[stops] - bounds[of]
        inner = (at > 0) & (at < totals[of])
        inner[1:] &= (at[1:] != at[:-1]) | (of[1:] != of[:-1])  # a word may have no id
        of, at = of[inner], at[inner]
        held = np.split(at, np.searchsorted(of, np.arange(1, len(split))))
        parts = np.split(ids, bounds[1:-1])
        return [
            (np.append(part, np.uint32(END_ID)), np.append(cuts, total + 1))
            for part, cuts, total in zip(parts, held, totals.tolist(), strict=True)
        ]

    def _learn(self, words: list[bytes]) -> None:
        text, other = b" ".join(words).decode(), []
        if not _PLAIN_LINE.fullmatch(text) or "<|" in text:
            parts = text.split(" ")
            plain = [_PLAIN.fullmatch(part) is not None and "<|" not in part for part in parts]
            text = " ".join(compress(parts, plain))
            other = [w for w, is_plain in zip(words, plain, strict=True) if not is_plain]
            words = list(compress(words, plain))
        if words:
            self.words.add(words, *self._merged(_PIECES.findall(text.lower())))
        if other:
            encoded = self.tokenizer.encode_batch_fast([w.decode() for w in other], add_special_tokens=False)
            ids = [e.ids for e in encoded]
            flat = np.fromiter(chain.from_iterable(ids), np.uint32)
            self.words.add(other, flat, np.fromiter(map(len, ids), np.int64, len(ids)))
        letters = np.frombuffer(b" ".join(chain(words, other)) + b" ", np.uint8)
        self.stops += _STOPS[letters[np.flatnonzero(letters == ord(" ")) - 1]].tobytes()

    def _merged(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words given by their pieces, with a space between words, and how many each word has."""
        known = self.pieces.places
        known.setdefault(" ", -1)
        new = [p for p in dict.fromkeys(pieces) if p not in known]
        if new:
            signs = " ".join(new).encode().decode("latin-1").translate(_SIGNS)
            ids = np.array(self.merger.encode_batch_fast([signs], add_special_tokens=False)[0].ids, np.uint32)
            self.pieces.add(new, ids, np.diff(np.flatnonzero(self.last[ids]), prepend=-1))
        places = self.pieces.find(pieces)
        between = places < 0
        ids, sizes = self.pieces.spread(places[~between])
        word = np.cumsum(between)[~between]
        return ids, np.bincount(word, sizes, minlength=between.sum() + 1).astype(np.int64)


@functools.cache
def encoder(path: str) -> Encoder:
    """The encoder of a file, which a worker makes once; later tasks of it know the words of earlier ones."""
    return Encoder(path)


def with_strides(stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cuts of one document and their penalties: sentence ends, and places inside long sentences."""
    starts = np.append(0, stops[:-1])
    extra = (stops - starts - 1) // STRIDE
    if not extra.any():
        cuts, cost = stops, np.full(len(stops), SENTENCE_CUT)
    else:
        steps = np.arange(int(extra.sum())) - np.repeat(np.cumsum(extra) - extra, extra) + 1
        inner = np.repeat(starts, extra) + steps * STRIDE
        cuts = np.concatenate([stops, inner])
        order = np.argsort(cuts, kind="stable")
        cost = np.concatenate([np.full(len(stops), SENTENCE_CUT), np.full(len(inner), INNER_CUT)])[order]
        cuts = cuts[order]
    cost = cost.copy()
    cost[-1] = 0
    return cuts, cost


def best_cuts(cuts: list[int], costs: list[int], final: bool, size: int = MAX_TOKENS) -> list[int]:
    """Ends of the windows over a stream from 0 with the given rising cuts.

    With ``final`` the last window ends at the last cut; else the windows end where they are cheapest within
    ``size`` of it, and the rest is left for later. Two cuts in a row are never more than ``size`` apart.
    """
    at, best, back = [0, *cuts], [0] * (len(cuts) + 1), [0] * (len(cuts) + 1)
    queue, values = deque([0]), deque([0])  # window starts and their cost plus place, rising
    for j in range(1, len(at)):
        here = at[j]
        while here - at[queue[0]] > size:
            queue.popleft()
            values.popleft()
        best[j] = values[0] - here + size + costs[j - 1]
        back[j] = queue[0]
        value = best[j] + here
        while values and values[-1] >= value:
            queue.pop()
            values.pop()
        queue.append(j)
        values.append(value)
    j = len(at) - 1
    if not final:
        near = [k for k in range(len(at)) if at[k] > at[-1] - size]
        j = min(near, key=lambda k: (best[k], -k)) if near else j
    ends = []
    while j:
        ends.append(at[j])
        j = back[j]
    return ends[::-1]


def powers(length: int) -> list[int]:
    """A length as powers of two, the largest first."""
    return [1 << k for k in reversed(range(length.bit_length())) if length >> k & 1]


class Packer:
    """Turns documents, one after another, into pieces with their place in a sequence."""

    def __init__(self, first_sequence: int):
        self.sequence = first_sequence
        self.docs: list[tuple] = []  # doc_id, ids, cuts, costs, tokens of it that are packed already
        self.held = 0

    def add(self, doc_id, ids: np.ndarray, stops: np.ndarray) -> list[tuple]:
        self.docs.append((doc_id, ids, *with_strides(stops), 0))
        self.held += len(ids)
        return self.flush(final=False) if self.held >= BLOCK_TOKENS else []

    def flush(self, final: bool) -> list[tuple]:
        """Pieces (doc_id, start, length, ids, doc_tokens, sequence_id, offset) of the windows that are sure."""
        if not self.docs:
            return []
        cuts, costs, base = [], [], 0
        for _, ids, own, cost, done in self.docs:
            left = np.searchsorted(own, done, side="right")
            cuts.append(own[left:] - done + base)
            costs.append(cost[left:])
            base += len(ids) - done
        ends = best_cuts(np.concatenate(cuts).tolist(), np.concatenate(costs).tolist(), final)
        if final and (last := ends[-1] - (ends[-2] if len(ends) > 1 else 0)) < MAX_TOKENS:
            parts = powers(last)
            if (len(parts) - 1) * INNER_CUT < MAX_TOKENS - last:
                ends[-1:] = (ends[-1] - last + np.cumsum(parts)).tolist()
        return self._cut(ends)

    def _cut(self, ends: list[int]) -> list[tuple]:
        pieces, docs, base, begin = [], deque(self.docs), 0, 0
        for end in ends:
            offset = 0
            while begin < end:
                doc_id, ids, own, cost, done = docs[0]
                take = min(end, base + len(ids) - done) - begin
                start = done + begin - base
                pieces.append((doc_id, start, take, ids[start : start + take].tobytes(), len(ids), self.sequence, offset))
                offset += take
                begin += take
                if start + take == len(ids):
                    base += len(ids) - done
                    docs.popleft()
            self.sequence += 1
        if docs and begin > base:
            doc_id, ids, own, cost, done = docs[0]
            docs[0] = (doc_id, ids, own, cost, done + begin - base)
        self.docs = list(docs)
        self.held = sum(len(ids) - done for _, ids, _, _, done in self.docs)
        return pieces


_PIECE = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
_NAMES = [c.split()[0] for c in _PIECE.split(", ")]
_TYPES = [pa.binary() if n == "ids" else pa.int64() for n in _NAMES]


def pack(docs: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset) of each piece of ``docs`` (doc_id, text, ...).

    A document is its ids and ``END_ID``; null text counts as empty, so it is that id alone. Pieces of a
    sequence lie one after another in the order of the input; sequences have no order among
    themselves. Repeated rows are packed each, a null id stays null, and other columns are ignored. An empty table
    gives no pieces.
    """

    def run(batches):
        encode, packer = encoder(path), Packer(TaskContext.get().partitionId() << 32)

        def packed(pieces):
            columns = zip(*pieces, strict=True) if pieces else ([] for _ in _NAMES)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], _NAMES)

        for part, texts in slices(batches, "text"):
            pieces = []
            for doc_id, (ids, stops) in zip(part.column(0).to_pylist(), encode(texts), strict=True):
                pieces += packer.add(doc_id, ids, stops)
            yield packed(pieces)
        yield packed(packer.flush(final=True))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _PIECE)
