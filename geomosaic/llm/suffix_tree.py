"""Language-model scores from a probabilistic suffix tree over words.

The tree's alphabet: every word that training has ``MIN_COUNT`` times (the end of a text is such a word),
and for the rarer ones a class per last two bytes. A context is what the last tokens, however many, are
in that alphabet. A context seen ``MIN_COUNT`` times becomes a state if its next-symbol distribution
diverges from that of the next shorter state by more than its parameters are worth (the likelihood
gain over a description-length price). A state's distribution is its counts, smoothed with the next
shorter state's; the longest state that a context ends with gives the probability of the next symbol.
Depths are added until one has no state.
A rare word is a draw from its class: by its discounted count, and what the discount takes goes to
words that training has not seen, thought as many as those seen once. Nothing of a text's own
words beyond the training rows enters its score.

All counts are over all training documents, whose texts are cut to symbols once; they are added up in the tasks and
then by a shuffle, and the divergence test is made where the counts are. Entries seen once are not stored: a context's
total is its count as an entry of the depth before. Least counts are absolute: what is learnt of a phrase does not depend on
how much else there is. Words of ``MIN_COUNT``, and the states that pass the test with their entries, are sent to every
task, so memory grows with them. The counts of rare words are not sent; rare words meet them by a join.
"""

from __future__ import annotations

import itertools
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geomosaic.llm.common import crc_bucket, discard, free_shuffles, sent, slices, staged

FOLDS, HELD_OUT = 7, 2
#: Least count of a symbol or context, and of a context with its next symbol.
MIN_COUNT, MIN_ENTRY = 5, 2
#: Weight of the shorter state's distribution, in counts.
PRIOR = 20.0
END = b"\n"
#: Bits of the map of frequent contexts that tasks look at before they count longer ones.
_MAP_BITS = 1 << 26
START, OTHER = 0, 1
_CACHED = 200_000
#: Tokens that a task counts at a time.
_RUN_TOKENS = 2_000_000


def tokens(text: bytes) -> list[bytes]:
    words = text.lower().split()
    words.append(END)
    return words


def find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each key in a sorted table, and whether it is there."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    place = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return place, table[place] == keys


def mixed(keys: np.ndarray, more: np.ndarray) -> np.ndarray:
    """64-bit hash of each key with one more symbol."""
    x = keys.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + more.astype(np.int64).view(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))).view(np.int64)


def hashes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)).view(np.int64)


@dataclass
class Vocabulary:
    """Words that are symbols of their own, classes of the others, and the counts of head words."""

    symbols: np.ndarray  # hashes, sorted; symbol = 2 + place
    classes: dict[bytes, int]  # last two bytes to symbol
    symbol_counts: np.ndarray  # training tokens of each symbol
    unseen: np.ndarray  # count that stands for an unseen word of each class
    discount: float
    head: np.ndarray  # hashes, sorted
    head_counts: np.ndarray
    size: float  # tokens, distinct tokens and one
    texts: int  # training texts

    @property
    def followed(self) -> np.ndarray:
        """How often each symbol stands before another token: all do but the ends; the start does in each text."""
        counts = self.symbol_counts.astype(np.int64)
        counts[self.describe([END])["symbol"]] -= self.texts
        counts[START] = self.texts
        return counts

    def describe(self, words: list[bytes]) -> dict[str, np.ndarray]:
        """For each word its hash, symbol, base score, and what its class says of it; nan where the count must be joined."""
        hashed = hashes_of(words)
        place, own = find(self.symbols, hashed)
        symbol = np.where(own, place + 2, OTHER)
        for k in np.flatnonzero(~own):
            symbol[k] = self.classes.get(words[k][-2:], OTHER)
        place, known = find(self.head, hashed)
        count = np.where(known, self.head_counts[place] if len(self.head) else 0.0, np.nan)
        within = np.log10(np.maximum(count - self.discount, 1e-9) / np.maximum(self.symbol_counts[symbol], 1))
        return {
            "hash": hashed,
            "symbol": symbol,
            "base": np.log10((count + 1) / self.size),
            "within": np.where(own, 0.0, within),
        }


class Described(dict):
    """What a vocabulary says of the words of a task, remembered up to a number of words."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary, self.columns = vocabulary, {}

    def places(self, words: list[bytes]) -> np.ndarray:
        distinct = set(words)
        new = [w for w in distinct if w not in self]
        if len(self) + len(new) > _CACHED:
            self.clear()
            self.columns = {}
            new = list(distinct)
        if new:
            found = self.vocabulary.describe(new)
            self.update(zip(new, range(len(self), len(self) + len(new)), strict=True))
            self.columns = {k: np.concatenate([self.columns[k], v]) if self.columns else v for k, v in found.items()}
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


@dataclass
class Tree:
    """Root distribution over symbols; per depth the states and their entries, sorted by key.

    The key of a context of one token is its symbol; a longer one's is the hash of the next shorter one's key with its
    oldest symbol. An entry's key is that of the context that its symbol makes with the tokens before it.
    """

    root: np.ndarray
    contexts: list[np.ndarray] = field(default_factory=list)
    weights: list[np.ndarray] = field(default_factory=list)  # of the next shorter state
    entries: list[np.ndarray] = field(default_factory=list)
    shares: list[np.ndarray] = field(default_factory=list)

    def probability(self, symbol: np.ndarray, before: list[np.ndarray]) -> np.ndarray:
        """Of each symbol after the symbols ``before`` it, the last one first."""
        p = self.root[symbol]
        before = before[: len(self.contexts)]
        for depth, (key, whole) in enumerate(zip(context_keys(before), context_keys([symbol, *before])[1:], strict=True)):
            spot, known = find(self.contexts[depth], key)
            at = np.flatnonzero(known)
            entry, seen = find(self.entries[depth], whole[at])
            own = np.where(seen, self.shares[depth][entry], 0.0) if len(self.entries[depth]) else 0.0
            p[at] = own + self.weights[depth][spot[at]] * p[at]
        return p


def context_keys(before: list[np.ndarray]) -> list[np.ndarray]:
    """Keys of the contexts of one, two, ... symbols, from the symbols one, two, ... tokens back."""
    return list(itertools.accumulate(before, mixed))


def histories(symbol: np.ndarray, sizes: np.ndarray, depth: int) -> list[np.ndarray]:
    """For each token of texts of these sizes laid end to end, the symbols one to ``depth`` tokens before it."""
    place = _place(sizes)
    padded = np.concatenate([np.full(depth, START), symbol])
    return [np.where(place >= k, padded[depth - k : depth - k + len(symbol)], START) for k in range(1, depth + 1)]


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, ending, n) of every distinct token: its 64-bit hash, last two bytes and count."""

    def run(batches):
        counts: Counter = Counter()

        def counted():
            words = list(counts)
            columns = [pa.array(hashes_of(words)), pa.array([w[-2:] for w in words], pa.binary()), pa.array(counts.values(), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["word", "ending", "n"])

        for _, texts in slices(batches, "text"):
            for text in texts:
                counts.update(tokens(text))
            if len(counts) > _CACHED:
                yield counted()
                counts.clear()
        yield counted()

    parts = docs.select("text").mapInArrow(run, "word long, ending binary, n long")
    return parts.groupBy("word", "ending").agg(F.sum("n").alias("n"))


def vocabulary(words: DataFrame) -> Vocabulary:
    """From (word, ending, n) rows. Words of the least count and at most 65,536 endings come to the driver."""
    ends = F.when(F.col("word") == int(hashes_of([END])[0]), F.col("n"))
    total, distinct, texts = words.agg(*(F.coalesce(c, F.lit(0)) for c in (F.sum("n"), F.count("*"), F.sum(ends)))).first()
    head_words, head_counts = _arrays(words.where(F.col("n") >= MIN_COUNT).select("word", F.col("n").cast("double")))
    rare = words.where(F.col("n") < MIN_COUNT)
    once, twice = F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice")
    found = rare.groupBy("ending").agg(F.sum("n").alias("n"), F.count("*").alias("types"), once, twice).toPandas()
    first, second = found["once"].sum(), found["twice"].sum()
    discount = float(min(0.9, max(0.1, first / max(1, first + 2 * second))))
    named = found[found["n"] >= MIN_COUNT]
    others = found[found["n"] < MIN_COUNT]
    own = np.zeros(len(head_words))
    counts = np.concatenate([[0, others["n"].sum()], head_counts, named["n"]]).astype(float)
    kept_back = discount * np.concatenate([[0, others["types"].sum()], own, named["types"]])
    singles = np.concatenate([[0, others["once"].sum()], own, named["once"]])
    unseen = np.maximum(kept_back, 0.1) / np.maximum(singles, 1)
    numbers = {bytes(e): 2 + len(head_words) + k for k, e in enumerate(named["ending"])}
    return Vocabulary(
        head_words, numbers, counts, unseen.astype(float), discount, head_words, head_counts, float(total + distinct + 1), texts
    )


def symbols_of(docs: DataFrame, words: Broadcast) -> DataFrame:
    """(symbols, cut) of each row of ``docs``: the symbols of its tokens, as 32-bit integers, and that they are a whole text."""

    def run(batches):
        described = Described(words.value)
        for _, texts in slices(batches, "text"):
            found = [tokens(t) for t in texts]
            place = described.places([w for f in found for w in f])
            symbol = described.columns["symbol"][place].astype(np.int32)
            ends = np.cumsum([0, *map(len, found)], dtype=np.int32) * np.int32(4)
            made = pa.Array.from_buffers(pa.binary(), len(found), [None, pa.py_buffer(ends), pa.py_buffer(symbol)])
            yield pa.RecordBatch.from_arrays([made, pa.array(np.zeros(len(found), bool))], ["symbols", "cut"])

    return docs.select("text").mapInArrow(run, _SYMBOLS)


def _pairs(symbols: DataFrame, words: Broadcast, tree: Broadcast) -> DataFrame:
    """(key, context, total, n, shorter) of each symbol with the one before it, seen ``MIN_ENTRY`` times.

    Only the two symbols and their count are shuffled; what follows from them is added to the entries that stay.
    """

    def count(batches):
        for symbol, sizes, _ in _runs(batches):
            (before,) = histories(symbol, sizes, 1)
            pair, n = np.unique(before.astype(np.int64) << 32 | symbol, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], ["pair", "n"])

    def describe(batches):
        followed, root = words.value.followed, tree.value.root
        for batch in batches:
            pair = batch.column(0).to_numpy()
            context, symbol = pair >> 32, pair & 0xFFFFFFFF
            columns = [mixed(symbol, context), context, followed[context], batch.column(1), root[symbol]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "context", "total", "n", "shorter"])

    rows = symbols.mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    often = rows.where(F.col("n") >= MIN_ENTRY)
    return often.mapInArrow(describe, "key long, context long, total long, n long, shorter double")


def _entries(symbols: DataFrame, tree: Broadcast, depth: int, before: DataFrame, maps: Broadcast) -> DataFrame:
    """(key, context, total, n, shorter): contexts of a depth from 2 on with the next symbol, seen ``MIN_ENTRY`` times.

    ``before`` holds the entries of the depth before. A context of the least count is one of them, which gives its
    total, and without its oldest symbol an entry must be one of them too. Tasks look at ``maps`` of both, which miss none.
    """

    def run(batches):
        frequent, repeated = maps.value
        for symbol, sizes, cut in _runs(batches):
            at, key = repeating(symbol, sizes, cut, depth, repeated)
            # the oldest symbol of an entry lies in its part
            inside = _place(sizes)[at] >= np.repeat(np.where(cut, depth, 1), sizes)[at]
            at, key, context = followed(symbol, sizes, at[inside], key[inside], depth, frequent)
            order = np.argsort(key)
            key = key[order]
            starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
            at, context, n = at[order[starts]], context[order[starts]], np.diff(np.append(starts, len(key)))
            before = [back(symbol, _place(sizes)[at], at, k) for k in range(1, depth)]
            columns = [key[starts], context, n, tree.value.probability(symbol[at], before)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "context", "n", "shorter"])

    rows = symbols.mapInArrow(run, "key long, context long, n long, shorter double").groupBy("key").agg(
        F.max("context").alias("context"), F.sum("n").alias("n"), F.max("shorter").alias("shorter")
    )
    totals = before.where(F.col("n") >= MIN_COUNT).select(F.col("key").alias("context"), F.col("n").alias("total"))
    return rows.where(F.col("n") >= MIN_ENTRY).join(totals, "context").select("key", "context", "total", "n", "shorter")


def repeating(
    symbol: np.ndarray, sizes: np.ndarray, cut: np.ndarray, depth: int, repeated: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Places of the tokens that may end an entry of a depth, with their keys of the depth before, which repeat."""
    place = _place(sizes)
    # no text starts where a part is cut off
    at = np.flatnonzero(place >= np.repeat(np.where(cut, depth - 1, 1), sizes))
    place, key = place[at], symbol[at]
    for k in range(1, depth):
        key = mixed(key, back(symbol, place, at, k))
    kept = is_mapped(repeated, key)
    return at[kept], key[kept]


def followed(
    symbol: np.ndarray, sizes: np.ndarray, at: np.ndarray, key: np.ndarray, depth: int, frequent: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Those of ``repeating`` after a frequent context, with the keys of entry and context."""
    place = _place(sizes)[at]
    # a context is an entry of the depth before, of the token before
    context = symbol[at - 1]
    for k in range(2, depth + 1):
        context = mixed(context, back(symbol, place, at, k))
    kept = is_mapped(frequent, context)
    at, place, key, context = at[kept], place[kept], key[kept], context[kept]
    return at, mixed(key, back(symbol, place, at, depth)), context


def parts_of(symbols: DataFrame, depth: int, repeated: Broadcast) -> DataFrame:
    """The parts of the texts of ``symbols`` that longer entries than those of a depth may lie in.

    A longer entry repeats only where an entry of the depth ends at each of two tokens in a row or more. Such stretches
    are kept, with the ``depth`` symbols before them.
    """

    def run(batches):
        for symbol, sizes, cut in _runs(batches):
            alive = np.zeros(len(symbol) + 2, np.int8)
            at, _ = repeating(symbol, sizes, cut, depth + 1, repeated.value)
            alive[at + 1] = 1
            edges = np.diff(alive)
            first, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
            first, end = first[end - first > 1], end[end - first > 1]
            place, small = _place(sizes)[first], symbol.astype(np.int32)
            begin, now_cut = first - np.minimum(place, depth), (place > depth) | np.repeat(cut, sizes)[first]
            made = pa.array([small[a:b].tobytes() for a, b in zip(begin.tolist(), end.tolist(), strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([made, pa.array(now_cut)], ["symbols", "cut"])

    return symbols.mapInArrow(run, _SYMBOLS)


def back(symbol: np.ndarray, place: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The symbols ``k`` tokens before those ``at`` some places, which have the place ``place`` in their text."""
    return np.where(place >= k, symbol[np.maximum(at - k, 0)], START)


def _place(sizes: np.ndarray) -> np.ndarray:
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _runs(batches):
    """The texts of (symbols, cut) batches, some ``_RUN_TOKENS`` at a time: symbols end to end, how many each has, and ``cut``."""
    held, cut, size = [], [], 0
    for part, texts in slices(batches, "symbols"):
        held += texts
        cut += part.column(1).to_pylist()
        size += sum(map(len, texts)) // 4
        if size >= _RUN_TOKENS:
            yield *_laid(held), np.array(cut, bool)
            held, cut, size = [], [], 0
    if held:
        yield *_laid(held), np.array(cut, bool)


def _laid(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.int32).astype(np.int64), np.fromiter(map(len, texts), np.int64, len(texts)) // 4


def grow(docs: DataFrame, words: Vocabulary) -> Tree:
    """The tree of the texts of ``docs``, a depth at a time until no context of a depth is a state."""
    size = words.symbol_counts.sum()
    tree = Tree((words.symbol_counts + 0.5) / (size + 0.5 * len(words.symbol_counts)))
    with sent(docs, words) as known_words, sent(docs, tree) as known:
        symbols = staged(symbols_of(docs, known_words), "symbols")
        rows = staged(_pairs(symbols, known_words, known), "entries")
    n = F.col("n")
    for depth in itertools.count(1):
        if depth > 1:
            repeated = key_map(rows)
            # after the depths 2, 4, 8, ... the texts are cut to what longer entries may lie in
            if depth > 2 and (depth - 1) & (depth - 2) == 0:
                with sent(docs, repeated) as known:
                    parts = staged(parts_of(symbols, depth - 1, known), "symbols")
                discard(symbols)
                symbols = parts
            with sent(docs, tree) as known, sent(docs, (key_map(rows.where(n >= MIN_COUNT)), repeated)) as maps:
                found = staged(_entries(symbols, known, depth, rows, maps), "entries")
            discard(rows)
            rows = found
        contexts = rows.groupBy("context").agg(
            F.max("total").alias("total"),
            F.sum("n").alias("held"),
            F.count("*").alias("parts"),
            F.sum(n * F.log(n / F.col("shorter"))).alias("cross"),
        )
        # the gain: of each entry, n ln(n / total / shorter)
        gain = F.col("cross") - F.col("held") * F.log(F.col("total"))
        passing = contexts.where((F.col("total") >= MIN_COUNT) & (gain > F.col("parts") * float(0.5 * np.log(max(size, 2)))))
        states = staged(passing.select("context", "total", "held"), "states")
        free_shuffles(states)
        context, whole, held = _arrays(states)
        if not len(context):
            discard(rows)
            discard(symbols)
            return tree
        kept = rows.join(states.select("context"), "context")
        kept = kept.select("key", (n / (F.col("total") + PRIOR)).alias("share"))
        tree.contexts.append(context)
        tree.weights.append((whole - held + PRIOR) / (whole + PRIOR))
        for part, column in zip((tree.entries, tree.shares), _arrays(kept), strict=True):
            part.append(column)


def _arrays(rows: DataFrame) -> list[np.ndarray]:
    """The columns of ``rows``, sorted by the first; as Arrow batches, so that no row becomes a Python object."""
    columns = [c.to_numpy() for c in rows.toArrow().columns]
    order = np.argsort(columns[0])
    return [c[order] for c in columns]


def key_map(rows: DataFrame) -> np.ndarray:
    """A bit per remainder of the keys of ``rows``: no key is missed, and the map's size is fixed."""
    bit = F.pmod("key", F.lit(_MAP_BITS)) + 1  # Spark's buckets are 1 to 32,768 and so on
    parts = rows.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
    made = np.zeros((_MAP_BITS >> 15, 4096), np.uint8)
    for bucket, bits in parts.agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit"))).collect():
        made[bucket - 1] = np.frombuffer(bits, np.uint8)
    return made.ravel()


def is_mapped(made: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bit = keys % _MAP_BITS
    return made[bit >> 3] >> (bit & 7).astype(np.uint8) & 1 == 1


def scores(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row of ``docs`` (doc_id, text, ...).

    Learns from the rows whose crc32(doc_id) mod 7 is not 2. Null text counts as empty: its one token is the
    end. Repeated rows are learned from and scored each; a null id has crc32 0. Other columns are ignored.
    """
    held_out = crc_bucket("doc_id", FOLDS) == HELD_OUT
    training = docs.where(~held_out)
    counted = staged(word_counts(training), "words")
    words = vocabulary(counted)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    with sent(docs, words) as known_words, sent(docs, grow(training, words)) as known:
        scored = staged(slim.mapInArrow(_scorer(known_words, known), _SCORED), "scored")
    rare = scored.select("row", F.inline(F.arrays_zip("rare", "unseen"))).withColumnRenamed("rare", "word")
    rare = rare.groupBy("row", "word", "unseen").agg(F.count("*").alias("times"))
    count = F.coalesce("n", F.lit(0))
    within = F.log10(F.when(count > 0, count - words.discount).otherwise(F.col("unseen")))
    rare = rare.join(counted.select("word", "n"), "word", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10((count + 1) / F.lit(words.size))).alias("more_base"),
        F.sum(F.col("times") * within).alias("more"),
        F.sum(F.when(count > 0, F.col("times")).otherwise(0)).alias("seen"),
    )
    zero = F.lit(0.0)
    return scored.join(rare, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("head_known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
        F.lit(int(words.symbol_counts.sum())).cast("long").alias("train_tokens"),
        (F.col("head_base") + F.coalesce("more_base", zero)).alias("base_score"),
        (F.col("head_score") + F.coalesce("more", zero)).alias("score"),
    )


def _scorer(known_words: Broadcast, known: Broadcast):
    """What a task does with the documents: their scores, and the rare words that are still to be counted."""

    def run(batches):
        words, tree = known_words.value, known.value
        first, described = TaskContext.get().partitionId() << 40, Described(words)
        for part, texts in slices(batches, "text"):
            found = [tokens(t) for t in texts]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            place = described.places([w for f in found for w in f])
            of = np.repeat(np.arange(len(found)), sizes)
            hashed, symbol, base, within = (described.columns[c][place] for c in ("hash", "symbol", "base", "within"))
            score = np.log10(tree.probability(symbol, histories(symbol, sizes, len(tree.contexts))))
            rare = np.isnan(base)
            score = score + np.where(rare, -np.log10(np.maximum(words.symbol_counts[symbol], 1)), within)
            ends = np.append(0, np.cumsum(np.bincount(of[rare], minlength=len(found)))).astype(np.int32)
            columns = [
                pa.array(np.arange(first, first + len(found))),
                part.column(0),
                part.column(1),
                pa.array(sizes),
                pa.array(np.bincount(of, score, minlength=len(found))),
                pa.array(np.bincount(of, np.where(rare, 0.0, base), minlength=len(found))),
                pa.array(sizes - np.diff(ends)),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(hashed[rare])),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(words.unseen[symbol[rare]])),
            ]
            first += len(found)
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _SCORED.split(", ")])

    return run


_SYMBOLS = "symbols binary, cut boolean"
_SCORED = (
    "row long, doc_id long, held_out boolean, n_tokens long, head_score double, head_base double, head_known long, "
    "rare array<long>, unseen array<double>"
)
