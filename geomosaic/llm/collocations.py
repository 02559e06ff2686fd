"""Phrases whose words keep together, from exact counts of words and n-grams in counting quotient filters.

Words are counted per language first. A word of a phrase that is found ``LEAST`` times is found as often itself, and so
is each part of the phrase, so only n-grams of such words, and only trigrams of two such bigrams, are counted.
Tasks know them by a bitmap of fixed size that misses none and lets a few others through.

The id of a word is the first ``bits`` bits of a 64-bit hash of language and word. It is as good as a
dictionary's, since all words that the bitmap lets through are checked to have ids of their own, under another salt or
with more bits if need be; yet no dictionary is sent anywhere. Each task fills a filter with the n-grams it
sees, and sends it off cut at fixed quotients. The filters of one range meet in one task and are merged there; n-grams
that are found too rarely go, the others get their ids back.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass
from itertools import count
from math import ceil, log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geomosaic.llm import quotient_filter as qf
from geomosaic.llm.common import slices, staged
from geomosaic.llm.suffix_tree import _MAP_BITS, is_mapped, key_map, mixed

LEAST = 10
PERCENT = 50
TOP = 2000
NO_LANG = "und"
#: Distinct words that a task counts before it sends the counts off.
COUNTED_WORDS = 150_000
#: N-grams that are sorted at once, entries that a task's filter takes, and entries meant for one range.
BATCH, ENTRIES, RANGE = 1 << 18, 1 << 20, 1 << 20
WIDTHS = (32, 40, 48, 56, 64)
#: Languages whose words a task remembers at a time, and words of each.
LANGUAGES, CACHE_WORDS = 8, 50_000

_BREAK = np.zeros(1, dtype=np.uint64)
_SENT = ["range", "lengths", "remainders", "small", "large"]

#: Letters to lower case, and what ends a piece to a full stop.
_TABLE = bytes.maketrans(bytes(range(65, 91)) + b",;:!?\n\v\f\r", bytes(range(97, 123)) + b"." * 9)


def tokens(text: bytes) -> list[bytes]:
    """Lower-case words, with ``b"."`` where a piece ends."""
    return text.translate(_TABLE).replace(b".", b" . ").split()


def _languages(part: pa.RecordBatch) -> list[str]:
    return [NO_LANG if lang is None else lang for lang in part.column(0).to_pylist()]


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n): how often each word is found in each language; null is ``und``."""

    def run(batches):
        counts: dict[str, Counter] = defaultdict(Counter)

        def counted():
            langs = [lang for lang, held in counts.items() for _ in held]
            columns = [
                pa.array(langs, pa.string()),
                pa.array([word for held in counts.values() for word in held], pa.binary()),
                pa.array([n for held in counts.values() for n in held.values()], pa.int64()),
            ]
            counts.clear()
            return pa.RecordBatch.from_arrays(columns, ["lang", "word", "n"])

        for part, texts in slices(batches, "text"):
            for lang, text in zip(_languages(part), texts, strict=True):
                counts[lang].update(tokens(text))
                counts[lang].pop(b".", None)
            if sum(map(len, counts.values())) > COUNTED_WORDS:
                yield counted()
        yield counted()

    slim = docs.select(F.col("lang").cast("string").alias("lang"), "text")
    counted = slim.mapInArrow(run, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    return counted.select("lang", F.col("word").cast("string").alias("word"), "n")


def key(salt: int) -> Column:
    """The 64-bit hash of language and word."""
    return F.xxhash64(F.lit(str(salt)), "lang", "word")


class Ids(dict):
    """The ids of the words of one language that the map has, 0 for others, remembered up to a number of words."""

    def __init__(self, lang: str, salt: int, bits: int, known: np.ndarray):
        super().__init__()
        self.seed = xxhash.xxh64_intdigest(lang.encode(), xxhash.xxh64_intdigest(str(salt).encode(), 42))
        self.bits, self.known = bits, known
        self[b"."] = 0

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
            self[b"."] = 0
        hashed = xxhash.xxh64_intdigest(word, self.seed)
        at = hashed % (8 * len(self.known))
        value = self[word] = hashed >> (64 - self.bits) if self.known[at >> 3] >> (at & 7) & 1 else 0
        return value


@dataclass(frozen=True)
class Naming:
    """What makes ids of words: a salt, the bits of an id, and the map of the words that get one."""

    salt: int
    bits: int
    known: np.ndarray

    def id(self) -> Column:
        """The id of a row's word as a signed long."""
        return F.shiftrightunsigned(key(self.salt), 64 - self.bits)


def naming(words: DataFrame, least: int) -> Naming:
    """Ids for the words (lang, word, n) found ``least`` times, different for all words that their map lets through."""
    for salt in count():
        keyed = words.select("n", key(salt).alias("key"))
        frequent, bit = keyed.where(F.col("n") >= least), F.pmod("key", F.lit(_MAP_BITS)).alias("bit")
        passing = keyed.select("key", bit).join(frequent.select(bit).distinct(), "bit", "left_semi")
        passing = staged(passing.select("key"), "named-words")
        size = passing.count()
        enough = [b for b in WIDTHS if size**2 < 1 << b] or [WIDTHS[-1]]
        for bits in enough[:2]:
            named = passing.select(F.shiftrightunsigned("key", 64 - bits).alias("id"))
            if named.where("id != 0").distinct().count() == size:
                return Naming(salt, bits, key_map(frequent))


def gram_counts(
    docs: DataFrame, named: Naming, size: int, total: int, least: int, pairs: np.ndarray | None = None, batch: int = BATCH, entries: int = ENTRIES
) -> DataFrame:
    """(w1, ..., n, key) of all n-grams of ``size`` named words within pieces that are found ``least`` times; key is a hash.

    ``total`` is the number of words in all. Of longer n-grams only those whose bigrams are all in the map ``pairs`` count.
    A task sorts ``batch`` n-grams at once and sends its filter off at ``entries`` entries.
    """
    spread = max(3, ceil(log2(max(total, 1) / RANGE)))
    shape = qf.Shape(size, named.bits, 8 * ceil((spread + 8) / 8), spread)

    def count_up(batches):
        ids: dict[str, Ids] = {}
        held, waiting, rows = None, [], 0

        def taken():
            parts = [qf.filter_of([np.concatenate(c) for c in zip(*waiting, strict=True)], shape)] if waiting else []
            return qf.merged(parts + ([held] if held else []), shape) if parts or held else None

        def sent(whole):
            parts = qf.ranges(whole, shape) if whole else []
            columns = zip(*[(place, *qf.packed(part, shape)) for place, part in parts], strict=True) if parts else [()] * 5
            kinds = [pa.int64()] + [pa.binary()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], _SENT)

        for part, texts in slices(batches, "text"):
            found = []
            for lang, text in zip(_languages(part), texts, strict=True):
                if lang not in ids:
                    if len(ids) >= LANGUAGES:
                        ids.clear()
                    ids[lang] = Ids(lang, named.salt, named.bits, named.known)
                words = tokens(text)
                found += [np.fromiter(map(ids[lang].__getitem__, words), np.uint64, len(words)), _BREAK]
            line = np.concatenate(found)
            columns = [line[k : max(len(line) - size + 1, 0) + k] for k in range(size)]
            good = np.all([c != 0 for c in columns], axis=0)
            columns = [c[good] for c in columns]
            if pairs is not None:
                good = np.all([is_mapped(pairs, mixed(x, y)) for x, y in zip(columns, columns[1:], strict=False)], axis=0)
                columns = [c[good] for c in columns]
            waiting.append(columns)
            rows += len(columns[0])
            if rows >= batch:
                held, waiting, rows = taken(), [], 0
                if len(held) >= entries:
                    yield sent(held)
                    held = None
        yield sent(taken())

    def merge(table: pa.Table) -> pa.Table:
        parts = [qf.unpacked(*row.values(), shape) for row in table.to_pylist()]
        whole = qf.merged(parts, shape)
        often = whole.counts >= least
        grams = qf.restored([c[often] for c in whole.columns], shape)
        columns = [c.view(np.int64) for c in grams] + [whole.counts[often], mixed(grams[0], grams[1])]
        return pa.table([pa.array(c) for c in columns], names=names)

    names = [f"w{k + 1}" for k in range(size)] + ["n", "key"]
    slim = docs.select(F.col("lang").cast("string").alias("lang"), "text")
    filters = slim.mapInArrow(count_up, "range long, lengths binary, remainders binary, small binary, large binary")
    return filters.groupBy("range").applyInArrow(merge, ", ".join(f"{n} long" for n in names))


def _score(left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)), exact."""
    wide = "cast({} as decimal(18,0))"
    above = "cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0))"
    return F.expr(f"({above}) div ({wide.format(left)} * {wide.format(right)})")


def collocations(docs: DataFrame, least: int = LEAST, percent: int = PERCENT, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the phrases of two and three words of ``docs`` (lang, text, ...) that keep together.

    Pieces end at ``.,;:!?`` and line ends, words at blanks and tabs; A to Z count as lower case. ``a`` counts a
    phrase, ``l`` and ``r`` the parts of its lowest-scoring cut (of equal scores the first), ``n`` all words of the language. A
    bigram goes if a trigram with it is found in ``percent`` of its places. Each language keeps ``top``
    phrases by score, count, and the phrase's bytes. Null text counts as empty, null language as ``und``; repeated rows
    count each. Other columns are ignored, whatever their names. An empty table gives an empty result.
    """
    words = staged(word_counts(docs), "words")
    total = words.agg(F.sum("n")).first()[0] or 0
    named = naming(words, least)
    frequent = staged(words.where(F.col("n") >= least).select("lang", "word", "n", named.id().alias("id")), "frequent-words")
    two = staged(gram_counts(docs, named, 2, total, least), "bigrams")
    three = staged(gram_counts(docs, named, 3, total, least, key_map(two)), "trigrams")

    def word(k: int) -> DataFrame:
        of_first = ["lang"] if k == 1 else []
        return frequent.select(*of_first, F.col("id").alias(f"w{k}"), F.col("word").alias(f"word{k}"), F.col("n").alias(f"n{k}"))

    within = three.select("n", F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("p"))
    longer = within.groupBy("p.w1", "p.w2").agg(F.max("n").alias("longer"))
    kept = two.drop("key").join(longer, ["w1", "w2"], "left").where(F.coalesce(100 * F.col("longer") < percent * F.col("n"), F.lit(True)))
    pairs = kept.withColumnRenamed("n", "a").join(word(1), "w1").join(word(2), "w2")
    pairs = pairs.select("lang", F.concat_ws(" ", "word1", "word2").alias("phrase"), "a", F.col("n1").alias("l"), F.col("n2").alias("r"))
    pairs = pairs.withColumn("score", _score("l", "r"))

    triples = three.drop("key").withColumnRenamed("n", "a").join(two.select("w1", "w2", F.col("n").alias("n12")), ["w1", "w2"])
    triples = triples.join(two.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("n").alias("n23")), ["w2", "w3"])
    triples = triples.join(word(1), "w1").join(word(2), "w2").join(word(3), "w3")
    cuts = [
        F.struct(_score(left, right).alias("score"), F.lit(k).alias("k"), F.col(left).alias("l"), F.col(right).alias("r"))
        for k, (left, right) in enumerate([("n1", "n23"), ("n12", "n3")])
    ]
    triples = triples.select("lang", F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"), "a", F.least(*cuts).alias("cut"))
    triples = triples.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = pairs.unionByName(triples).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    ranked = ranked.join(sizes, "lang")
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
