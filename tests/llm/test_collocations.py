"""Counting quotient filters and the phrases found with them, against plain counts."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from compare import compare, connect
from geomosaic.llm import collocations, queries
from geomosaic.llm import quotient_filter as qf

SF_DIR = "/root/testdata/sf0.001"
SHAPES = [qf.Shape(2, 32, 16, 3), qf.Shape(3, 40, 16, 8), qf.Shape(3, 64, 24, 9), qf.Shape(2, 24, 16, 5), qf.Shape(3, 32, 32, 20)]


@pytest.mark.parametrize("shape", SHAPES)
@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(*[st.integers(0, 2**64 - 1)] * 3), max_size=40), st.randoms())
def test_filters_count_exactly_and_give_the_ids_back(shape, grams, rng):
    grams = [tuple(x >> (64 - shape.bits) for x in g[: shape.words]) for g in grams]
    grams += [g for g in grams for _ in range(rng.choice([0, 1, 300]))]
    held = []
    for part in (grams[::2], grams[1::2]):
        columns = [np.array([g[k] for g in part], dtype=np.uint64) for k in range(shape.words)]
        mixed = qf.permuted(columns, shape)
        assert all((a == b).all() for a, b in zip(qf.restored(mixed, shape), columns, strict=True))
        held.append([(place, qf.packed(x, shape)) for place, x in qf.ranges(qf.filter_of(columns, shape), shape)])
    found = Counter()
    for place in {p for h in held for p, _ in h}:
        whole = qf.merged([qf.unpacked(p, *data, shape) for h in held for p, data in h if p == place], shape)
        ids = qf.restored(whole.columns, shape)
        found.update(dict(zip(zip(*(c.tolist() for c in ids), strict=True), whole.counts.tolist(), strict=True)))
    assert found == Counter(grams)


def test_grams_that_agree_in_their_first_bits_stay_apart():
    shape = qf.Shape(3, 40, 16, 3)
    columns = [np.array(c, dtype=np.uint64) for c in ([5, 5, 5, 5], [7, 7, 7, 7], [2, 1, 2, 1])]
    whole = qf.merged([qf.Filter(columns, np.array([1, 10, 100, 1000]))], shape)
    assert [c.tolist() for c in whole.columns] == [[5, 5], [7, 7], [1, 2]] and whole.counts.tolist() == [1010, 101]


def plain_phrases(rows, least=10, percent=50, top=2000):
    counts, sizes = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang, text = "und" if lang is None else lang, (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = re.findall("[^ \t]+", piece)
            sizes[lang] += len(words)
            for size in (1, 2, 3):
                counts[lang].update(tuple(words[k : k + size]) for k in range(len(words) - size + 1))
    out = []
    for lang, held in counts.items():
        found = []
        for gram, a in held.items():
            if len(gram) == 1 or a < least:
                continue
            if len(gram) == 2 and any(len(h) == 3 and n >= least and gram in (h[:2], h[1:]) and 100 * n >= percent * a for h, n in held.items()):
                continue
            cuts = [(10**6 * a * a // (held[gram[:k]] * held[gram[k:]]), k, held[gram[:k]], held[gram[k:]]) for k in range(1, len(gram))]
            score, _, left, right = min(cuts)
            found.append((-score, -a, " ".join(gram).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out)


def corpus(n, seed):
    rng = random.Random(seed)
    words = ["New", "york", "été", "ＡＢ", "x", "the", "of", "\x1cq", "\x85", "Zürich"]
    rows = []
    for _ in range(n):
        parts = [rng.choice([" ".join(rng.choices(words, k=rng.randrange(6))), "New York City", "the of the", "a\tb  c"]) for _ in range(12)]
        rows.append((rng.choice(["en", "de", None, "und", ""]), rng.choice([" ", ". ", "\n", "\x0b", "!"]).join(parts)))
    return rows + [("en", None), ("en", ""), (None, " .!\n"), ("fr", "only once"), ("en", "pad pad pad " * 9)] + rows[:5]


CLASH = "lang string, text string, n int, word string, id long, key long, phrase string, a int"


def test_phrases_equal_plain_counts(spark):
    rows = corpus(60, 3)
    docs = spark.createDataFrame([(*r, 1, "w", 2, 3, "p", 4) for r in rows], CLASH).repartition(3)
    assert sorted(map(tuple, collocations.collocations(docs).collect())) == plain_phrases(rows)
    few = collocations.collocations(docs, least=12, percent=90, top=3)
    assert sorted(map(tuple, few.collect())) == plain_phrases(rows, 12, 90, 3)
    assert collocations.collocations(docs.limit(0)).count() == 0
    assert collocations.collocations(docs.where("lang = 'fr'")).count() == 0


def test_counts_do_not_depend_on_when_filters_are_sent(spark):
    rows = corpus(40, 4)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(2)
    words = collocations.word_counts(docs)
    named = collocations.naming(words, 5)
    total = words.agg(F.sum("n")).first()[0]
    whole = collocations.gram_counts(docs, named, 2, total, 5).collect()
    assert whole and sorted(whole) == sorted(collocations.gram_counts(docs, named, 2, total, 5, batch=7, entries=3).collect())


def test_ids_are_the_hashes_of_spark(spark):
    rows = [(lang, word) for lang in ("en", "", "und") for word in ("été", "a", "x" * 40)]
    words = spark.createDataFrame([(*r, 20) for r in rows] + [("en", "rare", 1)], "lang string, word string, n long")
    named = collocations.naming(words, 10)
    found = {(r.lang, r.word): r.id for r in words.select("lang", "word", named.id().alias("id")).collect()}
    for lang, word in rows:
        assert collocations.Ids(lang, named.salt, named.bits, named.known)[word.encode()] == found[lang, word] != 0
    assert collocations.Ids("en", named.salt, named.bits, named.known)[b"rare"] == 0
    assert xxhash.xxh64_intdigest(b"x", 42) >> 32 != 0


def test_words_of_equal_ids_get_more_bits(spark, monkeypatch):
    words = spark.range(3000).select(F.lit("en").alias("lang"), F.col("id").cast("string").alias("word"), F.lit(10).alias("n"))
    monkeypatch.setattr(collocations, "WIDTHS", (8, 16, 40))
    assert collocations.naming(words, 10).bits == 40


def test_query_equals_sql(spark):
    name = "op12_phrase_mining"
    assert compare(spark, connect(SF_DIR), queries.QUERIES[name], queries.ORACLES[name], SF_DIR) == []
