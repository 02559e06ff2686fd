"""Periodic runs against a plain search over all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from geomosaic.llm import periodic_runs, queries
from geomosaic.llm.common import read

SF_DIR = "/root/testdata/sf0.001"


def plain_runs(words):
    """All (start, length, period): maximal stretches of every period, the smallest period of each kept."""
    numbers = {w: k for k, w in enumerate(dict.fromkeys(words))}
    ids, found = np.array([numbers[w] for w in words], dtype=np.int64), {}
    for q in range(1, len(ids) // 2 + 1):
        same = np.concatenate([[0], ids[q:] == ids[:-q], [0]]).astype(int)
        for s, e in zip(np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1), strict=True):
            if e - s >= max(q, 12 - q):
                found.setdefault((int(s), int(e) + q), q)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def words_of(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = h // 10 % n
    p = 1 + (n - a) // (3 + h // 10 % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def test_query_equals_plain_search(spark):
    expected = []
    for r in read(spark, SF_DIR, "documents").select("doc_id", "text").collect():
        words = planted(r.doc_id, words_of(r.text))
        runs = plain_runs(words)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
        milli = 1000 * best[1] // best[2] if runs else None
        digests = ["".join(f"{s},{n},{q}\n" for s, n, q in runs), collapsed(words, runs)]
        expected.append((r.doc_id, len(runs), *best, milli, *[hashlib.sha256(d.encode()).hexdigest() for d in digests]))
    found = queries.QUERIES["op13_periodic_runs"](spark, SF_DIR)
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    assert sum(r[1] for r in expected) > 20


def found_runs(words):
    numbers = {w: k for k, w in enumerate(dict.fromkeys(words))}
    return list(zip(*(x.tolist() for x in periodic_runs.runs_of(np.array([numbers[w] for w in words], dtype=np.int64))), strict=True))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=90) | st.lists(st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=9), st.integers(1, 9)), max_size=8).map(
    lambda parts: [w for block, times in parts for w in block * times]))
def test_runs_equal_plain_search(words):
    assert found_runs(words) == plain_runs(words)


def test_words_of_few_kinds_and_long_repeats():
    fibonacci = ["a"], ["a", "b"]
    while len(fibonacci[1]) < 900:
        fibonacci = fibonacci[1], fibonacci[1] + fibonacci[0]
    rng = random.Random(5)
    block = [rng.choice("xyz") for _ in range(150)]
    for words in (["a"] * 500, fibonacci[1], block * 4 + ["!"] + block * 3, block + block[:100], [str(k) for k in range(300)]):
        assert found_runs(words) == plain_runs(words)


def test_awkward_rows(spark):
    rng = random.Random(7)
    long = " ".join((" ".join(rng.choices("pqrs", k=300)) + " ") * 40 for _ in range(10))
    texts = [(1, None), (2, ""), (3, " \n"), (4, "a " * 12), (4, "a " * 12), (4, "a " * 11), (None, "a b\t" * 6), (5, "A a " * 6 + "A"),
             (6, "é\x85é\n" * 30), (7, long), (8, "x y z " * 5 + "x y w"), (9, "a " * 6), (10, "a " * 6)]
    schema = "doc_id long, text string, runs int, start long, words string, n_words int, collapsed int"
    docs = spark.createDataFrame([(i, t, 1, 2, "w", 3, 4) for i, t in texts], schema).coalesce(1)
    found = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs.periodic_runs(docs).collect()]
    expected = []
    for i, t in texts:
        words = words_of(t)
        runs = plain_runs(words) if i != 7 else found[9][2]
        expected.append((i, len(words), runs, collapsed(words, runs)))
    assert found == expected
    assert len(found[9][2]) >= 10 and found[9][0] == 7
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0
    assert queries.with_planted_runs(docs.limit(0)).count() == 0
    assert queries.with_planted_runs(docs).count() == len(texts)
