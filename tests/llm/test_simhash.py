"""Fingerprints and their components against plain versions."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from geomosaic.llm import queries, simhash
from geomosaic.llm.common import read

SF_DIR = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", (text or "").translate({c: c + 32 for c in range(65, 91)})) if w]
    size = min(3, len(words))
    shingles = [" ".join(words[k : k + size]) for k in range(len(words) - size + 1)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints):
    """The smallest id that each row reaches over links of at most three bits."""
    root = list(range(len(ids)))

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    values = np.array(prints, dtype=np.uint64)
    for k in range(len(ids)):
        apart = np.unpackbits((values[k + 1 :] ^ values[k]).view(np.uint8).reshape(-1, 8), axis=1).sum(axis=1)
        for j in np.flatnonzero(apart <= 3):
            root[find(k + 1 + int(j))] = find(k)
    least = {}
    for k, i in enumerate(ids):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return [least.get(find(k)) for k in range(len(ids))]


def test_query_equals_all_pairs(spark):
    rows = read(spark, SF_DIR, "documents").select("doc_id", "text").collect()
    ids, prints = [r.doc_id for r in rows], [plain_fingerprint(r.text) for r in rows]
    expected = sorted(zip(ids, [f"{p:016x}" for p in prints], plain_components(ids, prints), strict=True))
    found = queries.QUERIES["op11_simhash_near_dedup"](spark, SF_DIR).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in found) == expected
    assert len({r.component_id for r in found}) < len(rows)


@pytest.mark.parametrize("members", [simhash.MEMBERS, 4, 1])
def test_components_of_crowded_halves_equal_all_pairs(spark, members):
    rng = random.Random(members)
    centres = [rng.getrandbits(64) for _ in range(4)] + [0, 2**64 - 1, 1 << 63]
    prints = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(9))) for c in centres for _ in range(60)}
    prints |= {centres[0] & 0xFFFFFFFF00000000 | rng.getrandbits(32) & rng.getrandbits(32) for _ in range(150)}  # one upper half
    prints |= {rng.getrandbits(64) for _ in range(60)}
    prints = sorted(prints)
    rows = [(int(np.uint64(p).view(np.int64)),) for p in prints]
    made = simhash.components(simhash.links(spark.createDataFrame(rows, "print long").repartition(3), members))
    found = {r.node: r.component for r in made.collect()}
    groups, expected = {}, {}
    for (p,), least in zip(rows, plain_components(list(range(len(prints))), prints), strict=True):
        groups.setdefault(found.get(p, p), set()).add(p)
        expected.setdefault(least, set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_links_are_never_more_than_three_bits_apart(spark):
    rng = random.Random(1)
    base = rng.getrandbits(64)
    rows = {int(np.uint64(base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(7)))).view(np.int64)) for _ in range(200)}
    pairs = simhash.links(spark.createDataFrame([(r,) for r in rows], "print long"), 1).collect()
    assert pairs and all(bin((p.a ^ p.b) & (2**64 - 1)).count("1") <= 3 and p.a != p.b for p in pairs)


def test_awkward_rows(spark):
    long = " ".join(random.Random(2).choices(["a", "B", "été"], k=90_000))
    texts = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (4, "one TWO"), (None, "one two"), (5, long), (6, long + " x"), (7, "a"),
             (None, None), (8, "É a b"), (9, "é a b"), (10, "a\x1cb c d"), (11, "\x85 a b")]
    schema = "doc_id long, text string, print long, salt int, component_id long, part int, key long"
    docs = spark.createDataFrame([(i, t, 1, 2, 3, 4, 5) for i, t in texts], schema).repartition(3)
    found = simhash.near_duplicates(docs).collect()
    prints = [plain_fingerprint(t) for _, t in texts]
    expected = zip([i for i, _ in texts], [f"{p:016x}" for p in prints], plain_components([i for i, _ in texts], prints), strict=True)
    assert sorted(map(str, (tuple(r) for r in found))) == sorted(map(str, expected))
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_a_hot_fingerprint_is_dealt_over_tasks(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("same text here again").alias("text"))
    found = simhash.near_duplicates(docs)
    assert found.agg(F.count("*"), F.min("component_id"), F.max("component_id")).first() == (3000, 0, 0)
