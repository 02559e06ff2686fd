"""Near-duplicate documents: one-permutation hashing, banded buckets, star-shaped candidates.

A document's set holds the 64-bit hashes of its distinct word shingles. One permutation is
cut into bins; a bin keeps the smallest hash in it, and an empty bin takes over the value of the
first filled bin in an order of its own (optimal densification), so short documents fill
all bins too. Bands of bins are bucket keys. Equal sets share a node and so never make pairs.

In a bucket every node is linked to the smallest node only: as many candidates as nodes. Candidates are
confirmed on the full sets. While buckets hold more pairs across components than members, further stars
follow around the members with most links, as long as each halves those pairs. In the end all nodes of one
bucket that are in different components are compared by size and by a bitmap of their sets, so a star whose
centre is not similar loses nothing. A bit tells if an odd number of shingles falls on it; two bitmaps never differ
in more bits than their sets in shingles, so what the bitmaps rule out is not similar for certain. The
others are confirmed on the full sets.
Two documents of similarity 0.75 share no bucket with probability (1 - 0.75^6)^50 = 6e-5, those
of 0.8 with 3e-7.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geomosaic.llm.common import WordHash, one_per_document, slices, staged, word_hashes
from geomosaic.llm.components import components

WORDS = 5
BANDS, ROWS = 50, 6
BINS = BANDS * ROWS
PERCENT = 75
#: Bits of a set's bitmap, in words of 64.
BITMAP_WORDS = 16

_rng = np.random.default_rng(20)
_FACTORS = _rng.integers(0, 2**63, size=(WORDS + 1, WORDS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_FACTORS = _rng.integers(0, 2**63, size=ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_SALT = _rng.integers(0, 2**63, size=BANDS, dtype=np.uint64)
_DONORS = np.stack([_rng.permutation(BINS) for _ in range(BINS)])
_BOUNDS = np.array([-(-(k << 64) // BINS) for k in range(BINS)], dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes, cache: WordHash) -> np.ndarray:
    """Sorted distinct shingle hashes of a text; with fewer words, one for the whole sequence."""
    hashes = word_hashes(text.lower().split(), cache)
    size = min(WORDS, len(hashes))
    if not size:
        return hashes
    total = np.zeros(len(hashes) - size + 1, dtype=np.uint64)
    for k in range(size):
        total += hashes[k : k + len(total)] * _FACTORS[size, k]
    return np.unique(_mix(total))


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """One bucket key per band of a non-empty sorted set."""
    first = np.searchsorted(shingles, _BOUNDS)
    filled = first < np.append(first[1:], len(shingles))
    values = shingles[np.minimum(first, len(shingles) - 1)]
    if not filled.all():
        empty = np.flatnonzero(~filled)
        donors = _DONORS[empty]
        values[empty] = values[donors[np.arange(len(empty)), filled[donors].argmax(axis=1)]]
    return _mix((values.reshape(BANDS, ROWS) * _BAND_FACTORS).sum(axis=1, dtype=np.uint64) ^ _BAND_SALT)


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """For each bit, if an odd number of shingles falls on it, as signed 64-bit words."""
    odd = np.bincount(shingles.astype(np.int64) & (64 * BITMAP_WORDS - 1), minlength=64 * BITMAP_WORDS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def node_of(shingles: np.ndarray) -> int:
    """A signed 64-bit name of a set; equal sets have equal names."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, n_shingles, node, keys) of each row, mark a hash of the text; a text without words has no node and no keys."""

    def sign(batches):
        cache = WordHash()
        for part, texts in slices(batches, "text"):
            sets = [shingle_set(t, cache) for t in texts]
            keys = [band_keys(s).view(np.int64) if len(s) else np.empty(0, np.int64) for s in sets]
            ends = np.cumsum([0] + [len(k) for k in keys], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    part.column(1),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys))),
                ],
                ["doc_id", "mark", "n_shingles", "node", "keys"],
            )

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _mark(F.col("text")).alias("mark"), "text")
    return slim.mapInArrow(sign, "doc_id long, mark long, n_shingles long, node long, keys array<long>")


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles, size, bits) of the wanted nodes (node, rep), read again from the text of one document each."""

    def make(batches):
        cache = WordHash()
        for part, texts in slices(batches, "text"):
            sets = [shingle_set(t, cache) for t in texts]
            rows = [(n, s) for n, s in zip(part.column(0).to_pylist(), sets, strict=True) if len(s) and n == node_of(s)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([n for n, _ in rows], pa.int64()),
                    pa.array([s.tobytes() for _, s in rows], pa.binary()),
                    pa.array([len(s) for _, s in rows], pa.int64()),
                    pa.array([bitmap(s) for _, s in rows], pa.list_(pa.int64())),
                ],
                ["node", "shingles", "size", "bits"],
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), "text")
    joined = texts.join(wanted, texts["rep"].eqNullSafe(wanted["rep"])).select("node", "text")
    return joined.mapInArrow(make, "node long, shingles binary, size long, bits array<long>")


def _confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar."""

    def check(batches):
        for batch in batches:
            a, b, left, right = (batch.column(k) for k in range(4))
            keep = []
            for x, y in zip(left, right, strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                small, large = min(len(x), len(y)), max(len(x), len(y))
                if 100 * small < PERCENT * large:
                    keep.append(False)
                    continue
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([a, b], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(check, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, mark) of each row of ``docs`` (doc_id, text, ...).

    Null text counts as empty. A document without words is linked with nothing. Rows of one id
    are nodes by their text, and each gives a row; ``kept`` holds for every row that has the smallest
    id of its component. A null id is never the smallest unless all are null; then it is kept.
    Other columns are ignored. An empty table gives an empty result.
    """
    signed = staged(signatures(docs), "signatures")
    placed = signed.where(F.size("keys") > 0).select("node", F.explode("keys").alias("key"))
    shared = placed.groupBy("key").agg(F.min("node").alias("centre"), F.max("node").alias("last"))
    members = staged(
        placed.join(shared.where("centre < last").select("key", "centre"), "key").distinct(), "buckets"
    )
    involved = members.select("node").distinct()
    wanted = signed.join(involved, "node").groupBy("node").agg(F.min("doc_id").alias("rep"))
    sets = staged(_sets(docs, wanted), "shingles")

    stars = members.where("node > centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    links = staged(_confirm(stars, sets), "links")
    turn, before = 0, float("inf")
    while True:
        mixed = staged(_mixed(members, components(links)), "mixed")
        rows, left = mixed.agg(F.count("*"), F.coalesce(F.sum("pairs"), F.lit(0.0))).first()
        if left <= rows or left > before / 2:
            break
        before = left
        links = staged(links.unionByName(_confirm(_hub_stars(mixed, links, turn), sets)), "links")
        turn += 1
    links = links.unionByName(_confirm(_cross_pairs(mixed, sets), sets))

    found = components(links)
    of_row = signed.select("doc_id", "mark", "n_shingles", "node").join(found, "node", "left")
    of_row = of_row.select("doc_id", "mark", "n_shingles", "component", F.coalesce("component", "node").alias("class"))
    least = of_row.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("least"))
    of_row = of_row.join(least, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return of_row.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        "mark",
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, without those that have a near duplicate of smaller id.

    Of rows with one id and one text, one stays. A document without words stays.
    """
    kept = near_duplicates(docs).select("doc_id", "kept", "mark")
    return one_per_document(docs, kept, _mark)


def _mark(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _mixed(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members of buckets that hold several components: (key, node, centre, c, pairs).

    ``pairs`` is the number of pairs across components that the row stands for, so its sum is their number.
    """
    placed = members.join(found, "node", "left").select("key", "node", "centre", F.coalesce("component", "node").alias("c"))
    sizes = placed.groupBy("key", "c").agg(F.count("*").alias("n"))
    totals = sizes.groupBy("key").agg(F.sum("n").alias("all"), F.count("*").alias("parts")).where("parts > 1")
    sizes = sizes.join(totals, "key").select("key", "c", ((F.col("all") - F.col("n")) / 2).alias("pairs"))
    return placed.join(sizes, ["key", "c"])


def _hub_stars(mixed: DataFrame, links: DataFrame, turn: int) -> DataFrame:
    """In each bucket, its members with the one that has most links so far, or in later turns with any one.

    What most documents of a group are similar to, such as the text they were made from, is linked with
    the centres of many stars and so comes to the front.
    """
    ends = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node")))
    degrees = ends.groupBy("node").agg(F.count("*").alias("degree"))
    rank = F.coalesce("degree", F.lit(0)) if turn == 0 else F.xxhash64("node", F.lit(turn))
    hubs = mixed.join(degrees, "node", "left").groupBy("key").agg(
        F.max_by("node", rank).alias("hub"), F.max_by("c", rank).alias("hub_c")
    )
    pairs = mixed.join(hubs, "key").where("c != hub_c")
    return pairs.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def _cross_pairs(mixed: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs of one bucket, not in one component and not tested by the first star, that size and bitmap do not rule out."""
    bits = [f"bits_{k}" for k in range(BITMAP_WORDS)]
    known = sets.select("node", "size", *[F.col("bits")[k].alias(b) for k, b in enumerate(bits)])
    left = mixed.where("node > centre").select("key", "node", "c").join(known, "node")
    right = left.select("key", *[F.col(n).alias(f"{n}_") for n in ("node", "c", "size", *bits)])
    differ = sum((F.bit_count(F.col(b).bitwiseXOR(F.col(f"{b}_"))) for b in bits), F.lit(0))
    total = F.col("size") + F.col("size_")
    # the sets share at most (total - differ) / 2 shingles
    similar = ((100 + PERCENT) * (total - differ) >= 2 * PERCENT * total) & (
        100 * F.least("size", "size_") >= PERCENT * F.greatest("size", "size_")
    )
    pairs = left.join(right, "key").where((F.col("node") < F.col("node_")) & (F.col("c") != F.col("c_")) & similar)
    return pairs.select(F.col("node").alias("a"), F.col("node_").alias("b")).distinct()
