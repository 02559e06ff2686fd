"""Near duplicates by 64-bit fingerprints: multi-index hashing over both halves of a fingerprint.

Fingerprints that differ in at most three bits differ in at most one bit in one of their halves. Each half is
a table of its own: a fingerprint is entered under its half and looks up the Hamming ball of radius one around
it, of which only the keys with one set bit cleared are sent, since the partner with that bit clear is found
from this side and never from both. Matches are verified by the distance of the whole fingerprints. Equal
fingerprints are one node and make no pairs.

Where more than ``MEMBERS`` entries share a key, its members are not met in pairs. Every member stands under the
words around its other half instead: within one bit (near), and within two bits (far). Two members of one
key are three bits apart at most exactly if some word has one of them near and the other near or
far, and everything under a word is within three bits of each near member. So a star around
one near member per word gives the same components with work that grows with the members only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geomosaic.llm.common import slices, staged
from geomosaic.llm.components import components

WORDS = 3
SEED = 42
BITS, HALF = 64, 32
RADIUS = 3
#: Table entries under one key, beyond which they and those that look them up meet through stars.
MEMBERS = 1 << 10
#: Parts into which the rows of one fingerprint or one component are dealt.
SALTS = 256
#: Links that one task writes in a step of the components.
EDGES = 200_000
#: Shingles whose bits are counted at once.
STEP = 1 << 16


def fingerprint(text: bytes) -> int:
    """The fingerprint of a text as an unsigned number; zero without words."""
    words = text.lower().split()
    if not words:
        return 0
    line, size = b" ".join(words), min(WORDS, len(words))
    begins = np.cumsum([0] + [len(w) + 1 for w in words])
    starts, ends = begins[: len(words) - size + 1].tolist(), (begins[size:] - 1).tolist()
    counts = np.zeros(BITS, dtype=np.int64)
    for k in range(0, len(starts), STEP):
        spans = zip(starts[k : k + STEP], ends[k : k + STEP], strict=True)
        hashes = np.array([xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in spans], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(starts), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, print) of each row of ``docs`` (doc_id, text); print is the fingerprint as a signed long."""

    def work(batches):
        for part, texts in slices(batches, "text"):
            prints = np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(prints)], ["doc_id", "print"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, "doc_id long, print long")


def _halves(prints: DataFrame) -> DataFrame:
    """(print, part, key, rest): a fingerprint under each of its halves, with the other half."""
    low = F.col("print").bitwiseAND(F.lit((1 << HALF) - 1))
    high = F.shiftrightunsigned("print", HALF)
    sides = [F.struct(F.lit(k).alias("part"), a.alias("key"), b.alias("rest")) for k, (a, b) in enumerate([(low, high), (high, low)])]
    return prints.select("print", F.explode(F.array(*sides)).alias("side")).select("print", "side.*")


def _lookups(entries: DataFrame) -> DataFrame:
    """(print, part, key, rest, flipped): the entries' own keys, and the keys with one of their set bits cleared."""
    bits = F.filter(F.sequence(F.lit(0), F.lit(HALF - 1)), lambda i: F.col("key").bitwiseAND(_bit(i)) != 0)
    cleared = F.transform(bits, lambda i: F.struct(F.col("key").bitwiseXOR(_bit(i)).alias("at"), F.lit(1).alias("flipped")))
    own = F.array(F.struct(F.col("key").alias("at"), F.lit(0).alias("flipped")))
    return entries.select("print", "part", "rest", F.explode(F.concat(own, cleared)).alias("to")).select(
        "print", "part", F.col("to.at").alias("key"), "rest", "to.flipped"
    )


def _bit(i: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), i)


def links(prints: DataFrame, members: int = MEMBERS) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints (print), at most three bits apart, that have the components of all such pairs.

    Keys of up to ``members`` entries give all their pairs, the others their stars.
    """
    entries = _halves(prints)
    lookups = _lookups(entries)
    hot = staged(entries.groupBy("part", "key").count().where(F.col("count") > members).select("part", "key"), "hot-keys")
    crowded = None
    if not hot.isEmpty():
        crowded = lookups.join(hot, ["part", "key"], "left_semi")
        lookups = lookups.join(hot, ["part", "key"], "left_anti")
    table = entries.select("part", "key", F.col("print").alias("other"))
    apart = F.bit_count(F.col("print").bitwiseXOR(F.col("other")))
    # two entries of one key look each other up: one of the two counts
    once = (F.col("flipped") == 1) | (F.col("print") < F.col("other"))
    met = lookups.join(table, ["part", "key"]).where((apart <= RADIUS) & once)
    pairs = met.select(F.least("print", "other").alias("a"), F.greatest("print", "other").alias("b"))
    if crowded is not None:
        pairs = pairs.unionByName(_stars(crowded))
    return pairs.distinct()


def _stars(crowded: DataFrame) -> DataFrame:
    """Links (a, b) around one near member for each word around the other halves of crowded keys."""
    places = F.sequence(F.lit(0), F.lit(HALF - 1))
    one = F.transform(places, _bit)
    two = F.flatten(
        F.transform(places, lambda i: F.transform(F.filter(places, lambda j: j > i), lambda j: _bit(i).bitwiseOR(_bit(j))))
    )
    within = F.concat(F.array(F.lit(0).cast("long")), one)
    entered = crowded.where("flipped = 0")
    rows = (
        entered.select("part", "key", "print", "rest", F.lit(True).alias("near"), F.explode(within).alias("mask"))
        .unionByName(entered.select("part", "key", "print", "rest", F.lit(False).alias("near"), F.explode(two).alias("mask")))
        .unionByName(
            crowded.where("flipped = 1").select("part", "key", "print", "rest", F.lit(False).alias("near"), F.explode(within).alias("mask"))
        )
        .select("part", "key", F.col("rest").bitwiseXOR(F.col("mask")).alias("word"), "print", "near")
    )
    place = ["part", "key", "word"]
    centres = rows.where("near").groupBy(place).agg(F.min("print").alias("centre"))
    return (
        rows.join(centres, place)
        .where("print != centre")
        .select(F.least("print", "centre").alias("a"), F.greatest("print", "centre").alias("b"))
    )


def _with_least(rows: DataFrame, key: str, value: str, least: str) -> DataFrame:
    """``rows`` with the smallest ``value`` of their ``key``, the rows of one key dealt over ``SALTS`` tasks."""
    rows = rows.withColumn("salt", F.pmod(F.xxhash64(value), F.lit(SALTS)))
    parts = rows.groupBy(key, "salt").agg(F.min(value).alias(least))
    whole = parts.groupBy(key).agg(F.min(least).alias(least))
    return rows.join(parts.select(key, "salt").join(whole, key), [key, "salt"]).drop("salt")


def near_duplicates(docs: DataFrame, members: int = MEMBERS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of each row of ``docs`` (doc_id, text, ...).

    Null text counts as empty; a text without words has fingerprint zero and is linked like any other.
    Rows of one id are told apart by their texts, and each gives a row. Null ids are never the smallest unless
    all of a component are null; then its id is null. Other columns are ignored, whatever
    their names. An empty table gives an empty result.
    """
    signed = staged(fingerprints(docs), "fingerprints")
    nodes = staged(signed.groupBy("print").agg(F.min("doc_id").alias("first")), "prints")
    found = components(links(nodes.select("print"), members), EDGES)
    placed = nodes.join(found.withColumnRenamed("node", "print"), "print", "left")
    placed = placed.select("print", "first", F.coalesce("component", "print").alias("class"))
    of_print = _with_least(placed.select("class", "print", "first"), "class", "first", "component_id")
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt")
    parts = signed.select("print", salt).distinct().join(of_print.select("print", "component_id"), "print")
    of_row = signed.select("doc_id", "print", salt).join(parts, ["print", "salt"])
    return of_row.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
