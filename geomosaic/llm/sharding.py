"""Sharding by proportional stratified interleaving, with DataFrame functions only.

Rows of each source are ranked in a seeded random order; rank over size of the source is a
row's fractional rank. Sorted by that, every source is spread evenly over the whole, and cutting the
line into equal runs gives every shard the mixture of the input, to a row per source.

Neither rank is taken in one task: rows are ranked within slices (of the random number, then of the
fractional rank), and counts of the slices before are added. So a source with a third of all
rows is dealt over all tasks. Only ids, sizes and checksums are shuffled, never texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geomosaic.llm.common import staged

#: Slices of a source, and of the whole line; a power of two.
SLICES = 4096
_BITS = SLICES.bit_length() - 1
_TIES = ("random", "doc_id", "text_crc32", "size")


def sizes(docs: DataFrame, seed: int) -> DataFrame:
    """(doc_id, size, text_crc32, stratum, random) of each row."""
    text = F.coalesce("text", F.lit(""))
    stratum = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        stratum.alias("stratum"),
        F.xxhash64(F.lit(seed), F.col("doc_id").cast("long")).alias("random"),
    )


def _before(counts: DataFrame, part: list[str], order: str) -> DataFrame:
    """Rows in the slices before, and in all slices of the same part."""
    whole = Window.partitionBy(*part) if part else Window.partitionBy(F.lit(0))
    before = whole.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        *part, order, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("n").over(whole).alias("total")
    )


def interleave(docs: DataFrame, shards: int = 8, seed: int = 1) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of each row of ``docs`` (doc_id, text, source, ...).

    Shards have equal numbers of rows, to one; slots count from 0 in each. A null source is a source of its
    own, null text is empty, repeated rows are rows like others (which of two equal rows comes
    first makes no difference), and other columns are ignored.
    """
    rows = staged(sizes(docs, seed), "sizes").withColumn("slice", F.shiftrightunsigned("random", 64 - _BITS))
    places = _before(rows.groupBy("stratum", "slice").agg(F.count("*").alias("n")), ["stratum"], "slice")
    own = F.row_number().over(Window.partitionBy("stratum", "slice").orderBy(*_TIES))
    ranked = rows.join(places, ["stratum", "slice"]).withColumn("part", (F.col("before") + own - 0.5) / F.col("total"))
    ranked = staged(ranked.select("doc_id", "size", "text_crc32", "random", "part"), "ranked")

    ranked = ranked.withColumn("cut", F.floor(F.col("part") * SLICES))
    starts = _before(ranked.groupBy("cut").agg(F.count("*").alias("n")), [], "cut")
    inner = F.row_number().over(Window.partitionBy("cut").orderBy("part", *_TIES))
    line = ranked.join(starts, "cut").withColumn("at", F.col("before") + inner - 1)
    return line.withColumn("shard", F.expr(f"int(at * {shards} div total)")).select(
        "doc_id", "size", "text_crc32", "shard", F.expr(f"at - (shard * total + {shards - 1}) div {shards}").alias("slot")
    )


def write_shards(docs: DataFrame, assigned: DataFrame, path: str) -> None:
    """Write the documents, all columns, as one folder per shard in slot order; ids must be unique."""
    placed = docs.join(assigned.select("doc_id", F.col("shard").alias("__shard"), F.col("slot").alias("__slot")), "doc_id")
    placed = placed.repartitionByRange("__shard", "__slot").sortWithinPartitions("__shard", "__slot").drop("__slot")
    placed.write.partitionBy("__shard").parquet(path)
