"""What the operators of this package share: words, digests of words, and bounded slices of Arrow batches."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geomosaic.session import staged

__all__ = ["WordHash", "crc_bucket", "one_per_document", "read", "sent", "staged", "slices", "texts_of", "word_hashes"]

#: Text bytes that one step of a task handles at once; a longer text is a step of its own.
SLICE_BYTES = 4 << 20
#: Distinct words that a worker remembers before it starts anew.
CACHE_WORDS = 200_000


def read(spark, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def crc_bucket(column: str, n: int) -> Column:
    """crc32 of a column as text, modulo n; null counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))), F.lit(n))


def discard(table: DataFrame) -> None:
    """Remove the files of a staged table that nothing reads any more."""
    for file in table.inputFiles():
        place = table.sparkSession._jvm.org.apache.hadoop.fs.Path(file)
        place.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(place, False)


def free_shuffles(table: DataFrame) -> None:
    """Let Spark remove the shuffle files of queries that have ended; it does so once their plans are collected."""
    gc.collect()
    table.sparkSession._jvm.System.gc()


@contextmanager
def sent(table: DataFrame, value) -> Iterator[Broadcast]:
    """``value`` on every worker, for as long as the block lasts.

    A function that held it would be written to the disks of driver and executors anew for each plan, for good.
    """
    made = table.sparkSession.sparkContext.broadcast(value)
    try:
        yield made
    finally:
        made.destroy(blocking=True)


def texts_of(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null is empty."""
    return [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]


def slices(batches, column: str, most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Parts of the batches that hold at most ``most`` bytes of text or one row, with their texts."""
    for batch in batches:
        place = batch.schema.get_field_index(column)
        sizes = pc.fill_null(pc.binary_length(batch.column(place)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for row, size in enumerate(sizes.tolist()):
            if held and held + size > most:
                part = batch.slice(start, row - start)
                yield part, texts_of(part.column(place))
                start, held = row, 0
            held += size
        if start < batch.num_rows:
            part = batch.slice(start)
            yield part, texts_of(part.column(place))


class WordHash(dict):
    """The 64-bit hash of each word, remembered up to a fixed number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def word_hashes(words: list[bytes], cache: WordHash) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=len(words))


def one_per_document(docs: DataFrame, decided: DataFrame, mark) -> DataFrame:
    """The rows of ``docs`` that ``decided`` (doc_id, mark, kept) keeps, each document once.

    ``mark`` gives the column that ``decided`` calls mark from a row's text, so rows of one id
    but different texts are told apart. Rows that are equal in both are one document; one of them
    stays, whichever. All columns of ``docs`` come back, whatever their names.
    """
    decided = staged(decided.groupBy("doc_id", "mark").agg(F.max("kept").alias("kept"), F.count("*").alias("n")), "decided")
    odd = decided.where("not kept or n > 1")
    names = docs.columns
    whole = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.col("text").alias("t"))
    whole = whole.select("row", "id", mark(F.col("t")).alias("m"))
    same = whole["id"].eqNullSafe(odd["doc_id"]) & whole["m"].eqNullSafe(odd["mark"])
    kept = whole.join(odd, same, "left_anti").select("row")
    again = odd.where("kept")
    if not again.isEmpty():
        rows = whole.join(again, same).select("row", "doc_id", "mark").dropDuplicates(["doc_id", "mark"])
        kept = kept.unionByName(rows.select("row"))
    return kept.select([F.col("row").getField(name).alias(name) for name in names])
