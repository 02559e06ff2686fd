"""Exact token counts from a length histogram.

Documents are counted by encoded length; sums over the lengths from each one on answer totals,
quantiles and truncated totals for every context limit, without another look at a text. The
histogram has as many rows as there are distinct lengths. Its running sums are taken in blocks
of lengths, then over blocks, so no step gathers it in one task.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geomosaic.llm.bpe_codec import TOKENIZER
from geomosaic.llm.bpe_words import ByteTokenizer, Remembered
from geomosaic.llm.common import slices, staged

#: Lengths in a block.
BLOCK = 1024


def lengths(docs: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """(doc_id, length): the encoded length of each row's whole text; null counts as empty."""

    def run(batches):
        tokenizer = ByteTokenizer(path)
        remembered = Remembered(lambda pieces: [len(tokenizer.merge(p)) // 4 for p in pieces])
        for part, texts in slices(batches, "text"):
            cuts = [tokenizer.cut(t.decode()) for t in texts]
            remembered.learn(cuts)
            found = pa.array([sum(map(remembered.__getitem__, c)) for c in cuts], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0), found], ["doc_id", "length"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(run, "doc_id long, length long")


def histogram(measured: DataFrame) -> DataFrame:
    """One row per distinct length, with the sums over all documents of that length or more.

    (length, n_docs, docs_from, tokens_from, total_docs, total_tokens, truncated_tokens, share_up_to):
    truncated_tokens is what is left of all documents under a context limit of this length, share_up_to the
    part of documents that fit. Null lengths are left out; no rows give no rows.
    """
    counted = measured.where("length is not null").groupBy("length").agg(F.count("*").alias("n_docs"))
    counted = staged(counted.withColumn("block", F.floor(F.col("length") / BLOCK)), "lengths")
    tokens = F.col("n_docs") * F.col("length")
    blocks = counted.groupBy("block").agg(F.sum("n_docs").alias("docs"), F.sum(tokens).alias("tokens"))
    whole = Window.partitionBy(F.lit(0))
    later = whole.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        "block",
        _sum("docs", later).alias("docs_later"),
        _sum("tokens", later).alias("tokens_later"),
        F.sum("docs").over(whole).alias("total_docs"),
        F.sum("tokens").over(whole).alias("total_tokens"),
    )
    inner = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    rows = counted.select(
        "block", "length", "n_docs", F.sum("n_docs").over(inner).alias("docs_in"), F.sum(tokens).over(inner).alias("tokens_in")
    ).join(blocks, "block")
    rows = rows.select(
        "length",
        "n_docs",
        (F.col("docs_in") + F.col("docs_later")).alias("docs_from"),
        (F.col("tokens_in") + F.col("tokens_later")).alias("tokens_from"),
        "total_docs",
        "total_tokens",
    )
    truncated = F.col("total_tokens") - F.col("tokens_from") + F.col("length") * F.col("docs_from")
    fits = (F.col("total_docs") - F.col("docs_from") + F.col("n_docs")) / F.col("total_docs")
    return rows.withColumns({"truncated_tokens": truncated, "share_up_to": fits})


def _sum(column: str, window) -> Column:
    return F.coalesce(F.sum(column).over(window), F.lit(0))


def truncated_total(histogram_rows: DataFrame, limit: int) -> int:
    """Tokens left when every document is cut to ``limit``: from the first length not below it."""
    row = histogram_rows.where(F.col("length") >= limit).orderBy("length").first()
    if row is None:
        row = histogram_rows.first()
        return row["total_tokens"] if row else 0
    return row["total_tokens"] - row["tokens_from"] + limit * row["docs_from"]


def quantile(histogram_rows: DataFrame, share: float) -> int | None:
    """The smallest length that at least ``share`` of the documents do not exceed."""
    row = histogram_rows.where(F.col("share_up_to") >= share).orderBy("length").first()
    return row["length"] if row else None
