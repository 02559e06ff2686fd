"""Exact duplicates of an incoming batch against immutable snapshots.

Every text is stripped of white space and named by SHA-256. A snapshot is a fixed table of one row per
distinct text, dealt into buckets by a 64-bit key, with one static binary fuse filter per bucket. A
batch is first grouped within itself. Its distinct digests pass the filters; what a filter does
not know is new and meets no other table, and the positives are joined with the exact buckets. The
texts of every group of two or more are then compared byte by byte.

A filter takes 9 to 10 bits a digest and stands beside its bucket only; nothing is sent to all tasks.
Groups are combined before each shuffle, so a text with very many copies is one row per task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geomosaic.llm import fuse_filter
from geomosaic.llm.common import one_per_document, staged

#: Distinct texts in a bucket, about.
BUCKET_ROWS = 100_000
_CLASS = "key long, sha string, keep_id long, keep_chars int, n long, bucket long"


def normalised(text: Column) -> Column:
    """The text without white space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \t-\r]+", "")


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, sha, key) of each row; n_chars counts the original text."""
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.length("text"), F.lit(0)).alias("n_chars"),
        F.sha2(normalised(F.col("text")).cast("binary"), 256).alias("sha"),
    )
    return slim.withColumn("key", F.xxhash64("sha"))


def classes(rows: DataFrame, buckets: int) -> DataFrame:
    """One row per distinct text: its size, and the row that stays (most characters, then smallest id)."""
    ids = rows.groupBy("key", "sha", "n_chars").agg(F.min("doc_id").alias("id"), F.count("*").alias("n"))
    whole = ids.groupBy("key", "sha").agg(
        F.max_by("id", "n_chars").alias("keep_id"), F.max("n_chars").alias("keep_chars"), F.sum("n").alias("n")
    )
    return whole.withColumn("bucket", F.pmod("key", F.lit(buckets)))


def _merged(parts: DataFrame) -> DataFrame:
    """Classes of several tables as one per text, by the same rule."""
    ids = parts.groupBy("key", "sha", "keep_chars").agg(F.min("keep_id").alias("id"), F.sum("n").alias("n"))
    return ids.groupBy("key", "sha").agg(
        F.max_by("id", "keep_chars").alias("keep_id"), F.max("keep_chars").alias("keep_chars"), F.sum("n").alias("n")
    )


@dataclass(frozen=True)
class Snapshot:
    """Exact buckets (one row per distinct text) and their filters (bucket, filter)."""

    exact: DataFrame
    filters: DataFrame
    buckets: int


def snapshot(rows: DataFrame, buckets: int) -> Snapshot:
    """Write the buckets and filters of ``digests`` rows; neither is changed later."""
    exact = staged(classes(rows, buckets), "exact-buckets")

    def build(key: tuple, table: pa.Table) -> pa.Table:
        keys = np.unique(table.column("key").to_numpy().view(np.uint64))
        return pa.table({"bucket": [key[0].as_py()], "filter": [fuse_filter.build(keys)]})

    made = exact.select("bucket", "key").groupBy("bucket").applyInArrow(build, "bucket long, filter binary")
    return Snapshot(exact, staged(made, "fuse-filters"), buckets)


def screen(batch: DataFrame, known: Snapshot) -> DataFrame:
    """The classes of a batch with ``maybe``: false where the snapshot certainly lacks the text."""

    def ask(rows: pa.Table, filters: pa.Table) -> pa.Table:
        keys = rows.column("key").to_numpy().view(np.uint64)
        maybe = np.zeros(len(keys), bool)
        for made in filters.column("filter").to_pylist():
            maybe |= fuse_filter.contains(made, keys)
        return rows.append_column("maybe", pa.array(maybe)).cast(_SCREENED)

    columns = [name.split()[0] for name in _CLASS.split(", ")]
    pair = batch.select(columns).groupBy("bucket").cogroup(known.filters.groupBy("bucket"))
    return pair.applyInArrow(ask, f"{_CLASS}, maybe boolean")


_SCREENED = pa.schema(
    [("key", pa.int64()), ("sha", pa.string()), ("keep_id", pa.int64()), ("keep_chars", pa.int32()),
     ("n", pa.int64()), ("bucket", pa.int64()), ("maybe", pa.bool_())]
)


def groups(rows: DataFrame, in_snapshot: Column) -> DataFrame:
    """One class per distinct text of ``digests`` rows, the marked ones taken as an older snapshot."""
    buckets = max(1, -(-rows.count() // BUCKET_ROWS))
    known = snapshot(rows.where(in_snapshot), buckets)
    batch = staged(screen(classes(rows.where(~in_snapshot), buckets), known), "screened")
    columns = ["key", "sha", "keep_id", "keep_chars", "n"]
    positive = batch.where("maybe").select(columns)
    met = _merged(known.exact.select(columns).unionByName(positive))
    return met.unionByName(batch.where("not maybe").select(columns))


def check_bytes(docs: DataFrame, rows: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` again, where each group's stripped texts are equal byte by byte; else the job stops.

    Only rows of groups of two or more are read again. Least and greatest text are taken in each task first.
    """
    shared = found.where("n > 1").select("sha")
    members = rows.join(shared, "sha", "left_semi").select(F.col("doc_id").alias("member"), F.col("sha").alias("of")).distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(F.col("text")).alias("bare"))
    pairs = texts.join(members, texts["doc_id"].eqNullSafe(members["member"]))
    pairs = pairs.where(F.sha2(F.col("bare").cast("binary"), 256) == F.col("of"))
    ends = pairs.groupBy(F.col("of").alias("sha")).agg(F.min("bare").alias("a"), F.max("bare").alias("b"))
    same = ends.select("sha", F.assert_true(F.col("a") == F.col("b"), "two texts have one SHA-256").isNull().alias("same"))
    return found.join(same.where("same"), "sha", "left_semi").unionByName(found.where("n = 1"))


def exact_duplicates(docs: DataFrame, in_snapshot: Column | None = None) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256, n_chars) of each row of ``docs`` (doc_id, text, ...).

    ``in_snapshot`` is a condition on doc_id that tells the older snapshot from the incoming batch;
    by default half of the ids are one and half the other. The result does not depend on it.
    Null and empty texts are one group. Repeated rows count in the group's size and give a row each,
    all kept if one is. A null id is never the one that stays unless all are null. Other columns are ignored.
    """
    if in_snapshot is None:
        in_snapshot = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    rows = staged(digests(docs), "digests")
    found = staged(groups(rows, in_snapshot), "groups")
    sure = check_bytes(docs, rows, found)
    joined = rows.select("doc_id", "n_chars", "sha").join(sure.select("sha", "keep_id", "keep_chars", "n"), "sha")
    return joined.select(
        "doc_id",
        "keep_id",
        F.col("n").alias("group_size"),
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("keep_chars"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
        "n_chars",
    )


def _mark(text: Column) -> Column:
    return F.xxhash64(F.sha2(normalised(text).cast("binary"), 256), F.coalesce(F.length(text), F.lit(0)))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, of which each text is kept once."""
    found = exact_duplicates(docs)
    decided = found.select("doc_id", F.xxhash64("text_sha256", "n_chars").alias("mark"), "kept")
    return one_per_document(docs, decided, _mark)
