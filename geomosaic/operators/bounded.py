"""Joins and ranks that stay whole and balanced whatever the key distribution is."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geomosaic.session import reliable_checkpoint, staged

BROADCAST_BYTES = 32 << 20
#: Rows of one group that a task numbers, rows looked at for a splitter, and ranges of a group at most.
ROWS_PER_TASK, SAMPLES, RANGES = 200_000, 32, 4096
_GROUP_LIMIT_KEY = "spark.sql.optimizer.windowGroupLimitThreshold"


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure in bytes whether a side is small. Summed per task, so that no rows move; give it
    a side that is checkpointed or stored."""
    fixed = 16 + 16 * len(df.columns)
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields if f.dataType.simpleString() == "string"]
    nested = [F.octet_length(F.to_json(f.name)) for f in df.schema.fields if f.dataType.simpleString().startswith(("array", "struct", "map"))]
    width = sum([*texts, *(F.coalesce(n, F.lit(0)) for n in nested)], F.lit(fixed))
    return (df.agg(F.sum(width.cast("long"))).first()[0] or 0) <= max_bytes


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which a null key meets a null key; the keys come from the left side."""
    renamed = right.withColumnsRenamed({c: f"_of_{c}" for c in on})
    same = reduce(and_, (left[c].eqNullSafe(renamed[f"_of_{c}"]) for c in on))
    return left.join(renamed, same, how).drop(*(f"_of_{c}" for c in on))


def join_measured(
    big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner", max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Broadcast ``small`` when its measured size allows it; else a shuffled join,
    whose hot partitions adaptive execution splits. ``small`` is computed once. Null keys meet null keys."""
    small = reliable_checkpoint(small)
    side = F.broadcast(small) if fits_broadcast(small, max_bytes) else small
    return join_null_safe(big, side, list(on), how)


def ranked(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str = "mosaic_rank", rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Exact 1-based rank inside each group, without one task per group.

    ``order`` has values, compared upwards with nulls first, the last of which make it total. The rows are written once.
    A group of up to ``rows_per_task`` rows is numbered by a window. A larger one is cut at splitters into ranges of
    about so many rows; each range is numbered apart, and the counts of the ranges before it are added.
    """
    placed = staged(df, "unranked")
    sizes = placed.groupBy(*group).agg(F.count("*").alias("_rows")).where(F.col("_rows") > rows_per_task)
    hot = staged(sizes, "hot-groups")
    number = F.row_number()
    if hot.isEmpty():
        return placed.withColumn(name, number.over(Window.partitionBy(*group).orderBy(*order)).cast("bigint"))
    cuts = splitters(placed, hot, group, order, rows_per_task)
    below = F.filter("_splitters", lambda s: s <= _key(order))
    tagged = join_measured(placed, cuts, group, "left").withColumn("_range", F.coalesce(F.size(below), F.lit(0))).drop("_splitters")
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # at most one row per range and group
    offsets = tagged.groupBy(*group, "_range").agg(F.count("*").alias("_rows"))
    offsets = offsets.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    inside = Window.partitionBy(*group, "_range").orderBy(*order)
    found = join_null_safe(tagged.withColumn(name, number.over(inside)), offsets, [*group, "_range"])
    return found.withColumn(name, (F.col(name) + F.col("_before")).cast("bigint")).drop("_range", "_before")


def _key(order: Sequence[Column]) -> Column:
    return F.struct(*[c.alias(f"o{k}") for k, c in enumerate(order)])


def splitters(df: DataFrame, hot: DataFrame, group: Sequence[str], order: Sequence[Column], rows_per_task: int) -> DataFrame:
    """For each group of ``hot`` (its keys and ``_rows``) ascending values of ``order`` that cut it into about even ranges.

    They come from rows chosen by a hash of their values, so a second evaluation gives the same ones.
    """
    rate = max(1, rows_per_task // SAMPLES)
    known = F.broadcast(hot) if fits_broadcast(hot) else hot
    chosen = join_null_safe(df, known.drop("_rows"), group).where(F.pmod(F.xxhash64(*group, *order), F.lit(rate)) == 0)
    keyed = chosen.select(*group, _key(order).alias("_key"))
    in_group = Window.partitionBy(*group)
    keyed = keyed.withColumns({"_n": F.row_number().over(in_group.orderBy("_key")), "_all": F.count("*").over(in_group)})
    step = F.greatest(F.lit(min(SAMPLES, rows_per_task)), F.ceil(F.col("_all") / F.lit(RANGES)))
    return keyed.where(F.col("_n") % step == 0).groupBy(*group).agg(F.sort_array(F.collect_list("_key")).alias("_splitters"))


def first_n(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, name: str = "mosaic_rank") -> DataFrame:
    """The first ``n`` rows of each group. Every task keeps at most ``n`` rows per group
    before the shuffle, so a hot group stays small; for an ``n`` beyond what Spark plans so, all rows are ranked (see ``ranked`` for the order)."""
    if n > int(df.sparkSession.conf.get(_GROUP_LIMIT_KEY)):
        return ranked(df, group, order, name).where(F.col(name) <= n)
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= n).withColumn(name, F.col(name).cast("bigint"))
