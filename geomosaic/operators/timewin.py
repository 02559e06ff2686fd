"""Trailing ranges and sliding extents over item dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geomosaic.functions import dates


def daily_counts(items: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Items per day: all that later windows need, a small part of the input."""
    day = F.to_date("start_date")
    return items.groupBy(*group, day.alias("day")).agg(
        F.count("*").alias("n"), F.min("start_date").alias("first_start"), F.max("start_date").alias("last_start")
    )


def trailing_range(items: DataFrame, as_of: Column) -> DataFrame:
    """Every day of the trailing 52 weeks with its item count, also the empty days."""
    low, high = dates.range_start(as_of), dates.range_end(as_of)
    days = items.sparkSession.range(1).select(
        F.explode(F.sequence(F.to_date(low), F.to_date(high), F.expr("interval 1 day"))).alias("day")
    )
    held = daily_counts(items.where(F.col("start_date").between(low, high)))
    return days.join(held, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n_items"))


def sliding_extent(items: DataFrame, as_of: Column, group: Sequence[str] = (), days: int = 7 * dates.EXTENT_WEEKS) -> DataFrame:
    """Windows of three weeks that step by a day across the trailing range.

    Rows of the range are counted per day first; only those counts are put into windows.
    """
    low, high = F.to_date(dates.range_start(as_of)), F.to_date(dates.range_end(as_of))
    steps = F.explode(F.sequence(F.lit(0), F.lit(days - 1)))
    inside = items.where((F.col("start_date") >= low) & (F.col("start_date") < high))
    placed = daily_counts(inside, group).withColumn("_back", steps)
    placed = placed.withColumn("window_start", F.expr("day - _back")).withColumn(
        "window_end", F.date_add("window_start", days)
    )
    return (
        placed.where((F.col("window_end") <= high) & (F.col("window_start") >= low))
        .groupBy(*group, "window_start", "window_end")
        .agg(
            F.sum("n").alias("n_items"),
            F.min("first_start").alias("first_start"),
            F.max("last_start").alias("last_start"),
        )
    )
