"""Aggregates over items, blocks and pixels. All of them combine before the shuffle."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geomosaic.functions import dates, scales
from geomosaic.operators.bounded import join_measured

STATISTICS_SKIP = 5
RANGE_FACTOR = 10
# Fixed value: cell sizes within this share of one another are similar.
SIZE_TOLERANCE = 0.8


def overview_extent(items: DataFrame, group: Sequence[str]) -> DataFrame:
    """Time range of an overview: first and last start date, eight hours wider."""
    return items.groupBy(*group).agg(
        dates.overview_start(F.min("start_date")).alias("overview_start"),
        dates.overview_end(F.max("start_date")).alias("overview_end"),
    )


def ingest_counts(listing: DataFrame, catalog: DataFrame) -> DataFrame:
    """Found paths in the catalog and paths to add, in one pass over both sides."""
    marks = listing.select("path", F.lit(1).alias("listed"), F.lit(0).alias("held")).unionByName(
        catalog.select("path", F.lit(0).alias("listed"), F.lit(1).alias("held"))
    )
    per_path = marks.groupBy("path").agg(
        F.max("listed").alias("listed"), F.max("held").alias("held"), F.sum("held").alias("rows_held")
    )
    return per_path.agg(
        F.coalesce(F.sum("rows_held"), F.lit(0)).alias("n_found"),
        F.count_if((F.col("listed") == 1) & (F.col("held") == 0)).alias("n_added"),
    )


def any_tag(items: DataFrame) -> DataFrame:
    """One tag per dataset, always the same one, with its polarization."""
    # distinct first, on hashes: the least of a text takes a sort, which then sees a row per tag
    tags = items.select("dataset", "tag").distinct()
    return tags.groupBy("dataset").agg(F.min("tag").alias("tag")).withColumn(
        "polarization", F.element_at(F.split("tag", "_"), -1)
    )


def boundary(items: DataFrame) -> DataFrame:
    """Envelope of all footprints of a dataset."""
    return items.groupBy("dataset").agg(
        F.min("x_min").alias("x_min"),
        F.min("y_min").alias("y_min"),
        F.max("x_max").alias("x_max"),
        F.max("y_max").alias("y_max"),
        F.count("*").alias("n_items"),
    )


def covered_cells(items: DataFrame, cell: float) -> DataFrame:
    """Grid cells that a dataset's footprints touch, each once."""
    first, size = F.floor, F.lit(cell)

    def span(low: str, high: str) -> Column:
        # a footprint does not touch the cell that begins at its upper edge
        return F.sequence(first(F.col(low) / size), F.greatest(F.ceil(F.col(high) / size) - 1, first(F.col(low) / size)))

    return (
        items.select("dataset", "x_min", "y_min", "x_max", "y_max")
        .withColumn("cell_x", F.explode(span("x_min", "x_max")))
        .withColumn("cell_y", F.explode(span("y_min", "y_max")))
        .select("dataset", "cell_x", "cell_y")
        .distinct()
    )


def footprint(blocks: DataFrame, keys: Sequence[str], low: float = scales.VALID_LOW, high: float = scales.VALID_HIGH) -> DataFrame:
    """Rectangle of valid pixels of each block, inside the row: no explode, no shuffle.

    Needs ``values`` (row by row), ``n_cols``, ``cell``, ``x_min`` and ``y_max``.
    """
    hits = F.filter(
        F.transform(
            "values", lambda v, i: F.when(v.between(F.lit(low), F.lit(high)), i)
        ),
        lambda i: i.isNotNull(),
    )
    out = blocks.withColumn("_hits", hits)
    rows = F.transform("_hits", lambda i: F.floor(i / F.col("n_cols")))
    cols = F.transform("_hits", lambda i: i % F.col("n_cols"))
    return out.select(
        *keys,
        F.size("_hits").cast("bigint").alias("n_valid"),
        (F.col("x_min") + F.array_min(cols) * F.col("cell")).alias("fx_min"),
        (F.col("y_max") - (F.array_max(rows) + 1) * F.col("cell")).alias("fy_min"),
        (F.col("x_min") + (F.array_max(cols) + 1) * F.col("cell")).alias("fx_max"),
        (F.col("y_max") - F.array_min(rows) * F.col("cell")).alias("fy_max"),
    )


def sampled_pixels(blocks: DataFrame, keys: Sequence[str], skip: int = STATISTICS_SKIP) -> DataFrame:
    """Every ``skip``-th row and column of each block; only those cells are exploded."""
    return (
        blocks.withColumn("row", F.explode(F.sequence(F.lit(0), F.col("n_rows") - 1, F.lit(skip))))
        .withColumn("col", F.explode(F.sequence(F.lit(0), F.col("n_cols") - 1, F.lit(skip))))
        .select(*keys, "row", "col", F.get("values", F.col("row") * F.col("n_cols") + F.col("col")).alias("v"))
    )


def statistics(pixels: DataFrame, group: Sequence[str], value: str = "v") -> DataFrame:
    """Minimum, maximum, mean, population deviation and count of the valid pixels."""
    v = F.col(value)
    return pixels.groupBy(*group).agg(
        F.min(v).alias("v_min"),
        F.max(v).alias("v_max"),
        F.avg(v).alias("v_mean"),
        F.stddev_pop(v).alias("v_std"),
        F.count(v).alias("n_pixels"),
    )


def histogram(pixels: DataFrame, group: Sequence[str], bins: int, value: str = "v") -> DataFrame:
    """Counts per bin of equal width between the least and the greatest value of each group.

    The upper edge belongs to the last bin, a group of one value to the first. Nulls and NaN are left out; every
    other pixel is counted. The ends of the groups come first; with them each pixel is put into its bin where it
    lies, and counts per bin are combined before they move. Give it pixels that are cheap to read again.
    """
    v = F.col(value)
    valid = pixels.where(v.isNotNull() & ~F.isnan(v)).select(*group, v.alias("_v"))
    ends = valid.groupBy(*group).agg(F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    placed = join_measured(valid, ends, group)
    bin_number = F.least(F.width_bucket("_v", "_low", "_high", F.lit(bins)), F.lit(bins).cast("bigint"))
    bin_number = F.when(F.col("_low") < F.col("_high"), bin_number).otherwise(F.lit(1).cast("bigint"))
    return placed.groupBy(*group, bin_number.alias("bin")).agg(F.count("*").alias("n_pixels"))


def cell_size_ranges(items: DataFrame, factor: int = RANGE_FACTOR) -> DataFrame:
    """Lowest and highest pixel size of each item; ``min_ps`` and ``max_ps`` stay."""
    low = (F.col("x_max") - F.col("x_min")) / F.col("n_cols")
    return items.withColumn("low_ps", low).withColumn("high_ps", F.col("low_ps") * factor)


def cell_size_groups(items: DataFrame, tolerance: float = SIZE_TOLERANCE, group: str = "dataset") -> DataFrame:
    """(group, size_group, n_items, size_min, size_max): the cell sizes of each dataset, similar ones together.

    Sizes (``low_ps``) belong together while each is at least ``tolerance`` of the next larger one. Sizes are folded on a
    logarithmic scale whose steps are narrower than a gap, so only a few thousand rows of a dataset
    are compared, however many sizes it has. Null and non-positive sizes are left out.
    """
    size = F.col("low_ps")
    step = F.floor(F.log(size) / F.lit(-math.log(tolerance) / 2))
    folded = items.where(size > 0).groupBy(group, step.alias("step")).agg(
        F.count("*").alias("n"), F.min(size).alias("low"), F.max(size).alias("high")
    )
    in_order = Window.partitionBy(group).orderBy("step")
    gap = F.coalesce((F.lag("high").over(in_order) < F.col("low") * tolerance).cast("long"), F.lit(1))
    named = folded.withColumn("gap", gap).withColumn("size_group", F.sum("gap").over(in_order))
    return named.groupBy(group, "size_group").agg(
        F.sum("n").alias("n_items"), F.min("low").alias("size_min"), F.max("high").alias("size_max")
    )


def coverage_grid(
    catalog: DataFrame, products: Sequence[str], polarizations: Sequence[str], season_codes: Sequence[str]
) -> DataFrame:
    """Item count of every expected dataset, with the gaps; the grid is the three lists."""

    def each(values: Sequence[str]) -> Column:
        return F.explode(F.array(*[F.lit(v) for v in values]))

    grid = (
        catalog.sparkSession.range(1)
        .select(each(products).alias("product_type"))
        .withColumn("polarization", each(polarizations))
        .withColumn("season_code", each(season_codes))
        .withColumn("dataset", F.concat_ws("_", "product_type", "polarization", "season_code"))
    )
    held = catalog.groupBy("dataset").agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0))
    return grid.join(held, "dataset", "left").select(
        "dataset", "product_type", "polarization", "season_code", n.alias("n_items"), (n == 0).alias("is_gap")
    )
