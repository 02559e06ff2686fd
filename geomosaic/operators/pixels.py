"""Raster operators over block rows: pixels, regridding, clipping, stretching, lookups.

A block row has ``values`` row by row from the north-west corner, ``n_rows``, ``n_cols``,
``cell``, ``x_min`` and ``y_max``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geomosaic.functions import projection, scales
from geomosaic.operators import aggregates
from geomosaic.operators.bounded import join_measured


def explode_cells(blocks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per cell: ``row``, ``col`` and ``v``."""
    return blocks.select(*keys, "n_cols", F.posexplode("values").alias("_k", "v")).select(
        *keys,
        F.floor(F.col("_k") / F.col("n_cols")).alias("row"),
        (F.col("_k") % F.col("n_cols")).cast("bigint").alias("col"),
        "v",
    )


def explode_window(
    blocks: DataFrame, keys: Sequence[str], rows: tuple[Column, Column], cols: tuple[Column, Column]
) -> DataFrame:
    """Cells of a block inside closed row and column bounds; cells outside never become rows."""

    def span(bounds: tuple[Column, Column], size: str) -> Column:
        low = F.greatest(bounds[0], F.lit(0)).cast("bigint")
        high = F.least(bounds[1], F.col(size) - F.lit(1)).cast("bigint")
        return F.explode(F.when(low <= high, F.sequence(low, high)))

    return (
        blocks.withColumn("row", span(rows, "n_rows"))
        .withColumn("col", span(cols, "n_cols"))
        .select(*keys, "row", "col", F.get("values", (F.col("row") * F.col("n_cols") + F.col("col")).cast("int")).alias("v"))
    )


def value_at(x: Column, y: Column) -> Column:
    """Block value at a position; null outside of the block."""
    col = F.floor((x - F.col("x_min")) / F.col("cell"))
    row = F.floor((F.col("y_max") - y) / F.col("cell"))
    inside = col.between(0, F.col("n_cols") - 1) & row.between(0, F.col("n_rows") - 1)
    return F.when(inside, F.get("values", (row * F.col("n_cols") + col).cast("int")))


def resample_nearest(blocks: DataFrame, keys: Sequence[str], size: Column, top: float) -> DataFrame:
    """Nearest-neighbour regrid to cells of ``size`` metres, counted from (0, ``top``).

    Explodes the output cells whose centre lies in the block, never the source pixels.
    """
    x_max = F.col("x_min") + F.col("n_cols") * F.col("cell")
    y_min = F.col("y_max") - F.col("n_rows") * F.col("cell")
    # centres: x_min <= (c + 1/2) * cell < x_max, and top - (r + 1/2) * cell in (y_min, y_max]
    c_low, c_high = F.ceil(F.col("x_min") / size - 0.5), F.ceil(x_max / size - 0.5) - 1
    r_low, r_high = F.ceil((F.lit(top) - F.col("y_max")) / size - 0.5), F.ceil((F.lit(top) - y_min) / size - 0.5) - 1

    def span(low: Column, high: Column) -> Column:
        return F.when(low <= high, F.sequence(low, high))

    return (
        blocks.withColumn("out_col", F.explode(span(c_low, c_high)))
        .withColumn("out_row", F.explode(span(r_low, r_high)))
        .select(
            *keys,
            "out_col",
            "out_row",
            value_at((F.col("out_col") + 0.5) * size, F.lit(top) - (F.col("out_row") + 0.5) * size).alias("v"),
        )
    )


def clip(pixels: DataFrame, x: str, y: str, box: Sequence[Column]) -> DataFrame:
    """Pixels whose position lies in the closed box (x_min, y_min, x_max, y_max)."""
    return pixels.where(F.col(x).between(box[0], box[2]) & F.col(y).between(box[1], box[3]))


def stretch_deviation(pixels: DataFrame, view: Sequence[str], deviations: float = 2.0, value: str = "v") -> DataFrame:
    """Stretch by the deviation of the requested view only.

    The statistics have one row per view and are joined back on the view; with few
    views they are broadcast, so a hot view is never gathered.
    """
    stats = aggregates.statistics(pixels, view, value)
    low = F.greatest(F.col("v_min"), F.col("v_mean") - F.lit(deviations) * F.col("v_std"))
    high = F.least(F.col("v_max"), F.col("v_mean") + F.lit(deviations) * F.col("v_std"))
    bounds = stats.select(*view, low.alias("_low"), high.alias("_high"))
    return (
        join_measured(pixels, bounds, view)
        .withColumn("stretched", scales.stretch(F.col(value), F.col("_low"), F.col("_high")))
        .drop("_low", "_high")
    )


def project_extent(items: DataFrame, epsg: str = "epsg") -> DataFrame:
    """Source extents to web mercator, as the smallest box around the whole projected box.

    The edges of a projected UTM box are bent. On an edge of constant northing the latitude turns at the
    central meridian, on one of constant easting the longitude turns at the equator, and neither has an extreme inside.
    So each side of the envelope is found at one point that the position to meridian and equator gives.
    Latitudes beyond the square end at its edge. ``mx_min`` lies in the world's width from its
    western edge on; ``mx_max`` exceeds the eastern edge where the box crosses the antimeridian (see ``world_parts``).

    Rows keep null extents and say so in ``reject_reason``: ``epsg`` for an unsupported code, ``extent`` for a box that is
    null, infinite or inverted.
    """
    names = ("x_min", "y_min", "x_max", "y_max")
    code, world = F.col(epsg), F.lit(projection.WORLD)
    x0, y0, x1, y1 = (F.col(c).cast("double") for c in names)
    known = F.coalesce((x0 <= x1) & (y0 <= y1) & ~F.isnan(x1) & ~F.isnan(y1), F.lit(False))
    known = known & (F.greatest(*(F.abs(c) for c in (x0, y0, x1, y1))) < float("inf"))
    named = code.isin(3857, 4326) | projection.is_utm(code)
    y0, y1 = (F.when(code == 4326, F.greatest(F.lit(-90.0), F.least(F.lit(90.0), c))).otherwise(c) for c in (y0, y1))
    middle, level = F.lit(projection.FALSE_EASTING), projection.equator(code)

    def nearest(low: Column, high: Column, to: Column) -> Column:
        return F.greatest(low, F.least(to, high))

    def farthest(low: Column, high: Column, to: Column) -> Column:
        return F.when(to - low >= high - to, low).otherwise(high)

    def turning(low: Column, high: Column, to: Column, near: Column) -> Column:
        return F.when(near, nearest(low, high, to)).otherwise(farthest(low, high, to))

    xs = {"w": x0, "e": x1, "s": turning(x0, x1, middle, y0 < level), "n": turning(x0, x1, middle, y1 >= level)}
    ys = {"w": turning(y0, y1, level, x0 >= middle), "e": turning(y0, y1, level, x1 < middle), "s": y0, "n": y1}
    placed = projection.to_mercator(items, epsg, xs, ys, [(side, side) for side in "wesn"])
    west, east = F.col("mx_ww"), F.col("mx_ee")
    turns = F.floor((west + world) / (2 * world)) * (2 * world)
    whole, fine = east - west >= 2 * world, known & named
    sides = {
        "mx_min": F.when(whole, -world).otherwise(west - turns),
        "my_min": F.greatest(-world, F.least(world, F.col("my_ss"))),
        "mx_max": F.when(whole, world).otherwise(east - turns),
        "my_max": F.greatest(-world, F.least(world, F.col("my_nn"))),
    }
    reason = F.when(~F.coalesce(named, F.lit(False)), F.lit("epsg")).when(~known, F.lit("extent"))
    out = placed.withColumns({name: F.when(fine, side) for name, side in sides.items()} | {"reject_reason": reason})
    return out.drop(*[f"{m}_{side}{side}" for m in ("mx", "my") for side in "wesn"])


def world_parts(df: DataFrame, x_min: str = "x_min", x_max: str = "x_max", prefix: str = "_part") -> DataFrame:
    """A row for each part of a box that lies in the world: two where it crosses the antimeridian.

    Adds the number of the part, and its sides as ``{prefix}_min`` and ``{prefix}_max``.
    """
    world = F.lit(projection.WORLD)
    low, high = F.col(x_min).cast("double"), F.col(x_max).cast("double")

    def part(number: int, start: Column, end: Column) -> Column:
        return F.struct(F.lit(number).alias(prefix), start.alias(f"{prefix}_min"), end.alias(f"{prefix}_max"))

    first, second = part(0, low, F.least(high, world)), part(1, -world, high - 2 * world)
    crossing = F.coalesce(high > world, F.lit(False))
    uncut = part(0, low, high)
    return df.select("*", F.inline(F.when(crossing, F.array(first, second)).otherwise(F.array(uncut))))
