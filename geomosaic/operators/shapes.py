"""Shapes of rasters and datasets: footprints of few corners, outlines of covered cells."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geomosaic.functions import scales
from geomosaic.operators.bounded import join_null_safe
from geomosaic.session import staged

#: Fixed value: corners that a footprint may have.
MAX_CORNERS = 12


def footprint_corners(
    blocks: DataFrame, keys: Sequence[str], max_corners: int = MAX_CORNERS, low: float = scales.VALID_LOW, high: float = scales.VALID_HIGH
) -> DataFrame:
    """(keys, n_valid, corners, area): the convex hull of the valid pixels of each block, cut to ``max_corners``.

    Corners (x, y) run counter-clockwise from the lowest, of those the leftmost. While there are too many, the one
    whose loss costs least area goes, of equal ones the first. A block without valid pixels has no corners and no area. Works
    inside the row: nothing is exploded or moved. Needs the block columns of ``pixels``.
    """

    # all that a task runs is inside, so that executors need no copy of this package
    def cross(o, a, b):
        return (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])

    def half(points):
        out = []
        for p in points:
            while len(out) > 1 and cross(out[-2], out[-1], p) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    def corners_of(ends):
        """Hull in whole cells of (row, first column, last column); rows count downwards, so y is -row."""
        points = sorted({(x, y) for row, a, b in ends for x in (a, b + 1) for y in (-row, -row - 1)})
        ring = half(points) + half(points[::-1])
        first = min(range(len(ring)), key=lambda k: (ring[k][1], ring[k][0]))
        ring = ring[first:] + ring[:first]
        while len(ring) > max(max_corners, 3):
            costs = [cross(ring[k - 1], ring[k], ring[(k + 1) % len(ring)]) for k in range(len(ring))]
            del ring[costs.index(min(costs))]
        return ring

    def shape(values: pd.Series, n_cols: pd.Series, cell: pd.Series, x_min: pd.Series, y_max: pd.Series) -> pd.DataFrame:
        out = []
        for block, width, size, left, top in zip(values, n_cols, cell, x_min, y_max, strict=True):
            rows: dict[int, list[int]] = {}
            n_valid = 0
            for k, v in enumerate(() if block is None else block):
                if v is not None and low <= v <= high:
                    n_valid += 1
                    rows.setdefault(k // width, []).append(k % width)
            ring = corners_of([(r, min(c), max(c)) for r, c in rows.items()]) if rows else []
            twice = sum(a[0] * b[1] - a[1] * b[0] for a, b in zip(ring, ring[1:] + ring[:1], strict=True))
            places = [{"x": left + x * size, "y": top + y * size} for x, y in ring]
            out.append((n_valid, places, twice / 2 * size * size if ring else None))
        return pd.DataFrame(out, columns=["n_valid", "corners", "area"])

    made = F.pandas_udf(shape, "n_valid long, corners array<struct<x:double,y:double>>, area double")
    whole = [F.col(c).cast("double") for c in ("cell", "x_min", "y_max")]
    done = blocks.withColumn("_shape", made(F.col("values").cast("array<double>"), F.col("n_cols"), *whole))
    return done.select(*keys, "_shape.n_valid", "_shape.corners", "_shape.area")


# -- outlines: edges run with the cells on their left; directions are east, north, west, south --

_STEPS = ((0, 0, 0, 1, 0), (1, 1, 0, 1, 1), (2, 1, 1, 0, 1), (3, 0, 1, 0, 0))


def outline_edges(cells: DataFrame, group: str = "dataset") -> DataFrame:
    """(id, group, way, x0, y0, x1, y1): the unit edges of distinct cells (cell_x, cell_y) that no second cell shares."""
    x, y = F.col("cell_x"), F.col("cell_y")
    sides = [
        F.struct(F.lit(way).alias("way"), (x + a).alias("x0"), (y + b).alias("y0"), (x + c).alias("x1"), (y + d).alias("y1"))
        for way, a, b, c, d in _STEPS
    ]
    # a shared edge is there once in each direction, and both go
    edges = cells.select(group, F.explode(F.array(*sides)).alias("e")).select(group, "e.*")
    place = [group, F.least("x0", "x1").alias("px"), F.least("y0", "y1").alias("py"), (F.col("way") % 2).alias("upright")]
    kept = edges.groupBy(*place).agg(
        F.count("*").alias("n"), *[F.min(c).alias(c) for c in ("way", "x0", "y0", "x1", "y1")]
    ).where("n = 1")
    return kept.select(F.monotonically_increasing_id().alias("id"), group, "way", "x0", "y0", "x1", "y1")


def _followers(edges: DataFrame, group: str) -> DataFrame:
    """(id, next): the edge after each. Where cells touch at a corner only, the ring turns left and stays with its cell."""
    after = edges.select(group, F.col("id").alias("next"), F.col("way").alias("next_way"), F.col("x0").alias("x1"), F.col("y0").alias("y1"))
    met = join_null_safe(edges, after, [group, "x1", "y1"])
    # left, straight on, right
    turn = F.pmod(F.col("next_way") - F.col("way") - 1, F.lit(4))
    order = F.when(turn == 0, 0).when(turn == 3, 1).otherwise(2)
    return met.groupBy("id").agg(F.min_by("next", order).alias("next"))


def outline(cells: DataFrame, group: str = "dataset") -> DataFrame:
    """(group, ring, place, x, y): the corners of the rings around distinct cells, cell edge by cell edge.

    Outer rings run counter-clockwise, holes clockwise, so the sum of their areas is that of the cells. A ring is
    named by its smallest edge, at which it begins. Rings are found by pointer jumping: every edge doubles the stretch it
    knows in each round, by a join on the edge it points to, so no ring is gathered anywhere.
    """
    edges = staged(outline_edges(cells, group), "outline-edges")
    follows = staged(_followers(edges, group), "outline-next")

    def jumped(state: DataFrame, fold: Column) -> DataFrame:
        there = state.select(F.col("id").alias("to"), F.col("to").alias("_to"), F.col("known").alias("_known"))
        return state.join(there, "to").select("id", F.col("_to").alias("to"), fold.alias("known"))

    def settled(state: DataFrame, fold: Column) -> DataFrame:
        before = None
        while (now := state.agg(F.sum(F.col("known").cast("decimal(38,0)"))).first()[0]) != before:
            before = now
            state = staged(jumped(state, fold), "outline-jump")
        return state

    least = settled(follows.select("id", F.col("next").alias("to"), F.least("id", "next").alias("known")), F.least("known", "_known"))
    ring = staged(least.select("id", F.col("known").alias("ring")), "outline-rings")
    # from each edge to the last of its ring, which points to itself
    ways = follows.join(ring, "id")
    last = F.col("next") == F.col("ring")
    steps = ways.select("id", F.when(last, F.col("id")).otherwise(F.col("next")).alias("to"), F.when(last, 0).otherwise(1).cast("long").alias("known"))
    left = settled(steps, F.col("known") + F.col("_known")).select("id", F.col("known").alias("left"))
    placed = edges.join(ring, "id").join(left, "id")
    sizes = ring.groupBy("ring").agg(F.count("*").alias("n"))
    found = placed.join(sizes, "ring")
    return found.select(group, "ring", (F.col("n") - 1 - F.col("left")).alias("place"), F.col("x0").alias("x"), F.col("y0").alias("y"), "x1", "y1")


def ring_areas(rings: DataFrame, cell: float, group: str = "dataset") -> DataFrame:
    """(group, ring, n_edges, area): signed areas of the rings; those of holes are negative."""
    twice = F.col("x") * F.col("y1") - F.col("x1") * F.col("y")
    return rings.groupBy(group, "ring").agg(F.count("*").alias("n_edges"), (F.sum(twice) / 2 * F.lit(cell * cell)).alias("area"))
