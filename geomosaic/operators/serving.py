"""A served request from end to end: which items, in which order, how many, and the image they make."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geomosaic.functions import scales
from geomosaic.operators import mosaic, pixels
from geomosaic.operators.bounded import join_measured
from geomosaic.session import staged


@dataclass(frozen=True)
class Family:
    """How a family of datasets is served: its order of items, items per request, and pixel function."""

    order: Callable[[], Sequence[Column]]
    cap: int
    pixel: Callable[[Column], Column]


def too_large(cell: str = "cell") -> Column:
    """Whether a request asks for more rows or columns than one image may have."""
    cols, rows = (F.ceil((F.col(f"r{c}_max") - F.col(f"r{c}_min")) / F.col(cell)) for c in "xy")
    return (cols > mosaic.MAX_IMAGE_COLS) | (rows > mosaic.MAX_IMAGE_ROWS)


def chosen_items(items: DataFrame, requests: DataFrame, families: Mapping[str, Family], item_family: str, request_family: str) -> DataFrame:
    """(request_id, item_family, name, mosaic_rank): the leading items that each request shows, of its own family.

    ``items`` and ``requests`` as for ``mosaic.select_items``, each with a column that names the family. Requests that are too large get none.
    The orders of ``families`` follow from the items alone, so requests meet the leading items of their family only (``mosaic.cap_met``).
    """
    asked = requests.where(~too_large() & F.col(request_family).isin(*families))

    def shown(stretch: DataFrame, waiting: DataFrame) -> DataFrame:
        return mosaic.select_items(stretch, waiting).select("request_id", item_family, "name", "_place")

    capped = [
        mosaic.cap_met(items.where(F.col(item_family) == name), asked.where(F.col(request_family) == name), shown, family.order(), family.cap)
        for name, family in families.items()
    ]
    out = capped[0]
    for more in capped[1:]:
        out = out.unionByName(more)
    return out.select("request_id", item_family, "name", "mosaic_rank")


def serve(
    items: DataFrame,
    requests: DataFrame,
    blocks: DataFrame,
    families: Mapping[str, Family],
    top: float,
    item_family: str = "dataset",
    request_family: str = "asked",
) -> DataFrame:
    """(request_id, out_row, out_col, v): the image of every request, its cells counted from (0, ``top``).

    An image has the cells whose centres lie in the request's box. Under a centre the leading chosen item with a valid
    pixel wins, resampled to the request's cell size, and the family's pixel function is applied to what was merged. Cells that
    no item covers have no row. ``blocks`` has the block columns of ``pixels`` with ``name`` and the family of its item,
    overviews among them. Blocks of items that no request shows are left out where they are read, as far as the list of
    chosen items is small enough to be sent to them; else both sides are shuffled by item.
    """
    chosen = chosen_items(items, requests, families, item_family, request_family)
    shown = chosen.join(requests.select("request_id", "rx_min", "ry_min", "rx_max", "ry_max", F.col("cell").alias("out_cell")), "request_id")
    placed = join_measured(blocks, staged(shown, "served-items"), [item_family, "name"])
    keys = ["request_id", item_family, "mosaic_rank"]
    cut = _cut_to_request(placed, top)
    cells = cut.select(
        *keys, "out_col", "out_row", pixels.value_at((F.col("out_col") + 0.5) * F.col("out_cell"), F.lit(top) - (F.col("out_row") + 0.5) * F.col("out_cell")).alias("v")
    ).withColumn("v", scales.valid(F.col("v")))
    merged = mosaic.first_merge(cells, ["request_id", item_family, "out_row", "out_col"])
    value = F.lit(None).cast("double")
    for name, family in families.items():
        value = F.when(F.col(item_family) == name, family.pixel(F.col("v"))).otherwise(value)
    return merged.select("request_id", "out_row", "out_col", value.alias("v"))


def _cut_to_request(placed: DataFrame, top: float) -> DataFrame:
    """A row for each output cell whose centre lies in both the block and the request; no other pixel becomes a row."""
    size = F.col("out_cell")
    x_max = F.least(F.col("x_min") + F.col("n_cols") * F.col("cell"), F.col("rx_max"))
    y_min = F.greatest(F.col("y_max") - F.col("n_rows") * F.col("cell"), F.col("ry_min"))
    x_min, y_max = F.greatest("x_min", "rx_min"), F.least("y_max", "ry_max")
    # centres: x_min <= (c + 1/2) * size <= x_max, and the like from the top; the block's own edges are kept by value_at
    c_low, c_high = F.ceil(x_min / size - 0.5), F.floor(x_max / size - 0.5)
    r_low, r_high = F.ceil((F.lit(top) - y_max) / size - 0.5), F.floor((F.lit(top) - y_min) / size - 0.5)

    def span(low: Column, high: Column) -> Column:
        return F.explode(F.when(low <= high, F.sequence(low, high)))

    return placed.withColumn("out_col", span(c_low, c_high)).withColumn("out_row", span(r_low, r_high))
