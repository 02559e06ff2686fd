"""Stored overviews: the mosaic of a dataset at its overview cell, kept up to date block by block.

The store is a table of cells, laid out by dataset and block of the output grid. A cell holds its value and
the item it came from with that item's place in the order: the gap of its date, then its name. That is
enough to decide against any later item, so a run looks at the blocks its new items touch and at nothing else.
An update can be repeated: the same items give the same cells.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geomosaic.functions import scales
from geomosaic.operators import catalog, mosaic, pixels
from geomosaic.operators.bounded import join_measured, ranked
from geomosaic.session import staged

#: Cells of a block along each side.
BLOCK = 256
#: Blocks that a filter on the store's folders names; an update of more reads the whole store.
NAMED_BLOCKS = 10_000
_ITEM = ["dataset", "gap", "name"]


def block_of(size: int) -> Column:
    """The block of an output cell, as the text that names its folder."""
    row, col = (F.floor(F.col(c) / F.lit(size)).cast("string") for c in ("out_row", "out_col"))
    return F.concat_ws("_", row, col)


def dirty_blocks(blocks: DataFrame, cell: Column, top: float, size: int = BLOCK) -> DataFrame:
    """(dataset, block) of every block of the output grid that the extents of ``blocks`` touch; pixels are not read."""
    x_max = F.col("x_min") + F.col("n_cols") * F.col("cell")
    y_min = F.col("y_max") - F.col("n_rows") * F.col("cell")
    span = cell * F.lit(size)

    def reach(low: Column, high: Column) -> Column:
        return F.explode(F.sequence(F.floor(low / span), F.floor(high / span)))

    rows = blocks.select("dataset", reach(F.lit(top) - F.col("y_max"), F.lit(top) - y_min).alias("r"), "x_min", x_max.alias("x_max"), cell.alias("_c"))
    placed = rows.withColumn("c", F.explode(F.sequence(F.floor(F.col("x_min") / (F.col("_c") * size)), F.floor(F.col("x_max") / (F.col("_c") * size)))))
    return placed.select("dataset", F.concat_ws("_", F.col("r").cast("string"), F.col("c").cast("string")).alias("block")).distinct()


def read_store(spark: SparkSession, store: str) -> DataFrame | None:
    """The cells of a store, or None before its first run."""
    try:
        return spark.read.schema("out_row long, out_col long, v double, gap long, name string, dataset string, block string").parquet(store)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def held_cells(store: DataFrame, dirty: DataFrame) -> DataFrame:
    """The cells of the dirty blocks; the folders of other blocks are not read.

    The filter names the blocks, whose number the output grid bounds.
    """
    named = [r.block for r in dirty.select("block").distinct().limit(NAMED_BLOCKS + 1).collect()]
    if len(named) <= NAMED_BLOCKS:
        store = store.where(F.col("block").isin(named))
    return store.join(dirty, ["dataset", "block"], "left_semi")


def update(store: str, blocks: DataFrame, items: DataFrame, cell: Column, top: float, size: int = BLOCK) -> str:
    """Merge new items into a store and rewrite the blocks they touch.

    ``blocks`` has ``dataset``, ``name`` and the block columns of ``pixels``, ``items`` has ``dataset``, ``name`` and
    ``start_date`` of the same items, without pixels; names are unique in a dataset. ``cell`` is the cell size of a row's
    dataset, counted from (0, ``top``). The leading item with a valid pixel under a cell's centre wins, over all runs.
    """
    spark = blocks.sparkSession
    gap = mosaic.by_attribute()[1].alias("gap")
    new = items.select("dataset", gap, "name")
    dirty = staged(dirty_blocks(blocks, cell, top, size), "dirty-blocks")
    known = read_store(spark, store)
    held = held_cells(known, dirty) if known is not None else None
    if held is not None:
        held = staged(held, "held-cells")
        new = new.unionByName(held.select(*_ITEM)).distinct()
    order = staged(ranked(new, ["dataset"], [F.col("gap").isNull(), F.col("gap"), F.col("name")]), "item-order")

    placed = join_measured(blocks, order.select("dataset", "name", "mosaic_rank"), ["dataset", "name"])
    cells = pixels.resample_nearest(placed, ["dataset", "mosaic_rank"], cell, top)
    cells = cells.withColumn("v", scales.valid(F.col("v")))
    if held is not None:
        ranked_cells = join_measured(held, order, _ITEM)
        cells = cells.unionByName(ranked_cells.select(*cells.columns))
    merged = mosaic.first_merge(cells, ["dataset", "out_col", "out_row"])
    named = join_measured(merged.drop("n_candidates"), order, ["dataset", "mosaic_rank"])
    done = staged(named.withColumn("block", block_of(size)).drop("mosaic_rank"), "merged-cells")
    # the store is read above, so it is written from the copy
    laid = done.repartition("dataset", "block").sortWithinPartitions("dataset", "block", "out_row", "out_col")
    writer = laid.select("out_row", "out_col", "v", "gap", "name", "dataset", "block").write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("dataset", "block").parquet(store)
    return store


def records(store: DataFrame, sources: DataFrame, cell: Column, top: float, names: Column) -> DataFrame:
    """One overview record per dataset: extent and cell size as written in the store, dates and tag of its source items.

    A dataset of which nothing was written has no record.
    """
    edges = store.groupBy("dataset").agg(
        F.min("out_col").alias("c0"), F.max("out_col").alias("c1"), F.min("out_row").alias("r0"), F.max("out_row").alias("r1")
    )
    written = edges.select(
        "dataset",
        (F.col("c0") * cell).alias("x_min"),
        (F.lit(top) - (F.col("r1") + 1) * cell).alias("y_min"),
        ((F.col("c1") + 1) * cell).alias("x_max"),
        (F.lit(top) - F.col("r0") * cell).alias("y_max"),
        cell.alias("low_ps"),
        (F.col("c1") - F.col("c0") + 1).cast("int").alias("n_cols"),
        (F.col("r1") - F.col("r0") + 1).cast("int").alias("n_rows"),
    )
    found = catalog.overview_records(sources, names).drop("x_min", "y_min", "x_max", "y_max")
    return join_measured(found, written, ["dataset"])
