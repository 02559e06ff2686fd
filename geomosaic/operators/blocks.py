"""FIRST over whole blocks, for mosaics at full resolution.

``mosaic.first_merge`` moves one row per cell and task. Where blocks hardly overlap that
is one row per pixel, many times the size of the pixels. Here block arrays move as they
are, each cut to the output block it falls in, and are laid over one another with numpy
in the task that owns the output block. A task holds one output block and one batch.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geomosaic.functions import scales
from geomosaic.session import reliable_checkpoint, staged

HOT_PARTS = 4096
_BLOCK = ["block_row", "block_col"]


def cut(blocks: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """Parts of blocks, one per output block of ``size`` x ``size`` cells that a block touches.

    Needs ``row_0`` and ``col_0``, the place of the first cell in the output grid. A part
    says where it lies in its output block (``top``, ``left``) and how wide it is.
    """

    def outer(first: str, count: str) -> Column:
        return F.sequence(
            F.floor(F.col(first) / F.lit(size)), F.floor((F.col(first) + F.col(count) - F.lit(1)) / F.lit(size))
        )

    def inner(block: str, first: str, count: str) -> tuple[Column, Column]:
        start = F.col(block) * F.lit(size) - F.col(first)
        low = F.greatest(F.lit(0).cast("bigint"), start).cast("int")
        high = F.least(F.col(count).cast("bigint") - F.lit(1), start + F.lit(size - 1)).cast("int")
        return low, high

    placed = blocks.withColumn("block_row", F.explode(outer("row_0", "n_rows"))).withColumn(
        "block_col", F.explode(outer("col_0", "n_cols"))
    )
    r_low, r_high = inner("block_row", "row_0", "n_rows")
    c_low, c_high = inner("block_col", "col_0", "n_cols")
    bounded = placed.withColumns({"_r0": r_low, "_r1": r_high, "_c0": c_low, "_c1": c_high})
    width = F.col("_c1") - F.col("_c0") + F.lit(1)
    piece = F.flatten(
        F.transform(
            F.sequence("_r0", "_r1"),
            lambda r: F.slice("values", r * F.col("n_cols") + F.col("_c0") + F.lit(1), width),
        )
    )
    whole = (width == F.col("n_cols")) & (F.col("_r1") - F.col("_r0") + F.lit(1) == F.col("n_rows"))
    return bounded.select(
        *keys,
        *_BLOCK,
        (F.col("row_0") + F.col("_r0") - F.col("block_row") * F.lit(size)).cast("int").alias("top"),
        (F.col("col_0") + F.col("_c0") - F.col("block_col") * F.lit(size)).cast("int").alias("left"),
        width.alias("width"),
        F.when(whole, F.col("values")).otherwise(piece).alias("values"),
    )


def _hot_blocks(parts: DataFrame, group: list[str], hot_parts: int) -> DataFrame:
    """All output blocks with many parts, and the number of slices they are cut into."""
    counted = parts.groupBy(*group, *_BLOCK).agg(F.count("*").alias("_n")).where(F.col("_n") > hot_parts)
    return reliable_checkpoint(counted.withColumn("_n", F.ceil(F.col("_n") / F.lit(hot_parts)).cast("int")))


def _merged(parts: DataFrame, keys: list[str], size: int, low: float, high: float) -> DataFrame:
    """Lay the parts of each output block, or blocks merged before, over one another."""

    # all that a task runs is inside, so that executors need no copy of this package
    def lay(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = np.full((size, size), np.nan)
        best = np.full((size, size), np.iinfo(np.int64).max, dtype=np.int64)
        head: list = []
        for batch in batches:
            if not head and len(batch):
                head = [batch[k].iloc[0] for k in keys]
            for row in batch.itertuples(index=False):
                values = np.asarray(row.values, dtype=np.float64).reshape(-1, row.width)
                rank = row.mosaic_rank
                if np.ndim(rank):
                    rank = np.asarray(rank, dtype=np.int64).reshape(values.shape)
                at = np.s_[row.top : row.top + values.shape[0], row.left : row.left + row.width]
                wins = (values >= low) & (values <= high) & (rank < best[at])
                out[at] = np.where(wins, values, out[at])
                best[at] = np.where(wins, rank, best[at])
        if head:
            done = {k: [v] for k, v in zip(keys, head, strict=True)}
            yield pd.DataFrame(done | {"values": [out.ravel()], "mosaic_rank": [best.ravel()]})

    kinds = dict(parts.dtypes)
    schema = ", ".join([f"`{k}` {kinds[k]}" for k in keys] + ["`values` array<double>", "mosaic_rank array<bigint>"])
    return parts.groupBy(*keys).applyInPandas(lay, schema)


def first_merge_blocks(
    blocks: DataFrame,
    group: Sequence[str],
    size: int,
    low: float = scales.VALID_LOW,
    high: float = scales.VALID_HIGH,
    hot_parts: int = HOT_PARTS,
) -> DataFrame:
    """The FIRST mosaic as output blocks of ``size`` x ``size`` cells, row by row.

    Blocks carry ``mosaic_rank``. A cell without a valid pixel is null. An output block with
    very many parts is merged in slices first, and the slices then.
    """
    group = list(group)
    parts = cut(blocks, [*group, "mosaic_rank"], size)
    hot = _hot_blocks(cut(blocks.withColumn("values", F.array()), group, size), group, hot_parts)
    if hot.isEmpty():
        return _merged(parts, [*group, *_BLOCK], size, low, high).drop("mosaic_rank")
    n = F.coalesce("_n", F.lit(1))
    sliced = parts.join(hot, [*group, *_BLOCK], "left").withColumn(
        "_slice", F.pmod(F.xxhash64("mosaic_rank"), n).cast("int")
    )
    sliced = sliced.withColumn("_n", n)
    # read twice below, so kept
    once = staged(_merged(sliced, [*group, *_BLOCK, "_slice", "_n"], size, low, high), "merged_blocks")
    again = once.where("_n > 1").withColumns({"top": F.lit(0), "left": F.lit(0), "width": F.lit(size)})
    rest = _merged(again, [*group, *_BLOCK], size, low, high)
    return once.where("_n = 1").select(rest.columns).unionByName(rest).drop("mosaic_rank")


def block_cells(merged: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """The valid cells of merged blocks as rows, with their place in the output grid."""
    cells = merged.select(*keys, *_BLOCK, F.posexplode("values").alias("_k", "v")).where(
        F.col("v").isNotNull() & ~F.isnan("v")
    )
    return cells.select(
        *keys,
        (F.col("block_row") * F.lit(size) + F.floor(F.col("_k") / F.lit(size))).alias("grid_row"),
        (F.col("block_col") * F.lit(size) + F.col("_k") % F.lit(size)).alias("grid_col"),
        "v",
    )
