"""Quality checks over items and configs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geomosaic.operators.catalog import CATEGORY_OVERVIEW

# Keys a burst-product service config must have.
REQUIRED_CONFIG = (
    "project_name",
    "raster_store",
    "bucket",
    "overview_path",
    "s3_suffix",
    "opera_version",
    "dataset_name",
    "raster_function_templates",
    "default_raster_function_template",
    "service_folder",
    "service_name",
)


def item_count(items: DataFrame, listing: DataFrame) -> DataFrame:
    """Per dataset: items must be the listed rasters and one overview."""
    have = items.groupBy("dataset").agg(
        F.count("*").alias("n_items"),
        F.count_if(F.coalesce(F.col("category") == CATEGORY_OVERVIEW, F.lit(False))).alias("n_overviews"),
    )
    want = listing.groupBy("dataset").agg(F.count("*").alias("n_listed"))
    n_items, n_over, n_list = (F.coalesce(c, F.lit(0)) for c in ("n_items", "n_overviews", "n_listed"))
    return have.join(want, "dataset", "full").select(
        "dataset",
        n_items.alias("n_items"),
        n_over.alias("n_overviews"),
        n_list.alias("n_listed"),
        ((n_items == n_list + 1) & (n_over == 1)).alias("ok"),
    )


def fields_populated(items: DataFrame, fields: Sequence[str], group: Sequence[str] = ("dataset",)) -> DataFrame:
    """Empty values per field, in one pass."""
    return items.groupBy(*group).agg(
        F.count("*").alias("n_rows"), *[F.count_if(F.col(f).isNull()).alias(f"null_{f}") for f in fields]
    )


def missing_config(configs: DataFrame, required: Sequence[str] = REQUIRED_CONFIG) -> DataFrame:
    """One row per config and required key that it lacks."""
    absent = F.array_compact(
        F.array(
            *[
                F.when(F.col(k).isNull(), F.lit(k)) if k in configs.columns else F.lit(k)
                for k in required
            ]
        )
    )
    return configs.select("dataset_name", F.explode(absent).alias("missing_key"))


def duplicate_paths(catalog: DataFrame, path: str = "path") -> DataFrame:
    """Paths held more than once."""
    return catalog.groupBy(path).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def decimal_display(pixels: DataFrame, decimals: int = 2, group: Sequence[str] = (), value: str = "v") -> DataFrame:
    """Pixels whose unscaled value shows as 0 or 1 although the raw one is not 0 or 100."""
    shown = F.round(F.col(value) / F.lit(100.0), decimals)
    bad = shown.isin(0.0, 1.0) & ~F.col(value).isin(0.0, 100.0)
    return pixels.groupBy(*group).agg(F.count(value).alias("n_pixels"), F.count_if(bad).alias("n_collapsed"))
