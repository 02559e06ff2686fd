"""A catalog refresh: new paths, headers, attributes, rejects, and the overview record."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geomosaic.functions import headers as H
from geomosaic.functions import names
from geomosaic.operators import aggregates, catalog
from geomosaic.operators.bounded import fits_broadcast
from geomosaic.operators.pixels import project_extent
from geomosaic.session import reliable_checkpoint, staged
from geomosaic.sources import readers

# What overview records say in place of a tile and a link.
ZOOM_TILE = "Zoom in further to see specific tile information"
ZOOM_URL = "Zoom in further to access download link"

CORE = ("path", "name", "x_min", "y_min", "x_max", "y_max", "n_rows", "n_cols", "n_bands", "pixel_type", "srs")


def read_new(listing: DataFrame, headers: DataFrame, held: DataFrame, bucket_root: str) -> DataFrame:
    """Core catalog rows of the listed paths that ``held`` lacks, with a ``reject_reason``.

    ``headers`` has ``path`` and the document, as a ``header`` struct or as text in ``doc``;
    text is parsed for new paths only. Headers of known paths are dropped before any
    of them moves, when the new paths are few. A path has one header; if several landed,
    the smallest counts, so a path with many copies is combined where it lies.
    """
    paths = reliable_checkpoint(catalog.new_paths(listing, held))
    wanted = F.broadcast(paths) if fits_broadcast(paths) else paths
    flat = H.flatten(F.col("header"))
    flat.pop("raster")
    # cut down to the catalog columns before the shuffle: a document is far larger
    kept = headers.join(wanted, "path", "left_semi")
    if "header" not in kept.columns:
        kept = readers.parse_headers(kept)
    slim = kept.select(
        "path", F.struct(*[c.alias(n) for n, c in flat.items()]).alias("core")
    )
    of_new = slim.groupBy("path").agg(F.min("core").alias("core"))
    rows = catalog.with_headers(paths, of_new).select(
        "path", "has_header", names.stem(F.col("path")).alias("name"), "core.*"
    )
    reason = (
        F.when(~F.col("path").startswith(bucket_root), F.lit("bucket"))
        .when(~F.col("has_header") | F.col("n_cols").isNull(), F.lit("header"))
        .when(F.col("pixel_type").isNull(), F.lit("pixel type"))
    )
    return rows.select(*CORE, reason.alias("reject_reason"))


def in_web_mercator(rows: DataFrame) -> DataFrame:
    """Core rows with their extents in web mercator, by the code of their reference system.

    A row of another code gets the ``reject_reason`` ``epsg``, one without a proper box ``extent``, unless it had a reason
    before. The code of the source stays in ``srs``.
    """
    coded = rows.withColumnRenamed("reject_reason", "_before").withColumn("_epsg", F.expr("try_cast(srs as int)"))
    placed = project_extent(coded, "_epsg")
    moved = {side: F.col(f"m{side}") for side in ("x_min", "y_min", "x_max", "y_max")}
    placed = placed.withColumns(moved | {"reject_reason": F.coalesce("_before", "reject_reason")})
    return placed.select(*rows.columns)


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("reject_reason").isNotNull())


def check_attributes(rows: DataFrame, needed: tuple[str, ...]) -> DataFrame:
    """Reject rows whose name did not give the needed attributes."""
    lacking = F.lit(False)
    for column in needed:
        lacking = lacking | F.col(column).isNull()
    return rows.withColumn("reject_reason", F.when(lacking, F.lit("name")))


def source_rows(core: DataFrame, family: str, dataset: Column, attributes: Mapping[str, Column]) -> DataFrame:
    """Catalog rows as source items: attributes, the family's pixel-size limit, centres, ranges."""
    limits = {row[0]: row[1] for row in catalog.FAMILIES}
    named = core.withColumns(dict(attributes)).withColumns(
        {
            "dataset": dataset,
            "category": F.lit(1),
            "min_ps": F.lit(None).cast("double"),
            "max_ps": F.lit(limits[family]),
            "center_x": (F.col("x_min") + F.col("x_max")) / 2,
            "center_y": (F.col("y_min") + F.col("y_max")) / 2,
        }
    )
    return aggregates.cell_size_ranges(named)


def overview_values(family: str) -> dict[str, Column]:
    """What each family writes into its overview record; the rest of the record stays."""
    smallest = {row[0]: row[2] for row in catalog.FAMILIES}
    values = {"min_ps": F.lit(smallest[family]), "category": F.lit(catalog.CATEGORY_OVERVIEW)}
    if family == "RTC":
        values["group_name"] = F.lit("Mosaic Overview")
    if family == "OPERA":
        values |= {
            "tag": F.concat("_tag", F.lit("_Overview")),
            "group_name": F.concat("_tag", F.lit(" Mosaic Overview")),
            "polarization": F.element_at(F.split("_tag", "_"), -1),
            "download_url": F.lit(ZOOM_URL),
            "url_display": F.lit(ZOOM_URL),
        }
    if family == "COH":
        parts = names.overview_parts(F.col("name"))
        dataset = names.coh_tag(parts["product_type"], parts["polarization"], parts["season_code"])
        values |= {
            "tag": F.concat(dataset, F.lit("_Overview")),
            "group_name": F.concat(dataset, F.lit(" Mosaic Overview")),
            "product_type": parts["product_type"],
            "polarization": parts["polarization"],
            "season_code": parts["season_code"],
            "tile": F.lit(ZOOM_TILE),
            "download_url": F.lit(ZOOM_URL),
            "url_display": F.lit(ZOOM_URL),
        }
    if family == "HAND":
        values |= {
            "tag": F.col("name"),
            "product_name": F.col("name"),
            "dataset_id": F.lit(f"{names.HAND_DATASET_ID}_Overview"),
            "tile": F.lit(ZOOM_TILE),
            "url_display": F.lit(ZOOM_URL),
        }
    return values


def add_overviews(sources: DataFrame, family: str, name: Column) -> DataFrame:
    """Source items plus one finished overview record per dataset.

    The sources are written once; the records then read no more than their own columns.
    """
    sources = staged(sources, "sources")
    found = catalog.overview_records(sources, name)
    if family in ("HAND", "SAMPLE"):
        found = found.drop("start_date", "end_date")
    done = found.withColumn("tag", F.lit("Dataset")).withColumns(overview_values(family)).drop("_tag")
    if family == "COH":
        done = catalog.with_season_code(done.drop("start_date", "end_date")).withColumns(
            {"start_date": F.col("season_start"), "end_date": F.col("season_end")}
        )
        done = done.drop("season_start", "season_end", "season_short", "season_ordinal", "season_name")
    centred = done.withColumns(
        {"center_x": (F.col("x_min") + F.col("x_max")) / 2, "center_y": (F.col("y_min") + F.col("y_max")) / 2}
    )
    return catalog.append_overview(sources, centred)


def season_attributes(core: DataFrame) -> DataFrame:
    """Season columns of coherence rows, with a ``reject_reason``; the season lookup is a four-row broadcast."""
    parsed = core.withColumns(names.coh_fields(F.col("name")))
    known = catalog.with_every_season(parsed, strict=False)
    reason = F.when(F.col("tile").isNull(), F.lit("name")).when(F.col("season_code").isNull(), F.lit("season"))
    return known.withColumns(
        {
            "start_date": F.col("season_start"),
            "end_date": F.col("season_end"),
            "url_display": F.col("name"),
            "reject_reason": reason,
        }
    ).drop("season_start", "season_end", "season_short", "season_ordinal", "season_name")

