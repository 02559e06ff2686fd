"""Queries over sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from geomosaic.functions import headers as H
from geomosaic.plans import views
from geomosaic.plans.registry import query
from geomosaic.session import work_path
from geomosaic.sources import readers, writers


@query(
    "src_listing",
    """select concat('/vsis3/', bucket, '/', key) as path, size from inventory
       where starts_with(key, 'scenes/') and ends_with(key, '_VV.tif')""",
)
def src_listing(spark, sf_dir):
    return readers.list_objects(views.inventory(spark, sf_dir), "scenes/", "_VV.tif").select("path", "size")


@query(
    "src_listing_regex",
    """select event_id, path from (
         select event_id, concat('/vsis3/fixture-bucket/v1/', hand_name, '.tif') as path from granules)
       where regexp_full_match(path,
         '.*Copernicus_DSM_COG_10_[NS][0-8]\\d_00_[EW]\\d\\d\\d_00_HAND.tif')""",
)
def src_listing_regex(spark, sf_dir):
    tiles = views.granules(spark, sf_dir).selectExpr(
        "event_id", f"concat('/vsis3/{views.BUCKET}/v1/',hand_name,'.tif') as path"
    )
    return readers.list_matching(tiles)


@query("src_url_list", "select path from headers")
def src_url_list(spark, sf_dir):
    landed = writers.write_path_list(views.headers(spark, sf_dir).select("path"), work_path(spark, "src_url_list"))
    return readers.read_path_list(spark, landed)


@query(
    "src_granule_json",
    """select pol, replace(u, 's3://', '/vsis3/') as path from (
         select pol, list_filter(json_extract_string(doc, '$.umm.RelatedUrls[*].URL'),
           lambda x: starts_with(x, 's3://') and ends_with(x, pol || '.tif'))[1] as u
         from search_granules) where u is not null""",
)
def src_granule_json(spark, sf_dir):
    pages = views.search_granules(spark, sf_dir).selectExpr(
        "concat('{\"pol\":\"',pol,'\",\"items\":[',doc,']}') as value"
    )
    landed = work_path(spark, "src_granule_json")
    pages.write.text(landed)
    return readers.granule_paths(readers.read_search_pages(spark, landed))


@query(
    "src_header_json",
    """select path, x_min, y_max, n_cols, n_rows, band_type,
         concat('PROJCS["f",GEOGCS["g",AUTHORITY["EPSG","4326"]],AUTHORITY["EPSG","', epsg, '"]]') as wkt from headers""",
)
def src_header_json(spark, sf_dir):
    landed = work_path(spark, "src_header_json")
    views.header_docs(spark, sf_dir).select(F.col("doc").alias("value")).write.text(landed)
    h = F.col("header")
    return readers.read_headers(spark, landed).select(
        "path",
        F.get(h["cornerCoordinates"]["lowerLeft"], F.lit(0)).alias("x_min"),
        F.get(h["cornerCoordinates"]["upperRight"], F.lit(1)).alias("y_max"),
        F.get(h["size"], F.lit(0)).alias("n_cols"),
        F.get(h["size"], F.lit(1)).alias("n_rows"),
        F.get(h["bands"], F.lit(0))["type"].alias("band_type"),
        h["coordinateSystem"]["wkt"].alias("wkt"),
    )


@query(
    "src_catalog_csv",
    """select path, cast(n_rows as varchar) as n_rows, cast(epsg as varchar) as srs, band_type from headers""",
)
def src_catalog_csv(spark, sf_dir):
    rows = views.headers(spark, sf_dir).selectExpr("path", "n_rows", "epsg as srs", "band_type")
    landed = writers.write_catalog_csv(rows, work_path(spark, "src_catalog_csv"))
    return readers.read_catalog_csv(spark, landed, ["path", "n_rows", "srs", "band_type"])


def config_docs(spark, sf_dir):
    """One config document per coherence dataset in the data; every other one has overrides."""
    groups = (
        views.coherence(spark, sf_dir)
        .groupBy("dataset", "product_type", "polarization", "season_name", "season_code")
        .agg(F.max("season").alias("season"))
    )
    return groups.select(
        F.to_json(
            F.struct(
                F.lit("FIXTURE").alias("project_name"),
                F.lit("tiles/").alias("s3_prefix"),
                F.concat(
                    F.lit("_"), "season_name", F.lit("_"), F.lower("polarization"), F.lit("_"), "product_type", F.lit(".tif")
                ).alias("s3_suffix"),
                F.col("dataset").alias("dataset_name"),
                F.array(F.lit("Scaled.xml"), F.lit("Unscaled.xml")).alias("raster_function_templates"),
                F.when(F.col("polarization") == "VV", F.lit("Unscaled.xml"))
                .otherwise(F.lit("None"))
                .alias("default_raster_function_template"),
                F.when(
                    F.col("polarization") == "VV", F.create_map(F.lit("ItemInfo/Title"), F.col("season"))
                ).alias("service_definition_overrides"),
            )
        ).alias("value")
    )


def configs(spark, sf_dir):
    landed = work_path(spark, "configs")
    config_docs(spark, sf_dir).write.text(landed)
    return readers.read_configs(spark, landed, multi_line=False)


@query(
    "src_configs",
    """select distinct dataset as dataset_name, 'tiles/' as s3_prefix,
         concat('_', season_name, '_', lower(polarization), '_', product_type, '.tif') as s3_suffix,
         2 as n_templates,
         case when polarization = 'VV' then 'Unscaled.xml' else 'None' end as default_template,
         case when polarization = 'VV' then season end as title
       from coherence""",
)
def src_configs(spark, sf_dir):
    return configs(spark, sf_dir).select(
        "dataset_name",
        "s3_prefix",
        "s3_suffix",
        F.size("raster_function_templates").alias("n_templates"),
        F.col("default_raster_function_template").alias("default_template"),
        F.get(F.map_values("service_definition_overrides"), F.lit(0)).alias("title"),
    )


ITEM_TYPES = {
    "path": "string",
    "x_min": "double",
    "y_min": "double",
    "x_max": "double",
    "y_max": "double",
    "n_rows": "int",
    "n_cols": "int",
    "pixel_type": "int",
    "srs": "string",
}


@query(
    "src_items_from_catalog",
    """select path, x_min, y_min, x_max, y_max, n_rows, n_cols, srs, pixel_type,
         (x_min+x_max)/2 as center_x, (y_min+y_max)/2 as center_y from (
       select path, case when event_id%50 <> 0 then x_min end as x_min, y_min, x_max, y_max, n_rows, n_cols,
         cast(epsg as varchar) as srs,
         case band_type when 'Byte' then 3 when 'Int16' then 6 else 9 end as pixel_type from headers)""",
)
def src_items_from_catalog(spark, sf_dir):
    text = views.headers(spark, sf_dir).select(
        "path",
        # a damaged number now and then
        F.when(F.expr("event_id % 50 = 0"), F.lit("n/a")).otherwise(F.col("x_min").cast("string")).alias("x_min"),
        *[F.col(c).cast("string") for c in ("y_min", "x_max", "y_max", "n_rows", "n_cols")],
        H.pixel_type(F.col("band_type")).cast("string").alias("pixel_type"),
        F.col("epsg").cast("string").alias("srs"),
    )
    return readers.items_from_catalog(text, ITEM_TYPES)
