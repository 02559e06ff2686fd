"""Raster-shaped views over the test tables: scenes, headers, requests, tiles.

The rows grow with the tables; nothing is read but what a query selects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geomosaic.functions import dates, names
from geomosaic.operators import catalog, mosaic
from geomosaic.operators.spatial import Box, join_boxes

BUCKET = "fixture-bucket"
SITE = "https://fixture.example/"
VERSION = "V1"
AS_OF = "2024-01-31 00:00:00"
SCENE_CELL = 57_600.0
TOP = 100_000.0
#: What decides whether a request shows an item.
SHOWN = ["name", "start_date", "end_date", "x_min", "y_min", "x_max", "y_max", "min_ps", "max_ps"]


def as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def granules_of(events: DataFrame) -> DataFrame:
    """One scene per event, with its name in every grammar."""
    now = "date_format(ts, \"yyyyMMdd'T'HHmmss\")"
    later = "date_format(ts + interval 1 day, \"yyyyMMdd'T'HHmmss\")"
    pol = "case event_id%4 when 0 then 'VV' when 1 then 'VH' when 2 then 'HH' else 'HV' end"
    north = "case when event_id%2=0 then 'N' else 'S' end, lpad(cast(event_id%91 as string),2,'0')"
    east = "case when user_id%2=0 then 'E' else 'W' end, lpad(cast(user_id%180 as string),3,'0')"
    return events.select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        dates.whole_second(F.col("ts")).alias("start_date"),
        F.expr(pol).alias("pol"),
        F.expr(
            f"concat('S1A_IW_',{now},'_DVP_RTC30_G_gpuned_',lpad(hex(event_id%65536),4,'0'),'_',"
            "case event_id%4 when 0 then 'VV' when 1 then 'VH' when 2 then 'rgb' else 'WM' end)"
        ).alias("rtc_name"),
        F.expr(
            "concat('OPERA_L2_RTC-S1_T',lpad(cast(user_id%175+1 as string),3,'0'),'-',"
            "lpad(cast(event_id%1000000 as string),6,'0'),'-IW',cast(event_id%3+1 as string),"
            f"'_',{now},'Z_',{later},'Z_S1A_30_v1.0_',{pol})"
        ).alias("opera_name"),
        F.expr(
            f"concat({north},{east},'_',"
            "case event_id%4 when 0 then 'summer' when 1 then 'fall' when 2 then 'winter' else 'spring' end,'_',"
            "case when user_id%2=0 then 'vv' else 'hh' end,'_',"
            "case event_id%3 when 0 then 'COH06' when 1 then 'COH12' else 'COH24' end)"
        ).alias("coh_name"),
        F.expr(f"concat('Copernicus_DSM_COG_10_',{north},'_00_',{east},'_00_HAND')").alias("hand_name"),
    )


def granules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return granules_of(table(spark, sf_dir, "events"))


def headers_of(scenes: DataFrame, *keep: str) -> DataFrame:
    """Flattened headers: footprints of 28.8 km in a square of 2,000 km."""
    return scenes.selectExpr(
        *keep,
        "event_id",
        f"concat('/vsis3/{BUCKET}/',opera_name,'.tif') as path",
        "cast(event_id*7919%2000*1000 as double) as x_min",
        "cast(user_id*104729%2000*1000 as double) as y_min",
        "cast(event_id*7919%2000*1000+28800 as double) as x_max",
        "cast(user_id*104729%2000*1000+28800 as double) as y_max",
        "64 as n_cols",
        "64 as n_rows",
        "case event_id%3 when 0 then 'Byte' when 1 then 'Int16' else 'Float32' end as band_type",
        "case event_id%5 when 0 then 4326 else 32600+cast(user_id%60+1 as int) end as epsg",
    )


def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return headers_of(granules(spark, sf_dir))


def native_headers_of(scenes: DataFrame, *keep: str) -> DataFrame:
    """Flattened headers in the units of their own reference system, awkward ones among them.

    Some boxes cross the antimeridian or the equator, touch a pole, are 400 km wide, inverted, or of a code that is not known.
    """
    code = (
        "case when event_id%17=0 then 3413 when event_id%19=0 then 3857 when event_id%5=0 then 4326 "
        "else cast(user_id%60+1 as int) + if(event_id%2=0, 32600, 32700) end"
    )
    degrees = {"x_min": "k*9/50-180", "y_min": "m*9/100-90", "width": "0.3D", "height": "0.3D"}
    metres = {"x_min": "k*20000-20000000", "y_min": "m*20000-20000000", "width": "28800D", "height": "28800D"}
    zone = {
        "x_min": "160000+k*330",
        "y_min": "if(epsg < 32700, m*4600-14400, 800000+m*4600)",
        "width": "if(event_id%7=0, 400000D, 28800D)",
        "height": "28800D",
    }
    native = {
        name: F.expr(f"case epsg when 4326 then {degrees[name]} when 3857 then {metres[name]} else {zone[name]} end")
        for name in zone
    }
    placed = headers_of(scenes, *keep, "user_id").withColumns(
        {
            "k": F.expr("cast(event_id*7919%2000 as double)"),
            "m": F.expr("cast(user_id*104729%2000 as double)"),
            "epsg": F.expr(code),
        }
    )
    placed = placed.withColumns(native).withColumns(
        {"x_max": F.expr("if(event_id%29=0, x_min-1, x_min+width)"), "y_max": F.expr("y_min+height")}
    )
    return placed.drop("k", "m", "width", "height", "user_id")


def header_docs_of(scenes: DataFrame, name: str, native: bool = False) -> DataFrame:
    """Header documents as JSON text, for scenes whose rasters are named by ``name``; ``native`` ones in many units."""
    flat = native_headers_of if native else headers_of
    kept = flat(scenes.withColumn("raster_name", F.col(name)), "event_type", "raster_name")
    path = F.concat(F.lit(f"/vsis3/{BUCKET}/"), "raster_name", F.lit(".tif"))
    wkt = F.concat(
        F.lit('PROJCS["f",GEOGCS["g",AUTHORITY["EPSG","4326"]],AUTHORITY["EPSG","'),
        F.col("epsg").cast("string"),
        F.lit('"]]'),
    )
    doc = F.struct(
        path.alias("description"),
        F.struct(F.array("x_min", "y_min").alias("lowerLeft"), F.array("x_max", "y_max").alias("upperRight")).alias(
            "cornerCoordinates"
        ),
        F.array("n_cols", "n_rows").alias("size"),
        F.array(F.struct(F.col("band_type").alias("type"))).alias("bands"),
        F.struct(wkt.alias("wkt")).alias("coordinateSystem"),
    )
    return kept.select("event_id", "event_type", path.alias("path"), F.to_json(doc).alias("doc"))


def header_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return header_docs_of(granules(spark, sf_dir), "opera_name")


def catalog_old(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an earlier run took in."""
    return headers(spark, sf_dir).where("event_id % 3 = 0").select("path")


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed paths, some of them twice."""
    scenes = granules(spark, sf_dir)
    twice = F.when(F.col("event_type") == "click", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return scenes.withColumn("copy", F.explode(twice)).selectExpr(f"concat('/vsis3/{BUCKET}/',opera_name,'.tif') as path")


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landed object inventory."""
    return granules(spark, sf_dir).selectExpr(
        "event_id",
        f"'{BUCKET}' as bucket",
        "event_id*131%100000+1 as size",
        "start_date as mtime",
        "concat('scenes/',event_type,'/',opera_name,case when event_id%7=0 then '.tif.xml' else '.tif' end) as key",
    )


def search_granules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested search result per scene; each tenth has no fitting URL."""
    return granules(spark, sf_dir).selectExpr(
        "event_id",
        "pol",
        f"concat('{{\"umm\":{{\"RelatedUrls\":[{{\"URL\":\"{SITE}',opera_name,'.tif\"}},{{\"URL\":\"s3://{BUCKET}/',"
        "opera_name,case when event_id%10=0 then '.h5' else '.tif' end,'\"}]}}') as doc",
    )


def coherence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seasonal coherence rows with their season and dataset."""
    named = granules(spark, sf_dir).select("event_id", "coh_name")
    parsed = named.withColumns(names.coh_fields(F.col("coh_name")))
    return catalog.with_every_season(parsed).withColumn(
        "dataset", names.coh_tag(F.col("product_type"), F.col("polarization"), F.col("season_code"))
    )


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source items: each scene with its header, both from the same row."""
    named = headers_of(granules(spark, sf_dir), "pol", "opera_name", "start_date")
    return named.selectExpr(
        "event_id as item_id",
        "concat('OPERA_',pol) as dataset",
        "opera_name as name",
        "path",
        f"concat('OPERA_L2_RTC-S1_{VERSION}_',pol) as tag",
        "start_date",
        "start_date as end_date",
        "x_min",
        "y_min",
        "x_max",
        "y_max",
        "n_cols",
        "n_rows",
        "cast(null as double) as min_ps",
        "460.0D as max_ps",
        "1 as category",
        "(x_min+x_max)/2 as center_x",
        "(y_min+y_max)/2 as center_y",
        f"concat('{SITE}',opera_name,'.tif') as download_url",
    )


def overviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One overview record per dataset, as it is first added: tagged ``Dataset``."""
    name = names.run_name(F.lit("FIXTURE"), F.col("dataset"), as_of())
    return catalog.overview_records(scenes(spark, sf_dir), F.concat(name, F.lit("_overview")))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source items and the finished overview items."""
    found = overviews(spark, sf_dir).selectExpr(
        "cast(null as bigint) as item_id",
        "dataset",
        "name",
        "concat(_tag,'_Overview') as tag",
        "start_date",
        "end_date",
        "x_min",
        "y_min",
        "x_max",
        "y_max",
        "450.0D as min_ps",
        "category",
        "(x_min+x_max)/2 as center_x",
        "(y_min+y_max)/2 as center_y",
        "'Zoom in further to access download link' as download_url",
    )
    return catalog.append_overview(scenes(spark, sf_dir).drop("path", "n_cols", "n_rows"), found)


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as point_id",
        "cast(c_custkey*15485863%2000000 as double) as x",
        "cast(c_custkey*32452843%2000000 as double) as y",
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View requests: a box, a cell size and, for two of three, ten days."""
    return points(spark, sf_dir).selectExpr(
        "point_id as request_id",
        "x as rx_min",
        "y as ry_min",
        "x+10000+point_id%5*10000 as rx_max",
        "y+10000+point_id%5*10000 as ry_max",
        "cast(case point_id%4 when 0 then 30 when 1 then 455 when 2 then 300 else 2000 end as double) as cell",
        "case when point_id%3<>0 then timestamp_ntz'2024-01-01' + make_dt_interval(cast(point_id%20 as int)) end as t_from",
        "case when point_id%3<>0 then timestamp_ntz'2024-01-11' + make_dt_interval(cast(point_id%20 as int)) end as t_to",
    )


def chosen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible pairs of a request and an item."""
    slim = items(spark, sf_dir).drop("download_url", "tag")
    return mosaic.select_items(slim, requests(spark, sf_dir))


def chosen_in_order(spark: SparkSession, sf_dir: str, order, *keep: str, items_of=lambda items: items) -> DataFrame:
    """Visible pairs of a request and an item, numbered for each request."""
    slim = items_of(items(spark, sf_dir)).select(*SHOWN, *keep)
    return mosaic.order_selected(slim, requests(spark, sf_dir), order).select("request_id", "name", "mosaic_rank")


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Block rows of 8 x 8 cells of 450 m."""
    return table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id",
        "label",
        "cast(embedding as array<double>) as values",
        "8 as n_rows",
        "8 as n_cols",
        "450.0D as cell",
        "(vec_id%10)*1800.0D as x_min",
        f"{TOP}D - label*1800.0D as y_max",
        "(vec_id%10)*1800.0D+3600 as x_max",
        f"{TOP}D - label*1800.0D - 3600 as y_min",
    )


def dated_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles without their pixels, dated and named by the scene of the same number."""
    dated = granules(spark, sf_dir).selectExpr("event_id as vec_id", "opera_name as name", "start_date")
    return tiles(spark, sf_dir).drop("values").join(dated, "vec_id", "left")


def with_grid(cells: DataFrame) -> DataFrame:
    """Grid position of exploded cells of tiles."""
    return cells.selectExpr("*", "(vec_id%10)*4 + col as gx", "label*4 + row as gy")


def tile_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View requests over the tiles: squares of 8 to 32 cells."""
    grid = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey as view_id", "s_suppkey*7919%37 as gx0", "s_suppkey*104729%37 as gy0", "8+s_suppkey%4*8 as span"
    )
    return grid.selectExpr(
        "*",
        "gx0*450.0D as vx_min",
        "(gx0+span)*450.0D as vx_max",
        f"{TOP}D-(gy0+span)*450.0D as vy_min",
        f"{TOP}D-gy0*450.0D as vy_max",
    )


def tile_pairs(tiles: DataFrame, asked: DataFrame) -> DataFrame:
    """Tiles that overlap a view, without the boxes; both sides are stored."""
    asked_box = Box("vx_min", "vy_min", "vx_max", "vy_max")
    pairs = join_boxes(tiles, asked, Box(), asked_box, stored=(True, True))
    return pairs.drop(*(f"{v}{side}" for v in ("", "v") for side in ("x_min", "y_min", "x_max", "y_max")))


def capped_tiles(spark: SparkSession, sf_dir: str, cap: int) -> DataFrame:
    """The newest tiles of each view, without their pixels."""
    slim = dated_tiles(spark, sf_dir).select("vec_id", "name", "start_date", "x_min", "y_min", "x_max", "y_max")
    return mosaic.cap_met(slim, tile_views(spark, sf_dir), tile_pairs, mosaic.by_attribute(), cap, ["view_id"])
