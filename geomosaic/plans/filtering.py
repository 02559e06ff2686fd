"""Queries over predicates and conditional updates."""

from __future__ import annotations

from pyspark.sql import functions as F

from geomosaic.functions import dates, names, scales
from geomosaic.operators import bounded, catalog, pixels
from geomosaic.plans import views
from geomosaic.plans.registry import query


def fresh_items(spark, sf_dir):
    """Items right after the overviews were added: an overview is tagged ``Dataset``."""
    added = views.overviews(spark, sf_dir).drop("_tag", "start_date", "end_date").withColumn("tag", F.lit("Dataset"))
    return catalog.append_overview(views.scenes(spark, sf_dir), added)


@query("flt_source_items", "select dataset, name, case when length(name) % 3 > 0 then tag end as tag from scenes")
def flt_source_items(spark, sf_dir):
    # some sources lack a tag, as those of one family all do
    tag = F.when((F.length("name") % 3 > 0) | F.col("tag").eqNullSafe("Dataset"), F.col("tag"))
    return catalog.source_items(fresh_items(spark, sf_dir).withColumn("tag", tag)).select("dataset", "name", "tag")


@query(
    "flt_select_by_name",
    """select dataset, name, tag, x_min, x_max from items where name = 'FIXTURE_'||dataset||'_240131_0000_overview'""",
)
def flt_select_by_name(spark, sf_dir):
    run = names.run_name(F.lit("FIXTURE"), F.col("dataset"), views.as_of())
    return (
        views.items(spark, sf_dir)
        .where(F.col("name") == F.concat(run, F.lit("_overview")))
        .select("dataset", "name", "tag", "x_min", "x_max")
    )


UPDATE_SQL = """
select s.dataset, s.name, s.tag, s.start_date, s.end_date, cast(null as double) as min_ps, null as group_name, s.download_url
from scenes s
union all
select dataset, name, tag||'_Overview', start_date, end_date, 450.0, tag||' Mosaic Overview',
  'Zoom in further to access download link' from overviews
"""


@query("upd_overview", UPDATE_SQL)
def upd_overview(spark, sf_dir):
    scenes = views.scenes(spark, sf_dir)
    found = scenes.groupBy("dataset").agg(
        dates.overview_start(F.min("start_date")).alias("o_start"),
        dates.overview_end(F.max("start_date")).alias("o_end"),
        F.min("tag").alias("o_tag"),
    )
    # one row per dataset
    rows = bounded.join_measured(fresh_items(spark, sf_dir), found, ["dataset"]).withColumn("group_name", F.lit(None).cast("string"))
    done = catalog.calculate_fields(
        rows,
        {
            "tag": "concat(o_tag, '_Overview')",
            "min_ps": F.lit(450.0),
            "start_date": "o_start",
            "end_date": "o_end",
            "group_name": "concat(o_tag, ' Mosaic Overview')",
            "download_url": F.lit("Zoom in further to access download link"),
        },
        where=catalog.is_overview(),
    )
    return done.select("dataset", "name", "tag", "start_date", "end_date", "min_ps", "group_name", "download_url")


@query(
    "upd_overview_season",
    """select distinct 'FIXTURE_'||dataset||'_240131_0000_overview' as name, dataset||'_Overview' as tag,
         900.0::double as min_ps, 2 as category, season_start as start_date, season_end as end_date,
         dataset||' Mosaic Overview' as group_name, product_type, season, polarization,
         'Zoom in further to see specific tile information' as tile from coherence""",
)
def upd_overview_season(spark, sf_dir):
    run = names.run_name(F.lit("FIXTURE"), F.col("dataset"), views.as_of())
    added = views.coherence(spark, sf_dir).select(F.concat(run, F.lit("_overview")).alias("name")).distinct()
    parts = added.withColumns(names.overview_parts(F.col("name")))
    known = catalog.with_season_code(parts)
    dataset = names.coh_tag(F.col("product_type"), F.col("polarization"), F.col("season_code"))
    return known.select(
        "name",
        F.concat(dataset, F.lit("_Overview")).alias("tag"),
        F.lit(900.0).alias("min_ps"),
        F.lit(catalog.CATEGORY_OVERVIEW).alias("category"),
        F.col("season_start").alias("start_date"),
        F.col("season_end").alias("end_date"),
        F.concat(dataset, F.lit(" Mosaic Overview")).alias("group_name"),
        "product_type",
        "season",
        "polarization",
        F.lit("Zoom in further to see specific tile information").alias("tile"),
    )


@query(
    "flt_path_guard",
    """select p as path, case when starts_with(p, '/vsis3/fixture-bucket/') then null else 'bucket' end as reject_reason
       from (select case when user_id%9=0 then replace(path, 'fixture-bucket', 'other') else path end as p
             from headers join granules using (event_id))""",
)
def flt_path_guard(spark, sf_dir):
    scenes = views.headers_of(views.granules(spark, sf_dir), "user_id")
    mixed = scenes.selectExpr(
        f"case when user_id%9=0 then replace(path,'{views.BUCKET}','other') else path end as path"
    )
    return catalog.guard_prefix(mixed, f"/vsis3/{views.BUCKET}/", strict=False)


@query(
    "flt_retention",
    """select name, mtime from (select rtc_name||case event_id%3 when 0 then '.gdb' when 1 then '.sd' else '.csv' end as name,
         start_date as mtime from granules)
       where (ends_with(name,'gdb') or ends_with(name,'.sd')) and mtime < timestamp '2024-01-31' - interval 10800 minutes""",
)
def flt_retention(spark, sf_dir):
    outputs = views.granules(spark, sf_dir).selectExpr(
        "concat(rtc_name,case event_id%3 when 0 then '.gdb' when 1 then '.sd' else '.csv' end) as name",
        "start_date as mtime",
    )
    return catalog.expired(outputs, ("gdb", ".sd"), views.as_of())


@query(
    "flt_valid_range",
    """select vec_id, k, case when v between 0 and 4294967295 then v end as v_valid,
         case when v between 0 and 1 then v end as v_unit from pixels""",
)
def flt_valid_range(spark, sf_dir):
    cells = pixels.explode_cells(views.tiles(spark, sf_dir), ["vec_id"])
    v = F.col("v")
    return cells.select(
        "vec_id",
        (F.col("row") * 8 + F.col("col")).cast("int").alias("k"),
        scales.valid(v).alias("v_valid"),
        scales.valid(v, high=scales.HAND_VALID_HIGH).alias("v_unit"),
    )
