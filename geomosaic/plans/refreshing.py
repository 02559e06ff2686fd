"""Whole refreshes of a catalog: from a listing to the items with their overviews."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geomosaic.functions import names
from geomosaic.operators import ingest
from geomosaic.plans import views
from geomosaic.plans.registry import query
from geomosaic.session import staged
from geomosaic.sources import readers

ROOT = f"/vsis3/{views.BUCKET}/"


def new_core(spark, sf_dir, name):
    """Core rows that this run adds, for scenes named by ``name``."""
    return ingest.accepted(new_rows(views.granules(spark, sf_dir), name))


def new_rows(scenes, name):
    docs = views.header_docs_of(scenes, name, native=True)
    held = held_paths(scenes, name)
    return ingest.in_web_mercator(ingest.read_new(docs.select("path"), docs.select("path", "doc"), held, ROOT))


def hand_rows(scenes):
    docs = views.header_docs_of(scenes, "hand_name", native=True)
    listed = readers.list_matching(docs.select("path"))
    return ingest.in_web_mercator(ingest.read_new(listed, docs.select("path", "doc"), listed.where(F.lit(False)), ROOT))


def hand_attributes(core):
    return core.withColumns(names.hand_fields(F.col("name"), F.lit(views.SITE)))


def held_paths(scenes, name):
    return scenes.where("event_id % 3 = 0").select(F.concat(F.lit(ROOT), name, F.lit(".tif")).alias("path"))


def sides():
    """The extent of an item in web mercator, to the millimetre."""
    return [F.round(c, 3).alias(c) for c in ("x_min", "y_min", "x_max", "y_max")]


PLACED_SQL = "m.mx_min as x_min, m.my_min as y_min, m.mx_max as x_max, m.my_max as y_max"
NEW_SQL = f"""(select g.*, {PLACED_SQL} from granules g join mercator m using (event_id)
         where event_id%3 <> 0 and m.reject_reason is null)"""
SIDES_SQL = "round(x_min,3) as x_min, round(y_min,3) as y_min, round(x_max,3) as x_max, round(y_max,3) as y_max"
ALL_SIDES_SQL = "round(min(x_min),3), round(min(y_min),3), round(max(x_max),3), round(max(y_max),3)"


def first_headers_sql(name, table="granules"):
    """Of the headers of one raster the smallest counts, the reason to reject it included."""
    return f"""(select h.{name}, h.event_id, m.reject_reason, {PLACED_SQL} from (
           select g.*, row_number() over (partition by {name} order by n.x_min, n.y_min, n.x_max, n.y_max, event_id%3,
             n.epsg::varchar) as place from {table} g join native_headers n using (event_id)) h
         join mercator m using (event_id) where h.place = 1)"""


@query(
    "refresh_rtc",
    f"""with n as (select rtc_name as name, split_part(rtc_name,'_',9) as tag, start_date, x_min, y_min, x_max, y_max, rtc_name from {NEW_SQL})
       select 'RTC_'||tag as dataset, name, 1 as category, tag, left(name,46) as group_name, start_date, start_date as end_date,
         null::double as min_ps, 1610.0::double as max_ps, round((x_max-x_min)/64,6) as low_ps, {SIDES_SQL},
         'https://fixture.example/'||name||'.tif' as download_url from n
       union all
       select 'RTC_'||tag, 'FIXTURE_RTC_'||tag||'_240131_0000_overview', 2, 'Dataset', 'Mosaic Overview',
         min(start_date) - interval 8 hours, max(start_date) + interval 8 hours, 1600.0, null, null, {ALL_SIDES_SQL}, null
       from n group by tag""",
)
def refresh_rtc(spark, sf_dir):
    core = new_core(spark, sf_dir, "rtc_name")
    fields = names.rtc_fields(F.col("name"), F.lit(views.SITE))
    sources = ingest.source_rows(core, "RTC", F.concat(F.lit("RTC_"), fields["tag"]), fields)
    named = ingest.accepted(ingest.check_attributes(sources, ("tag", "start_date")))
    items = ingest.add_overviews(named, "RTC", overview_name())
    return items.select(
        "dataset", "name", "category", "tag", "group_name", "start_date", "end_date",
        "min_ps", "max_ps", F.round("low_ps", 6).alias("low_ps"), *sides(), "download_url",
    )


def overview_name():
    return F.concat(names.run_name(F.lit("FIXTURE"), F.col("dataset"), views.as_of()), F.lit("_overview"))


@query(
    "refresh_opera",
    f"""with n as (select opera_name as name, pol, start_date, x_min, y_min, x_max, y_max from {NEW_SQL})
       select 'OPERA_'||pol as dataset, name, 1 as category, 'OPERA_L2_RTC-S1_V1_'||pol as tag,
         left(name, length(name)-3) as group_name, pol as polarization, start_date, start_date as end_date,
         null::double as min_ps, 460.0::double as max_ps, {SIDES_SQL}, name as url_display from n
       union all
       select 'OPERA_'||pol, 'FIXTURE_OPERA_'||pol||'_240131_0000_overview', 2, 'OPERA_L2_RTC-S1_V1_'||pol||'_Overview',
         'OPERA_L2_RTC-S1_V1_'||pol||' Mosaic Overview', pol, min(start_date) - interval 8 hours,
         max(start_date) + interval 8 hours, 450.0, null, {ALL_SIDES_SQL}, 'Zoom in further to access download link'
       from n group by pol""",
)
def refresh_opera(spark, sf_dir):
    core = new_core(spark, sf_dir, "opera_name")
    fields = names.opera_fields(F.col("name"), views.VERSION, F.lit(views.SITE))
    sources = ingest.source_rows(core, "OPERA", F.concat(F.lit("OPERA_"), fields["polarization"]), fields)
    named = ingest.accepted(ingest.check_attributes(sources, ("tag", "start_date")))
    items = ingest.add_overviews(named, "OPERA", overview_name())
    return items.select(
        "dataset", "name", "category", "tag", "group_name", "polarization", "start_date", "end_date",
        "min_ps", "max_ps", *sides(), "url_display",
    )


@query(
    "refresh_coh",
    f"""with m as (select c.dataset, c.coh_name as name, c.product_type, c.polarization, c.season, c.season_code, c.tile,
           c.season_start, c.season_end, n.x_min, n.y_min, n.x_max, n.y_max
         from {first_headers_sql("coh_name")} n join coherence c using (event_id)
         where n.reject_reason is null and c.coh_name not in (select coh_name from granules where event_id%3 = 0))
       select dataset, name, 1 as category, dataset as tag, product_type, polarization, season, tile, season_start as start_date,
         season_end as end_date, null::double as min_ps, 910.0::double as max_ps, {SIDES_SQL} from m
       union all
       select dataset, 'FIXTURE_'||dataset||'_240131_0000_overview', 2, dataset||'_Overview', any_value(product_type),
         any_value(polarization), any_value(season), 'Zoom in further to see specific tile information',
         any_value(season_start), any_value(season_end), 900.0, null, {ALL_SIDES_SQL} from m group by dataset""",
)
def refresh_coh(spark, sf_dir):
    core = new_core(spark, sf_dir, "coh_name")
    seasonal = ingest.accepted(ingest.season_attributes(core))
    tag = names.coh_tag(F.col("product_type"), F.col("polarization"), F.col("season_code"))
    sources = ingest.source_rows(seasonal, "COH", tag, {"tag": tag, "group_name": tag})
    items = ingest.add_overviews(sources, "COH", overview_name())
    return items.select(
        "dataset", "name", "category", "tag", "product_type", "polarization", "season", "tile",
        "start_date", "end_date", "min_ps", "max_ps", *sides(),
    )


@query(
    "refresh_hand",
    f"""with n as (select hand_name as name, regexp_extract(hand_name,'_([NS]\\d+)_00_([EW]\\d+)_',1)
           ||regexp_extract(hand_name,'_([NS]\\d+)_00_([EW]\\d+)_',2) as t, x_min, y_min, x_max, y_max
         from {first_headers_sql("hand_name")} where reject_reason is null and not regexp_matches(hand_name, '_[NS]90_'))
       select 'GLO30_HAND' as dataset, name, 1 as category, t as tile, 'GLO30_HAND' as tag, 'Global_30m_HAND' as dataset_id,
         'GLO30_HAND_'||t as product_name, null::double as min_ps, 610.0::double as max_ps, {SIDES_SQL} from n
       union all
       select 'GLO30_HAND', 'GLO30_HAND_Overview', 2, 'Zoom in further to see specific tile information', 'GLO30_HAND_Overview',
         'Global_30m_HAND_Overview', 'GLO30_HAND_Overview', 600.0, null, {ALL_SIDES_SQL} from n""",
)
def refresh_hand(spark, sf_dir):
    core = ingest.accepted(hand_rows(views.granules(spark, sf_dir)))
    fields = names.hand_fields(F.col("name"), F.lit(views.SITE))
    dated = core.withColumn("start_date", F.lit(None).cast("timestamp_ntz"))
    sources = ingest.source_rows(dated, "HAND", F.lit(names.HAND_TAG), fields)
    named = ingest.accepted(ingest.check_attributes(sources, ("tile",)))
    items = ingest.add_overviews(named, "HAND", F.concat("dataset", F.lit("_Overview")))
    return items.select(
        "dataset", "name", "category", "tile", "tag", "dataset_id", "product_name", "min_ps", "max_ps", *sides()
    )


@query(
    "refresh_sample",
    f"""select 'SAMPLE' as dataset, rtc_name as name, 1 as category, null::double as min_ps, 810.0::double as max_ps,
         round((x_max-x_min)/64,6) as low_ps, round((x_min+x_max)/2,3) as center_x, null::varchar as tag, {SIDES_SQL} from {NEW_SQL}
       union all
       select 'SAMPLE', 'FIXTURE_SAMPLE_240131_0000_overview', 2, 800.0, null, null, round((min(x_min)+max(x_max))/2,3), 'Dataset',
         {ALL_SIDES_SQL}
       from {NEW_SQL}""",
)
def refresh_sample(spark, sf_dir):
    core = new_core(spark, sf_dir, "rtc_name")
    empty = {"tag": F.lit(None).cast("string"), "start_date": F.lit(None).cast("timestamp_ntz")}
    sources = ingest.source_rows(core, "SAMPLE", F.lit("SAMPLE"), empty)
    items = ingest.add_overviews(sources, "SAMPLE", overview_name())
    rounded = [F.round("low_ps", 6).alias("low_ps"), F.round("center_x", 3).alias("center_x")]
    return items.select("dataset", "name", "category", "min_ps", "max_ps", *rounded, "tag", *sides())


def spoiled_names(scenes):
    """Scenes of which some have a coherence name without its product type, or with a season that is not known."""
    short = F.regexp_replace("coh_name", "_[^_]*$", "")
    odd = F.regexp_replace("coh_name", "_(summer|fall|winter|spring)_", "_monsoon_")
    name = F.when(F.expr("event_id%31=0"), short).when(F.expr("event_id%13=0"), odd).otherwise(F.col("coh_name"))
    return scenes.withColumn("coh_name", name)


@query(
    "refresh_rejects",
    f"""with spoiled as (
         select * replace (case when event_id%31=0 then regexp_replace(coh_name, '_[^_]*$', '')
           when event_id%13=0 then regexp_replace(coh_name, '_(summer|fall|winter|spring)_', '_monsoon_') else coh_name end as coh_name)
         from granules)
       select reject_reason, count(*) as n from (
         select case when event_type = 'error' then 'header' when event_type = 'click' then 'pixel type' else m.reject_reason end
           as reject_reason
         from granules join mercator m using (event_id) where event_id%3 <> 0
         union all
         select coalesce(reject_reason, case when coh_name not like '%\\_%\\_%\\_%' escape '\\' then 'name'
           when coh_name like '%monsoon%' then 'season' end)
         from {first_headers_sql("coh_name", "spoiled")} where coh_name not in (select coh_name from spoiled where event_id%3 = 0)
         union all
         select reject_reason from {first_headers_sql("hand_name")} where not regexp_matches(hand_name, '_[NS]90_'))
       where reject_reason is not null group by 1""",
)
def refresh_rejects(spark, sf_dir):
    scenes = views.granules(spark, sf_dir)
    docs = views.header_docs_of(scenes, "opera_name", native=True)
    held = held_paths(scenes, "opera_name")
    # some headers never landed, and some tell a band type that the catalog cannot hold
    landed = docs.where("event_type <> 'error'").withColumn(
        "doc",
        F.when(F.col("event_type") == "click", F.regexp_replace("doc", '"type":"[A-Za-z0-9]+"', '"type":"CInt16"')).otherwise(
            F.col("doc")
        ),
    )
    rows = ingest.in_web_mercator(ingest.read_new(docs.select("path"), landed.select("path", "doc"), held, ROOT))
    # each is looked at twice: rows without a header, and rows whose name says too little
    coh, hand = staged(new_rows(spoiled_names(scenes), "coh_name"), "coh-rows"), staged(hand_rows(scenes), "hand-rows")
    tiles = ingest.check_attributes(hand_attributes(ingest.accepted(hand)), ("tile",))
    found = [rows, coh, ingest.season_attributes(ingest.accepted(coh)), hand, tiles]
    reasons = [ingest.rejected(f).select("reject_reason") for f in found]
    return functools.reduce(DataFrame.unionAll, reasons).groupBy("reject_reason").agg(F.count("*").alias("n"))
