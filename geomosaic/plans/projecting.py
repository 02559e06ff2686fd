"""Queries over scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from geomosaic.functions import dates, names, text
from geomosaic.functions import headers as H
from geomosaic.operators import catalog
from geomosaic.plans import sinking, views
from geomosaic.plans.registry import query
from geomosaic.sources import readers


@query("prj_stem", "select event_id, opera_name as stem, opera_name || '.tif' as stem_aux from granules")
def prj_stem(spark, sf_dir):
    path = F.col("path")
    return views.headers(spark, sf_dir).select(
        "event_id", names.stem(path).alias("stem"), names.stem(F.concat(path, F.lit(".xml"))).alias("stem_aux")
    )


@query(
    "prj_vsi_path",
    """select event_id, concat('/vsis3/', bucket, '/', key) as path, concat('s3://', bucket, '/', key) as url,
         concat('/vsis3/', bucket, '/', key) as path_again from inventory""",
)
def prj_vsi_path(spark, sf_dir):
    path = names.vsi_path(F.col("bucket"), F.col("key"))
    url = names.vsi_to_s3(path)
    return views.inventory(spark, sf_dir).select(
        "event_id", path.alias("path"), url.alias("url"), names.s3_to_vsi(url).alias("path_again")
    )


@query("prj_strip_prefix", "select event_id, opera_name || '.tif' as key from granules")
def prj_strip_prefix(spark, sf_dir):
    key = names.strip_prefix(F.col("path"), F.lit(f"/vsis3/{views.BUCKET}/"))
    return views.headers(spark, sf_dir).select("event_id", key.alias("key"))


@query(
    "prj_header_flatten",
    """select path as raster, x_min, y_min, x_max, y_max, n_rows, n_cols, 1 as n_bands,
         case band_type when 'Byte' then 3 when 'Int16' then 6 else 9 end as pixel_type, cast(epsg as varchar) as srs
       from headers""",
)
def prj_header_flatten(spark, sf_dir):
    parsed = readers.parse_headers(views.header_docs(spark, sf_dir))
    return parsed.select(*[c.alias(n) for n, c in H.flatten(F.col("header")).items()])


@query(
    "prj_pixel_type",
    """select event_id, t as band_type,
         case t when 'Byte' then 3 when 'Int16' then 6 when 'Float32' then 9 end as pixel_type,
         case when t not in ('Byte','Int16','Float32') then 'pixel type' end as reject_reason
       from (select event_id, case when user_id%13=0 then 'CInt16' else band_type end as t
             from headers join granules using (event_id))""",
)
def prj_pixel_type(spark, sf_dir):
    scenes = views.headers_of(views.granules(spark, sf_dir), "user_id")
    mixed = scenes.selectExpr("event_id", "case when user_id%13=0 then 'CInt16' else band_type end as band_type")
    code = H.pixel_type(F.col("band_type"))
    return mixed.select(
        "event_id",
        "band_type",
        code.alias("pixel_type"),
        F.when(code.isNull(), F.lit("pixel type")).alias("reject_reason"),
    )


@query("prj_epsg", "select event_id, cast(epsg as varchar) as srs, null::varchar as no_srs from headers")
def prj_epsg(spark, sf_dir):
    wkt = F.get_json_object("doc", "$.coordinateSystem.wkt")
    return views.header_docs(spark, sf_dir).select(
        "event_id",
        H.root_epsg(wkt).alias("srs"),
        H.root_epsg(F.regexp_replace(wkt, r',AUTHORITY\["EPSG","\d+"\]\]$', "]")).alias("no_srs"),
    )


@query(
    "prj_name_rtc",
    """select event_id, split_part(rtc_name,'_',9) as tag, left(rtc_name,46) as group_name, start_date,
         start_date as end_date, 'https://fixture.example/scenes/'||rtc_name||'.tif' as download_url from granules""",
)
def prj_name_rtc(spark, sf_dir):
    fields = names.rtc_fields(F.col("rtc_name"), F.lit(f"{views.SITE}scenes/"))
    return views.granules(spark, sf_dir).select("event_id", *[c.alias(n) for n, c in fields.items()])


@query(
    "prj_name_opera",
    """select event_id, 'OPERA_L2_RTC-S1_V1_'||pol as tag, left(opera_name, length(opera_name)-3) as group_name,
         pol as polarization, start_date, start_date as end_date,
         'https://fixture.example/'||opera_name||'.tif' as download_url, opera_name as url_display from granules""",
)
def prj_name_opera(spark, sf_dir):
    fields = names.opera_fields(F.col("opera_name"), views.VERSION, F.lit(views.SITE))
    return views.granules(spark, sf_dir).select("event_id", *[c.alias(n) for n, c in fields.items()])


@query(
    "prj_name_coh",
    """select event_id, tile, season_name, polarization, product_type, dataset as tag, dataset as group_name from coherence""",
)
def prj_name_coh(spark, sf_dir):
    return views.coherence(spark, sf_dir).selectExpr(
        "event_id", "tile", "season_name", "polarization", "product_type", "dataset as tag", "dataset as group_name"
    )


@query(
    "prj_name_hand",
    """select event_id, t as tile, 'GLO30_HAND' as tag, 'Global_30m_HAND' as dataset_id, 'GLO30_HAND_'||t as product_name,
         'GLO30_HAND_'||t as url_display, 'https://fixture.example/v1/'||hand_name||'.tif' as download_url
       from (select event_id, hand_name, regexp_extract(hand_name,'_([NS]\\d+)_00_([EW]\\d+)_',1)
               ||regexp_extract(hand_name,'_([NS]\\d+)_00_([EW]\\d+)_',2) as t from granules)""",
)
def prj_name_hand(spark, sf_dir):
    fields = names.hand_fields(F.col("hand_name"), F.lit(f"{views.SITE}v1/"))
    return views.granules(spark, sf_dir).select("event_id", *[c.alias(n) for n, c in fields.items()])


@query(
    "prj_overview_name",
    """select distinct 'FIXTURE_'||dataset||'_240131_0000_overview' as name, product_type, polarization, season_code
       from coherence""",
)
def prj_overview_name(spark, sf_dir):
    run = names.run_name(F.lit("FIXTURE"), F.col("dataset"), views.as_of())
    named = views.coherence(spark, sf_dir).select(F.concat(run, F.lit("_overview")).alias("name")).distinct()
    return named.withColumns(names.overview_parts(F.col("name")))


@query(
    "prj_download_url",
    """select event_id, 'https://fixture.example/scenes/'||rtc_name||'.tif' as rtc_url,
         'https://fixture.example/'||opera_name||'.tif' as opera_url,
         'https://fixture-bucket.example/tiles/'||coh_name||'.tif' as coh_url,
         'https://fixture.example/v1/'||hand_name||'.tif' as hand_url from granules""",
)
def prj_download_url(spark, sf_dir):
    site = views.SITE
    coh_path = F.concat(F.lit(f"/vsis3/{views.BUCKET}/tiles/"), "coh_name", F.lit(".tif"))
    coh_key = names.strip_prefix(coh_path, F.lit(f"/vsis3/{views.BUCKET}/"))
    return views.granules(spark, sf_dir).select(
        "event_id",
        names.rtc_fields(F.col("rtc_name"), F.lit(f"{site}scenes/"))["download_url"].alias("rtc_url"),
        names.opera_fields(F.col("opera_name"), views.VERSION, F.lit(site))["download_url"].alias("opera_url"),
        F.concat(F.lit(f"https://{views.BUCKET}.example/"), coh_key).alias("coh_url"),
        names.hand_fields(F.col("hand_name"), F.lit(f"{site}v1/"))["download_url"].alias("hand_url"),
    )


@query(
    "prj_dates",
    """select event_id, strftime(start_date, '%m/%d/%Y %H:%M:%S') as acquired, start_date, start_date as end_date,
         null::varchar as no_date from granules""",
)
def prj_dates(spark, sf_dir):
    acquired = names.catalog_text(F.col("start_date"))
    start = names.catalog_time(acquired)
    return views.granules(spark, sf_dir).select(
        "event_id",
        acquired.alias("acquired"),
        start.alias("start_date"),
        start.alias("end_date"),
        names.catalog_time(F.regexp_replace(acquired, "/", "-")).cast("string").alias("no_date"),
    )


@query(
    "prj_resolution_consts",
    """select g.event_id, f.* from (select event_id, case event_id%5 when 0 then 'RTC' when 1 then 'OPERA' when 2 then 'COH'
           when 3 then 'SAMPLE' else 'HAND' end as family from granules) g
       join (values ('RTC',1610.0::double,1600.0::double,1200.0::double,50), ('OPERA',460.0,450.0,450.0,75),
         ('COH',910.0,900.0,900.0,50), ('SAMPLE',810.0,800.0,800.0,50), ('HAND',610.0,600.0,600.0,50))
         f(family, source_max_ps, overview_min_ps, overview_cell, mosaic_cap) using (family)""",
)
def prj_resolution_consts(spark, sf_dir):
    tagged = views.granules(spark, sf_dir).selectExpr(
        "event_id",
        "case event_id%5 when 0 then 'RTC' when 1 then 'OPERA' when 2 then 'COH' when 3 then 'SAMPLE' else 'HAND' end as family",
    )
    return catalog.with_family(tagged)


@query("prj_center", "select item_id, name, (x_min+x_max)/2 as center_x, (y_min+y_max)/2 as center_y from scenes")
def prj_center(spark, sf_dir):
    return views.scenes(spark, sf_dir).select("item_id", "name", "center_x", "center_y")


@query(
    "prj_run_stamp",
    """select event_id, 'FIXTURE_'||pol||'_'||strftime(start_date,'%y%m%d_%H%M') as run_name,
         'FIXTURE_'||pol||'_'||strftime(start_date,'%y%m%d_%H%M')||'_overview' as overview_name from granules""",
)
def prj_run_stamp(spark, sf_dir):
    run = names.run_name(F.lit("FIXTURE"), F.col("pol"), F.col("start_date"))
    return views.granules(spark, sf_dir).select(
        "event_id", run.alias("run_name"), F.concat(run, F.lit("_overview")).alias("overview_name")
    )


@query("prj_epoch_ms", "select event_id, epoch_ms(start_date) as start_ms from granules")
def prj_epoch_ms(spark, sf_dir):
    return views.granules(spark, sf_dir).select("event_id", dates.epoch_ms(F.col("start_date")).alias("start_ms"))


@query(
    "prj_interval_math",
    """select event_id, date_trunc('second', ts) - interval 8 hours as lead, date_trunc('second', ts) + interval 8 hours as lag,
         date_trunc('second', ts) + interval 1 day as range_end,
         date_trunc('second', ts) + interval 1 day - interval 364 days as range_start,
         date_trunc('second', ts) + interval 1 day - interval 21 days as extent_start from events""",
)
def prj_interval_math(spark, sf_dir):
    when = dates.whole_second(F.col("ts"))
    return views.table(spark, sf_dir, "events").select(
        "event_id",
        dates.overview_start(F.col("ts")).alias("lead"),
        dates.overview_end(F.col("ts")).alias("lag"),
        dates.range_end(when).alias("range_end"),
        dates.range_start(when).alias("range_start"),
        dates.extent_start(when).alias("extent_start"),
    )


@query(
    "prj_pol_from_suffix",
    """select event_id, pol, cast(right(split_part(coh_name,'_',4),2) as int) as interval_days from granules""",
)
def prj_pol_from_suffix(spark, sf_dir):
    suffix = F.concat(F.lit("_"), "pol", F.lit(".tif"))
    return views.granules(spark, sf_dir).select(
        "event_id",
        names.suffix_polarization(suffix).alias("pol"),
        names.product_interval(F.substring_index("coh_name", "_", -1)).alias("interval_days"),
    )


@query(
    "prj_pol_class",
    """select event_id, pol, case when pol in ('VH','HV') then 'cross-polarized: volume scattering'
         when pol = 'VV' then 'co-polarized: surface roughness and soil moisture'
         when pol = 'HH' then 'co-polarized: double-bounce scattering' else '' end as note from granules""",
)
def prj_pol_class(spark, sf_dir):
    return views.granules(spark, sf_dir).select("event_id", "pol", names.polarization_class(F.col("pol")).alias("note"))


@query("prj_render_text", sinking.DATASET_TEXT_SQL)
def prj_render_text(spark, sf_dir):
    return sinking.dataset_texts(spark, sf_dir)


@query(
    "prj_template_list",
    """select event_id, case when pol in ('VV','VH') then 'rft/Power.xml;rft/dB.xml;None' else 'None' end as templates,
         case when pol in ('VV','VH') then 'rft/dB.xml' else 'None' end as default_template from granules""",
)
def prj_template_list(spark, sf_dir):
    scaled = F.col("pol").isin("VV", "VH")
    listed = F.when(scaled, F.array(F.lit("Power.xml"), F.lit("dB.xml"))).otherwise(F.array().cast("array<string>"))
    chosen = F.when(scaled, F.lit("dB.xml")).otherwise(F.lit("None"))
    return views.granules(spark, sf_dir).select(
        "event_id",
        text.template_list(listed, "rft").alias("templates"),
        text.default_template(chosen, "rft").alias("default_template"),
    )


@query(
    "prj_calculate_fields",
    """select item_id, name, left(name,46) as group_name, 1610.0::double as max_ps,
         case when dataset = 'OPERA_VV' then 'selected' else tag end as tag from scenes""",
)
def prj_calculate_fields(spark, sf_dir):
    named = catalog.calculate_fields(
        views.scenes(spark, sf_dir), {"group_name": "substring(name, 1, 46)", "max_ps": F.lit(1610.0)}
    )
    picked = catalog.calculate_fields(named, {"tag": F.lit("selected")}, where=F.col("dataset") == "OPERA_VV")
    return picked.select("item_id", "name", "group_name", "max_ps", "tag")


@query(
    "prj_add_fields",
    """select event_id, path, cast(null as timestamp) as start_date, cast(null as varchar) as download_url from headers""",
)
def prj_add_fields(spark, sf_dir):
    fields = {"start_date": "timestamp_ntz", "download_url": "string", "path": "string"}
    return catalog.add_fields(views.headers(spark, sf_dir).select("event_id", "path"), fields)


@query("prj_transmit", "select name, start_date, end_date, min_ps, max_ps, center_x, center_y, tag from items")
def prj_transmit(spark, sf_dir):
    fields = ("name", "start_date", "end_date", "min_ps", "max_ps", "center_x", "center_y", "tag", "start_date", "end_date")
    return catalog.transmit(views.items(spark, sf_dir), fields)


WINDOW_SCHEMA = (
    "title string, widgets struct<timeSlider: struct<properties: struct<startTime: bigint, endTime: bigint, "
    "timeStopInterval: struct<interval: int, units: string>, currentTimeExtent: array<bigint>, thumbCount: int>>>"
)


@query(
    "prj_json_window",
    """select event_id, event_type as title, 2 as thumbs, 1 as step, 'esriTimeUnitsDays' as units,
         epoch_ms(start_date + interval 1 day) as end_ms,
         epoch_ms(start_date + interval 1 day - interval 364 days) as start_ms,
         epoch_ms(start_date + interval 1 day - interval 21 days) as extent_from,
         epoch_ms(start_date + interval 1 day) as extent_to from granules""",
)
def prj_json_window(spark, sf_dir):
    docs = views.granules(spark, sf_dir).select(
        "event_id",
        "start_date",
        F.concat(
            F.lit('{"title":"'),
            "event_type",
            F.lit('","widgets":{"timeSlider":{"properties":{"startTime":0,"endTime":1,"thumbCount":2}}}}'),
        ).alias("doc"),
    )
    when = F.col("start_date")
    new = text.rewrite_window(
        docs,
        "doc",
        WINDOW_SCHEMA,
        dates.epoch_ms(dates.range_end(when)),
        dates.epoch_ms(dates.range_start(when)),
        dates.epoch_ms(dates.extent_start(when)),
    )

    def member(path, kind):
        return F.get_json_object("doc", path).cast(kind)

    base = "$.widgets.timeSlider.properties"
    return new.select(
        "event_id",
        member("$.title", "string").alias("title"),
        member(f"{base}.thumbCount", "int").alias("thumbs"),
        member(f"{base}.timeStopInterval.interval", "int").alias("step"),
        member(f"{base}.timeStopInterval.units", "string").alias("units"),
        member(f"{base}.endTime", "bigint").alias("end_ms"),
        member(f"{base}.startTime", "bigint").alias("start_ms"),
        member(f"{base}.currentTimeExtent[0]", "bigint").alias("extent_from"),
        member(f"{base}.currentTimeExtent[1]", "bigint").alias("extent_to"),
    )


@query(
    "prj_repair_paths",
    """select event_id, case when starts_with(p,'/old/cache/scenes/') then '/mnt/scenes/'||substr(p,19)
         when starts_with(p,'/old/') then '/mnt/other/'||substr(p,6) else p end as path
       from (select event_id, case event_id%3 when 0 then '/old/cache/scenes/' when 1 then '/old/' else '/kept/' end||opera_name as p
             from granules)""",
)
def prj_repair_paths(spark, sf_dir):
    broken = views.granules(spark, sf_dir).selectExpr(
        "event_id",
        "concat(case event_id%3 when 0 then '/old/cache/scenes/' when 1 then '/old/' else '/kept/' end, opera_name) as path",
    )
    return catalog.repair_paths(broken, {"/old/": "/mnt/other/", "/old/cache/scenes/": "/mnt/scenes/"})
