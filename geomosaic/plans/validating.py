"""Queries over quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from geomosaic.operators import catalog, quality
from geomosaic.plans import scanning, views
from geomosaic.plans.registry import query


@query(
    "qa_item_count",
    """select dataset, count(*)+1 as n_items, 1::bigint as n_overviews, count(*) as n_listed, true as ok
       from scenes group by dataset""",
)
def qa_item_count(spark, sf_dir):
    listed = views.granules(spark, sf_dir).select(F.concat(F.lit("OPERA_"), "pol").alias("dataset"))
    return quality.item_count(views.items(spark, sf_dir).select("dataset", "category"), listed)


@query(
    "qa_fields_populated",
    """select dataset, count(*) as n_rows, count(*)-count(name) as null_name, count(*)-count(start_date) as null_start_date,
         count(*)-count(min_ps) as null_min_ps, count(*)-count(item_id) as null_item_id from items group by dataset""",
)
def qa_fields_populated(spark, sf_dir):
    return quality.fields_populated(views.items(spark, sf_dir), ("name", "start_date", "min_ps", "item_id"))


@query(
    "qa_config_required",
    """select distinct dataset as dataset_name, k as missing_key from coherence,
         (values ('raster_store'),('bucket'),('overview_path'),('opera_version'),('service_folder'),('service_name')) t(k)""",
)
def qa_config_required(spark, sf_dir):
    return quality.missing_config(scanning.configs(spark, sf_dir))


@query("qa_unique_path", "select path, count(*) as n from listing group by path having count(*) > 1")
def qa_unique_path(spark, sf_dir):
    return quality.duplicate_paths(views.listing(spark, sf_dir))


@query(
    "qa_decimal_display",
    """select label, count(raw) as n_pixels,
         count(*) filter (where round(raw/100.0::double, 1) in (0,1) and raw not in (0,100)) as n_collapsed
       from (select label, floor(abs(v)*100) as raw from pixels) group by label""",
)
def qa_decimal_display(spark, sf_dir):
    raw = views.table(spark, sf_dir, "embeddings").select("label", F.explode("embedding").alias("e"))
    cells = raw.select("label", F.floor(F.abs(F.col("e").cast("double")) * 100).cast("double").alias("v"))
    return quality.decimal_display(cells, 1, ["label"])


@query(
    "qa_rejects",
    """select 'bucket' as reject_reason, count(*) as n from granules where user_id%9=0 having count(*) > 0""",
)
def qa_rejects(spark, sf_dir):
    scenes = views.headers_of(views.granules(spark, sf_dir), "user_id")
    mixed = scenes.selectExpr(f"case when user_id%9=0 then replace(path,'{views.BUCKET}','other') else path end as path")
    flagged = catalog.guard_prefix(mixed, f"/vsis3/{views.BUCKET}/", strict=False)
    return flagged.where("reject_reason is not null").groupBy("reject_reason").agg(F.count("*").alias("n"))
