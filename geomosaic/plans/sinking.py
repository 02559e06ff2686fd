"""Queries over sinks: write a run, and read it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from geomosaic.functions import names, text
from geomosaic.plans import views
from geomosaic.plans.registry import query
from geomosaic.session import work_path
from geomosaic.sources import readers, writers


@query(
    "sink_catalog_csv",
    "select path, cast(x_min as bigint) as x_min, cast(epsg as varchar) as srs from headers",
)
def sink_catalog_csv(spark, sf_dir):
    rows = views.headers(spark, sf_dir).selectExpr("path", "cast(x_min as bigint) as x_min", "epsg as srs")
    run = writers.write_catalog_csv(rows, work_path(spark, "sink_catalog_csv"))
    held = readers.read_catalog_csv(spark, run, ["path", "x_min", "srs"])
    return held.withColumn("x_min", F.col("x_min").cast("bigint"))


@query("sink_catalog_append", "select path, n_cols, 1::bigint as n from headers")
def sink_catalog_append(spark, sf_dir):
    held = work_path(spark, "sink_catalog_append")
    rows = views.headers(spark, sf_dir).select("event_id", "path", "n_cols")
    writers.append_catalog(rows.where("event_id % 3 = 0").drop("event_id"), held)
    writers.append_catalog(rows.drop("event_id"), held)
    writers.append_catalog(rows.drop("event_id"), held)
    return spark.read.parquet(held).groupBy("path", "n_cols").agg(F.count("*").alias("n")).orderBy("path")


@query(
    "sink_url_list",
    """select concat('/vsis3/fixture-bucket/', opera_name, '.tif') as path from granules where event_id%10 <> 0""",
)
def sink_url_list(spark, sf_dir):
    pages = views.search_granules(spark, sf_dir).select(
        "pol",
        F.array(
            F.struct(
                F.from_json("doc", "umm struct<RelatedUrls: array<struct<URL: string>>>")["umm"].alias("umm")
            )
        ).alias("items"),
    )
    run = writers.write_path_list(readers.granule_paths(pages).select("path"), work_path(spark, "sink_url_list"))
    return spark.read.text(run).select(F.col("value").alias("path"))


DATASET_TEXT = (
    "Median {{ interval }}-day coherence ({{ data_type }}), {{ polarization }}, {{ months_abbreviated }}: "
    "{{ season }} over {{ months_full }}, {{ n_items }} tiles"
)


def dataset_texts(spark, sf_dir):
    """A text per coherence dataset."""
    groups = (
        views.coherence(spark, sf_dir)
        .groupBy("dataset", "product_type", "polarization", "season_name", "season_short", "season")
        .agg(F.count("*").alias("n_items"))
    )
    fields = {
        "data_type": F.col("product_type"),
        "interval": names.product_interval(F.col("product_type")),
        "polarization": F.col("polarization"),
        "months_abbreviated": F.col("season_short"),
        "season": F.col("season_name"),
        "months_full": F.col("season"),
        "n_items": F.col("n_items"),
    }
    return groups.select("dataset", text.render(DATASET_TEXT, fields).alias("text"))


DATASET_TEXT_SQL = """
select dataset, concat('Median ', cast(right(product_type,2) as int), '-day coherence (', product_type, '), ', polarization,
  ', ', season_short, ': ', season_name, ' over ', season, ', ', count(*), ' tiles') as text
from coherence group by dataset, product_type, polarization, season_short, season_name, season"""


@query("sink_item_text", DATASET_TEXT_SQL)
def sink_item_text(spark, sf_dir):
    run = writers.write_text_by_dataset(dataset_texts(spark, sf_dir), work_path(spark, "sink_item_text"))
    return spark.read.text(run).select("dataset", F.col("value").alias("text"))


@query(
    "sink_items",
    """select 'FIXTURE_240131_0000' as run_name, timestamp '2024-01-31 00:00:00' as run_stamp, dataset, name, category, start_date,
         x_min, max_ps, (select count(*) from items) as n_items
       from items""",
)
def sink_items(spark, sf_dir):
    """The last complete run of three, of which the newest broke off before its manifest."""
    base, items = work_path(spark, "sink_items"), views.items(spark, sf_dir)
    earlier = F.expr("timestamp_ntz'2024-01-30 00:00:00'")
    writers.write_run(items.where("item_id%2 = 0"), base, "FIXTURE_240130_0000", earlier)
    for _ in range(2):  # the second time finds it complete
        writers.write_run(items, base, "FIXTURE_240131_0000", views.as_of())
    writers.write_items(items.limit(1), f"{base}/runs/FIXTURE_240201_0000")
    counts = writers.complete_runs(spark, base).select("run_name", "n_items")
    return writers.read_last_run(spark, base).join(F.broadcast(counts), "run_name").select(
        "run_name", "run_stamp", "dataset", "name", "category", "start_date", "x_min", "max_ps", "n_items"
    )
