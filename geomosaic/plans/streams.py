"""Queries over streams: the final tables of a run that uses up its input."""

from __future__ import annotations

from pyspark.sql import functions as F

from geomosaic.plans import views
from geomosaic.plans.registry import query
from geomosaic.session import work_path
from geomosaic.streaming import ingest


def scene_stream(spark, sf_dir):
    schema = views.table(spark, sf_dir, "events").schema
    return views.granules_of(ingest.landed_stream(spark, f"{sf_dir}/events.parquet*", schema))


@query("st_ingest", "select path, 1::bigint as n from headers")
def st_ingest(spark, sf_dir):
    held, copies = work_path(spark, "st_ingest"), F.explode(F.array(F.lit(0), F.lit(1)))
    for run in range(2):
        listed = scene_stream(spark, sf_dir).withColumn("copy", copies)
        paths = listed.select(F.expr(f"concat('/vsis3/{views.BUCKET}/',opera_name,'.tif')").alias("path"))
        ingest.ingest_catalog(paths, held, work_path(spark, f"st_ingest_checkpoint_{run}"), buckets=8)
    return spark.read.parquet(held).groupBy("path").agg(F.count("*").alias("n"))


@query(
    "st_extent",
    """select dataset, min(start_date) - interval 8 hours as overview_start, max(start_date) + interval 8 hours as overview_end
       from scenes group by dataset""",
)
def st_extent(spark, sf_dir):
    state = work_path(spark, "st_extent")
    named = scene_stream(spark, sf_dir).select(F.concat(F.lit("OPERA_"), "pol").alias("dataset"), "start_date")
    ingest.live_extent(named, state, work_path(spark, "st_extent_checkpoint"))
    return ingest.read_extent(spark, state)


@query(
    "st_sliding_counts",
    """select 'OPERA_'||pol as dataset, d as window_start, d + interval 21 days as window_end, count(*) as n_items
       from (select unnest(generate_series((select min(start_date)::date - 20 from granules), (select max(start_date)::date from granules),
         interval 1 day)) as d)
       join granules g on g.start_date >= d and g.start_date < d + interval 21 days group by 1, 2, 3""",
)
def st_sliding_counts(spark, sf_dir):
    sink = work_path(spark, "st_sliding_counts")
    named = scene_stream(spark, sf_dir).select(F.concat(F.lit("OPERA_"), "pol").alias("dataset"), "start_date")
    ingest.daily_deltas(named, sink, work_path(spark, "st_sliding_checkpoint"))
    windows = ingest.sliding_counts(spark, sink)
    return windows.select("dataset", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")], "n_items")
