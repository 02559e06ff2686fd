"""Queries over sorts and limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from geomosaic.operators import mosaic, records
from geomosaic.plans import views
from geomosaic.plans.registry import query


@query("ord_catalog_path", "select path, n_rows from headers order by path")
def ord_catalog_path(spark, sf_dir):
    return views.headers(spark, sf_dir).select("path", "n_rows").orderBy("path")


@query("ord_catalog_date", "select path, end_date from scenes order by end_date, path")
def ord_catalog_date(spark, sf_dir):
    return views.scenes(spark, sf_dir).select("path", "end_date").orderBy("end_date", "path")


@query(
    "lim_records",
    """select item_id, name, start_date, tag from scenes
       where start_date between timestamp '2024-01-05' and timestamp '2024-01-25'
         and x_min < 1500000 and x_max > 200000 and y_min < 1900000 and y_max > 100000
       order by item_id limit 2000""",
)
def lim_records(spark, sf_dir):
    return record_page(spark, sf_dir)


def record_page(spark, sf_dir, after=None):
    return records.records(
        views.scenes(spark, sf_dir),
        ["item_id"],
        fields=["item_id", "name", "start_date", "tag"],
        where="x_min < 1500000",
        box=(200000, 100000, 1e12, 1900000),
        time=("2024-01-05 00:00:00", "2024-01-25 00:00:00"),
        after=after,
    )


@query(
    "lim_records_next",
    """select item_id, name, start_date, tag from scenes
       where start_date between timestamp '2024-01-05' and timestamp '2024-01-25'
         and x_min < 1500000 and x_max > 200000 and y_min < 1900000 and y_max > 100000
       order by item_id limit 2000 offset 2000""",
)
def lim_records_next(spark, sf_dir):
    """The second page, by the key of the last record of the first."""
    return record_page(spark, sf_dir, after=records.last_key(record_page(spark, sf_dir), ["item_id"]))


@query(
    "lim_downloads",
    """select view_id, mosaic_rank, 'https://fixture.example/'||name||'.tif' as download_url from tile_choice
       where mosaic_rank <= 50""",
)
def lim_downloads(spark, sf_dir):
    capped = views.capped_tiles(spark, sf_dir, mosaic.MAX_DOWNLOADS)
    url = F.concat(F.lit(views.SITE), "name", F.lit(".tif"))
    return capped.select("view_id", "mosaic_rank", url.alias("download_url"))


@query(
    "lim_image_size",
    """select request_id, n_cols, n_rows, case when n_cols > 5000 or n_rows > 5000 then 'image size' end as reject_reason
       from (select request_id, cast(ceil((rx_max-rx_min)/(3+request_id%7)) as bigint) as n_cols,
               cast(ceil((ry_max-ry_min)/(3+request_id%7)) as bigint) as n_rows from requests)""",
)
def lim_image_size(spark, sf_dir):
    asked = views.requests(spark, sf_dir).selectExpr(
        "request_id",
        "ceil((rx_max-rx_min)/(3+request_id%7)) as n_cols",
        "ceil((ry_max-ry_min)/(3+request_id%7)) as n_rows",
    )
    too_big = (F.col("n_cols") > mosaic.MAX_IMAGE_COLS) | (F.col("n_rows") > mosaic.MAX_IMAGE_ROWS)
    return asked.withColumn("reject_reason", F.when(too_big, F.lit("image size")))


@query(
    "ord_season",
    """select distinct product_type, polarization, season_ordinal, dataset from coherence
       order by product_type, polarization, season_ordinal""",
)
def ord_season(spark, sf_dir):
    return (
        views.coherence(spark, sf_dir)
        .select("product_type", "polarization", "season_ordinal", "dataset")
        .distinct()
        .orderBy("product_type", "polarization", "season_ordinal")
    )
