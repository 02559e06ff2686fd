"""Queries over pixel functions and raster operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from geomosaic.functions import names, scales
from geomosaic.operators import aggregates, catalog, overviews, pixels
from geomosaic.operators.spatial import Box, join_boxes
from geomosaic.plans import mosaicking, views
from geomosaic.plans.registry import query
from geomosaic.session import staged, work_path


def blocks(spark, sf_dir, value=lambda v: v):
    """Tile blocks with a pixel function applied to the array; nothing is exploded."""
    return views.table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.transform("embedding", lambda v: value(v.cast("double"))).alias("values")
    )


def scaled(spark, sf_dir, source, **outputs):
    """Rows of (vec_id, k) with one column per named pixel function of the source value."""
    cells = blocks(spark, sf_dir).select("vec_id", F.posexplode("values").alias("k", "v"))
    raw = cells.select("vec_id", "k", source(F.col("v")).alias("raw"))
    return raw.select("vec_id", "k", "raw", *[F.round(f(F.col("raw")), 6).alias(n) for n, f in outputs.items()])


@query(
    "px_coherence_unscale",
    "select vec_id, k, raw, round(raw/100.0::double, 6) as unscaled from (select vec_id, k, floor(abs(v)*100) as raw from pixels)",
)
def px_coherence_unscale(spark, sf_dir):
    raw = blocks(spark, sf_dir, lambda v: F.floor(F.abs(v) * 100).cast("double"))
    both = raw.select(
        "vec_id", "values", scales.over_block(F.col("values"), scales.unscale_coherence).alias("unscaled")
    )
    return both.select("vec_id", F.posexplode(F.arrays_zip("values", "unscaled")).alias("k", "p")).select(
        "vec_id", "k", F.col("p.values").alias("raw"), F.round("p.unscaled", 6).alias("unscaled")
    )


@query(
    "px_amp_power",
    """select vec_id, k, raw, round(raw*raw/199526231.0::double, 6) as power
       from (select vec_id, k, floor(abs(v)*10000) as raw from pixels)""",
)
def px_amp_power(spark, sf_dir):
    return scaled(spark, sf_dir, lambda v: F.floor(F.abs(v) * 10000).cast("double"), power=scales.amplitude_power)


@query(
    "px_amp_db",
    """select vec_id, k, raw, case when raw > 0 then round(20*log10(raw)-83, 6) end as db
       from (select vec_id, k, floor(abs(v)*10000) as raw from pixels)""",
)
def px_amp_db(spark, sf_dir):
    return scaled(spark, sf_dir, lambda v: F.floor(F.abs(v) * 10000).cast("double"), db=scales.amplitude_db)


@query(
    "px_rtc_scales",
    """select vec_id, k, raw, round(raw,6) as power, round(sqrt(raw),6) as amplitude,
         case when raw > 0 then round(10*log10(raw),6) end as db from (select vec_id, k, abs(v) as raw from pixels)""",
)
def px_rtc_scales(spark, sf_dir):
    return scaled(
        spark,
        sf_dir,
        F.abs,
        power=scales.PIXEL_FUNCTIONS["rtc_power"],
        amplitude=scales.PIXEL_FUNCTIONS["rtc_amplitude"],
        db=scales.PIXEL_FUNCTIONS["rtc_db"],
    )


@query(
    "px_stretch_sd",
    """select p.view_id, gx, gy, round(case when hi = lo then 0 else 255*least(1,greatest(0,(v-lo)/(hi-lo))) end, 6) as stretched
       from view_pixels p join (select view_id, greatest(min(v), avg(v)-2*stddev_pop(v)) as lo,
         least(max(v), avg(v)+2*stddev_pop(v)) as hi from view_pixels group by view_id) s using (view_id)""",
)
def px_stretch_sd(spark, sf_dir):
    # the mosaic of the views is read for their statistics and for their pixels
    shown = pixels.stretch_deviation(staged(mosaicking.view_cells(spark, sf_dir), "view-cells"), ["view_id"])
    return shown.select("view_id", "gx", "gy", F.round("stretched", 6).alias("stretched"))


@query(
    "px_db_stretch",
    """select p.vec_id, p.k, round(case when hi = lo then 0 else 255*least(1,greatest(0,(db-lo)/(hi-lo))) end, 6) as stretched
       from (select vec_id, label, k, case when v <> 0 then 10*log10(abs(v)) end as db from pixels) p
       join (select label, greatest(min(db), avg(db)-2*stddev_pop(db)) as lo, least(max(db), avg(db)+2*stddev_pop(db)) as hi
             from (select label, case when v <> 0 then 10*log10(abs(v)) end as db from pixels) group by label) s using (label)""",
)
def px_db_stretch(spark, sf_dir):
    cells = blocks(spark, sf_dir).select("vec_id", "label", F.posexplode("values").alias("k", "v"))
    db = cells.select("vec_id", "label", "k", scales.power_db(F.abs("v")).alias("v"))
    shown = pixels.stretch_deviation(db, ["label"])
    return shown.select("vec_id", "k", F.round("stretched", 6).alias("stretched"))


RESAMPLE_SQL = """
select vec_id, out_col, out_row, embedding[cast(row*8+col+1 as int)]::double as v from (
  select vec_id, embedding, out_col, out_row, floor(((out_col+0.5)*{cell}-x_min)/450) as col,
    floor((y_max-(100000-(out_row+0.5)*{cell}))/450) as row
  from tiles, (select unnest(generate_series(0::bigint,60)) as out_col), (select unnest(generate_series(0::bigint,60)) as out_row))
where col between 0 and 7 and row between 0 and 7"""


@query("px_resample_nearest", RESAMPLE_SQL.format(cell="800.0::double"))
def px_resample_nearest(spark, sf_dir):
    return pixels.resample_nearest(views.tiles(spark, sf_dir), ["vec_id"], F.lit(800.0), views.TOP)


#: Newest first; the tile number as text settles ties and stands for undated tiles' names.
OVERVIEW_ORDER = "struct_pack(a := abs(epoch_us(start_date) - epoch_us(timestamp '2050-01-01')), b := vec_id::varchar)"


@query(
    "px_overview",
    " union all ".join(
        f"""select '{family}' as family, out_col, out_row, arg_min(v, {OVERVIEW_ORDER}) as v
            from ({RESAMPLE_SQL.format(cell=f"{cell}.0::double")}) r join (select vec_id, start_date from tiles) t
            using (vec_id) where v between 0 and 4294967295 group by out_col, out_row"""
        for family, cell in (("RTC", 1200), ("OPERA", 450), ("COH", 900), ("SAMPLE", 800), ("HAND", 600))
    ),
)
def px_overview(spark, sf_dir):
    """The whole mosaic at the overview cell of each family, written to a store and read from it."""
    store = overview_store(spark, sf_dir, [F.lit(True)])
    return store.select(F.col("dataset").alias("family"), "out_col", "out_row", "v")


def overview_cell():
    """The overview cell of a row's family."""
    sizes = {row[0]: row[3] for row in catalog.FAMILIES}
    return F.element_at(F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair]), F.col("dataset"))


def overview_store(spark, sf_dir, runs, size=64):
    """The store after a run over the tiles that each condition picks."""
    store = work_path(spark, "overview-store")
    every = F.explode(F.array(*[F.lit(row[0]) for row in catalog.FAMILIES])).alias("dataset")
    for run in runs:
        dated = views.dated_tiles(spark, sf_dir).where(run)
        items = dated.select(every, F.col("vec_id").cast("string").alias("name"), "start_date")
        tiles = views.tiles(spark, sf_dir).where(run)
        blocks = tiles.select("*", every).withColumn("name", F.col("vec_id").cast("string"))
        overviews.update(store, blocks, items, overview_cell(), views.TOP, size)
    return overviews.read_store(spark, store)


@query(
    "px_overview_update",
    " union all ".join(
        f"""select '{family}' as family, out_col, out_row, arg_min(v, {OVERVIEW_ORDER}) as v, arg_min(vec_id, {OVERVIEW_ORDER}) as vec_id
            from ({RESAMPLE_SQL.format(cell=f"{cell}.0::double")}) r join (select vec_id, start_date from tiles) t
            using (vec_id) where v between 0 and 4294967295 group by out_col, out_row"""
        for family, cell in (("RTC", 1200), ("OPERA", 450), ("COH", 900), ("SAMPLE", 800), ("HAND", 600))
    ),
)
def px_overview_update(spark, sf_dir):
    """The same store after three runs, of which the later ones rewrite only what their tiles touch."""
    runs = [F.expr("label < 5"), F.expr("label >= 5 and vec_id % 3 = 0"), F.expr("label >= 5 and vec_id % 3 <> 0")]
    store = overview_store(spark, sf_dir, runs, size=16)
    return store.select(F.col("dataset").alias("family"), "out_col", "out_row", "v", F.col("name").cast("bigint").alias("vec_id"))


@query(
    "px_project_3857",
    """select event_id, epsg, round(mx_min,3) as mx_min, round(my_min,3) as my_min, round(mx_max,3) as mx_max,
         round(my_max,3) as my_max, reject_reason from mercator""",
)
def px_project_3857(spark, sf_dir):
    done = pixels.project_extent(views.native_headers_of(views.granules(spark, sf_dir)))
    sides = ("mx_min", "my_min", "mx_max", "my_max")
    return done.select("event_id", "epsg", *[F.round(c, 3).alias(c) for c in sides], "reject_reason")


@query(
    "px_clip",
    """select vec_id, gx, gy, v from pixels join
         (select vec_id, min(gx) as x0, max(gx) as x1, min(gy) as y0, max(gy) as y1 from pixels where v between 0 and 4294967295
          group by vec_id) f using (vec_id)
       where gx between x0 and x1 and gy between y0 and y1""",
)
def px_clip(spark, sf_dir):
    tiles = views.tiles(spark, sf_dir)
    # the footprint stays in the row of its block
    framed = aggregates.footprint(tiles, ["vec_id", "label", "values", "n_cols"])
    cells = views.with_grid(
        pixels.explode_cells(framed, ["vec_id", "label", "fx_min", "fy_min", "fx_max", "fy_max"])
    ).withColumns({"x": F.expr("(gx+0.5D)*450"), "y": F.lit(views.TOP) - F.expr("(gy+0.5D)*450")})
    box = [F.col(c) for c in ("fx_min", "fy_min", "fx_max", "fy_max")]
    return pixels.clip(cells, "x", "y", box).select("vec_id", "gx", "gy", "v")


@query(
    "px_water_extent",
    """select vec_id, k, case when w=1 then 1 end as blue, case when w in (0,1) then w end as white_blue
       from (select vec_id, k, case when v > 0.1 then 1 when v < -0.3 then 255 else 0 end as w from pixels)""",
)
def px_water_extent(spark, sf_dir):
    cells = blocks(spark, sf_dir).select("vec_id", F.posexplode("values").alias("k", "v"))
    w = F.when(F.col("v") > 0.1, 1).when(F.col("v") < -0.3, 255).otherwise(0)
    water = cells.select("vec_id", "k", w.alias("w"))
    return water.select(
        "vec_id",
        "k",
        scales.water_blue(F.col("w")).alias("blue"),
        scales.water_white_blue(F.col("w")).alias("white_blue"),
    )


@query(
    "px_water_legacy",
    "select vec_id, k, case when v > 0 then 1 end as old, case when v > 0 then 1 else 0 end as water from pixels",
)
def px_water_legacy(spark, sf_dir):
    cells = blocks(spark, sf_dir).select("vec_id", F.posexplode("values").alias("k", "v"))
    old = cells.select("vec_id", "k", F.when(F.col("v") > 0, F.lit(1)).alias("old"))
    return old.withColumn("water", scales.water_from_legacy(F.col("old")))


@query(
    "px_identify",
    """select p.point_id, t.vec_id, t.name, t.start_date, floor(abs(px.v)*100) as raw,
         round(floor(abs(px.v)*100)/100.0::double, 2) as unscaled
       from (select c_custkey as point_id, c_custkey*15485863%25000+0.5::double as x,
               100000-(c_custkey*32452843%25000+0.5::double) as y from customer) p
       join tiles t on p.x >= t.x_min and p.x < t.x_max and p.y >= t.y_min and p.y < t.y_max
       join pixels px on px.vec_id = t.vec_id
         and px.k = cast(floor((t.y_max-p.y)/450)*8 + floor((p.x-t.x_min)/450) as bigint)""",
)
def px_identify(spark, sf_dir):
    points = views.table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as point_id",
        "c_custkey*15485863%25000+0.5D as x",
        f"{views.TOP}D-(c_custkey*32452843%25000+0.5D) as y",
    )
    # a block meets its points with its values, so the pairs need not move to them
    slim = views.dated_tiles(spark, sf_dir).select("vec_id", "name", "start_date", "x_min", "y_min", "x_max", "y_max")
    held = views.table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("values"))
    pairs = join_boxes(slim.join(held, "vec_id"), points, Box(), Box("x", "y", "x", "y"), half_open=True, stored=(False, True))
    found = pairs.withColumns({"cell": F.lit(450.0), "n_cols": F.lit(8), "n_rows": F.lit(8)})
    raw = F.floor(F.abs(pixels.value_at(F.col("x"), F.col("y")).cast("double")) * 100).cast("double")
    return found.select("point_id", "vec_id", "name", "start_date", raw.alias("raw")).withColumn(
        "unscaled", F.round(scales.unscale_coherence(F.col("raw")), 2)
    )


@query(
    "px_overview_item",
    " union all ".join(
        f"""select '{family}' as dataset, 'FIXTURE_{family}_240131_0000_overview' as name, 2 as category, {smallest}::double as min_ps,
              {cell}::double as low_ps, min(start_date) - interval 8 hours as start_date, max(start_date) + interval 8 hours as end_date,
              any_value(w.x_min) as x_min, any_value(w.y_min) as y_min, any_value(w.x_max) as x_max, any_value(w.y_max) as y_max,
              1::bigint as n_overviews
            from tiles, (select min(out_col)*{cell}::double as x_min, 100000-(max(out_row)+1)*{cell}::double as y_min,
              (max(out_col)+1)*{cell}::double as x_max, 100000-min(out_row)*{cell}::double as y_max
              from ({RESAMPLE_SQL.format(cell=f"{cell}::double")}) where v between 0 and 4294967295) w"""
        for family, _, smallest, cell, _ in catalog.FAMILIES
    ),
)
def px_overview_item(spark, sf_dir):
    """The overview of each family, added to the items with the extent and cell of what was written."""
    every = F.explode(F.array(*[F.lit(row[0]) for row in catalog.FAMILIES])).alias("dataset")
    sources = views.dated_tiles(spark, sf_dir).select(
        every, "name", F.lit("t").alias("tag"), "start_date", "x_min", "y_min", "x_max", "y_max", F.lit(1).alias("category")
    )
    store = overview_store(spark, sf_dir, [F.lit(True)])
    name = F.concat(names.run_name(F.lit("FIXTURE"), F.col("dataset"), views.as_of()), F.lit("_overview"))
    smallest = F.create_map(*[F.lit(x) for row in catalog.FAMILIES for x in (row[0], row[2])])
    found = overviews.records(store, sources, overview_cell(), views.TOP, name)
    found = found.withColumn("min_ps", F.element_at(smallest, F.col("dataset")))
    merged = catalog.append_overview(sources, found).where(catalog.is_overview())
    held = ["dataset", "name", "category", "min_ps", "low_ps", "start_date", "end_date", "x_min", "y_min", "x_max", "y_max"]
    return merged.groupBy(*held).agg(F.count("*").alias("n_overviews"))
