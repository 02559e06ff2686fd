"""Whole requests, from the item table and the stored overviews to the pixels of the image."""

from __future__ import annotations

from pyspark.sql import functions as F

from geomosaic.functions import scales
from geomosaic.operators import catalog, mosaic, overviews, serving
from geomosaic.operators.bounded import join_measured
from geomosaic.plans import rastering, views
from geomosaic.plans.registry import query

LIMITS = {row[0]: row for row in catalog.FAMILIES}
FAMILIES = {
    "RTC": serving.Family(mosaic.by_attribute, LIMITS["RTC"][4], scales.PIXEL_FUNCTIONS["rtc_amplitude"]),
    "OPERA": serving.Family(mosaic.by_attribute, LIMITS["OPERA"][4], scales.PIXEL_FUNCTIONS["rtc_db"]),
    "HAND": serving.Family(mosaic.by_name, LIMITS["HAND"][4], lambda v: v),
}


def family_overviews(family):
    _, largest, smallest, cell, _ = LIMITS[family]
    return f"""select '{family}' as dataset, out_col, out_row, arg_min(v, {rastering.OVERVIEW_ORDER}) as v
         from ({rastering.RESAMPLE_SQL.format(cell=f"{cell}::double")}) r join (select vec_id, start_date from tiles) t
         using (vec_id) where v between 0 and 4294967295 group by out_col, out_row"""


SERVE_SQL = f"""
with family as (select * from (values {", ".join(f"('{f}', {LIMITS[f][1]}::double, {LIMITS[f][2]}::double, {LIMITS[f][3]}::double, {LIMITS[f][4]})" for f in FAMILIES)})
    t(dataset, source_max, overview_min, overview_cell, cap)),
  stored as ({" union all ".join(map(family_overviews, FAMILIES))}),
  asked as (select view_id as request_id, gx0*450.0::double+100 as rx_min, (gx0+span)*450.0::double+100 as rx_max,
      100000-(gy0+span)*450.0::double+50 as ry_min, 100000-gy0*450.0::double+50 as ry_max,
      case view_id%3 when 0 then 'RTC' when 1 then 'OPERA' else 'HAND' end as asked,
      case view_id%4 when 0 then 300.0::double when 1 then 455 when 2 then 1605 else case when view_id%8 = 3 then 0.5 else 2000 end end as cell,
      case when view_id%5 > 1 then timestamp '2024-01-05' end as t_from, case when view_id%5 > 2 then timestamp '2024-01-20' end as t_to
    from tile_views),
  shown as (
    select dataset, vec_id::varchar as name, start_date, start_date as end_date, x_min, y_min, x_max, y_max, null::double as min_ps, source_max as max_ps
    from tiles, family
    union all
    select s.dataset, s.dataset||'_overview', min(t.a), min(t.b), min(out_col)*any_value(overview_cell),
      100000-(max(out_row)+1)*any_value(overview_cell), (max(out_col)+1)*any_value(overview_cell), 100000-min(out_row)*any_value(overview_cell),
      any_value(overview_min), null
    from stored s join family using (dataset), (select min(start_date) - interval 8 hours as a, max(start_date) + interval 8 hours as b from tiles) t
    group by s.dataset),
  ranked as (
    select r.*, i.dataset, i.name, row_number() over (partition by r.request_id order by
        case when r.asked <> 'HAND' then i.start_date is null end, case when r.asked <> 'HAND' then abs(epoch_us(i.start_date) - epoch_us(timestamp '2050-01-01')) end, i.name) as place
    from asked r join shown i on i.dataset = r.asked and i.x_min < r.rx_max and r.rx_min < i.x_max and i.y_min < r.ry_max and r.ry_min < i.y_max
    where coalesce(i.min_ps, 0) <= r.cell and (i.max_ps is null or r.cell <= i.max_ps)
      and ceil((rx_max-rx_min)/cell) <= 5000 and ceil((ry_max-ry_min)/cell) <= 5000
      and (t_from is null and t_to is null or i.start_date <= coalesce(t_to, i.start_date) and i.end_date >= coalesce(t_from, i.end_date))),
  kept as (select k.* from ranked k join family f using (dataset) where k.place <= f.cap),
  grid as (
    select *, unnest(generate_series(cast(ceil(rx_min/cell-0.5) as bigint), cast(floor(rx_max/cell-0.5) as bigint))) as out_col
    from (select *, unnest(generate_series(cast(ceil((100000-ry_max)/cell-0.5) as bigint), cast(floor((100000-ry_min)/cell-0.5) as bigint))) as out_row
          from (select distinct request_id, rx_min, rx_max, ry_min, ry_max, cell from kept))),
  centres as (select k.request_id, k.dataset, k.name, k.place, g.out_row, g.out_col, (g.out_col+0.5)*g.cell as x, 100000-(g.out_row+0.5)*g.cell as y
    from kept k join grid g using (request_id)),
  found as (
    select c.request_id, c.dataset, c.place, c.out_row, c.out_col,
      t.embedding[cast(floor((t.y_max-c.y)/450)*8 + floor((c.x-t.x_min)/450) + 1 as int)]::double as v
    from centres c join tiles t on t.vec_id::varchar = c.name
    where floor((c.x-t.x_min)/450) between 0 and 7 and floor((t.y_max-c.y)/450) between 0 and 7
    union all
    select c.request_id, c.dataset, c.place, c.out_row, c.out_col, s.v
    from centres c join family f using (dataset) join stored s on s.dataset = c.dataset and c.name = c.dataset||'_overview'
      and s.out_col = floor(c.x/f.overview_cell) and s.out_row = floor((100000-c.y)/f.overview_cell))
select request_id, out_row, out_col, round(case dataset when 'RTC' then sqrt(v) when 'OPERA' then case when v > 0 then 10*log10(v) end else v end, 6) as v
from (select request_id, dataset, out_row, out_col, arg_min(v, place) as v from found where v between 0 and 4294967295 group by 1, 2, 3, 4)
"""


def requests(spark, sf_dir):
    """Views a little off the grid, of three families, at cells that show sources, overviews, or both."""
    return views.tile_views(spark, sf_dir).selectExpr(
        "view_id as request_id",
        "vx_min+100 as rx_min",
        "vx_max+100 as rx_max",
        "vy_min+50 as ry_min",
        "vy_max+50 as ry_max",
        "case view_id%3 when 0 then 'RTC' when 1 then 'OPERA' else 'HAND' end as asked",
        "case view_id%4 when 0 then 300D when 1 then 455D when 2 then 1605D else if(view_id%8 = 3, 0.5D, 2000D) end as cell",
        "case when view_id%5 > 1 then timestamp_ntz'2024-01-05 00:00:00' end as t_from",
        "case when view_id%5 > 2 then timestamp_ntz'2024-01-20 00:00:00' end as t_to",
    )


def constant(place):
    """A column of the family constants by dataset."""
    return F.element_at(F.create_map(*[F.lit(x) for f in FAMILIES for x in (f, LIMITS[f][place])]), F.col("dataset"))


@query("serve_request", SERVE_SQL)
def serve_request(spark, sf_dir):
    """Images of all requests from source tiles and stored overviews."""
    every = F.explode(F.array(*map(F.lit, FAMILIES))).alias("dataset")
    extent = ["x_min", "y_min", "x_max", "y_max"]
    number = F.col("vec_id").cast("string").alias("name")
    tagged = F.lit("t").alias("tag")
    sources = views.dated_tiles(spark, sf_dir).select(every, number, tagged, "start_date", F.col("start_date").alias("end_date"), *extent)
    store = rastering.overview_store(spark, sf_dir, [F.lit(True)]).where(F.col("dataset").isin(*FAMILIES))
    found = overviews.records(store, sources, constant(3), views.TOP, F.concat("dataset", F.lit("_overview")))
    none = F.lit(None).cast("double")
    columns = ["dataset", "name", "start_date", "end_date", *extent, "min_ps", "max_ps"]
    items = sources.withColumns({"min_ps": none, "max_ps": constant(1)}).select(columns)
    items = items.unionByName(found.withColumns({"min_ps": constant(2), "max_ps": none}).select(columns))

    held = ["dataset", "name", "values", "n_rows", "n_cols", "cell", "x_min", "y_max"]
    tiles = views.tiles(spark, sf_dir).select("*", every, number).select(held)
    cells = join_measured(store.drop("name"), found.select("dataset", "name"), ["dataset"]).withColumn("cell", constant(3))
    cells = cells.select(
        "dataset", "name", F.array("v").alias("values"), F.lit(1).alias("n_rows"), F.lit(1).alias("n_cols"), "cell",
        (F.col("out_col") * F.col("cell")).alias("x_min"), (F.lit(views.TOP) - F.col("out_row") * F.col("cell")).alias("y_max"),
    )
    images = serving.serve(items, requests(spark, sf_dir), tiles.unionByName(cells), FAMILIES, views.TOP)
    return images.withColumn("v", F.round("v", 6))
