"""Queries over aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from geomosaic.operators import aggregates, pixels, shapes
from geomosaic.plans import views
from geomosaic.plans.registry import query


@query(
    "agg_overview_extent",
    """select dataset, min(start_date) - interval 8 hours as overview_start, max(start_date) + interval 8 hours as overview_end
       from scenes group by dataset""",
)
def agg_overview_extent(spark, sf_dir):
    return aggregates.overview_extent(views.scenes(spark, sf_dir), ["dataset"])


@query(
    "agg_ingest_counts",
    """select (select count(*) from catalog_old) as n_found,
         (select count(distinct path) from listing where path not in (select path from catalog_old)) as n_added""",
)
def agg_ingest_counts(spark, sf_dir):
    return aggregates.ingest_counts(views.listing(spark, sf_dir), views.catalog_old(spark, sf_dir))


@query(
    "agg_any_tag",
    "select dataset, min(tag) as tag, right(min(tag),2) as polarization from scenes group by dataset",
)
def agg_any_tag(spark, sf_dir):
    return aggregates.any_tag(views.scenes(spark, sf_dir))


@query(
    "agg_boundary",
    """select dataset, min(x_min) as x_min, min(y_min) as y_min, max(x_max) as x_max, max(y_max) as y_max, count(*) as n_items
       from scenes group by dataset""",
)
def agg_boundary(spark, sf_dir):
    return aggregates.boundary(views.scenes(spark, sf_dir))


@query(
    "agg_boundary_cells",
    """select distinct dataset, cell_x, unnest(generate_series(cast(floor(y_min/57600) as bigint), cast(ceil(y_max/57600) as bigint)-1)) as cell_y
       from (select dataset, y_min, y_max,
               unnest(generate_series(cast(floor(x_min/57600) as bigint), cast(ceil(x_max/57600) as bigint)-1)) as cell_x from scenes)""",
)
def agg_boundary_cells(spark, sf_dir):
    return aggregates.covered_cells(views.scenes(spark, sf_dir), views.SCENE_CELL)


@query(
    "agg_boundary_outline",
    """with touched as (select distinct dataset, cell_x,
           unnest(generate_series(cast(floor(y_min/57600) as bigint), cast(ceil(y_max/57600) as bigint)-1)) as cell_y
         from (select dataset, y_min, y_max,
           unnest(generate_series(cast(floor(x_min/57600) as bigint), cast(ceil(x_max/57600) as bigint)-1)) as cell_x
           from scenes where item_id%4 = 0)),
       c as (select * from touched where (cell_x*7 + cell_y*13)%5 <> 0)
       select c.dataset, cast(4*count(*) - 2*count(r.cell_x) - 2*count(u.cell_x) as bigint) as n_edges,
         count(*)*57600.0::double*57600 as area, true as closed
       from c left join c r on r.dataset = c.dataset and r.cell_x = c.cell_x+1 and r.cell_y = c.cell_y
         left join c u on u.dataset = c.dataset and u.cell_x = c.cell_x and u.cell_y = c.cell_y+1 group by c.dataset""",
)
def agg_boundary_outline(spark, sf_dir):
    """Length and area of the outline of covered cells, holes taken off; some cells are left out, so that there are holes."""
    cells = aggregates.covered_cells(views.scenes(spark, sf_dir).where("item_id%4 = 0"), views.SCENE_CELL)
    rings = shapes.outline(cells.where("(cell_x*7 + cell_y*13)%5 <> 0"))
    # each place of a ring is there once, from 0 on
    whole = (F.min("place") == 0) & (F.max("place") == F.count("*") - 1) & (F.sum("place") * 2 == F.max("place") * F.count("*"))
    closed = rings.groupBy("dataset", "ring").agg(whole.alias("closed"))
    areas = shapes.ring_areas(rings, views.SCENE_CELL).join(closed, ["dataset", "ring"])
    return areas.groupBy("dataset").agg(
        F.sum("n_edges").alias("n_edges"), F.sum("area").alias("area"), F.every("closed").alias("closed")
    )


@query("agg_footprint_corners")
def agg_footprint_corners(spark, sf_dir):
    """Footprints of at most twelve corners; SQL has no hull, a test holds it against a plain one."""
    found = shapes.footprint_corners(views.tiles(spark, sf_dir), ["vec_id"])
    corner = F.transform("corners", lambda c: F.concat_ws(" ", c.x, c.y))
    return found.select("vec_id", "n_valid", F.array_join(corner, ",").alias("corners"), "area")


@query(
    "agg_footprint",
    """select t.vec_id, count(v) as n_valid,
         t.x_min + min(k%8) * 450 as fx_min, t.y_max - (max(k//8)+1) * 450 as fy_min,
         t.x_min + (max(k%8)+1) * 450 as fx_max, t.y_max - min(k//8) * 450 as fy_max
       from tiles t left join (select vec_id, k, v from pixels where v between 0 and 4294967295) p using (vec_id)
       group by t.vec_id, t.x_min, t.y_max""",
)
def agg_footprint(spark, sf_dir):
    return aggregates.footprint(views.tiles(spark, sf_dir), ["vec_id"])


@query(
    "agg_statistics",
    """select label, min(v) as v_min, max(v) as v_max, round(avg(v),6) as v_mean, round(stddev_pop(v),6) as v_std,
         count(v) as n_pixels from pixels where (k//8)%5=0 and (k%8)%5=0 group by label""",
)
def agg_statistics(spark, sf_dir):
    sampled = aggregates.sampled_pixels(views.tiles(spark, sf_dir), ["label"])
    found = aggregates.statistics(sampled, ["label"])
    return found.withColumns({"v_mean": F.round("v_mean", 6), "v_std": F.round("v_std", 6)})


@query(
    "agg_histogram",
    """with e as (select label, min(v) as low, max(v) as high from pixels group by label)
       select label, cast(least(floor(32.0*(v-low)/(high-low))+1, 32) as bigint) as bin, cast(count(*) as bigint) as n_pixels
       from pixels join e using (label) group by 1, 2""",
)
def agg_histogram(spark, sf_dir):
    cells = views.tiles(spark, sf_dir).select("label", F.explode("values").alias("v"))
    return aggregates.histogram(cells, ["label"], 32)


@query(
    "agg_cell_size_ranges",
    """select dataset, min((x_max-x_min)/n_cols) as low_ps, max((x_max-x_min)/n_cols*10) as high_ps, max(max_ps) as max_ps,
         count(*) as n_items from scenes group by dataset""",
)
def agg_cell_size_ranges(spark, sf_dir):
    return (
        aggregates.cell_size_ranges(views.scenes(spark, sf_dir))
        .groupBy("dataset")
        .agg(
            F.min("low_ps").alias("low_ps"),
            F.max("high_ps").alias("high_ps"),
            F.max("max_ps").alias("max_ps"),
            F.count("*").alias("n_items"),
        )
    )


@query(
    "agg_cell_size_groups",
    """with s as (select 'OPERA_'||pol as dataset, round((mx_max-mx_min)/64, 6) as size from granules join mercator using (event_id)
         where reject_reason is null and mx_max > mx_min),
       d as (select dataset, size, count(*) as n from s group by 1, 2),
       g as (select *, case when lag(size) over w >= size*0.8::double then 0 else 1 end as gap from d
         window w as (partition by dataset order by size)),
       k as (select *, cast(sum(gap) over (partition by dataset order by size) as bigint) as size_group from g)
       select dataset, size_group, cast(sum(n) as bigint) as n_items, min(size) as size_min, max(size) as size_max from k group by 1, 2""",
)
def agg_cell_size_groups(spark, sf_dir):
    """Cell sizes of projected scenes, grouped by the tolerance."""
    scenes = views.granules(spark, sf_dir)
    placed = pixels.project_extent(views.native_headers_of(scenes, "pol")).where("reject_reason is null and mx_max > mx_min")
    sized = placed.select(F.concat(F.lit("OPERA_"), "pol").alias("dataset"), F.round(F.expr("(mx_max-mx_min)/64"), 6).alias("low_ps"))
    return aggregates.cell_size_groups(sized)


@query(
    "agg_coverage_grid",
    """select concat_ws('_',p,l,s) as dataset, p as product_type, l as polarization, s as season_code,
         count(c.event_id) as n_items, count(c.event_id)=0 as is_gap
       from (values ('COH06'),('COH12'),('COH24'),('COH48')) a(p), (values ('VV'),('HH')) b(l),
         (values ('DJF'),('MAM'),('JJA'),('SON')) d(s)
       left join coherence c on c.dataset = concat_ws('_',p,l,s) group by p, l, s""",
)
def agg_coverage_grid(spark, sf_dir):
    return aggregates.coverage_grid(
        views.coherence(spark, sf_dir),
        ("COH06", "COH12", "COH24", "COH48"),
        ("VV", "HH"),
        ("DJF", "MAM", "JJA", "SON"),
    )
