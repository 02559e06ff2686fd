"""The raster-shaped views over the test tables, in DuckDB SQL, in order of dependence."""

VIEWS: dict[str, str] = {}

VIEWS["granules"] = """
select event_id, user_id, event_type, value, date_trunc('second', ts) as start_date,
  case event_id%4 when 0 then 'VV' when 1 then 'VH' when 2 then 'HH' else 'HV' end as pol,
  concat('S1A_IW_', strftime(ts, '%Y%m%dT%H%M%S'), '_DVP_RTC30_G_gpuned_',
    lpad(upper(hex((event_id%65536)::bigint)),4,'0'), '_',
    case event_id%4 when 0 then 'VV' when 1 then 'VH' when 2 then 'rgb' else 'WM' end) as rtc_name,
  concat('OPERA_L2_RTC-S1_T', lpad(cast(user_id%175+1 as varchar),3,'0'), '-',
    lpad(cast(event_id%1000000 as varchar),6,'0'), '-IW', cast(event_id%3+1 as varchar), '_',
    strftime(ts, '%Y%m%dT%H%M%S'), 'Z_', strftime(ts + interval 1 day, '%Y%m%dT%H%M%S'), 'Z_S1A_30_v1.0_',
    case event_id%4 when 0 then 'VV' when 1 then 'VH' when 2 then 'HH' else 'HV' end) as opera_name,
  concat(case when event_id%2=0 then 'N' else 'S' end, lpad(cast(event_id%91 as varchar),2,'0'),
    case when user_id%2=0 then 'E' else 'W' end, lpad(cast(user_id%180 as varchar),3,'0'), '_',
    case event_id%4 when 0 then 'summer' when 1 then 'fall' when 2 then 'winter' else 'spring' end, '_',
    case when user_id%2=0 then 'vv' else 'hh' end, '_',
    case event_id%3 when 0 then 'COH06' when 1 then 'COH12' else 'COH24' end) as coh_name,
  concat('Copernicus_DSM_COG_10_', case when event_id%2=0 then 'N' else 'S' end,
    lpad(cast(event_id%91 as varchar),2,'0'), '_00_', case when user_id%2=0 then 'E' else 'W' end,
    lpad(cast(user_id%180 as varchar),3,'0'), '_00_HAND') as hand_name
from events
"""

VIEWS["headers"] = """
select event_id, concat('/vsis3/fixture-bucket/', opera_name, '.tif') as path,
  cast(event_id*7919%2000*1000 as double) as x_min, cast(user_id*104729%2000*1000 as double) as y_min,
  cast(event_id*7919%2000*1000+28800 as double) as x_max, cast(user_id*104729%2000*1000+28800 as double) as y_max,
  64 as n_cols, 64 as n_rows,
  case event_id%3 when 0 then 'Byte' when 1 then 'Int16' else 'Float32' end as band_type,
  case event_id%5 when 0 then 4326 else 32600+cast(user_id%60+1 as int) end as epsg
from granules
"""

VIEWS["native_headers"] = """
select event_id, epsg, x_min, y_min, case when event_id%29=0 then x_min-1 else x_min+width end as x_max, y_min+height as y_max
from (
  select event_id, epsg,
    case epsg when 4326 then k*9/50-180 when 3857 then k*20000-20000000 else 160000+k*330 end as x_min,
    case when epsg = 4326 then m*9/100-90 when epsg = 3857 then m*20000-20000000
      when epsg < 32700 then m*4600-14400 else 800000+m*4600 end as y_min,
    case when epsg = 4326 then 0.3::double when epsg = 3857 then 28800 when event_id%7=0 then 400000 else 28800 end as width,
    case when epsg = 4326 then 0.3::double else 28800 end as height
  from (
    select event_id, cast(event_id*7919%2000 as double) as k, cast(user_id*104729%2000 as double) as m,
      case when event_id%17=0 then 3413 when event_id%19=0 then 3857 when event_id%5=0 then 4326
        else cast(user_id%60+1 as int) + case when event_id%2=0 then 32600 else 32700 end end as epsg
    from granules))
"""

# the envelope is the least box around nine points: corners, and where the edges may turn
VIEWS["mercator"] = """
select event_id, epsg,
  case when reject_reason is null then west - turns end as mx_min,
  case when reject_reason is null then greatest(-world, least(world, south)) end as my_min,
  case when reject_reason is null then east - turns end as mx_max,
  case when reject_reason is null then greatest(-world, least(world, north)) end as my_max, reject_reason
from (
 select *, floor((west+world)/(2*world))*(2*world) as turns from (
 select event_id, epsg, min(mx) as west, min(my) as south, max(mx) as east, max(my) as north,
  pi()*6378137.0::double as world,
  case when epsg not in (3857, 4326) and not (epsg%100 between 1 and 60 and epsg//100 in (326, 327)) then 'epsg'
    when bool_or(bad) then 'extent' end as reject_reason
 from (
 select event_id, epsg, bad,
  case when epsg = 3857 then x when epsg = 4326 then radians(x)*6378137.0::double
    when epsg > 32600 then (radians((epsg%100)*6.0::double-183)+atan2(sinh(e1),cos(x1)))*6378137.0::double end as mx,
  case when epsg = 3857 then y when epsg = 4326 then asinh(tan(radians(y)))*6378137.0::double
    when epsg > 32600 then asinh(tan(lat))*6378137.0::double end as my
 from (
  select *, chi + d1*sin(2*chi) + d2*sin(4*chi) + d3*sin(6*chi) + d4*sin(8*chi) as lat from (
   select *, asin(sin(x1)/cosh(e1)) as chi from (
    select *,
     xi - b1*sin(2*xi)*cosh(2*eta) - b2*sin(4*xi)*cosh(4*eta) - b3*sin(6*xi)*cosh(6*eta) - b4*sin(8*xi)*cosh(8*eta) as x1,
     eta - b1*cos(2*xi)*sinh(2*eta) - b2*cos(4*xi)*sinh(4*eta) - b3*cos(6*xi)*sinh(6*eta) - b4*cos(8*xi)*sinh(8*eta) as e1
    from (
     select *, (case when epsg > 32600 then y else 0 end - case when epsg > 32700 then 10000000 else 0 end)/(0.9996::double*ra) as xi,
       (case when epsg > 32600 then x else 500000 end - 500000)/(0.9996::double*ra) as eta
     from (
      select event_id, epsg, x, y_min > y_max or x_min > x_max as bad,
        case when epsg = 4326 then greatest(-90, least(90, y)) else y end as y
      from (
       select *, unnest([y_min, y_max, greatest(y_min, least(y_max, case when epsg > 32700 then 10000000 else 0 end))]) as y
       from (select *, unnest([x_min, x_max, greatest(x_min, least(x_max, 500000))]) as x from native_headers))),
     (
      select 6378137.0::double/(1+n)*(1+n**2/4+n**4/64) as ra,
       n/2-2*n**2/3+37*n**3/96-n**4/360 as b1, n**2/48+n**3/15-437*n**4/1440 as b2,
       17*n**3/480-37*n**4/840 as b3, 4397*n**4/161280 as b4,
       2*n-2*n**2/3-2*n**3+116*n**4/45 as d1, 7*n**2/3-8*n**3/5-227*n**4/45 as d2,
       56*n**3/15-136*n**4/35 as d3, 4279*n**4/630 as d4
      from (select (1/298.257223563::double)/(2-1/298.257223563::double) as n)))))))
 group by event_id, epsg))
"""

VIEWS["catalog_old"] = "select path from headers where event_id%3=0"

VIEWS["listing"] = """
select path from headers
union all select h.path from headers h join granules g using (event_id) where g.event_type = 'click'
"""

VIEWS["inventory"] = """
select event_id, 'fixture-bucket' as bucket, event_id*131%100000+1 as size, start_date as mtime,
  concat('scenes/', event_type, '/', opera_name, case when event_id%7=0 then '.tif.xml' else '.tif' end) as key
from granules
"""

VIEWS["search_granules"] = """
select event_id, pol, concat('{"umm":{"RelatedUrls":[{"URL":"https://fixture.example/', opera_name,
  '.tif"},{"URL":"s3://fixture-bucket/', opera_name, case when event_id%10=0 then '.h5' else '.tif' end, '"}]}}') as doc
from granules
"""

VIEWS["seasons"] = """
select * from (values
  ('winter','DJF','December/January/February','Dec/Jan/Feb',date '2019-12-01',date '2020-02-29',1),
  ('spring','MAM','March/April/May','Mar/Apr/May',date '2020-03-01',date '2020-05-31',2),
  ('summer','JJA','June/July/August','Jun/Jul/Aug',date '2020-06-01',date '2020-08-31',3),
  ('fall','SON','September/October/November','Sep/Oct/Nov',date '2020-09-01',date '2020-11-30',4)
) t(season_name, season_code, season, season_short, season_start, season_end, season_ordinal)
"""

VIEWS["coherence"] = """
select g.event_id, g.coh_name, split_part(coh_name,'_',1) as tile, s.season_name, s.season_code, s.season,
  s.season_short, s.season_start, s.season_end, s.season_ordinal,
  upper(split_part(coh_name,'_',3)) as polarization, split_part(coh_name,'_',4) as product_type,
  split_part(coh_name,'_',4)||'_'||upper(split_part(coh_name,'_',3))||'_'||s.season_code as dataset
from granules g join seasons s on s.season_name = split_part(g.coh_name,'_',2)
"""

VIEWS["scenes"] = """
select g.event_id as item_id, concat('OPERA_', g.pol) as dataset, g.opera_name as name, h.path,
  concat('OPERA_L2_RTC-S1_V1_', g.pol) as tag,
  g.start_date, g.start_date as end_date, h.x_min, h.y_min, h.x_max, h.y_max, h.n_cols, h.n_rows,
  cast(null as double) as min_ps, 460.0::double as max_ps, 1 as category,
  (h.x_min+h.x_max)/2 as center_x, (h.y_min+h.y_max)/2 as center_y,
  concat('https://fixture.example/', g.opera_name, '.tif') as download_url
from granules g join headers h using (event_id)
"""

VIEWS["overviews"] = """
select dataset, concat('FIXTURE_', dataset, '_240131_0000_overview') as name, min(tag) as tag,
  min(start_date) - interval 8 hours as start_date, max(start_date) + interval 8 hours as end_date,
  min(x_min) as x_min, min(y_min) as y_min, max(x_max) as x_max, max(y_max) as y_max
from scenes group by dataset
"""

VIEWS["items"] = """
select item_id, dataset, name, tag, start_date, end_date, x_min, y_min, x_max, y_max, min_ps, max_ps, category,
  center_x, center_y, download_url from scenes
union all
select null, dataset, name, tag||'_Overview', start_date, end_date, x_min, y_min, x_max, y_max,
  450.0::double, cast(null as double), 2, (x_min+x_max)/2, (y_min+y_max)/2, 'Zoom in further to access download link'
from overviews
"""

VIEWS["points"] = """
select c_custkey as point_id, cast(c_custkey*15485863%2000000 as double) as x,
  cast(c_custkey*32452843%2000000 as double) as y
from customer
"""

VIEWS["requests"] = """
select point_id as request_id, x as rx_min, y as ry_min,
  x + 10000 + point_id%5*10000 as rx_max, y + 10000 + point_id%5*10000 as ry_max,
  cast(case point_id%4 when 0 then 30 when 1 then 455 when 2 then 300 else 2000 end as double) as cell,
  case when point_id%3<>0 then timestamp '2024-01-01' + to_days(cast(point_id%20 as int)) end as t_from,
  case when point_id%3<>0 then timestamp '2024-01-11' + to_days(cast(point_id%20 as int)) end as t_to
from points
"""

VIEWS["chosen"] = """
select r.request_id, r.rx_min, r.ry_min, r.rx_max, r.ry_max, r.cell, i.*
from items i join requests r
  on i.x_min < r.rx_max and r.rx_min < i.x_max and i.y_min < r.ry_max and r.ry_min < i.y_max
where coalesce(i.min_ps,0) <= r.cell and (i.max_ps is null or r.cell <= i.max_ps)
  and (r.t_from is null or (i.start_date <= r.t_to and i.end_date >= r.t_from))
"""

VIEWS["tiles"] = """
select e.vec_id, e.label, e.embedding, g.opera_name as name, g.start_date,
  (e.vec_id%10)*1800.0::double as x_min, 100000 - e.label*1800.0::double as y_max,
  (e.vec_id%10)*1800.0::double + 3600 as x_max, 100000 - e.label*1800.0::double - 3600 as y_min,
  450.0::double as cell
from embeddings e left join granules g on g.event_id = e.vec_id
"""

VIEWS["pixels"] = """
select vec_id, label, name, start_date, k, cast(v as double) as v, (vec_id%10)*4 + k%8 as gx, cast(label*4 + k//8 as bigint) as gy
from (select vec_id, label, name, start_date, unnest(embedding) as v,
        cast(generate_subscripts(embedding,1)-1 as int) as k from tiles)
"""

VIEWS["tile_views"] = """
select s_suppkey as view_id, s_suppkey*7919%37 as gx0, s_suppkey*104729%37 as gy0, 8+s_suppkey%4*8 as span
from supplier
"""

VIEWS["tile_choice"] = """
select w.view_id, w.gx0, w.gy0, w.span, t.vec_id, t.name, t.start_date,
  row_number() over (partition by w.view_id
    order by abs(epoch_us(t.start_date) - epoch_us(timestamp '2050-01-01')), t.name) as mosaic_rank
from tile_views w join tiles t
  on t.x_min < (w.gx0+w.span)*450 and w.gx0*450 < t.x_max
 and t.y_min < 100000 - w.gy0*450 and 100000 - (w.gy0+w.span)*450 < t.y_max
"""

VIEWS["view_pixels"] = """
select c.view_id, p.gx, p.gy, arg_min(p.v, c.mosaic_rank) as v
from tile_choice c join pixels p using (vec_id)
where c.mosaic_rank <= 50 and p.v between 0 and 4294967295
  and p.gx >= c.gx0 and p.gx < c.gx0+c.span and p.gy >= c.gy0 and p.gy < c.gy0+c.span
group by c.view_id, p.gx, p.gy
"""
