"""Cubes over time: accumulation, tiles, merges, set operations, order."""

from datetime import datetime

from pyspark.sql import functions as F

from skygrid.functions.time import granule_time
from skygrid.operators import accumulate, merge, moments, regrid, reports
from skygrid.operators.catalog import frame_order, top_k
from skygrid.session import shared_dir
from skygrid.sources.tables import scan_cube
from skygrid.workload.fixtures import BIN_GRID, CUBE_GRID
from skygrid.workload.helpers import DS, R6, TS, dbl, ds, r6, ts
from skygrid.workload.registry import query
from skygrid.workload.regridding import ADAPTIVE, VALID, CELLS, _thinned, idw_sql, pairs_cte, supersample_ctes
from skygrid.workload.scalars import GRANULE_TIME, NAMES

STATS = """sum(w * v) / nullif(sum(w), 0) as value, count_if(w > 0) as count,
  sqrt(greatest(sum(w * v * v) / nullif(sum(w), 0) - pow(sum(w * v) / nullif(sum(w), 0), 2), 0)) as std"""


@query("T1_accumulate", ["v_pixel"], f"""
with {supersample_ctes()}, days as (select granule_id, cast(min(obs_time) as date) as obs_date from v_pixel group by 1),
cells as (select obs_date, i, j, count as w, value as v from gridded join days using (granule_id))
select {DS('obs_date')} as obs_date, i, j, {R6('value')} as value, count, floor(std * 1e4 + 0.3137e0) / 1e4 as std
from (select obs_date, i, j, {STATS} from cells group by 1, 2, 3)""")
def t1(t):
    """Supersampled granules combined per day."""
    days = t.pixel.groupBy("granule_id").agg(F.to_date(F.min("obs_time")).alias("obs_date"))
    cells = regrid.supersample_regrid(t.pixel, BIN_GRID).join(days, "granule_id")
    out = accumulate.accumulate(cells, ("obs_date",))
    return out.select(ds("obs_date").alias("obs_date"), "i", "j", r6("value").alias("value"), "count",
                      (F.floor(F.col("std") * 1e4 + 0.3137) / 1e4).alias("std"))


PERIODS = {
    "day": "obs_date", "month": "cast(date_trunc('month', obs_date) as date)", "year": "cast(date_trunc('year', obs_date) as date)",
    "fortnight": "date '1970-01-01' + cast(datediff('day', date '1970-01-01', obs_date) // 14 * 14 as int)",
    "season": "cast(date_trunc('month', obs_date) - interval 1 month * (month(obs_date) % 3) as date)",
}


@query("T2_period_bucket", ["v_cube"], " union all ".join(f"""
select '{p}' as bucket, {DS('period')} as period, i, {R6('avg(value)')} as value, count(value) as count from (
  select *, {e} as period from v_cube where value is not null) group by 2, 3""" for p, e in PERIODS.items()))
def t2(t):
    """Zonal means of all five period lengths."""
    cells = t.cube.where("value is not null").withColumns({"time": F.col("obs_date").cast("timestamp"), "count": F.lit(1.0), "j": F.lit(0)})
    return accumulate.period_buckets(cells, list(PERIODS)).select("bucket", ds("period").alias("period"), "i", r6("value").alias("value"), "count")


# Means around 1e16 with a spread a hundred thousand times smaller, as in columns of molecules; check SQL in two passes.
LARGE = "1e16 + 1e10 * value"
TWO_PASSES = """with_mean as (select *, sum(w * v) over g / sum(w) over g as mean from {cells} window g as (partition by {keys})),
stats as (select {keys}, min(mean) as value, count(*) as count, sqrt(sum(w * (v - mean) * (v - mean)) / sum(w)) as std from with_mean group by {keys})"""


def _large_out(df, *keys):
    return df.select(*keys, (F.floor(F.col("value") / 1e10 * 1e3 + 0.3137) / 1e3).alias("value"), "count", r6(F.col("std") / 1e10).alias("std"))


LARGE_OUT = f"floor(value / 1e10 * 1e3 + 0.3137e0) / 1e3 as value, count, {R6('std / 1e10')} as std"


@query("T1_large_values", ["v_cube"], f"""
with cells as (select cast(date_trunc('month', obs_date) as date) as m, i, j, 1 + slice_no % 3 as w, {LARGE} as v from v_cube where value is not null),
{TWO_PASSES.format(cells='cells', keys='m, i, j')} select {DS('m')} as period, i, j, {LARGE_OUT} from stats""")
def t1_large(t):
    """Weighted spread of large values, by month."""
    cells = t.cube.withColumns({"value": F.lit(1e16) + F.lit(1e10) * F.col("value"), "count": 1 + F.col("slice_no") % 3,
                                "period": F.to_date(F.date_trunc("month", "obs_date"))})
    out = accumulate.accumulate(cells, ("period",)).where("count > 0")
    return _large_out(out.withColumn("period", ds("period")), "period", "i", "j")


@query("T2_states_topped_up", ["v_cube"], f"""
with cells as (select p.bucket, case p.bucket {' '.join(f"when '{p}' then {e}" for p, e in PERIODS.items())} end as period, i, j, 1 + slice_no % 3 as w, {LARGE} as v
  from v_cube cross join (values {', '.join(f"('{p}')" for p in PERIODS)}) p(bucket) where value is not null),
{TWO_PASSES.format(cells='cells', keys='bucket, period, i, j')} select bucket, {DS('period')} as period, i, j, {LARGE_OUT} from stats""")
def t2_states(t):
    """All period lengths out of day states that were kept as a table and topped up by later slices, one batch twice."""
    cells = t.cube.where("value is not null").withColumns(
        {"value": F.lit(1e16) + F.lit(1e10) * F.col("value"), "count": 1 + F.col("slice_no") % 3})
    path = shared_dir(t.spark, "day-states")
    for batch, part in (("a", "slice_no <= 3"), ("b", "slice_no > 3"), ("b", "slice_no > 3")):
        moments.add_to_states(cells.where(part), path, batch, F.col("obs_date"))
    out = moments.finished(moments.rolled_up(moments.stored_states(t.spark, path)))
    return _large_out(out.withColumn("period", ds("period")), "bucket", "period", "i", "j")


TILES = f"{VALID}, {CELLS}, {pairs_cte('pairs', 'ok', 0.4)}, days as (select granule_id, cast(min(obs_time) as date) as obs_date from v_pixel group by 1), " \
        f"tiles as (select obs_date, granule_id, i, j, value from ({idw_sql('pairs')}) join days using (granule_id))"


def _tiles(t):
    days = t.pixel.groupBy("granule_id").agg(F.to_date(F.min("obs_time")).alias("obs_date"))
    return regrid.idw_regrid(t.pixel, BIN_GRID, 0.4).join(days, "granule_id")


def _tile_out(df):
    return df.select(ds("obs_date").alias("obs_date"), "i", "j", r6("value").alias("value"))


@query("T3_tile_mean", ["v_pixel"], f"""
with {TILES} select {DS('obs_date')} as obs_date, i, j, {R6('avg(value)')} as value from tiles group by obs_date, i, j""")
def t3(t):
    return _tile_out(accumulate.tile_mean(_tiles(t)))


@query("T3_tile_mean_legacy", ["v_pixel"], f"""
with {TILES}, n as (select obs_date, count(distinct granule_id) as m from tiles group by 1)
select {DS('obs_date')} as obs_date, i, j, {R6('case when max(m) > 1 then (sum(value) + arg_min(value, granule_id)) / (count(*) + 1) else sum(value) end')} as value
from tiles join n using (obs_date) group by obs_date, i, j""")
def t3_legacy(t):
    return _tile_out(accumulate.tile_mean(_tiles(t), legacy=True))


@query("T4_tile_overlay", ["v_pixel"], f"""
with {TILES} select {DS('obs_date')} as obs_date, i, j, {R6('arg_max(value, granule_id)')} as value from tiles group by obs_date, i, j""")
def t4(t):
    return _tile_out(accumulate.tile_overlay(_tiles(t)))


LAT0, LON0, LAT1, LON1 = (dbl(x) for x in (20.8763171, 118.8809113, 20.8763171 + 20 * 0.25, 118.8809113 + 16 * 0.25))


@query("T5_first_fill", ["v_pixel"], f"""
select granule_id, cast(least(floor((lat - {LAT0}) / 0.25), 20) as int) as i, cast(least(floor((lon - {LON0}) / 0.25), 16) as int) as j,
  {R6('arg_min(value, pixel_id)')} as value from v_pixel
where value is not null and lat between {LAT0} and {LAT1} and lon between {LON0} and {LON1} group by 1, 2, 3""")
def t5(t):
    return accumulate.first_fill(t.pixel, BIN_GRID).withColumn("value", r6("value"))


DAILY = f"""{ADAPTIVE}, days as (select granule_id, cast(min(obs_time) as date) as obs_date from kept group by 1),
daily as (select obs_date, i, j, avg(value) as value from tiles join days using (granule_id) group by 1, 2, 3)"""


@query("T6_daily_cube", ["v_pixel"], f"with {DAILY} select {DS('obs_date')} as obs_date, i, j, {R6('value')} as value from daily")
def t6(t):
    return _tile_out(accumulate.daily_cube(_thinned(t), BIN_GRID))


@query("T7_monthly_cubes", ["v_pixel"], f"""
with {DAILY} select strftime(obs_date, '%Y') as yyyy, strftime(obs_date, '%m') as mm, count(*) as n_cells, count(distinct obs_date) as n_days,
  floor(sum(value) * 1e4 + 0.3137e0) / 1e4 as total from daily group by 1, 2""")
def t7(t):
    """Monthly outputs written, then read back."""
    path = shared_dir(t.spark, "months")
    accumulate.monthly_cubes(_thinned(t), BIN_GRID, path, hub="modis", product="aod", level="L3")
    cubes = scan_cube(t.spark, path, "aod").withColumn("obs_date", F.to_date("time"))
    return cubes.groupBy("yyyy", "mm").agg(F.count("*").alias("n_cells"), F.countDistinct("obs_date").alias("n_days"),
                                           (F.floor(F.sum("value") * 1e4 + 0.3137) / 1e4).alias("total"))


@query("T8_granule_stats", ["v_pixel"], f"""
select granule_id, count(*) as n_valid, {R6('min(lat)')} as lat_min, {R6('max(lat)')} as lat_max, {R6('min(lon)')} as lon_min,
  {R6('max(lon)')} as lon_max, {R6('count(*) / 357e0')} as density,
  {R6('(max(lat) - min(lat)) * (max(lon) - min(lon)) / (20 * 0.25e0 * 16 * 0.25e0)')} as extent_ratio
from v_pixel where value is not null group by granule_id""")
def t8(t):
    s = regrid.granule_stats(t.pixel, BIN_GRID)
    return s.select("granule_id", "n_valid", *[r6(c).alias(c) for c in ("lat_min", "lat_max", "lon_min", "lon_max", "density", "extent_ratio")])


@query("T9_file_expiry_report", ["v_inventory"], f"""
with old as (select * from v_inventory where modified < timestamp '1999-06-01' and path like '%.nc')
select coalesce(top_dir, 'total') as top_dir, count(*) as file_count, cast(sum(length) as bigint) as total_bytes,
  first(path order by modified, path) as oldest_path, {TS('min(modified)')} as oldest,
  first(path order by modified desc, path desc) as newest_path, {TS('max(modified)')} as newest
from old group by rollup (top_dir)""")
def t9(t):
    r = reports.file_expiry_report(t.inventory, "1999-06-01", [".nc"])
    return r.select("top_dir", "file_count", "total_bytes", "oldest_path", ts("oldest").alias("oldest"), "newest_path",
                    ts("newest").alias("newest"))


@query("T10_freshness_check", ["v_inventory"], f"""
with made as (select strftime(modified, '%Y-%m') as period, max(modified) as modified from v_inventory group by 1),
wanted as (select distinct strftime(o_orderdate, '%Y-%m') as period from orders
           union select strftime(l_shipdate + interval 60 day, '%Y-%m') from lineitem)
select period, {TS('modified')} as modified, coalesce(modified <= timestamp '2001-10-10' - interval 7 day, true) as refresh
from wanted left join made using (period)""")
def t10(t):
    made = t.inventory.withColumn("period", F.date_format("modified", "yyyy-MM"))
    wanted = t.orders.select(F.date_format("o_orderdate", "yyyy-MM").alias("period")).union(
        t.lineitem.select(F.date_format(F.date_add("l_shipdate", 60), "yyyy-MM"))).distinct()
    out = reports.freshness_check(made, wanted, "2001-10-10")
    return out.select("period", ts("modified").alias("modified"), "refresh")


@query("U1_merge_cubes", ["v_cube"], f"""
with part as (select * from v_cube where obs_date between date '1996-01-01' and date '1998-12-31')
select hub, product, level, time_range, n_sources, count(*) as n_rows, count(value) as n_valid, {TS('min(t)')} as first, {TS('max(t)')} as last
from (select 'modis' as hub, 'aod' as product, 'L2' as level, '1996-01-01..1998-12-31' as time_range,
        (select count(*) from (select distinct obs_date, slice_no from part)) as n_sources, value,
        obs_date + interval 1 hour * slice_no as t from part) group by 1, 2, 3, 4, 5""")
def u1(t):
    """Two halves of a product on one grid, joined along time with their provenance."""
    cube = t.cube_slices()
    merged = merge.merge_cubes([cube.where("slice_no <= 3"), cube.where("slice_no > 3")], "1996-01-01", "1998-12-31",
                               hub="modis", product="aod", grids=[CUBE_GRID, CUBE_GRID], slice_key="slice_id")
    return merged.groupBy("hub", "product", "level", "time_range", "n_sources").agg(
        F.count("*").alias("n_rows"), F.count("value").alias("n_valid"), ts(F.min("time")).alias("first"), ts(F.max("time")).alias("last"))


@query("U2_assign_time", ["v_filename"], f"""
with named as (select file_id, case when name like '%-20240601.nc' then regexp_extract(name, '-([0-9]{{8}})-', 1)
  else regexp_extract(name, '([0-9]{{8}})', 1) end as d from v_filename)
select file_id, {TS("coalesce(case when file_id % 10 = 0 then timestamp '2020-02-02 03:00:00' end, try_strptime(nullif(d, ''), '%Y%m%d'), timestamp '1970-01-01')")} as time
from named""")
def u2(t):
    own = F.when(F.col("file_id") % 10 == 0, F.lit(datetime(2020, 2, 2, 3)))
    return merge.assign_time(t.filename.withColumn("time", own)).select("file_id", ts("time").alias("time"))


@query("U3_discover_l3", ["v_filename"], """
with named as (select file_id, name, try_strptime(nullif(case when name like '%-20240601.nc' then regexp_extract(name, '-([0-9]{8})-', 1)
  else regexp_extract(name, '([0-9]{8})', 1) end, ''), '%Y%m%d') as d from v_filename)
select file_id, name from named where d is null or d between timestamp '1997-01-01' and timestamp '1998-06-30'""")
def u3(t):
    return merge.discover_l3(t.filename, "1997-01-01", "1998-06-30")


@query("U4_merge_gems", ["v_cube"], f"""
select {TS("obs_date + interval '1' hour * slice_no + interval 45 minute")} as time, count(*) as n_rows, cast(max(cast(value as float)) as double) as top
from v_cube where obs_date between date '1996-01-01' and date '1998-12-31' group by 1""")
def u4(t):
    """The time of a slice is the stamp in its file name."""
    name = F.concat(F.lit("GK2_GEMS_L2_"), F.date_format("obs_date", "yyyyMMdd"), F.lit("_"),
                    F.lpad(F.col("slice_no").cast("string"), 2, "0"), F.lit("45_NO2_FW.nc"))
    merged = merge.merge_by_name_time(t.cube.withColumn("name", name), "1996-01-01", "1998-12-31")
    return merged.groupBy(ts("time").alias("time")).agg(F.count("*").alias("n_rows"), F.max("value").cast("double").alias("top"))


@query("U5_union_stations", ["v_place"], """
select owner, name, site_type from v_place where owner = 'environment' union all select owner, name, null from v_place where owner = 'power'""")
def u5(t):
    return merge.union_tables([t.place.where("owner = 'environment'").select("owner", "name", "site_type"),
                               t.place.where("owner = 'power'").select("owner", "name")])


@query("U6_missing_keys", ["v_cube", "v_catalog"], f"""
select distinct {DS('start_time')} as obs_date from v_catalog where cast(start_time as date) not in (select obs_date from v_cube)""")
def u6(t):
    """Catalog days without any cell of the cube."""
    wanted = t.catalog.select(F.to_date("start_time").alias("obs_date")).distinct()
    present = t.cube.select("obs_date").distinct()
    return merge.missing_keys(wanted, present, ["obs_date"]).select(ds("obs_date").alias("obs_date"))


@query("S1_sort_by_time", ["v_cube"], f"""
select {DS('obs_date')} as obs_date, slice_no, count(*) as n_rows from v_cube group by v_cube.obs_date, slice_no order by v_cube.obs_date, slice_no""")
def s1(t):
    """Slices in time order, by a range exchange at the sink."""
    slices = t.cube.groupBy("obs_date", "slice_no").agg(F.count("*").alias("n_rows"))
    return merge.sort_by_time(slices, "slice_no", time="obs_date").select(ds("obs_date").alias("obs_date"), "slice_no", "n_rows")


@query("S2_top_k", ["v_catalog"], f"select granule_id, {TS('start_time')} as start_time from v_catalog order by v_catalog.start_time desc, granule_id limit 50")
def s2(t):
    newest = top_k(t.catalog, 50, F.desc("start_time"), F.asc("granule_id"))
    return newest.select("granule_id", ts("start_time").alias("start_time"))


@query("S3_frame_order", ["v_filename"], f"""
with {NAMES} select file_id, name, {TS(GRANULE_TIME)} as frame_time from names order by frame_time nulls last, name""")
def s3(t):
    ordered = frame_order(t.filename, granule_time(F.col("name")))
    return ordered.select("file_id", "name", ts("frame_time").alias("frame_time"))


@query("X5_affected_days", ["v_cube"], f"""
select {DS('obs_date')} as obs_date, count(*) as n from v_cube where obs_date between date '2000-03-31' - 30 and date '2000-03-31' group by 1""")
def x5_days(t):
    kept = merge.affected_days(t.cube_slices(), datetime(2000, 3, 31).date())
    return kept.groupBy(ds("obs_date").alias("obs_date")).agg(F.count("*").alias("n"))


