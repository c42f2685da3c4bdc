"""Regional coverage."""

from pyspark.sql import functions as F

from skygrid.operators import coverage
from skygrid.operators.stations import expected_slots
from skygrid.plans.grid import FILTER_BOX, GridSpec
from skygrid.session import shared_dir
from skygrid.sources.grids import read_grids, register_grid
from skygrid.workload.fixtures import CUBE_GRID
from skygrid.workload.grids import RAYS
from skygrid.workload.helpers import cells_cte, r6, R6
from skygrid.workload.registry import query

HEAD = "'modis' as hub, 'aod' as product, '{region}' as region, {label} as time, '{gran}' as granularity, '{weight}' as weight"
REG = cells_cte("cells", CUBE_GRID) + ", reg as (select i, j, lat from cells where lon between 120 and 122 and lat between 22 and 25)"
LABELS = {"daily": "strftime(d.obs_date, '%Y-%m-%d')", "monthly": "strftime(m, '%Y-%m')", "yearly": "strftime(m, '%Y')"}


def _weight(weight, lat):
    return "1e0" if weight == "count" else f"cos(radians({lat}))"


def daily_ctes(weight="count", reg=REG):
    return f"""{reg}, tot as (select sum({_weight(weight, 'lat')}) as total from reg),
days as (select obs_date, count(distinct slice_no) as n_slices from v_cube group by obs_date),
seen as (select distinct obs_date, i, j from v_cube where value is not null),
hit as (select s.obs_date, sum({_weight(weight, 'r.lat')}) as valid from seen s join reg r on s.i = r.i and s.j = r.j group by 1),
daily as (select d.obs_date, round_even(coalesce(h.valid, 0e0), 3) as valid, round_even(t.total, 3) as total,
  round_even(coalesce(h.valid, 0e0) / t.total, 5) as coverage, d.n_slices from days d cross join tot t left join hit h on d.obs_date = h.obs_date)"""


def daily_sql(weight="count", reg=REG, region="box"):
    head = HEAD.format(region=region, label=LABELS["daily"], gran="daily", weight=weight)
    return f"with {daily_ctes(weight, reg)} select {head}, valid, total, coverage, n_slices from daily d"


def bucket_sql(gran, unit):
    head = HEAD.format(region="box", label=LABELS[gran], gran=gran, weight="count")
    return f"""with {daily_ctes()}, b as (select date_trunc('{unit}', obs_date) as m, round_even(sum(round_even(valid * 1e3, 0)) / count(valid), 0) / 1e3 as valid, min(total) as total,
  round_even(sum(round_even(coverage * 1e5, 0)) / count(coverage), 0) / 1e5 as coverage, cast(sum(n_slices) as bigint) as n_slices from daily group by 1)
select {head}, valid, total, coverage, n_slices from b"""


def _run(t, **kw):
    kw = {"region": FILTER_BOX, "hub": "modis", "product": "aod", **kw}
    return coverage.compute_coverage(t.cube_slices(), CUBE_GRID, **kw)


@query("V1_coverage_per_file", ["v_cube"], f"""
with {REG}, tot as (select count(*) as total from reg), hit as (select obs_date, slice_no, count(*) as valid from v_cube c join reg r using (i, j)
  where value is not null group by 1, 2), slices as (select distinct obs_date, slice_no from v_cube)
select {HEAD.format(region='box', label="strftime(obs_date + interval 1 hour * slice_no, '%Y-%m-%d %H:%M')", gran='per_file', weight='count')},
  round_even(coalesce(valid, 0e0), 3) as valid, total * 1e0 as total, round_even(coalesce(valid, 0) / total, 5) as coverage, cast(1 as bigint) as n_slices
from slices cross join tot left join hit using (obs_date, slice_no)""")
def v1(t):
    return _run(t, granularity="per_file")


COARSE_GRID = GridSpec(21.0, 0.2, 26, 119.0, 0.2, 21)


def _two_grids(t):
    """Slices of even number on a grid of half the resolution; every row names its grid, and both grids are registered."""
    path = shared_dir(t.spark, "grids")
    fine, coarse = (register_grid(t.spark, path, g) for g in (CUBE_GRID, COARSE_GRID))
    even = F.col("slice_no") % 2 == 0
    cube = t.cube_slices().withColumns({c: F.when(even, F.expr(f"cast({c} div 2 as int)")).otherwise(F.col(c)) for c in ("i", "j")})
    cube = cube.withColumns({"lat": F.when(even, COARSE_GRID.lat_of(F.col("i"))).otherwise(F.col("lat")),
                             "lon": F.when(even, COARSE_GRID.lon_of(F.col("j"))).otherwise(F.col("lon")),
                             "grid_id": F.when(even, F.lit(coarse)).otherwise(F.lit(fine))})
    return cube, read_grids(t.spark, path)


@query("V1_coverage_two_grids", ["v_cube"], f"""
with {REG}, {cells_cte("wide", COARSE_GRID)}, reg2 as (select i, j, lat from wide where lon between 120 and 122 and lat between 22 and 25),
tot as (select 1 as odd, sum(cos(radians(lat))) as total from reg union all select 0, sum(cos(radians(lat))) from reg2),
seen as (select distinct obs_date, slice_no, case when slice_no % 2 = 0 then i // 2 else i end as i, case when slice_no % 2 = 0 then j // 2 else j end as j from v_cube where value is not null),
hit as (select obs_date, slice_no, sum(cos(radians(coalesce(r.lat, s.lat)))) as valid from seen
  left join reg r on slice_no % 2 = 1 and r.i = seen.i and r.j = seen.j left join reg2 s on slice_no % 2 = 0 and s.i = seen.i and s.j = seen.j
  where coalesce(r.lat, s.lat) is not null group by 1, 2), slices as (select distinct obs_date, slice_no from v_cube)
select {HEAD.format(region='box', label="strftime(obs_date + interval 1 hour * slice_no, '%Y-%m-%d %H:%M')", gran='per_file', weight='area')},
  round_even(coalesce(valid, 0e0), 3) as valid, round_even(total, 3) as total, round_even(coalesce(valid, 0e0) / total, 5) as coverage, cast(1 as bigint) as n_slices
from slices join tot on odd = slice_no % 2 left join hit using (obs_date, slice_no)""")
def v1_two_grids(t):
    """Each slice by the mask and the total of its own grid."""
    cube, grids = _two_grids(t)
    return coverage.coverage_by_grid(cube, grids, region=FILTER_BOX, weight="area", hub="modis", product="aod")


@query("V2_coverage_daily", ["v_cube"], daily_sql())
def v2(t):
    return _run(t)


@query("V2_coverage_daily_zone", ["v_cube", "v_zone_vertex"], daily_sql("count", RAYS + ", reg as (select m.i, m.j, c.lat from mask m join cells c using (i, j))", "west"))
def v2_zone(t):
    """A zone given by county outlines instead of a box."""
    return _run(t, region="west", vertices=t.zone_vertex)


@query("V3_coverage_monthly", ["v_cube"], bucket_sql("monthly", "month"))
def v3(t):
    return _run(t, granularity="monthly")


@query("V3_coverage_yearly", ["v_cube"], bucket_sql("yearly", "year"))
def v3_yearly(t):
    return _run(t, granularity="yearly")


@query("V4_coverage_total", ["v_cube"], f"""
with {REG} select (select count(*) * 1e0 from reg) as by_count, {R6('(select sum(cos(radians(lat))) from reg)')} as by_area, count(*) as n_rows,
  count_if(lon between 120 and 122 and lat between 22 and 25) as n_inside from v_cube""")
def v4(t):
    """Region weight, whether or not a cell was ever observed, next to what was observed."""
    inside = F.col("lon").between(120, 122) & F.col("lat").between(22, 25)
    return t.cube.agg(F.count("*").alias("n_rows"), F.count_if(inside).alias("n_inside")).select(
        coverage.coverage_total(CUBE_GRID, FILTER_BOX).alias("by_count"),
        r6(coverage.coverage_total(CUBE_GRID, FILTER_BOX, "area")).alias("by_area"), "n_rows", "n_inside")


@query("V5_rounding", ["v_cube"], daily_sql("area"))
def v5(t):
    """Area weights: three decimals for weights, five for the share."""
    return _run(t, weight="area")


def _map(t):
    """A coverage map made in two writes, of which the second also brings slices of the first again."""
    cube, path = t.cube_slices(), shared_dir(t.spark, "coverage-map")
    coverage.add_to_map(cube.where("slice_no <= 4"), CUBE_GRID, path, "first")
    coverage.add_to_map(cube.where("slice_no >= 3"), CUBE_GRID, path, "second")
    return path


@query("V2_coverage_from_map", ["v_cube"], daily_sql("area"))
def v2_map(t):
    """Daily area shares from a stored map of cells, after a second write."""
    return coverage.coverage_from_map(t.spark, _map(t), CUBE_GRID, region=FILTER_BOX, weight="area", hub="modis", product="aod")


@query("V2_coverage_from_map_zone", ["v_cube", "v_zone_vertex"], daily_sql("count", RAYS + ", reg as (select m.i, m.j, c.lat from mask m join cells c using (i, j))", "west"))
def v2_map_zone(t):
    """The same map asked for a zone."""
    return coverage.coverage_from_map(t.spark, _map(t), CUBE_GRID, region="west", vertices=t.zone_vertex, hub="modis", product="aod")


@query("V3_coverage_from_map", ["v_cube"], bucket_sql("monthly", "month"))
def v3_map(t):
    """Monthly shares from the map after it was compacted."""
    path = shared_dir(t.spark, "compact-map")
    coverage.compact_map(t.spark, _map(t), path)
    return coverage.coverage_from_map(t.spark, path, CUBE_GRID, region=FILTER_BOX, granularity="monthly", hub="modis", product="aod")


SLOTS = "slots as (select v.variable, s.t as time_utc from (select distinct variable from v_field) v, (select min(time_utc) as a, max(time_utc) + interval 9 hour as b from v_field) r, lateral (select unnest(generate_series(r.a, r.b, interval 1 hour)) as t) s)"


@query("C6_expected_slots", ["v_field"], f"""
with {SLOTS} select variable, strftime(time_utc, '%Y-%m-%d') as slot_date, count(*) as n from slots group by 1, 2""")
def c6(t):
    """Hourly slots from the first time to nine hours past the last, for every variable."""
    span = t.field.agg(F.min("time_utc").alias("a"), (F.max("time_utc") + F.expr("interval 9 hours")).alias("b"))
    keys = t.field.select("variable").distinct()
    slots = expected_slots(keys, span.select("a").scalar(), span.select("b").scalar(), 60)
    return slots.groupBy("variable", F.date_format("time_utc", "yyyy-MM-dd").alias("slot_date")).agg(F.count("*").alias("n"))


@query("V6_temporal_availability", ["v_field"], f"""
with {SLOTS}, seen as (select distinct variable, time_utc from v_field)
select variable, count(o.time_utc) as present, count(*) as expected, {R6('count(o.time_utc) / count(*)')} as availability
from slots s left join seen o using (variable, time_utc) group by 1""")
def v6(t):
    span = t.field.agg(F.min("time_utc").alias("a"), (F.max("time_utc") + F.expr("interval 9 hours")).alias("b"))
    keys = t.field.select("variable").distinct()
    slots = expected_slots(keys, span.select("a").scalar(), span.select("b").scalar(), 60)
    out = coverage.temporal_availability(t.field, slots)
    return out.withColumn("availability", r6("availability"))


@query("V7_coverage_summary", ["v_cube"], f"""
with {daily_ctes()} select round_even(sum(round_even(coverage * 1e5, 0)) / count(coverage), 0) / 1e5 as mean_coverage, count(*) as buckets, cast(sum(n_slices) as bigint) as slices from daily""")
def v7(t):
    return coverage.coverage_summary(_run(t))
