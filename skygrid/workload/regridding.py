"""Swath to grid."""

from pyspark.sql import functions as F

from skygrid.operators import regrid
from skygrid.plans.grid import GridSpec
from skygrid.workload.fixtures import BIN_GRID, CUBE_GRID
from skygrid.workload.helpers import R6, cells_cte, cells_out, ds, grid_edges_ctes, in_bin, r6
from skygrid.workload.registry import query

VALID = "ok as (select * from v_pixel where value is not null)"
CELLS = cells_cte("cells", BIN_GRID)


def pairs_cte(name, src, radius, key="granule_id"):
    """All pixel-cell pairs within a radius, by comparing every pixel with every cell."""
    return f"""{name} as (select p.{key}, c.i, c.j, p.pixel_id, p.value, sqrt((p.lat - c.lat) * (p.lat - c.lat) + (p.lon - c.lon) * (p.lon - c.lon)) as d
  from {src} p, cells c where sqrt((p.lat - c.lat) * (p.lat - c.lat) + (p.lon - c.lon) * (p.lon - c.lon)) <= {radius})"""


def nearest_sql(pairs, key="granule_id"):
    return f"select {key}, i, j, arg_min(value, row(d, pixel_id)) as value from {pairs} group by {key}, i, j"


def idw_sql(pairs):
    return f"select granule_id, i, j, sum(value / (d + 1e-6)) / sum(1 / (d + 1e-6)) as value from {pairs} group by all"


def linear_ctes(name, src, radius, drop_negative=True):
    """Mesh triangles of the valid pixels, their cells, and the distance mask."""
    tri = lambda a, b, c: ", ".join(f"{p}.lat as y{k}, {p}.lon as x{k}, {p}.value as v{k}" for k, p in enumerate((a, b, c)))
    quad = (f"from {name}_at o left join {src} a on a.granule_id = o.granule_id and a.row_idx = o.r and a.col_idx = o.c "
            f"left join {src} b on b.granule_id = o.granule_id and b.row_idx = o.r + 1 and b.col_idx = o.c "
            f"left join {src} c on c.granule_id = o.granule_id and c.row_idx = o.r + 1 and c.col_idx = o.c + 1 "
            f"left join {src} d on d.granule_id = o.granule_id and d.row_idx = o.r and d.col_idx = o.c + 1")
    has = lambda *ps: " and ".join(f"{p}.pixel_id is not null" for p in ps)
    no = lambda p: f"{p}.pixel_id is null"
    det = "((y1 - y2) * (x0 - x2) + (x2 - x1) * (y0 - y2))"
    return f"""{name}_at as (select distinct granule_id, row_idx - dr as r, col_idx - dc as c from {src}, range(2) x(dr), range(2) y(dc)),
{name}_tri as (select o.granule_id, {tri('a', 'b', 'c')} {quad} where {has('a', 'b', 'c')}
 union all select o.granule_id, {tri('a', 'c', 'd')} {quad} where {has('a', 'c', 'd')}
 union all select o.granule_id, {tri('a', 'b', 'd')} {quad} where {has('a', 'b', 'd')} and {no('c')}
 union all select o.granule_id, {tri('b', 'c', 'd')} {quad} where {has('b', 'c', 'd')} and {no('a')}),
{name}_uv as (select granule_id, c.i, c.j, v0, v1, v2, ((y1 - y2) * (c.lon - x2) + (x2 - x1) * (c.lat - y2)) / {det} as u,
   ((y2 - y0) * (c.lon - x2) + (x0 - x2) * (c.lat - y2)) / {det} as v from {name}_tri, cells c
   where c.lat between least(y0, y1, y2) - 1e-6 and greatest(y0, y1, y2) + 1e-6 and c.lon between least(x0, x1, x2) - 1e-6 and greatest(x0, x1, x2) + 1e-6),
{pairs_cte(name + '_near', src, radius)},
{name} as (select granule_id, i, j, avg(u * v0 + v * v1 + (1 - u - v) * v2) as value from {name}_uv
  where u >= -1e-9 and v >= -1e-9 and 1 - u - v >= -1e-9 and (granule_id, i, j) in (select granule_id, i, j from {name}_near)
  group by all{' having avg(u * v0 + v * v1 + (1 - u - v) * v2) >= 0' if drop_negative else ''})"""


# Corners by the neighbour rule written with window functions, first down the rows, then along them.
CORNERS = """down as (
  select granule_id, col_idx, row_idx as k, case when row_idx = 0 then lat + (lead(lat, 1) over w - lead(lat, 2) over w) / 2 else (lag(lat) over w + lat) / 2 end as lat,
         case when row_idx = 0 then lon + (lead(lon, 1) over w - lead(lon, 2) over w) / 2 else (lag(lon) over w + lon) / 2 end as lon
  from v_pixel window w as (partition by granule_id, col_idx order by row_idx)
  union all
  select granule_id, col_idx, row_idx + 1, la, lo from (
    select granule_id, col_idx, row_idx, lat + (lag(lat, 1) over w - lag(lat, 2) over w) / 2 as la, lon + (lag(lon, 1) over w - lag(lon, 2) over w) / 2 as lo,
           lead(row_idx) over w as nxt from v_pixel window w as (partition by granule_id, col_idx order by row_idx)) where nxt is null),
corners as (
  select granule_id, k, col_idx as l, case when col_idx = 0 then lat + (lead(lat, 1) over w - lead(lat, 2) over w) / 2 else (lag(lat) over w + lat) / 2 end as lat,
         case when col_idx = 0 then lon + (lead(lon, 1) over w - lead(lon, 2) over w) / 2 else (lag(lon) over w + lon) / 2 end as lon
  from down window w as (partition by granule_id, k order by col_idx)
  union all
  select granule_id, k, col_idx + 1, la, lo from (
    select granule_id, k, col_idx, lat + (lag(lat, 1) over w - lag(lat, 2) over w) / 2 as la, lon + (lag(lon, 1) over w - lag(lon, 2) over w) / 2 as lo,
           lead(col_idx) over w as nxt from down window w as (partition by granule_id, k order by col_idx)) where nxt is null)"""


@query("R1_corners_from_centers", ["v_pixel"], f"""
with {CORNERS} select granule_id, k, l, {R6('lat')} as lat, {R6('lon')} as lon from corners""")
def r1(t):
    c = regrid.corners_from_centers(t.pixel)
    return c.select("granule_id", "k", "l", r6("lat").alias("lat"), r6("lon").alias("lon"))


FOOTPRINTS = f"""
with {CORNERS} select p.pixel_id, {', '.join(f"{R6(f'{n}.{x}')} as {n}_{x}" for n in 'abcd' for x in ('lat', 'lon'))}
from v_pixel p join corners a on a.granule_id = p.granule_id and a.k = p.row_idx and a.l = p.col_idx
join corners b on b.granule_id = p.granule_id and b.k = p.row_idx + 1 and b.l = p.col_idx
join corners c on c.granule_id = p.granule_id and c.k = p.row_idx + 1 and c.l = p.col_idx + 1
join corners d on d.granule_id = p.granule_id and d.k = p.row_idx and d.l = p.col_idx + 1"""


def _footprints(pixels):
    feet = regrid.pixel_footprints(pixels)
    return feet.select("pixel_id", *[r6(f"{n}_{x}").alias(f"{n}_{x}") for n in "abcd" for x in ("lat", "lon")])


@query("W2_pixel_footprints", ["v_pixel"], FOOTPRINTS)
def w2(t):
    return _footprints(t.pixel)


@query("W2_repeated_rows", ["v_pixel"], FOOTPRINTS)
def w2_repeated(t):
    """Every seventh pixel comes twice; no footprint is lost or moved."""
    return _footprints(t.pixel.union(t.pixel.where(F.col("pixel_id") % 7 == 0)))


def supersample_ctes(name="gridded", k=4, threshold=0.5):
    blend = lambda x: f"(1 - s) * (1 - t) * a.{x} + s * (1 - t) * b.{x} + s * t * c.{x} + (1 - s) * t * d.{x}"
    g = BIN_GRID
    return f"""{CORNERS}, {grid_edges_ctes(g)},
offs as (select (m + 0.5e0) / {k} as s, (n + 0.5e0) / {k} as t from range({k}) x(m), range({k}) y(n)),
pts as (select p.granule_id, p.value, p.qa / {k * k} as w, {blend('lat')} as y, {blend('lon')} as x
  from v_pixel p join corners a on a.granule_id = p.granule_id and a.k = p.row_idx and a.l = p.col_idx
  join corners b on b.granule_id = p.granule_id and b.k = p.row_idx + 1 and b.l = p.col_idx
  join corners c on c.granule_id = p.granule_id and c.k = p.row_idx + 1 and c.l = p.col_idx + 1
  join corners d on d.granule_id = p.granule_id and d.k = p.row_idx and d.l = p.col_idx + 1
  cross join offs where p.qa >= {threshold} and p.value is not null
  and p.lat between (select min(lo) from lat_bins) and (select max(hi) from lat_bins)
  and p.lon between (select min(lo) from lon_bins) and (select max(hi) from lon_bins)),
{name} as (select granule_id, e.k as i, f.k as j, sum(w * value) / sum(w) as value, cast(count(*) as double) as count
  from pts join lat_bins e on {in_bin('y', 'e')} join lon_bins f on {in_bin('x', 'f')} group by 1, 2, 3)"""


@query("R2_supersample_regrid", ["v_pixel"], f"""
with {supersample_ctes()} select granule_id, i, j, {R6('value')} as value, count from gridded""")
def r2(t):
    return cells_out(regrid.supersample_regrid(t.pixel, BIN_GRID), "count")


@query("R3_nearest_regrid", ["v_pixel"], f"""
with {VALID}, {CELLS}, {pairs_cte('pairs', 'ok', 0.3)}
select granule_id, i, j, {R6('value')} as value from ({nearest_sql('pairs')})""")
def r3(t):
    return cells_out(regrid.nearest_regrid(t.pixel, BIN_GRID, 0.3))


@query("R4_idw_regrid", ["v_pixel"], f"""
with {VALID}, {CELLS}, {pairs_cte('pairs', 'ok', 0.4)}
select granule_id, i, j, {R6('value')} as value from ({idw_sql('pairs')})""")
def r4(t):
    return cells_out(regrid.idw_regrid(t.pixel, BIN_GRID, 0.4))


FINE_GRID = GridSpec(20.8763171, 0.1, 53, 118.8809113, 0.1, 43)


@query("R3_nearest_outward", ["v_pixel"], f"""
with {VALID}, {cells_cte('cells', FINE_GRID)}, {pairs_cte('pairs', 'ok', 0.7)}
select granule_id, i, j, {R6('value')} as value from ({nearest_sql('pairs')})""")
def r3_outward(t):
    """Cells much finer than the radius: found in rounds, from the pixel's own surroundings outwards."""
    return cells_out(regrid.nearest_regrid(t.pixel, FINE_GRID, 0.7))


@query("R5_nearest_limited", ["v_pixel"], f"""
with {VALID}, {CELLS}, {pairs_cte('pairs', 'ok', 0.25)}
select granule_id, i, j, {R6('value')} as value from ({nearest_sql('pairs')})""")
def r5(t):
    return cells_out(regrid.nearest_limited(t.pixel, BIN_GRID))


@query("R6_linear_regrid", ["v_pixel"], f"""
with {VALID}, {CELLS}, {linear_ctes('lin', 'ok', 0.2)}
select granule_id, i, j, {R6('value')} as value from lin""")
def r6_linear(t):
    return cells_out(regrid.linear_regrid(t.pixel, BIN_GRID, 0.2))


# Granules are stretched by different factors, so that some are coarser than the grid and some are not.
STRETCH = """px as (select * replace (lat * f as lat, lon * f as lon) from (
  select *, case granule_id % 3 when 0 then 1e0 when 1 then 0.85e0 else 0.7e0 end as f from (
    select * replace (lat - 21 as lat, lon - 119 as lon) from v_pixel))),
stretched as (select * replace (lat + 21 as lat, lon + 119 as lon) from px where value is not null)"""
SPACING = """near as (select a.granule_id, a.pixel_id, min(sqrt(pow(a.lat - b.lat, 2) + pow(a.lon - b.lon, 2))) as d
  from stretched a join stretched b on a.granule_id = b.granule_id and a.pixel_id <> b.pixel_id group by 1, 2),
spacing as (select granule_id, median(d) > 0.375e0 as coarse from near group by 1)"""


def _stretched(t):
    f = F.when(F.col("granule_id") % 3 == 0, 1.0).when(F.col("granule_id") % 3 == 1, 0.85).otherwise(0.7)
    return t.pixel.withColumns({"lat": (F.col("lat") - 21) * f + 21, "lon": (F.col("lon") - 119) * f + 119})


@query("R7_coarse_granules", ["v_pixel"], f"with {STRETCH}, {SPACING} select granule_id, coarse from spacing")
def r7_spacing(t):
    return regrid.coarse_granules(_stretched(t), BIN_GRID)


@query("R7_overwrite_upsample", ["v_pixel"], f"""
with {VALID}, {CELLS}, {pairs_cte('pairs', 'ok', 0.5)}
select granule_id, i, j, {R6('arg_max(value, pixel_id)')} as value from pairs group by granule_id, i, j""")
def r7(t):
    return cells_out(regrid.overwrite_regrid(t.pixel, BIN_GRID, 0.3))


# Granules differ in how strict their quality filter is, so that all three methods occur.
THINNED = """kept as (select * from v_pixel where qa >= case granule_id % 3 when 0 then 0 when 1 then 0.85 else 0.95 end
  and cloud <= case granule_id % 3 when 2 then 0.4 else 1 end),
thin as (select * from kept where value is not null and value <> 0)"""


def _thinned(t):
    """All pixels; those that fail their granule's filter have no value, so the operator itself has to refuse them. Nor have
    they a time: a granule's day is that of its first pixel which passes."""
    g = F.col("granule_id") % 3
    passes = ((F.col("qa") >= F.when(g == 0, 0.0).when(g == 1, 0.85).otherwise(0.95))
              & (F.col("cloud") <= F.when(g == 2, 0.4).otherwise(1.0)))
    return t.pixel.withColumns({c: F.when(passes, F.col(c)) for c in ("value", "obs_time")})


EXTENT = f"({BIN_GRID.nlat - 1} * 0.25e0 * {BIN_GRID.nlon - 1} * 0.25e0)"
METHOD = f"""stats as (select granule_id, count(*) as n, count(*) / {float(BIN_GRID.size)}e0 as density,
  (max(lat) - min(lat)) * (max(lon) - min(lon)) / {EXTENT} as ratio from thin group by 1),
method as (select granule_id, case when density > 0.1 and ratio > 0.3 then 1 when density > 0.01 then 2 else 3 end as method from stats)"""


METHOD_NO = {"linear": 1, "idw": 2, "nearest": 3}


def part_cte(kind):
    return f"thin_{kind} as materialized (select t.* from thin t join method m on m.granule_id = t.granule_id and m.method = {METHOD_NO[kind]})"


ADAPTIVE = f"""{THINNED}, {METHOD}, {CELLS}, {part_cte('linear')}, {part_cte('idw')}, {part_cte('nearest')},
{linear_ctes('lin', 'thin_linear', 0.15)}, {pairs_cte('pi', 'thin_idw', 0.2)}, {pairs_cte('pn', 'thin_nearest', 0.25)},
tiles as (select granule_id, i, j, value, 1 as method from lin
  union all select granule_id, i, j, value, 2 from ({idw_sql('pi')})
  union all select granule_id, i, j, value, 3 from ({nearest_sql('pn')}))"""


@query("R8_adaptive_regrid", ["v_pixel"], f"with {ADAPTIVE} select granule_id, i, j, method, {R6('value')} as value from tiles")
def r8(t):
    numbers = F.create_map(*[F.lit(x) for pair in METHOD_NO.items() for x in pair])
    cells = regrid.adaptive_regrid(_thinned(t), BIN_GRID)
    return cells_out(cells, F.element_at(numbers, F.col("method")).alias("method"))


STEP = """nb as (select *, lead(lat) over w as nlat, lead(lon) over w as nlon, lag(lat) over w as plat, lag(lon) over w as plon
  from v_pixel window w as (partition by granule_id, row_idx order by col_idx)),
steps as (select *, coalesce(sqrt(pow(nlat - lat, 2) + pow((nlon - lon) * cos(radians(lat)), 2)),
                             sqrt(pow(lat - plat, 2) + pow((lon - plon) * cos(radians(plat)), 2))) as step from nb)"""
RADIUS = STEP + ", feet as (select *, least(greatest(0.5e0 * step, 0.5e0 * 0.25e0 * sqrt(2e0)), 0.35e0) as radius from steps)"


@query("W1_scanline_step", ["v_pixel"], f"with {STEP} select pixel_id, {R6('step')} as step from steps")
def w1(t):
    return regrid.scanline_step(t.pixel).select("pixel_id", r6("step").alias("step"))


@query("R9_footprint_radius", ["v_pixel"], f"with {RADIUS} select pixel_id, {R6('radius')} as radius from feet")
def r9(t):
    return regrid.footprint_radius(t.pixel, 0.25).select("pixel_id", r6("radius").alias("radius"))


@query("R10_footprint_nn_daily", ["v_pixel"], f"""
with {RADIUS}, {CELLS}, ok as (select *, cast(obs_time as date) as obs_date from feet where value is not null),
scale as (select obs_date, cos(radians(avg(lat))) as s from ok group by 1),
scaled as materialized (select o.*, s.s from ok o join scale s using (obs_date)),
pairs as (select o.obs_date, c.i, c.j, o.pixel_id, o.value, o.radius, sqrt(pow(o.lat - c.lat, 2) + pow((o.lon - c.lon) * o.s, 2)) as d
  from scaled o, cells c where abs(o.lat - c.lat) <= 0.36 and abs(o.lon - c.lon) <= 0.5),
best as (select obs_date, i, j, min(d) as d, arg_min(value, row(d, pixel_id)) as value, arg_min(radius, row(d, pixel_id)) as radius from pairs group by 1, 2, 3)
select strftime(obs_date, '%Y-%m-%d') as obs_date, i, j, {R6('value')} as value from best where d <= radius""")
def r10(t):
    day = regrid.footprint_nn_daily(t.pixel, BIN_GRID)
    return day.select(ds("obs_date").alias("obs_date"), "i", "j", r6("value").alias("value"))


@query("R11_smooth_regrid", ["v_pixel"], f"""
with {VALID}, {CELLS}, {pairs_cte('pairs', 'ok', 0.4)}
select granule_id, i, j, {R6('sum(exp(-(d * d) / (2 * 0.2e0 * 0.2e0)) * value) / sum(exp(-(d * d) / (2 * 0.2e0 * 0.2e0)))')} as value
from pairs group by granule_id, i, j""")
def r11(t):
    return cells_out(regrid.smooth_regrid(t.pixel, BIN_GRID, 0.4))


@query("R12_search_radius", ["v_pixel"], f"""
select granule_id, count(value) as n_valid, {R6('case when count(value) < 100 then 2 when count(value) < 500 then 3 else 4 end * 0.25e0')} as radius
from v_pixel group by granule_id""")
def r12(t):
    return regrid.search_radius(t.pixel, BIN_GRID).select("granule_id", "n_valid", r6("radius").alias("radius"))


@query("R12_regrid_by_density", ["v_pixel"], f"""
with {VALID}, {CELLS}, sized as (select granule_id, case when count(*) < 100 then 2 when count(*) < 500 then 3 else 4 end * 0.25e0 as r from ok group by 1),
placed as materialized (select p.*, s.r from ok p join sized s using (granule_id)),
pairs as (select p.granule_id, c.i, c.j, p.pixel_id, p.value, sqrt((p.lat - c.lat) * (p.lat - c.lat) + (p.lon - c.lon) * (p.lon - c.lon)) as d, p.r
  from placed p, cells c)
select granule_id, i, j, {R6('value')} as value from ({nearest_sql('(select * from pairs where d <= r)')})""")
def r12_regrid(t):
    return cells_out(regrid.regrid_by_density(t.pixel, BIN_GRID, "kdtree"))


GRIDDATA = f"""{STRETCH}, {SPACING}, {CELLS},
fine as materialized (select s.* from stretched s join spacing g on g.granule_id = s.granule_id and not g.coarse),
wide as materialized (select s.* from stretched s join spacing g on g.granule_id = s.granule_id and g.coarse),
{linear_ctes('lin', 'fine', 0.2, False)}, {pairs_cte('over', 'wide', 0.25)}"""


@query("R13_interpolate", ["v_pixel"], f"""
with {GRIDDATA}
select granule_id, i, j, {R6('value')} as value, 1e0 as count from lin
union all select granule_id, i, j, {R6('arg_max(value, pixel_id)')}, 1e0 from over group by granule_id, i, j""")
def r13(t):
    """The default method: overwrite for granules coarser than the grid, linear for the others."""
    return cells_out(regrid.interpolate(_stretched(t), BIN_GRID, "griddata", 0.2), "count")


@query("R14_smooth3x3", ["v_cube"], f"""
with cube as (select year(obs_date) as yyyy, i, j, max(value) as value from v_cube group by 1, 2, 3),
near as (select c.yyyy, (c.i + a.d + 51) % 51 as i, (c.j + b.d + 41) % 41 as j, c.value
  from cube c, (values (-1), (0), (1)) a(d), (values (-1), (0), (1)) b(d) where c.value is not null)
select cast(yyyy as int) as yyyy, cast(i as int) as i, cast(j as int) as j, {R6('sum(value) / 9')} as value from near group by 1, 2, 3 having count(*) = 9""")
def r14(t):
    yearly = t.cube.groupBy(F.year("obs_date").alias("yyyy"), "i", "j").agg(F.max("value").alias("value"))
    return regrid.smooth_box(yearly, CUBE_GRID, ["yyyy"]).withColumn("value", r6("value"))


@query("W3_sample_pixels", ["v_pixel"], """
select granule_id, pixel_id from (select granule_id, pixel_id, row_number() over (partition by granule_id order by md5(cast(pixel_id as varchar)), pixel_id) as rn
  from v_pixel) where rn <= 25""")
def w3(t):
    return regrid.sample_pixels(t.pixel, 25).select("granule_id", "pixel_id")
