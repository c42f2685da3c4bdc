"""Grid construction, cell indices, region masks and places."""

from pyspark.sql import functions as F

from skygrid.functions import lookup
from skygrid.functions.geo import is_finite
from skygrid.operators import coverage, region, stations
from skygrid.plans.dimension import dimension, hint_if_bounded
from skygrid.plans.grid import FIGURE_BOX, GridSpec
from skygrid.workload.fixtures import BIN_GRID, CUBE_GRID
from skygrid.workload.helpers import CENTS, R6, cells_cte, cents, edges_cte, grid_edges_ctes, in_bin, r6
from skygrid.workload.registry import query

KM_GRID = GridSpec.from_km((55.0, 35.0))
CROPPED = KM_GRID.crop(FIGURE_BOX)
DEGREE_FULL = GridSpec.from_degrees(FIGURE_BOX, 0.5)
DEGREE_HALF = GridSpec.from_degrees(FIGURE_BOX, 0.5, end_margin=0.5)


def _filled(t, grid, label=None):
    """Every cell of the grid with the number of pixels that fall in it."""
    counts = (t.pixel.select(grid.row_index(F.col("lat")).alias("i"), grid.col_index(F.col("lon")).alias("j"))
              .groupBy("i", "j").agg(F.count("*").alias("n")))
    out = grid.cells(t.spark).join(counts, ["i", "j"], "left").select(
        "i", "j", r6("lat").alias("lat"), r6("lon").alias("lon"), F.coalesce("n", F.lit(0)).alias("n"))
    return out if label is None else out.withColumn("rule", F.lit(label))


def _filled_sql(grid, cells, label=None, lat="lat_bins", lon="lon_bins"):
    tag = "" if label is None else f", '{label}' as rule"
    return f"""select c.i, c.j, {R6('c.lat')} as lat, {R6('c.lon')} as lon, count(p.pixel_id) as n{tag}
from {cells} c join {lat} a on a.k = c.i join {lon} b on b.k = c.j
left join v_pixel p on {in_bin('p.lat', 'a')} and {in_bin('p.lon', 'b')} group by c.i, c.j, c.lat, c.lon"""


@query("G1_make_grid", ["v_pixel"], f"""
with {cells_cte('cells', KM_GRID)}, {grid_edges_ctes(KM_GRID)}
{_filled_sql(KM_GRID, 'cells')}""")
def g1(t):
    return _filled(t, KM_GRID)


@query("G2_grid_edges", ["v_pixel"], f"""
with {edges_cte('lat_bins', BIN_GRID.lat_edge0, BIN_GRID.lat_step, BIN_GRID.nlat)}
select b.k, {R6('b.lo')} as lo, {R6('b.hi')} as hi, count(p.pixel_id) as n
from lat_bins b left join v_pixel p on {in_bin('p.lat', 'b')} group by b.k, b.lo, b.hi""")
def g2(t):
    """Both edges of every latitude bin, with the pixels between them."""
    counts = t.pixel.groupBy(BIN_GRID.row_index(F.col("lat")).alias("k")).agg(F.count("*").alias("n"))
    bins = t.spark.range(BIN_GRID.nlat).select(F.col("id").cast("int").alias("k"))
    return bins.join(counts, "k", "left").select(
        "k", r6(BIN_GRID.lat_edge(F.col("k"))).alias("lo"), r6(BIN_GRID.lat_edge(F.col("k") + 1)).alias("hi"),
        F.coalesce("n", F.lit(0)).alias("n"))


@query("G3_crop_grid", ["v_pixel"], f"""
with {cells_cte('cells', KM_GRID)}, {grid_edges_ctes(KM_GRID)}
select i - {CROPPED.i0} as i, j - {CROPPED.j0} as j, lat, lon, n from ({_filled_sql(KM_GRID, 'cells')})
where lon between 119 and 123 and lat between 21 and 26""")
def g3(t):
    return _filled(t, CROPPED)


@query("G4_make_degree_grid", ["v_pixel"], f"""
with {cells_cte('full_cells', DEGREE_FULL)}, {grid_edges_ctes(DEGREE_FULL, 'fa', 'fo')},
{cells_cte('half_cells', DEGREE_HALF)}, {grid_edges_ctes(DEGREE_HALF, 'ha', 'ho')}
{_filled_sql(DEGREE_FULL, 'full_cells', 'full', 'fa', 'fo')}
union all
{_filled_sql(DEGREE_HALF, 'half_cells', 'half', 'ha', 'ho')}""")
def g4(t):
    """The two end rules differ by one row and one column."""
    return _filled(t, DEGREE_FULL, "full").unionByName(_filled(t, DEGREE_HALF, "half"))


@query("G5_grid_signature", ["v_cube"], f"""
select strftime(obs_date, '%Y-%m-%d') || '-' || slice_no as slice_id, max(i) - min(i) + 1 as n_rows, max(j) - min(j) + 1 as n_cols,
  {R6('min(lat)')} as lat_min, {R6('max(lat)')} as lat_max, {R6('min(lon)')} as lon_min, {R6('max(lon)')} as lon_max
from v_cube group by obs_date, slice_no""")
def g5(t):
    sig = coverage.grid_signature(t.cube_slices())
    return sig.select("slice_id", "n_rows", "n_cols", *[r6(c).alias(c) for c in ("lat_min", "lat_max", "lon_min", "lon_max")])


@query("G5_off_grid_cells", ["v_cube"], "select cast(count(*) as bigint) as n from v_cube where i > 45 or abs(lat - (21e0 + i * 0.1e0)) > 1e-6")
def g5_stray(t):
    """Cells that do not belong to a grid of 46 rows."""
    small = GridSpec(21.0, 0.1, 46, 119.0, 0.1, 41)
    return coverage.off_grid_cells(t.cube, small).agg(F.count("*").alias("n"))


@query("G6_cell_index", ["v_pixel"], f"""
with {grid_edges_ctes(BIN_GRID)}
select p.pixel_id, a.k as i, b.k as j from v_pixel p left join lat_bins a on {in_bin('p.lat', 'a')} left join lon_bins b on {in_bin('p.lon', 'b')}""")
def g6(t):
    return t.pixel.select("pixel_id", BIN_GRID.row_index(F.col("lat")).alias("i"), BIN_GRID.col_index(F.col("lon")).alias("j"))


RAYS = f"""edges as (select zone, county, ring, lat as y1, lon as x1, lead(lat) over w as y2, lead(lon) over w as x2
  from v_zone_vertex window w as (partition by zone, county, ring order by seq)),
{cells_cte('cells', CUBE_GRID)},
crossings as (select c.i, c.j, e.zone, e.county, count(*) as n from cells c join edges e
  on e.y2 is not null and c.lat >= least(e.y1, e.y2) and c.lat < greatest(e.y1, e.y2)
  and c.lon < e.x1 + (c.lat - e.y1) / (e.y2 - e.y1) * (e.x2 - e.x1) group by all),
mask as (select distinct zone, i, j from crossings where n % 2 = 1)"""


@query("J1_region_mask", ["v_cube", "v_zone_vertex"], f"""
with {RAYS}
select m.zone, m.i, m.j, count(c.obs_date) as n_rows, count(c.value) as n_valid
from mask m left join v_cube c using (i, j) group by m.zone, m.i, m.j""")
def j1(t):
    mask = region.zone_mask(t.zone_vertex, CUBE_GRID)
    seen = t.cube.groupBy("i", "j").agg(F.count("*").alias("n_rows"), F.count("value").alias("n_valid"))
    return mask.join(seen, ["i", "j"], "left").select(
        "zone", "i", "j", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("n_valid", F.lit(0)).alias("n_valid"))


COUNTIES = [c for cs in lookup.AIR_QUALITY_ZONES.values() for c in cs]
ZONE_VALUES = ", ".join(f"({k}, '{z}')" for k, (z, c) in enumerate((z, c) for z, cs in lookup.AIR_QUALITY_ZONES.items() for c in cs))


@query("J2_zone_membership", [], f"""
select z.zone, count(*) as n, {CENTS('c_acctbal')} as total from customer
join (values {ZONE_VALUES}) z(k, zone) on z.k = c_custkey % {len(COUNTIES)} group by z.zone""")
def j2(t):
    """Customers of a county counted under the county's zone."""
    names = F.array(*[F.lit(c) for c in COUNTIES])
    placed = t.customer.withColumn("county", F.element_at(names, (F.col("c_custkey") % len(COUNTIES) + 1).cast("int")))
    return (placed.join(lookup.zone_counties(t.spark), "county").groupBy("zone")
            .agg(F.count("*").alias("n"), cents("c_acctbal").alias("total")))


@query("J3_stations_in_box", ["v_place"], """
select owner, site_type, count(*) as n from v_place where lon between 120 and 121.5 and lat between 23.4 and 25 group by 1, 2""")
def j3(t):
    return stations.count_in_box(t.place, (120.0, 121.5, 23.4, 25.0), ["owner", "site_type"])


PLANT_VALUES = ", ".join(f"('{n}', {a}e0, {o}e0, '{k}')" for n, a, o, k in lookup.POWER_PLANTS)


@query("J3_plants_in_box", ["v_cube"], f"""
with plants as (select * from (values {PLANT_VALUES}) p(name, lat, lon, kind) where lon between 120 and 121.5 and lat between 23.4 and 25),
{cells_cte('cells', CUBE_GRID)},
near as (select p.kind, p.name, arg_min(c.i, sqrt(pow(c.lat - p.lat, 2) + pow(c.lon - p.lon, 2))) as i,
         arg_min(c.j, sqrt(pow(c.lat - p.lat, 2) + pow(c.lon - p.lon, 2))) as j from plants p, cells c group by 1, 2)
select n.kind, n.name, count(c.value) as n_obs from near n left join v_cube c on c.i = n.i and c.j = n.j group by 1, 2""")
def j3_plants(t):
    """Plants inside the box with the observations of their cell."""
    plants = dimension(t.spark, lookup.POWER_PLANTS, "name string, lat double, lon double, kind string")
    inside = plants.where(F.col("lon").between(120.0, 121.5) & F.col("lat").between(23.4, 25.0))
    cells = stations.nearest_cell(inside, CUBE_GRID).select("kind", "name", "i", "j")
    seen = t.cube.where(is_finite(F.col("value"))).join(hint_if_bounded(cells, len(lookup.POWER_PLANTS)), ["i", "j"]).groupBy("kind", "name").agg(F.count("*").alias("n"))
    return cells.join(seen, ["kind", "name"], "left").select("kind", "name", F.coalesce("n", F.lit(0)).alias("n_obs"))


@query("J3_station_subset", ["v_place"], """
select name, owner, site_type from v_place where name in ('Supplier#000000003', 'Supplier#000000007', 'Supplier#000000042')""")
def j3_subset(t):
    names = ["Supplier#000000003", "Supplier#000000007", "Supplier#000000042"]
    return stations.select_stations(t.place, names, "name").select("name", "owner", "site_type")
