"""Scans, sources and sinks."""

from pyspark.sql import functions as F

from skygrid.functions.lookup import HUBS, SWATH_AOD_VARIABLES, TILE_AOD_VARIABLES
from skygrid.functions.time import granule_time
from skygrid.operators.coverage import compute_coverage, coverage_summary
from skygrid.operators.merge import union_tables
from skygrid.operators.stations import station_series, with_level_key
from skygrid.functions.lookup import stations as default_stations
from skygrid.session import shared_dir
from skygrid.sources import swath, tables
from skygrid.workload.fixtures import CUBE_GRID, FIELD_GRID
from skygrid.workload.helpers import CENTS, DS, R6, TS, cents, ds, r6
from skygrid.workload.registry import query
from skygrid.workload.scalars import GRANULE_TIME, NAMES


@query("A1_scan_cube", ["v_cube"], f"""
select strftime(obs_date, '%Y') as yyyy, strftime(obs_date, '%m') as mm, count(*) as n_rows, {CENTS('value')} as total
from v_cube where strftime(obs_date, '%Y%m') between '199603' and '199902' group by 1, 2""")
def a1(t):
    """A cube of two regions on disk; one region and a range of months are scanned."""
    path = shared_dir(t.spark, "scan")
    for region in ("taiwan", "east_asia"):
        tables.write_cube(tables.cube_layout(t.cube_slices(), hub="modis", product="MYD04_L2", region=region), path)
    cube = tables.scan_cube(t.spark, path, "MYD04_L2", "1996-03-15", "1999-02-10", hub="modis", level="L2", region="taiwan")
    return (cube.groupBy("yyyy", "mm")
            .agg(F.count("*").alias("n_rows"), cents("value").alias("total")))


@query("A2_slices", ["v_cube"], f"""
select {DS('obs_date')} as obs_date, count(*) as n_rows, count(value) as n_valid from v_cube
where obs_date + interval '1' hour * slice_no between timestamp '1996-03-15 00:00:00' and timestamp '1999-02-10 23:59:59'
group by 1""")
def a2(t):
    cube = tables.slices(t.cube_slices(), "1996-03-15", "1999-02-10")
    return (cube.groupBy(ds("obs_date").alias("obs_date"))
            .agg(F.count("*").alias("n_rows"), F.count("value").alias("n_valid")))


@query("A2_slice_time_from_name", ["v_filename"], f"""
with {NAMES}, timed as (select file_id, {GRANULE_TIME} as slice_time from names)
select file_id, {TS('slice_time')} as slice_time from timed where slice_time between timestamp '1996-01-01' and timestamp '1999-12-31 23:59:59'""")
def a2_named(t):
    """Slices of every kind of name, none of which has a time of its own; undated names are in no range."""
    timed = tables.slices(t.filename.withColumn("time", F.lit(None).cast("timestamp")), "1996-01-01", "1999-12-31", path="name")
    return timed.select("file_id", F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("slice_time"))


@query("A3_explode_grid", [], f"""
select vec_id as granule_id, cast(k // 8 as int) as row_idx, cast(k % 8 as int) as col_idx,
       20e0 + k // 8 as lat, 119e0 + k % 8 as lon, {R6('cast(embedding[k + 1] as double)')} as value
from embeddings, range(64) r(k)""")
def a3(t):
    """An 8 x 8 field per embedding, exploded to pixels."""
    rows = F.sequence(F.lit(0), F.lit(7))
    dense = t.embeddings.select(
        F.col("vec_id").alias("granule_id"),
        F.transform(rows, lambda r: F.transform(F.sequence(F.lit(0), F.lit(7)), lambda c: F.lit(20.0) + r)).alias("lat"),
        F.transform(rows, lambda r: F.transform(F.sequence(F.lit(0), F.lit(7)), lambda c: F.lit(119.0) + c)).alias("lon"),
        F.transform(rows, lambda r: F.slice(F.col("embedding").cast("array<double>"), r * 8 + 1, F.lit(8))).alias("value"))
    return swath.explode_grid(dense).withColumn("value", r6("value"))


@query("A4_resolve_variable", ["v_pixel"], f"""
select granule_id, count(value) as n_valid, {CENTS('value')} as total, count(raw) as n_tile from v_pixel group by granule_id""")
def a4(t):
    """The preferred optical-depth variable is absent in both sources, the next one is taken."""
    land = swath.resolve_variable(t.pixel.withColumnRenamed("value", SWATH_AOD_VARIABLES[1]), SWATH_AOD_VARIABLES)
    both = swath.resolve_variable(land.withColumnRenamed("raw", TILE_AOD_VARIABLES[1]), TILE_AOD_VARIABLES, "tile_value")
    return both.groupBy("granule_id").agg(F.count("value").alias("n_valid"), cents("value").alias("total"),
                                          F.count("tile_value").alias("n_tile"))


@query("A5_resolve_coords", ["v_pixel"], f"""
select granule_id, {R6('min(lat)')} as lat_min, {R6('max(lon)')} as lon_max from v_pixel group by granule_id""")
def a5(t):
    hub = HUBS["sentinel5p"]
    raw = t.pixel.withColumnsRenamed({"lat": "latitude", "lon": "longitude"})
    named = swath.resolve_coords(raw, {"lat": hub.lat_names, "lon": hub.lon_names})
    return named.groupBy("granule_id").agg(r6(F.min("lat")).alias("lat_min"), r6(F.max("lon")).alias("lon_max"))


@query("A6_swath_s5p", ["v_pixel"], f"""
select pixel_id, {R6('value')} as value, 1e0 as qa from v_pixel where flag = 0""")
def a6(t):
    """Two products share the table; one of them is read, without a qa column."""
    shared = t.pixel.drop("qa").withColumns({
        "hub": F.lit("sentinel5p"), "product": F.when(F.col("flag") == 0, "NO2___").otherwise("O3____")})
    return swath.swath_s5p(shared, "sentinel5p", "NO2___").select("pixel_id", r6("value").alias("value"), "qa")


@query("A7_swath_gems", ["v_pixel"], f"""
select pixel_id, {R6('lat')} as lat, {R6('lon')} as lon, {R6('value')} as value, flag from v_pixel""")
def a7(t):
    data = t.pixel.select("granule_id", "row_idx", "col_idx", "pixel_id", "value", "flag")
    geo = t.pixel.select("granule_id", "row_idx", "col_idx", "lat", "lon")
    return swath.swath_gems(data, geo).select("pixel_id", r6("lat").alias("lat"), r6("lon").alias("lon"),
                                              r6("value").alias("value"), "flag")


@query("A8_explode_bands", ["v_pixel"], f"""
select pixel_id, cast(b.nm as int) as band_nm, {R6('value * b.f')} as value
from v_pixel cross join (values (354, 1e0), (443, 0.5e0), (550, 0.25e0)) b(nm, f) where qa > 0""")
def a8(t):
    """Pixels with qa 0 carry two bands only and give nothing."""
    v = F.col("value")
    bands = F.when(F.col("qa") > 0, F.array(v, v * 0.5, v * 0.25)).otherwise(F.array(v, v))
    return (swath.explode_bands(t.pixel.withColumn("bands", bands).drop("value"))
            .select("pixel_id", "band_nm", r6("value").alias("value")))


@query("A9_swath_modis", ["v_pixel"], f"""
select pixel_id, {R6('case when raw <> -9999 and raw >= 0 then raw * 0.001e0 end')} as value from v_pixel""")
def a9(t):
    return swath.swath_modis(t.pixel).select("pixel_id", r6("value").alias("value"))


@query("A10_first_layer", ["v_pixel"], f"select pixel_id, 0 as layer_idx, {R6('value')} as value from v_pixel")
def a10(t):
    layers = t.pixel.select("pixel_id", F.posexplode(F.array(F.col("value"), F.col("value") * 2)).alias("layer_idx", "value"))
    return swath.first_layer(layers).withColumn("value", r6("value"))


@query("A11_align_shapes", ["v_pixel"], f"""
select granule_id, row_idx, col_idx, {R6('value')} as value from v_pixel where row_idx <= 7 and col_idx <= 8""")
def a11(t):
    """Three arrays of one granule with 10 x 10, 8 x 10 and 10 x 9 places."""
    keys = ["granule_id", "row_idx", "col_idx"]
    aligned = swath.align_shapes(t.pixel.select(*keys, "value"),
                                 t.pixel.where("row_idx <= 7").select(*keys, "lat"),
                                 t.pixel.where("col_idx <= 8").select(*keys, "lon"))
    return aligned.select(*keys, r6("value").alias("value"))


@query("A11_common_shape", ["v_pixel"], """
with cut as (select * from v_pixel where row_idx <= 9 - granule_id % 3 and col_idx <= 8 + granule_id % 2),
sizes as (select granule_id, max(row_idx) as r, max(col_idx) as c from cut group by granule_id),
low as (select min(r) as r, min(c) as c from sizes)
select granule_id, count(*) as n from cut, low where row_idx <= low.r and col_idx <= low.c group by granule_id""")
def a11_common(t):
    """Granules of different sizes cropped to the smallest."""
    cut = t.pixel.where((F.col("row_idx") <= 9 - F.col("granule_id") % 3) & (F.col("col_idx") <= 8 + F.col("granule_id") % 2))
    return swath.common_shape(cut).groupBy("granule_id").agg(F.count("*").alias("n"))


@query("A12_scan_fields", ["v_field"], f"""
select variable, coalesce(cast(level as varchar), 'sfc') as level_key, count(*) as n_rows, count(value) as n_valid,
       {R6('max(value)')} as top from v_field group by 1, 2""")
def a12(t):
    surface = tables.scan_fields(t.field.where("level is null").drop("level"), ("time", "latitude", "longitude"))
    upper = tables.scan_fields(t.field.where("level is not null").withColumnRenamed("level", "pressure_level"),
                               ("time", "pressure_level", "latitude", "longitude"))
    fields = with_level_key(surface.unionByName(upper))
    return fields.groupBy("variable", "level_key").agg(F.count("*").alias("n_rows"), F.count("value").alias("n_valid"),
                                                       r6(F.max("value")).alias("top"))


@query("A13_read_stations", [], """
select 'environment' as owner, s_name as station, cast(s_nationkey as int) as county, null as site_type from supplier
union all select 'power', c_name, cast(c_nationkey as int), c_mktsegment from customer""")
def a13(t):
    """Two providers' CSV files with their own headers and encodings, which the reader finds out; one has no site type."""
    path = shared_dir(t.spark, "stations")
    t.supplier.select(F.col("s_name").alias("sitename"), F.col("s_nationkey").alias("county_no")).write.csv(f"{path}/environment", header=True)
    (t.customer.select(F.col("c_name").alias("\u96fb\u5ee0\u540d\u7a31"), F.col("c_nationkey").alias("\u7e23\u5e02"), F.col("c_mktsegment").alias("\u985e\u578b"))
     .write.option("encoding", "big5").csv(f"{path}/power", header=True))
    one = tables.read_provider_csv(t.spark, f"{path}/environment", {"sitename": "station", "county_no": "county"}, "environment")
    two = tables.read_provider_csv(t.spark, f"{path}/power", {"\u96fb\u5ee0\u540d\u7a31": "station", "\u7e23\u5e02": "county", "\u985e\u578b": "site_type"}, "power")
    return union_tables([one, two]).withColumn("county", F.col("county").cast("int")).select("owner", "station", "county", "site_type")


@query("A14_skip_bad_files", ["v_filename"], "select file_id, name from v_filename where not starts_with(name, '._')")
def a14(t):
    return t.filename.where(tables.is_real_file(F.concat(F.lit("/data/"), "name")))


@query("A14_damaged_files", ["v_cube"], f"""
select count(*) as n_rows, {CENTS('value')} as total, 1 as n_unread from v_cube""")
def a14_damaged(t):
    """A cube beside a file that is no Parquet: the scan leaves that file out on request and tells its name."""
    path = shared_dir(t.spark, "damaged")
    tables.write_cube(tables.cube_layout(t.cube_slices(), hub="modis", product="MYD04_L2"), path)
    broken = f"{path}/hub=modis/level=L2/region=taiwan/product=MYD04_L2/yyyy=1992/mm=01/broken.parquet"
    fs_path = t.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(broken)
    out = fs_path.getFileSystem(t.spark.sparkContext._jsc.hadoopConfiguration()).create(fs_path)
    out.writeBytes("not a table")
    out.close()
    unread = tables.unread_files(t.spark, path).agg(F.count("*").cast("int")).scalar()
    return (tables.scan_cube(t.spark, path, "MYD04_L2", skip_damaged=True)
            .agg(F.count("*").alias("n_rows"), cents("value").alias("total")).withColumn("n_unread", unread))


@query("A15_write_cube", ["v_cube"], f"""
select 'modis' as hub, 'L2' as level, 'taiwan' as region, 'MYD04_L2' as product, cast(strftime(obs_date, '%Y') as int) as yyyy,
       cast(strftime(obs_date, '%m') as int) as mm, count(*) as n_rows, {CENTS('value')} as total from v_cube group by 5, 6""")
def a15(t):
    """Written to partitioned Parquet and read back."""
    path = shared_dir(t.spark, "cube")
    tables.write_cube(tables.cube_layout(t.cube_slices(), hub="modis", product="MYD04_L2", method="supersample"), path)
    return (t.spark.read.parquet(path).groupBy("hub", "level", "region", "product", "yyyy", "mm")
            .agg(F.count("*").alias("n_rows"), cents("value").alias("total")))


@query("A16_write_station_csv", ["v_field", "v_station"], f"""
with cells as (select station, cast(round(lat - 22) as int) as i, cast(round(lon - 119) as int) as j from v_station),
stems as (select case when level is null then concat('era5_sfc_', variable)
                 else concat('era5_pl_', variable, '_', cast(level as varchar)) end as stem, time_utc, station, value
          from v_field f join cells c using (i, j)
          where time_utc + interval 8 hour >= timestamp '2024-01-01' and time_utc + interval 8 hour < timestamp '9999-01-01')
select stem, station, count(*) as n_rows, count(value) as n_valid, {CENTS('value')} as total from stems group by 1, 2""")
def a16(t):
    path = shared_dir(t.spark, "stations")
    series = station_series(with_level_key(t.field), default_stations(t.spark), FIELD_GRID, "2024-01-01", "9998-12-31")
    tables.write_station_csv(series, path)
    back = t.spark.read.option("header", "true").schema(
        "time_utc timestamp, station string, value double, time_local timestamp, variable string, level_key string").csv(path)
    level = F.when(F.col("level_key") != "sfc", F.col("level_key").cast("int"))
    return (back.groupBy(tables.station_file_stem(F.col("variable"), level).alias("stem"), "station")
            .agg(F.count("*").alias("n_rows"), F.count("value").alias("n_valid"), cents("value").alias("total")))


@query("A17_write_coverage_csv", ["v_cube"], """
with days as (select obs_date, count(distinct slice_no) as n from v_cube group by 1),
hit as (select obs_date, count(distinct i * 1000 + j) as v from v_cube
        where value is not null and lon between 120 and 122 and lat between 22 and 25 group by 1),
tot as (select count(*) as total from range(51) a(i), range(41) b(j)
        where 21e0 + 0.1e0 * i between 22 and 25 and 119e0 + 0.1e0 * j between 120 and 122)
select round_even(sum(round_even(coalesce(v, 0) * 1e5 / total, 0)) / count(*), 0) / 1e5 as mean_coverage, count(*) as buckets, cast(sum(n) as bigint) as slices
from days cross join tot left join hit using (obs_date)""")
def a17(t):
    path = shared_dir(t.spark, "coverage")
    table = compute_coverage(t.cube_slices(), CUBE_GRID, region=(120.0, 122.0, 22.0, 25.0), hub="modis", product="aod")
    tables.write_coverage_csv(table, path)
    return coverage_summary(t.spark.read.schema(table.schema).option("header", "true").csv(path))


@query("A18_crop_l3", ["v_cube"], f"""
select {DS('obs_date')} as obs_date, count(*) as n_rows, {CENTS('value')} as total from v_cube
where lon between 119.95 and 121.55 and lat between 22.05 and 24.45 group by 1""")
def a18(t):
    return (tables.crop_l3(t.cube, (119.95, 121.55, 22.05, 24.45)).groupBy(ds("obs_date").alias("obs_date"))
            .agg(F.count("*").alias("n_rows"), cents("value").alias("total")))


@query("A2_undated_files", ["v_filename"], "select file_id from v_filename where name like '.\\_%' escape '\\'")
def a2_undated(t):
    """Names no pattern can date."""
    return t.filename.where(granule_time(F.col("name")).isNull()).select("file_id")
