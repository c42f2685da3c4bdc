"""Scalar functions over whole tables."""

from pyspark.sql import functions as F

from skygrid.functions import geo, lookup
from skygrid.functions import time as tm
from skygrid.workload.helpers import DS, R6, TS, ds, r6, ts
from skygrid.workload.registry import query

YEAR_DAY = "cast(make_date(cast(substr(d, 1, 4) as int), 1, 1) as timestamp) + interval 1 day * (cast(substr(d, 5, 3) as int) - 1)"
GRANULE_TIME = f"""
case when name like 'GK2%' then strptime(regexp_extract(name, '_([0-9]{{8}}_[0-9]{{4}})_', 1), '%Y%m%d_%H%M')
     when name like 'S5P_OFFL%' then strptime(regexp_extract(name, '([0-9]{{8}}T[0-9]{{6}})', 1), '%Y%m%dT%H%M%S')
     when name like 'MYD04%' then {YEAR_DAY} + interval 5 hour + interval 5 minute
     when name like 'MCD19%' then {YEAR_DAY}
     when name like 'S5P_L3%' then strptime(regexp_extract(name, '-([0-9]{{8}})-', 1), '%Y%m%d')
     when name like 'report%' then strptime(regexp_extract(name, '([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})', 1), '%Y-%m-%d') end"""
NAMES = "names as (select *, regexp_extract(name, 'A([0-9]{7})', 1) as d from v_filename)"


@query("B1_granule_time", ["v_filename"], f"with {NAMES} select file_id, {TS(GRANULE_TIME)} as granule_time from names")
def b1(t):
    return t.filename.select("file_id", ts(tm.granule_time(F.col("name"))).alias("granule_time"))


@query("B2_to_local", ["v_field"], f"""
select variable, {TS("time_utc + interval 8 hour")} as time_local, count(*) as n from v_field group by 1, 2""")
def b2(t):
    return t.field.groupBy("variable", ts(tm.to_local(F.col("time_utc"))).alias("time_local")).agg(F.count("*").alias("n"))


@query("B3_gems_time", ["v_filename"], f"""
select file_id, {TS("case when name like 'GK2%' then strptime(regexp_extract(name, '_([0-9]{8}_[0-9]{4})_', 1), '%Y%m%d_%H%M') end")} as gems_time
from v_filename""")
def b3(t):
    return t.filename.select("file_id", ts(tm.gems_time(F.col("name"))).alias("gems_time"))


@query("B4_slice_date", ["v_filename"], f"""
select file_id,
  {DS("try_strptime(nullif(regexp_extract(name, '(20[0-9]{6})', 1), ''), '%Y%m%d')")} as slice_date,
  {DS("try_strptime(nullif(case when name like '%-20240601.nc' then regexp_extract(name, '-([0-9]{8})-', 1) else regexp_extract(name, '([0-9]{8})', 1) end, ''), '%Y%m%d')")} as l3_date
from v_filename""")
def b4(t):
    return t.filename.select("file_id", ds(tm.slice_date(F.col("name"))).alias("slice_date"),
                             ds(tm.l3_date(F.col("name"))).alias("l3_date"))


@query("B5_km_to_deg", ["v_cube"], f"""
select i, slice_no, {R6('max(slice_no / 111.32e0)')} as deg_lat,
       {R6('max(slice_no / (6371e0 * cos(radians(lat)) * 2 * 3.141592653589793e0 / 360))')} as deg_lon
from v_cube group by i, slice_no""")
def b5(t):
    km = F.col("slice_no").cast("double")
    return t.cube.groupBy("i", "slice_no").agg(r6(F.max(geo.km_to_deg_lat(km))).alias("deg_lat"),
                                               r6(F.max(geo.km_to_deg_lon(km, F.col("lat")))).alias("deg_lon"))


@query("B6_sinusoidal_to_lonlat", [], f"""
with p as (select l_orderkey, l_linenumber, cast(l_partkey % 1200 as int) as r, cast((l_suppkey * 13 + l_linenumber) % 1200 as int) as c,
                  cast(l_partkey % 36 as int) as h, cast(l_suppkey % 18 as int) as v from lineitem),
xy as (select *, -20015109.354e0 + h * (1200 * 926.625433056e0) + c * (1200 * 926.625433056e0 / 1199) as x,
                 10007554.677e0 - v * (1200 * 926.625433056e0) - r * (1200 * 926.625433056e0 / 1199) as y from p),
ll as (select *, degrees(y / 6371007.181e0) as la, degrees(x / (6371007.181e0 * cos(y / 6371007.181e0))) as lo from xy)
select l_orderkey, l_linenumber, {R6('greatest(-90e0, least(la, 90e0))')} as lat,
       case when abs(la) > 89.99 then null else {R6('greatest(-180e0, least(lo, 180e0))')} end as lon from ll""")
def b6(t):
    """Next to the poles the longitude is a quotient of two vanishing numbers and is left out."""
    lat, lon = geo.sinusoidal_to_lonlat(F.col("h"), F.col("v"), F.col("r"), F.col("c"))
    p = t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_partkey") % 1200).cast("int").alias("r"),
                          ((F.col("l_suppkey") * 13 + F.col("l_linenumber")) % 1200).cast("int").alias("c"),
                          (F.col("l_partkey") % 36).cast("int").alias("h"), (F.col("l_suppkey") % 18).cast("int").alias("v"))
    return p.withColumns({"lat": lat, "lon": lon}).select(
        "l_orderkey", "l_linenumber", r6("lat").alias("lat"), F.when(F.abs("lat") <= 89.99, r6("lon")).alias("lon"))


@query("B7_decode", ["v_pixel"], f"""
select pixel_id, {R6('case when raw <> -9999 and raw >= 0 then raw * 0.001e0 end')} as swath_value,
       {R6('case when raw - 500 <> -28672 and raw - 500 >= 0 then (raw - 500) * 0.0001e0 end')} as tile_value from v_pixel""")
def b7(t):
    return t.pixel.select("pixel_id", r6(geo.decode(F.col("raw"))).alias("swath_value"),
                          r6(geo.decode(F.col("raw") - 500, 0.0001, -28672)).alias("tile_value"))


@query("B8_tile_hv", ["v_filename"], """
select file_id, cast(coalesce(nullif(regexp_extract(name, 'h([0-9]{2})v', 1), ''), '29') as int) as h,
       cast(coalesce(nullif(regexp_extract(name, 'h[0-9]{2}v([0-9]{2})', 1), ''), '6') as int) as v from v_filename""")
def b8(t):
    h, v = geo.tile_hv(F.col("name"))
    return t.filename.select("file_id", h.alias("h"), v.alias("v"))


@query("B9_normalize_range", ["v_catalog"], f"""
with p as (select granule_id, end_time as a, case when start_time = date_trunc('day', start_time)
             then start_time + interval '23 hours 59 minutes 59 seconds' else start_time end as b from v_catalog),
q as (select granule_id, least(a, timestamp '2000-01-01') as a, least(b, timestamp '2000-01-01') as b from p)
select granule_id, {TS('least(a, b)')} as range_start, {TS('greatest(a, b)')} as range_end from q""")
def b9(t):
    """Ranges given the wrong way round, with bare end dates, some of them past the clock."""
    lo, hi = tm.normalize_range(F.col("end_time"), F.col("start_time"), F.lit("2000-01-01").cast("timestamp"))
    return t.catalog.select("granule_id", ts(lo).alias("range_start"), ts(hi).alias("range_end"))


@query("B10_local_day_window", ["v_field"], f"""
select variable, {TS("time_utc + interval 8 hour")} as time_local, count(value) as n_valid from v_field
where cast(time_utc + interval 8 hour as date) between date '2024-01-02' and date '2024-01-20' group by 1, 2""")
def b10(t):
    kept = t.field.where(tm.local_day_window(F.col("time_utc"), "2024-01-02", "2024-01-20"))
    return kept.groupBy("variable", ts(tm.to_local(F.col("time_utc"))).alias("time_local")).agg(F.count("value").alias("n_valid"))


@query("B11_half_year_period", ["v_catalog"], """
select case when month(start_time) <= 6 then concat(year(start_time)::varchar, '0101-', year(start_time)::varchar, '0630')
            else concat(year(start_time)::varchar, '0701-', year(start_time)::varchar, '1231') end as period, count(*) as n
from v_catalog group by 1""")
def b11(t):
    return t.catalog.groupBy(tm.half_year_period(F.col("start_time"))[2].alias("period")).agg(F.count("*").alias("n"))


@query("B12_product_code", ["v_catalog"], """
select product, file_class,
  case product when 'NO2___' then 'no2-tropospheric' when 'O3____' then 'o3' when 'CH4___' then 'ch4' end as l3_id,
  case product when 'NO2___' then 'NO2' when 'O3____' then 'O3T' end as gems_code,
  case file_class when 'NRTI' then 'sentinel5p' else 'modis' end as hub, count(*) as n from v_catalog group by all""")
def b12(t):
    short = F.regexp_replace("product", "_+$", "")
    named = t.catalog.withColumns({
        "l3_id": lookup.l3_product_id(F.col("product")), "gems_code": lookup.gems_code(short),
        "hub": lookup.hub_column(F.when(F.col("file_class") == "NRTI", "S5-P").otherwise("MODIS"))})
    return named.groupBy("product", "file_class", "l3_id", "gems_code", "hub").agg(F.count("*").alias("n"))


@query("B13_product_info", ["v_catalog"], """
select product, case product when 'NO2___' then 'nitrogendioxide_tropospheric_column' when 'O3____' then 'ozone_total_vertical_column'
         else 'methane_mixing_ratio' end as dataset_name,
  5.5e0 as res_x_km, case product when 'CH4___' then 7e0 else 3.5e0 end as res_y_km, 'gas_or_ozone' as kind,
  true as product_ok, true as class_ok, false as level_ok, count(*) as n from v_catalog group by product""")
def b13(t):
    checks = lookup.validate_inputs(F.col("product"), F.lit("L9__"), F.col("file_class"))
    rx, ry = lookup.resolution_columns(F.col("product"))
    info = lookup.with_product_info(t.catalog.drop("name")).withColumns({"ok": checks, "rx": rx, "ry": ry})
    kind = F.when(lookup.product_group(F.col("product")).isin("gas", "ozone"), "gas_or_ozone")
    return info.groupBy("product", "dataset_name", F.col("rx").alias("res_x_km"), F.col("ry").alias("res_y_km"),
                        kind.alias("kind"), F.col("ok.product_type").alias("product_ok"),
                        F.col("ok.product_class").alias("class_ok"), F.col("ok.product_level").alias("level_ok")
                        ).agg(F.count("*").alias("n"))


@query("B14_cell_weight", ["v_cube"], f"""
select {DS('obs_date')} as obs_date, cast(count(*) as double) as by_count, {R6('sum(cos(radians(lat)))')} as by_area
from v_cube group by 1""")
def b14(t):
    return t.cube.groupBy(ds("obs_date").alias("obs_date")).agg(
        F.sum(geo.cell_weight(F.col("lat"), "count")).alias("by_count"),
        r6(F.sum(geo.cell_weight(F.col("lat"), "area"))).alias("by_area"))


@query("B15_bucket_label", ["v_pixel"], """
select strftime(obs_time, '%Y-%m-%d') as day, strftime(obs_time, '%Y-%m') as month, strftime(obs_time, '%Y') as year,
       min(strftime(obs_time, '%Y-%m-%d %H:%M')) as first_file, count(*) as n from v_pixel group by 1, 2, 3""")
def b15(t):
    c = F.col("obs_time")
    return t.pixel.groupBy(tm.bucket_label(c, "daily").alias("day"), tm.bucket_label(c, "monthly").alias("month"),
                           tm.bucket_label(c, "yearly").alias("year")).agg(
        F.min(tm.bucket_label(c, "per_file")).alias("first_file"), F.count("*").alias("n"))


@query("B16_deg_distance", ["v_pixel"], f"""
select pixel_id, {R6('sqrt((lat - 24) * (lat - 24) + (lon - 121) * (lon - 121))')} as plain,
  {R6('sqrt((lat - 24) * (lat - 24) + pow((lon - 121) * cos(radians(24e0)), 2))')} as scaled from v_pixel""")
def b16(t):
    lat, lon, c = F.col("lat"), F.col("lon"), (F.lit(24.0), F.lit(121.0))
    return t.pixel.select("pixel_id", r6(geo.deg_distance(lat, lon, *c)).alias("plain"),
                          r6(geo.deg_distance(lat, lon, *c, F.cos(F.radians(F.lit(24.0))))).alias("scaled"))


@query("B17_var_abbr", ["v_field"], """
select case variable when 'boundary_layer_height' then 'blh' when '2m_temperature' then 't2m' when 'temperature' then 't' end as abbr,
       'clo' as other, count(*) as n from v_field group by 1""")
def b17(t):
    return t.field.groupBy(lookup.variable_abbreviation(F.col("variable")).alias("abbr"),
                           lookup.variable_abbreviation(F.lit("Cloud_cover")).alias("other")).agg(F.count("*").alias("n"))


@query("B18_readable_size", ["v_inventory"], """
with s as (select path, length, length * length as big from v_inventory)
select path, case when length < 1024 then concat(length::varchar, ' B') else printf('%.2f KB', length / 1024e0) end as size,
  case when big < 1024 then concat(big::varchar, ' B') when big < 1048576 then printf('%.2f KB', big / 1024e0)
       when big < 1073741824 then printf('%.2f MB', big / 1048576e0) else printf('%.2f GB', big / 1073741824e0) end as big_size from s""")
def b18(t):
    return t.inventory.select("path", geo.readable_size(F.col("length")).alias("size"),
                              geo.readable_size(F.col("length") * F.col("length")).alias("big_size"))
