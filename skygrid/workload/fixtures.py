"""Observation tables derived from the given tables.

One portable statement per table, run by Spark here and prefixed to the check SQL,
so both sides start from the same rows. Every statement reads its whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skygrid.plans.grid import GridSpec
from skygrid.session import configure

# Bins: the edges avoid the pixel lattice, so no point sits on an edge.
BIN_GRID = GridSpec(20.8763171, 0.25, 21, 118.8809113, 0.25, 17)
# Cube: 0.1 degree, 51 x 41 cells.
CUBE_GRID = GridSpec(21.0, 0.1, 51, 119.0, 0.1, 41)
# Fields: whole degrees, 5 x 5 cells.
FIELD_GRID = GridSpec(22.0, 1.0, 5, 119.0, 1.0, 5)

SQL = {
    "v_pixel": ("events", """
select event_id as pixel_id,
       cast(floor(event_id / 100) as bigint) as granule_id,
       cast(floor((event_id % 100) / 10) as int) as row_idx,
       cast(event_id % 10 as int) as col_idx,
       cast(ts as timestamp) as obs_time,
       cast(21.0 as double) + cast(0.5 as double) * floor((event_id % 100) / 10)
         + cast(0.02 as double) * (event_id % 10)
         + cast(0.05 as double) * (floor(event_id / 100) % 7) as lat,
       cast(119.0 as double) + cast(0.4 as double) * (event_id % 10)
         - cast(0.03 as double) * floor((event_id % 100) / 10)
         + cast(0.05 as double) * (floor(event_id / 100) % 5) as lon,
       case when event_id % 13 = 0 then cast(null as double) else value end as value,
       cast(case when event_id % 19 = 0 then -9999 else floor(value * 10) end as int) as raw,
       cast(event_id % 11 as double) / 10 as qa,
       cast(event_id % 17 as double) / 16 as cloud,
       cast(case when event_id % 9 = 0 then 1 else 0 end as int) as flag
from {events}"""),
    "v_cube": ("lineitem", """
select cast(l_shipdate as date) as obs_date,
       cast(l_linenumber as int) as slice_no,
       cast(l_partkey % 51 as int) as i,
       cast(l_suppkey % 41 as int) as j,
       cast(21.0 as double) + cast(0.1 as double) * cast(l_partkey % 51 as double) as lat,
       cast(119.0 as double) + cast(0.1 as double) * cast(l_suppkey % 41 as double) as lon,
       max(case when l_discount = 0 then cast(null as double) else l_extendedprice end) as value
from {lineitem}
group by cast(l_shipdate as date), cast(l_linenumber as int), cast(l_partkey % 51 as int), cast(l_suppkey % 41 as int),
         cast(21.0 as double) + cast(0.1 as double) * cast(l_partkey % 51 as double),
         cast(119.0 as double) + cast(0.1 as double) * cast(l_suppkey % 41 as double)"""),
    "v_field": ("events", """
select case cast(floor(event_id / 25) as bigint) % 4 when 0 then 'boundary_layer_height' when 1 then '2m_temperature'
            else 'temperature' end as variable,
       case cast(floor(event_id / 25) as bigint) % 4 when 2 then 850 when 3 then 500 else null end as level,
       timestamp '2024-01-01 00:00:00' + interval '1' hour * cast(floor(event_id / 100) as int) as time_utc,
       cast(floor((event_id % 25) / 5) as int) as i,
       cast(event_id % 5 as int) as j,
       cast(22.0 as double) + floor((event_id % 25) / 5) as lat,
       cast(119.0 as double) + (event_id % 5) as lon,
       case when event_id % 17 = 0 then cast(null as double) else value end as value
from {events}"""),
    "v_catalog": ("orders", """
select o_orderkey as granule_id,
       case when o_orderstatus = 'F' then 'NO2___' when o_orderstatus = 'O' then 'O3____' else 'CH4___' end as product,
       case when o_orderkey % 5 = 0 then 'NRTI' else 'OFFL' end as file_class,
       concat('S5P_', case when o_orderkey % 5 = 0 then 'NRTI' else 'OFFL' end, '_L2__',
              case when o_orderstatus = 'F' then 'NO2___' when o_orderstatus = 'O' then 'O3____' else 'CH4___' end,
              '_', cast(o_orderkey as string), case when o_orderkey % 23 = 0 then '.NRT.hdf' else '.hdf' end) as name,
       case when o_orderkey % 29 = 0 then null else concat('item/', cast(o_orderkey as string)) end as link,
       concat('v', cast(o_custkey % 3 + 1 as string), '.0.', cast(o_orderkey % 4 as string)) as ver,
       cast(o_orderdate as timestamp) as start_time,
       cast(o_orderdate as timestamp) + interval '1' day * cast(o_orderkey % 5 as int) as end_time,
       cast(floor(o_totalprice) as bigint) as bytes,
       cast(100 + o_custkey % 40 as double) as lon_min,
       cast(100 + o_custkey % 40 + 5 as double) as lon_max,
       cast(o_orderkey % 45 as double) as lat_min,
       cast(o_orderkey % 45 + 5 as double) as lat_max
from {orders}"""),
    "v_footprint": ("orders", """
select granule_id,
       case when x > 180 then x - 360 else x end as lon1, y as lat1,
       case when x + 2 > 180 then x + 2 - 360 else x + 2 end as lon2, y + cast(0.5 as double) as lat2,
       case when x + 5 > 180 then x + 5 - 360 else x + 5 end as lon3, y + cast(5.5 as double) as lat3,
       case when x + 3 > 180 then x + 3 - 360 else x + 3 end as lon4, y + cast(5 as double) as lat4
from (select o_orderkey as granule_id,
             cast(100 + o_custkey % 40 + case when o_orderkey % 3 = 0 then 55 else 0 end as double) as x,
             cast(o_orderkey % 45 as double) as y
      from {orders}) as placed"""),
    "v_filename": ("orders", """
select o_orderkey as file_id,
       case o_orderkey % 7
         when 0 then concat('GK2_GEMS_L2_', replace(cast(cast(o_orderdate as date) as string), '-', ''), '_0345_NO2_FW_DPRO_ORI.nc')
         when 1 then concat('S5P_OFFL_L2__NO2____', replace(cast(cast(o_orderdate as date) as string), '-', ''), 'T045523_x.nc')
         when 2 then concat('MYD04_L2.A', cast(year(o_orderdate) as string), lpad(cast(dayofyear(o_orderdate) as string), 3, '0'), '.0505.061.2025001180158.hdf')
         when 3 then concat('MCD19A2.A', cast(year(o_orderdate) as string), lpad(cast(dayofyear(o_orderdate) as string), 3, '0'), '.h2', cast(o_orderkey % 10 as string), 'v06.061.2025003055754.hdf')
         when 4 then concat('report-', cast(cast(o_orderdate as date) as string), '.csv')
         when 5 then concat('S5P_L3_NO2-', replace(cast(cast(o_orderdate as date) as string), '-', ''), '-20240601.nc')
         else concat('._undated_', cast(o_orderkey % 1000 as string), '.nc') end as name
from {orders}"""),
    "v_ledger": ("orders", """
select o_orderkey as granule_id,
       case when o_orderpriority = '1-URGENT' then 'pending' when o_orderkey % 7 = 0 then 'empty'
            when o_orderkey % 11 = 0 then 'error' else 'ok' end as status
from {orders}"""),
    "v_inventory": ("lineitem", """
select concat('/data/', lower(l_returnflag), '/', cast(l_orderkey as string), '_', cast(l_linenumber as string),
              case when l_linestatus = 'F' then '.nc' else '.png' end) as path,
       l_returnflag as top_dir,
       cast(l_shipdate as timestamp) as modified,
       cast(l_quantity * 1000 as bigint) as length
from {lineitem}"""),
    "v_place": ("supplier", """
select s_suppkey as place_id, s_name as name,
       cast(21.5003 as double) + cast(0.001 as double) * (s_suppkey * 37 % 4000) as lat,
       cast(119.5003 as double) + cast(0.001 as double) * (s_suppkey * 53 % 2500) as lon,
       case when s_nationkey % 3 = 0 then 'power' else 'environment' end as owner,
       case when s_acctbal < 0 then 'background' else 'general' end as site_type,
       cast(s_nationkey as int) as county_no
from {supplier}"""),
    "v_station": (None, """
select station, cast(lat as double) as lat, cast(lon as double) as lon
from (values ('FS', 22.6294, 120.3461), ('NZ', 22.7422, 120.3339), ('TH', 24.1817, 120.5956), ('TP', 25.0330, 121.5654)) as t(station, lat, lon)"""),
    "v_zone_vertex": (None, """
select zone, county, 0 as ring, seq, cast(lon as double) as lon, cast(lat as double) as lat
from (values
  ('west', 'A', 0, 120.05, 23.05), ('west', 'A', 1, 121.05, 23.05), ('west', 'A', 2, 121.05, 24.05), ('west', 'A', 3, 120.05, 24.05), ('west', 'A', 4, 120.05, 23.05),
  ('west', 'B', 0, 120.05, 24.05), ('west', 'B', 1, 121.35, 24.05), ('west', 'B', 2, 120.55, 24.45), ('west', 'B', 3, 121.35, 25.05), ('west', 'B', 4, 120.05, 25.05), ('west', 'B', 5, 120.05, 24.05)
) as t(zone, county, seq, lon, lat)"""),
}

GIVEN = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
         "embeddings", "pages", "benchmark", "labels", "conversations")


class Tables:
    """The derived tables of one data folder, and the given ones by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    def given(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        source, text = SQL[name]
        return self.spark.sql(text) if source is None else self.spark.sql(text, **{source: self.given(source)})

    def __getattr__(self, name: str) -> DataFrame:
        """``t.pixel`` is the table ``v_pixel``."""
        if f"v_{name}" in SQL:
            return self.view(f"v_{name}")
        if name in GIVEN:
            return self.given(name)
        raise AttributeError(name)

    def cube_slices(self) -> DataFrame:
        """The cube with a slice key and a time of day per slice."""
        from pyspark.sql import functions as F

        return self.cube.withColumns({
            "time": F.col("obs_date").cast("timestamp") + F.make_dt_interval(hours=F.col("slice_no")),
            "slice_id": F.concat_ws("-", F.col("obs_date").cast("string"), F.col("slice_no").cast("string"))})


def check_ctes(names) -> str:
    """The statements of the named tables as a WITH list for the check engine."""
    parts = []
    for name in names:
        source, text = SQL[name]
        parts.append(f"{name} as ({text.format(**{source: source}) if source else text})")
    return ",\n".join(parts)
