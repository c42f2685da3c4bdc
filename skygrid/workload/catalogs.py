"""Granule catalog queries."""

from pyspark.sql import functions as F

from skygrid.operators import catalog
from skygrid.workload.helpers import TS, ts
from skygrid.workload.registry import query


@query("C1_search_granules", ["v_catalog"], f"""
select granule_id, name, {TS('start_time')} as start_time from v_catalog
where name like '%OFFL%' and name like '%NO2\\_\\_\\_%' escape '\\' and start_time >= timestamp '1997-03-01' and start_time < timestamp '1998-02-28 23:59:59.999'
order by v_catalog.start_time desc, granule_id limit 100""")
def c1(t):
    found = catalog.search_granules(t.catalog, "OFFL", "NO2___", "1997-03-01", "1998-02-28", limit=100)
    return found.select("granule_id", "name", ts("start_time").alias("start_time"))


@query("C1_search_any_class", ["v_catalog"], f"""
select granule_id, {TS('start_time')} as start_time from v_catalog
where name like '%CH4%' and start_time >= timestamp '1997-03-01' and start_time < timestamp '1998-02-28 23:59:59.999'""")
def c1_any(t):
    found = catalog.search_granules(t.catalog, "*", "CH4___", "1997-03-01", "1998-02-28")
    return found.select("granule_id", ts("start_time").alias("start_time"))


@query("C2_footprint_intersects", ["v_catalog"], """
select granule_id from v_catalog where lon_min <= 122 and lon_max >= 120 and lat_min <= 25 and lat_max >= 22""")
def c2(t):
    return catalog.footprint_intersects(t.catalog, (120, 122, 22, 25)).select("granule_id")


def _apart(a: str, b: str, c: str, d: str) -> str:
    """Parallelogram against box by separating axes, on three turns of the globe."""
    def on_turn(s: int) -> str:
        corners = [f"({x} + {s}, {y})" for x in (a, b) for y in (c, d)]
        tests = [f"greatest(u1, u2, u3, u4) >= {a} + {s} and least(u1, u2, u3, u4) <= {b} + {s}",
                 f"greatest(lat1, lat2, lat3, lat4) >= {c} and least(lat1, lat2, lat3, lat4) <= {d}"]
        for k in (2, 4):
            along = lambda x, y: f"((lat1 - lat{k}) * ({x}) + (u{k} - u1) * ({y}))"
            ring = ", ".join(along(f"u{n}", f"lat{n}") for n in (1, 2, 3, 4))
            box = ", ".join(along(*corner[1:-1].split(", ")) for corner in corners)
            tests.append(f"greatest({ring}) >= least({box}) and least({ring}) <= greatest({box})")
        return "(" + " and ".join(tests) + ")"
    return " or ".join(on_turn(s) for s in (-360, 0, 360))


@query("C2_footprint_outlines", ["v_footprint"], f"""
with placed as (
  select granule_id, lat1, lat2, lat3, lat4, lon1 as u1,
         {", ".join(f"lon{k} - 360 * round((lon{k} - lon1) / 360) as u{k}" for k in (2, 3, 4))}
  from v_footprint)
select granule_id, ({_apart("120", "122", "22", "25")}) as at_strait, ({_apart("178", "183", "10", "30")}) as at_dateline from placed""")
def c2_outlines(t):
    corner = lambda k: F.struct(F.col(f"lon{k}").alias("lon"), F.col(f"lat{k}").alias("lat"))
    ring = F.array(*[corner(k) for k in (1, 2, 3, 4)])
    return t.footprint.select("granule_id", catalog.ring_intersects(ring, (120, 122, 22, 25)).alias("at_strait"),
                              catalog.ring_intersects(ring, [(178, 10), (-177, 10), (-177, 30), (178, 30)]).alias("at_dateline"))


@query("C3_overlaps_period", ["v_catalog"], f"""
select granule_id, {TS('start_time')} as start_time from v_catalog where not (end_time < timestamp '1997-03-01' or start_time > timestamp '1997-06-30')""")
def c3(t):
    found = catalog.overlaps_period(t.catalog, "1997-03-01", "1997-06-30")
    return found.select("granule_id", ts("start_time").alias("start_time"))


@query("C4_latest_version", ["v_catalog"], """
select product, file_class, max(ver) as ver from v_catalog group by 1, 2""")
def c4(t):
    return catalog.latest_version(t.catalog)


@query("C5_exclude_nrt", ["v_catalog"], "select granule_id from v_catalog where name not like '%.NRT.hdf%' and link is not null")
def c5(t):
    return catalog.exclude_nrt(t.catalog).select("granule_id")


@query("C7_pending_granules", ["v_catalog", "v_ledger"], """
select granule_id, product from v_catalog where granule_id not in (select granule_id from v_ledger where status in ('ok', 'empty'))""")
def c7(t):
    return catalog.pending_granules(t.catalog, t.ledger).select("granule_id", "product")


@query("C8_run_summary", ["v_ledger"], "select status, count(*) as n from v_ledger group by 1")
def c8(t):
    return catalog.run_summary(t.ledger)


@query("C_nested_content_date", ["v_catalog"], f"""
select product, {TS('min(start_time)')} as first_start, {TS('max(end_time)')} as last_end, cast(sum(bytes) as bigint) as bytes from v_catalog group by 1""")
def c_nested(t):
    """The listing form, with the period as a nested record."""
    listing = t.catalog.select("granule_id", "product", "bytes", F.struct(F.col("start_time").alias("start"), F.col("end_time").alias("end")).alias("content_date"))
    return listing.groupBy("product").agg(ts(F.min("content_date.start")).alias("first_start"),
                                          ts(F.max("content_date.end")).alias("last_end"), F.sum("bytes").alias("bytes"))
