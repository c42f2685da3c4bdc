"""Grids kept beside cubes: slices of two grids, refusals by the data, monthly outputs, coverage out of one stream."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from swaths import swath

from skygrid.operators import accumulate, coverage, merge
from skygrid.plans.grid import GridSpec
from skygrid.sources import grids, tables
from skygrid.streaming import ingest

FINE, COARSE = GridSpec(21.0, 0.25, 8, 119.0, 0.25, 10), GridSpec(21.0, 0.5, 4, 119.0, 0.5, 5)
BOX = (119.0, 120.0, 21.0, 22.0)


def _slice(spark, grid, name, time, cells, gid=None):
    rows = [(name, time, i, j, float(grid.lats()[i]), float(grid.lons()[j]), 1.0, gid or grids.grid_id(grid)) for i, j in cells]
    return spark.createDataFrame(rows, "slice_id string, time timestamp, i int, j int, lat double, lon double, value double, grid_id string")


def test_registry_round_trip(spark, tmp_path):
    path = str(tmp_path / "grids")
    assert grids.read_grids(spark, path) == {}
    crop = FINE.crop(BOX)
    for g in (FINE, COARSE, crop, FINE):
        grids.register_grid(spark, path, g)
    found = grids.read_grids(spark, path)
    assert len(found) == 3 and found[grids.grid_id(FINE)] == FINE and found[grids.grid_id(crop)] == crop
    assert grids.grid_id(GridSpec(21.0, 0.25, 8, 119.0, 0.25, 9)) != grids.grid_id(FINE)


def test_each_slice_by_its_own_grid(spark):
    registered = {grids.grid_id(g): g for g in (FINE, COARSE)}
    t0 = datetime(2024, 5, 1)
    cube = _slice(spark, FINE, "a", t0, [(0, 0), (0, 1), (0, 1), (7, 9)]).union(_slice(spark, COARSE, "b", t0 + timedelta(hours=1), [(0, 0), (3, 4)]))
    got = {r.time[-5:]: (r.valid, r.total, r.coverage) for r in coverage.coverage_by_grid(cube, registered, region=BOX).collect()}
    assert got == {"00:00": (2.0, 25.0, 0.08), "01:00": (1.0, 9.0, 0.11111)}
    for granularity in ("daily", "monthly", "yearly"):
        with pytest.raises(ValueError, match="mixes grids"):
            coverage.coverage_by_grid(cube, registered, region=BOX, granularity=granularity)
    one = coverage.coverage_by_grid(cube.where("slice_id = 'b'"), registered, region=BOX, granularity="daily").collect()
    assert [(r.valid, r.total) for r in one] == [(1.0, 9.0)]
    for stray in ("other", None):
        with pytest.raises(ValueError, match="not registered"):
            coverage.coverage_by_grid(cube.withColumn("grid_id", F.lit(stray).cast("string")), registered, region=BOX)
    assert coverage.coverage_by_grid(cube.where("false"), registered, region=BOX).collect() == []


def test_merge_looks_at_the_data(spark):
    t0 = datetime(2024, 5, 1)
    a, b = _slice(spark, FINE, "a", t0, [(0, 0)]), _slice(spark, COARSE, "b", t0 + timedelta(days=3), [(0, 0), (1, 1)])
    span = dict(hub="h", product="p")
    with pytest.raises(ValueError, match="different grids"):
        merge.merge_cubes([a, b], "2024-05-01", "2024-05-09", **span)
    # The other cube has no row in the span.
    assert merge.merge_cubes([a, b], "2024-05-01", "2024-05-02", **span).count() == 1
    # Rows without names, told by their positions.
    bare = [x.drop("grid_id") for x in (a, b)]
    with pytest.raises(Exception, match="mixes grids"):
        merge.merge_cubes(bare, "2024-05-01", "2024-05-09", grids=[FINE, FINE], **span).collect()
    assert merge.merge_cubes(bare[:1], "2024-05-01", "2024-05-09", grids=[FINE], **span).count() == 1


def test_monthly_outputs(spark, tmp_path):
    path = str(tmp_path / "cube")
    px = swath(spark, granule=1).unionByName(swath(spark, granule=2, value=lambda la, lo: 3.0))
    px = px.withColumn("obs_time", F.when(F.col("granule_id") == 2, F.lit(datetime(2024, 2, 10))).otherwise(F.col("obs_time")))
    accumulate.monthly_cubes(px, FINE, path, hub="h", product="p", level="L3", units="u")
    cube = tables.scan_cube(spark, path, "p")
    assert {(r.yyyy, r.mm) for r in cube.select("yyyy", "mm").distinct().collect()} == {("2024", "01"), ("2024", "02")}
    want = {(r.obs_date, r.i, r.j, r.value) for r in accumulate.daily_cube(px, FINE).collect()}
    assert {(r.time.date(), r.i, r.j, r.value) for r in cube.collect()} == want and want
    # The grid is kept beside the cube and does not show up in it.
    registered = grids.read_grids(spark, grids.grids_path(path))
    assert registered == {grids.grid_id(FINE): FINE} and grids.grids_in(cube, registered) == set(registered)
    # One month is written again, with less; the other stays.
    accumulate.monthly_cubes(px.where("granule_id = 2 and row_idx < 5"), FINE, path, hub="h", product="p", level="L3")
    by_month = {r.mm: r["count"] for r in tables.scan_cube(spark, path, "p").groupBy("mm").count().collect()}
    assert by_month["01"] == len([w for w in want if w[0].month == 1]) and 0 < by_month["02"] < len([w for w in want if w[0].month == 2])


def _arrivals(spark, path, days=9):
    parts = []
    for d in range(days):
        px = swath(spark, granule=1 + d % 3, value=lambda la, lo: 1.0, lat0=21.03 + 0.1 * d, holes={(r, c) for r in range(8) for c in range(7) if (r + c + d) % 3 == 0})
        px = px.withColumns({"granule_id": F.lit(100 + d).cast("long"), "obs_time": F.lit(datetime(2024, 3, 1) + timedelta(days=d // 2, hours=d)),
                             "value": F.when(F.lit(d == 4), F.lit(None)).otherwise(F.col("value"))})
        px.coalesce(1).write.mode("append").parquet(path)
        parts.append(px)
    return parts[0].schema


@pytest.mark.parametrize("weight", ["count", "area"])
@pytest.mark.parametrize("zone", [False, True])
def test_stream_equals_batch_on_closed_days(spark, tmp_path, weight, zone):
    schema = _arrivals(spark, str(tmp_path / "in"))
    region, vertices = BOX, None
    if zone:
        ring = [(119.1, 21.1), (121.1, 21.1), (120.3, 22.6), (119.1, 21.1)]
        region, vertices = "z", spark.createDataFrame([("z", "A", 0, k, x, y) for k, (x, y) in enumerate(ring)],
                                                      "zone string, county string, ring int, seq int, lon double, lat double")
    for _ in range(2):  # The second run finds nothing new and adds nothing.
        stream = ingest.read_stream(spark, str(tmp_path / "in"), schema, 2)
        days = ingest.stream_coverage(stream, FINE, region, weight, vertices, delay="1 hour")
        ingest.write_closed_days(days, str(tmp_path / "days"), str(tmp_path / "cp")).awaitTermination()
    got = {str(r.obs_date): (round(r.valid, 3), round(r.total, 3), r.coverage, r.n_slices) for r in spark.read.parquet(str(tmp_path / "days")).collect()}
    cube = FINE.with_cell(spark.read.schema(schema).parquet(str(tmp_path / "in"))).select(
        F.col("granule_id").alias("slice_id"), F.date_trunc("day", "obs_time").alias("time"), "i", "j", "value")
    batch = coverage.compute_coverage(cube, FINE, region=region, weight=weight, vertices=vertices).collect()
    last = "2024-03-05"
    want = {r.time: (r.valid, r.total, r.coverage, r.n_slices) for r in batch if r.time < last}
    assert got.keys() == want.keys() and len(got) >= 3
    for k in got:
        assert got[k] == pytest.approx(want[k], abs=2e-3)
