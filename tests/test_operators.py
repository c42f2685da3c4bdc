from datetime import datetime

import pytest
from pyspark.sql import functions as F
from swaths import swath

from skygrid.operators import catalog, coverage, merge, qc, region, reports, stations
from skygrid.plans.dimension import BROADCAST_ROWS, hint_if_bounded
from skygrid.plans.grid import GridSpec
from skygrid.workload.fixtures import CUBE_GRID, Tables

GRID = GridSpec(22.0, 0.5, 5, 120.0, 0.5, 5)


def cube(spark, rows):
    return spark.createDataFrame([(s, datetime.fromisoformat(t), i, j, v) for s, t, i, j, v in rows],
                                 "slice_id string, time timestamp, i int, j int, value double")


SLICES = [
    ("a", "2024-01-01 01:00:00", 0, 0, 1.0), ("a", "2024-01-01 01:00:00", 0, 1, float("nan")),
    ("b", "2024-01-01 05:00:00", 0, 0, 2.0), ("b", "2024-01-01 05:00:00", 4, 4, 2.0),
    ("c", "2024-01-02 05:00:00", 1, 1, None), ("d", "2024-02-01 00:00:00", 1, 1, 3.0)]
BOX = (120.0, 121.0, 22.0, 23.0)


def run(spark, **kw):
    return coverage.compute_coverage(cube(spark, SLICES), GRID, region=BOX, **kw).orderBy("time").collect()


def test_daily_union_and_empty_days(spark):
    rows = [(r.time, r.valid, r.total, r.coverage, r.n_slices) for r in run(spark)]
    assert rows == [("2024-01-01", 1.0, 9.0, 0.11111, 2), ("2024-01-02", 0.0, 9.0, 0.0, 1), ("2024-02-01", 1.0, 9.0, 0.11111, 1)]


def test_monthly_averages_rounded_days(spark):
    rows = [(r.time, r.valid, r.coverage, r.n_slices) for r in run(spark, granularity="monthly")]
    assert rows == [("2024-01", 0.5, round(0.11111 / 2, 5), 3), ("2024-02", 1.0, 0.11111, 1)]


def test_per_file_never_exceeds_daily(spark):
    files = run(spark, granularity="per_file")
    assert [r.time for r in files] == ["2024-01-01 01:00", "2024-01-01 05:00", "2024-01-02 05:00", "2024-02-01 00:00"]
    daily = {r.time: r.coverage for r in run(spark)}
    assert all(0 <= r.coverage <= daily[r.time[:10]] <= 1 for r in files)


def test_end_date_covers_its_day(spark):
    assert [r.time for r in run(spark, start="2024-01-01", end="2024-01-02")] == ["2024-01-01", "2024-01-02"]


def test_bad_arguments(spark):
    for kw in ({"granularity": "hourly"}, {"weight": "volume"}):
        with pytest.raises(ValueError):
            run(spark, **kw)
    with pytest.raises(ValueError):
        coverage.compute_coverage(cube(spark, SLICES), GRID, region="atlantis")


def test_region_without_cells_gives_null_share(spark):
    out = coverage.compute_coverage(cube(spark, SLICES), GRID, region=(0.0, 1.0, 0.0, 1.0)).collect()
    assert {(r.total, r.coverage) for r in out} == {(0.0, None)}


def test_mixed_grids_are_refused(spark):
    good = GRID.with_coordinates(cube(spark, SLICES))
    coverage.assert_single_grid(good, GRID)
    with pytest.raises(ValueError):
        coverage.assert_single_grid(good.withColumn("lat", F.col("lat") + 0.1), GRID)
    with pytest.raises(ValueError):
        merge.merge_cubes([good, good], "2024-01-01", "2024-01-02", hub="h", product="p", grids=[GRID, CUBE_GRID])


def test_zone_mask_with_hole_and_union(spark):
    square = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
    hole = [(1.2, 1.2), (2.8, 1.2), (2.8, 2.8), (1.2, 2.8), (1.2, 1.2)]
    rows = [("z", "A", 0, k, x - 0.3, y - 0.3) for k, (x, y) in enumerate(square)]
    rows += [("z", "A", 1, k, x, y) for k, (x, y) in enumerate(hole)]
    rows += [("z", "B", 0, k, x + 3.3, y - 0.3) for k, (x, y) in enumerate(square)]
    v = spark.createDataFrame(rows, "zone string, county string, ring int, seq int, lon double, lat double")
    grid = GridSpec(0.0, 1.0, 6, 0.0, 1.0, 9)
    got = {(r.i, r.j) for r in region.zone_mask(v, grid).collect()}
    want = {(i, j) for i in range(4) for j in range(4) if (i, j) != (2, 2)} | {(i, j) for i in range(4) for j in range(4, 8)}
    assert got == want


def test_station_3x3_at_the_border(spark):
    places = spark.createDataFrame([("x", 22.0, 120.0)], "station string, lat double, lon double")
    c = cube(spark, [("a", "2024-01-01 01:00:00", 0, 0, 3.0), ("b", "2024-01-02 01:00:00", 1, 1, 5.0),
                     ("b", "2024-01-02 01:00:00", 0, 0, 7.0), ("c", "2024-01-03 01:00:00", 4, 4, 9.0)])
    rows = stations.extract_3x3(c, places, GRID).orderBy("time").collect()
    assert [(r.grid_4, r.grid_8, r.grid_0, r["mean"], r["std"]) for r in rows] == [
        (3.0, None, None, 3.0, 0.0), (7.0, 5.0, None, 6.0, 1.0), (None, None, None, None, None)]
    out = stations.analyze_3x3(stations.extract_3x3(c, places, GRID)).orderBy("time").collect()
    assert [r.valid_points for r in out] == [1, 2, 0] and out[1].matrix[2][2] == 5.0 and out[1].center_value == 7.0


def test_far_station_is_flagged(spark):
    places = spark.createDataFrame([("in", 22.05, 120.0), ("out", 30.0, 120.0)], "station string, lat double, lon double")
    assert {r.station: r.far for r in stations.nearest_cell(places, GRID).collect()} == {"in": False, "out": True}


def test_slots_end_inclusive_and_limit(spark):
    keys = spark.createDataFrame([("v",)], "variable string")
    a, b = F.lit("2024-01-01 00:00:00").cast("timestamp"), F.lit("2024-01-01 01:00:00").cast("timestamp")
    assert stations.expected_slots(keys, a, b, 10).count() == 7
    assert stations.expected_slots(keys, a, b, 10, limit=3).count() == 3


def test_filters_skip_missing_columns(spark):
    bare = swath(spark).drop("qa")
    assert qc.qa_filter(bare).count() == qc.flag_filter(bare).count() == qc.cloud_filter(bare, 0.1).count() == bare.count()
    nulls = swath(spark).withColumn("qa", F.lit(None).cast("double"))
    assert qc.qa_filter(nulls).count() == 0


def test_min_points_counts_after_filters(spark):
    two = swath(spark, 3, 3, granule=1).union(swath(spark, 4, 4, granule=2))
    assert {r.granule_id for r in qc.min_points(two).collect()} == {2}


def test_search_order_limit_and_wildcard(spark):
    rows = [(k, f"S5P_{c}_NO2___{k}", datetime(2024, 1, d)) for k, (c, d) in enumerate([("OFFL", 1), ("NRTI", 2), ("OFFL", 3), ("OFFL", 9)])]
    df = spark.createDataFrame(rows, "granule_id long, name string, start_time timestamp")
    assert [r.granule_id for r in catalog.search_granules(df, "OFFL", "NO2", "2024-01-01", "2024-01-03", 1).collect()] == [2]
    assert [r.granule_id for r in catalog.search_granules(df, "*", "*", "2024-01-01", "2024-01-03").collect()] == [2, 1, 0]


def test_pending_retries_errors(spark):
    cat = spark.range(4).withColumnRenamed("id", "granule_id")
    led = spark.createDataFrame([(0, "ok"), (1, "empty"), (2, "error")], "granule_id long, status string")
    assert {r.granule_id for r in catalog.pending_granules(cat, led).collect()} == {2, 3}


def test_default_version(spark):
    df = spark.createDataFrame([("NO2", "L2", None), ("O3T", "L2", "v2.0"), ("O3T", "L2", "v10.0")], "product string, file_class string, ver string")
    assert {r.product: r.ver for r in catalog.latest_version(df).collect()} == {"NO2": "v4.0.1", "O3T": "v2.0"}


def test_freshness_at_exactly_a_week(spark):
    made = spark.createDataFrame([("a", datetime(2024, 1, 1)), ("b", datetime(2024, 1, 1, 0, 0, 1))], "period string, modified timestamp")
    want = spark.createDataFrame([("a",), ("b",), ("c",)], "period string")
    out = {r.period: r.refresh for r in reports.freshness_check(made, want, "2024-01-08").collect()}
    assert out == {"a": True, "b": False, "c": True}


def test_broadcast_only_below_the_bound(spark):
    big, small = hint_if_bounded(spark.range(5), BROADCAST_ROWS + 1), hint_if_bounded(spark.range(5), 5)
    assert "broadcast" not in big._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" in small._jdf.queryExecution().logical().toString().lower()


# -- plans -------------------------------------------------------------------------

def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_box_and_columns_reach_the_scan(spark, tmp_path, sf_dir):
    path = str(tmp_path / "px")
    Tables(spark, sf_dir).pixel.write.parquet(path)
    p = plan(qc.bbox_filter(qc.qa_filter(spark.read.parquet(path)), BOX).select("value"))
    pushed = p[p.index("PushedFilters"):p.index("ReadSchema")]
    assert "lat" in pushed and "lon" in pushed and "qa" in pushed
    schema = p[p.index("ReadSchema"):]
    assert "cloud" not in schema and "flag" not in schema


def test_coverage_box_is_an_index_range_in_the_scan(spark, tmp_path):
    path = str(tmp_path / "cube")
    cube(spark, SLICES).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    p = plan(coverage.compute_coverage(spark.read.parquet(path), GRID, region=BOX))
    assert "LessThanOrEqual(i,2)" in p and "GreaterThanOrEqual(j,0)" in p


def test_rows_of_another_grid_are_refused(spark):
    own = cube(spark, SLICES).withColumns({"lat": GRID.lat_of(F.col("i")), "lon": GRID.lon_of(F.col("j"))})
    assert coverage.compute_coverage(own, GRID, region=BOX).count() == 3
    stray = own.withColumn("lat", F.when(F.col("slice_id") == "d", 30.0).otherwise(F.col("lat")))
    for granularity in ("daily", "per_file"):
        with pytest.raises(Exception, match="mixes grids"):
            coverage.compute_coverage(stray, GRID, region=BOX, granularity=granularity).collect()


def test_no_query_pairs_everything_or_leaves_the_jvm(spark, sf_dir):
    from skygrid.workload import QUERIES

    for name, fn in QUERIES.items():
        if name.startswith("X"):
            continue
        text = plan(fn(spark, sf_dir))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"):
            assert bad not in text, (name, bad)
