from datetime import datetime

import pytest
from pyspark.sql import functions as F
from swaths import swath

from skygrid.operators import regrid
from skygrid.plans.grid import GridSpec
from skygrid.sources import swath as sw
from skygrid.sources import tables
from skygrid.streaming import ingest

GRID = GridSpec(20.8763171, 0.25, 12, 118.8809113, 0.25, 10)


def layout(spark):
    rows = [(datetime(2024, m, d), i, 0, 22.0 + i, 120.0, float(m)) for m in (1, 2, 3) for d in (1, 15) for i in range(3)]
    df = spark.createDataFrame(rows, "time timestamp, i int, j int, lat double, lon double, value double")
    return tables.cube_layout(df, hub="gems", product="NO2", region="taiwan", units="u", method="kdtree")


def test_scan_prunes_months_and_survives_bad_files(spark, tmp_path):
    path = str(tmp_path / "cube")
    tables.write_cube(layout(spark), path)
    month = tmp_path / "cube/hub=gems/level=L2/region=taiwan/product=NO2/yyyy=2024/mm=02"
    (month / "broken.parquet").write_bytes(b"not a parquet file at all")
    (month / "._sidecar.parquet").write_bytes(b"x")
    with pytest.raises(Exception):
        tables.scan_cube(spark, path, "NO2", "2024-02-10", "2024-03-31").count()
    got = tables.scan_cube(spark, path, "NO2", "2024-02-10", "2024-03-31", skip_damaged=True)
    assert [r.path.split("/")[-1] for r in tables.unread_files(spark, path).collect()] == ["broken.parquet"]
    assert tables.scan_cube(spark, path, "NO2", region="east_asia", skip_damaged=True).count() == 0
    assert {(r.yyyy, r.mm) for r in got.select("yyyy", "mm").distinct().collect()} == {("2024", "02"), ("2024", "03")}
    assert got.count() == 12
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    p = tables.scan_cube(spark, path, "NO2", "2024-02-10", "2024-03-31")._jdf.queryExecution().executedPlan().toString()
    filters = p[p.index("PartitionFilters"):p.index("PushedFilters")]
    assert "mm" in filters and "product" in filters
    assert tables.slices(got, "2024-02-15", "2024-03-01").count() == 6
    assert got.first().units == "u"


def test_writing_a_month_twice_leaves_it_once(spark, tmp_path):
    path = str(tmp_path / "cube")
    for _ in range(2):
        tables.write_cube(layout(spark), path)
    assert tables.scan_cube(spark, path, "NO2").count() == 18


def test_small_months_make_one_file(spark, tmp_path):
    path = tmp_path / "cube"
    tables.write_cube(layout(spark), str(path))
    assert len(list(path.rglob("*.parquet"))) == 3


def test_rebuild_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "cube")
    tables.write_cube(layout(spark), path)
    feb = layout(spark).where("mm = '02'").withColumn("value", F.lit(99.0))
    for _ in range(2):
        tables.rebuild_partitions(feb, path)
    sums = {r.mm: r["sum(value)"] for r in spark.read.parquet(path).groupBy("mm").sum("value").collect()}
    assert sums == {1: 6.0, 2: 594.0, 3: 18.0}


@pytest.mark.parametrize("encoding", ["utf-8", "big5"])
def test_provider_files_in_several_encodings(spark, tmp_path, encoding):
    file = tmp_path / "stations.csv"
    file.write_bytes("sitename,county,twd97lon,twd97lat\n古亭,臺北市,121.53,25.02\n".encode(encoding))
    names = {"sitename": "station", "county": "county", "twd97lon": "lon", "twd97lat": "lat"}
    got = tables.read_provider_csv(spark, str(file), names, "env")
    assert [tuple(r) for r in got.collect()] == [("古亭", "臺北市", "121.53", "25.02", "env")]


def test_missing_provider_is_tolerated(spark, tmp_path):
    assert tables.read_provider_csv(spark, str(tmp_path / "none.csv"), {}, "env") is None


def test_inventory_reads_metadata_only(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a/x.nc").write_bytes(b"12345")
    (tmp_path / "a/._x.nc").write_bytes(b"1")
    (tmp_path / "y.png").write_bytes(b"12")
    inv = tables.file_inventory(spark, str(tmp_path), "*.nc")
    assert [(r.path.split("/")[-1], r.length) for r in inv.collect()] == [("x.nc", 5)]
    assert "content" not in inv._jdf.queryExecution().executedPlan().toString()


def test_dense_arrays_with_unequal_shapes(spark):
    df = spark.createDataFrame([(1, [[1.0, 2.0, 3.0], [4.0, 5.0, 6.0]], [[1.0, 1.0], [2.0, 2.0], [3.0, 3.0]], [[float("nan"), 8.0], [9.0, 10.0]])],
                               "granule_id int, lat array<array<double>>, lon array<array<double>>, value array<array<double>>")
    got = sorted((r.row_idx, r.col_idx, r.lat, r.lon, r.value) for r in sw.explode_grid(df).where("value is not null").collect())
    assert got == [(0, 1, 2.0, 1.0, 8.0), (1, 0, 4.0, 2.0, 9.0), (1, 1, 5.0, 2.0, 10.0)]
    assert sw.explode_grid(df).where("value is null").count() == 1


def test_aliases(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "Optical_Depth_055 double, lat double, longitude double")
    assert sw.resolve_variable(df, ("Optical_Depth_047", "Optical_Depth_055")).columns[0] == "value"
    assert sw.resolve_variable(df, ("x",)) is None
    assert sw.resolve_variable(df, ("x",), fallback_to_first=True, ignore=("lat", "longitude")).columns[0] == "value"
    assert sw.resolve_coords(df, {"lat": ("latitude", "lat"), "lon": ("longitude", "lon")}).columns[1:] == ["lat", "lon"]
    with pytest.raises(ValueError):
        sw.resolve_coords(df, {"time": ("time",)})
    assert tables.scan_fields(df, ("lat", "lon")) is None


def test_stream_restart_keeps_each_granule_once(spark, tmp_path):
    src, out, led, cp = (str(tmp_path / n) for n in ("in", "out", "led", "cp"))
    px = swath(spark, granule=1).union(swath(spark, granule=2, value=lambda la, lo: 2.0))
    px.repartition(2, "granule_id").write.parquet(src)

    def drive():
        ingest.ingest_granules(ingest.read_stream(spark, src, px.schema), out, led, cp).awaitTermination()

    drive()
    px.write.mode("append").parquet(src)
    swath(spark, granule=3, value=lambda la, lo: float("nan")).write.mode("append").parquet(src)
    drive()
    counts = {r.granule_id: r["count"] for r in spark.read.parquet(out).groupBy("granule_id").count().collect()}
    assert counts == {1: 56, 2: 56, 3: 56}
    assert {r.granule_id: r.status for r in spark.read.parquet(led).collect()} == {1: "ok", 2: "ok", 3: "empty"}


def test_repeated_batch_leaves_the_same_rows(spark, tmp_path):
    """The checkpoint is lost after the batch was written; the batch runs again."""
    src, out, led = (str(tmp_path / n) for n in ("in", "out", "led"))
    px = swath(spark, granule=1)
    px.write.parquet(src)
    for k in range(2):
        ingest.ingest_granules(ingest.read_stream(spark, src, px.schema), out, led, str(tmp_path / f"cp{k}")).awaitTermination()
    assert spark.read.parquet(out).count() == 56 and spark.read.parquet(led).count() == 1


def test_streamed_grid_equals_batch(spark, tmp_path):
    src = str(tmp_path / "in")
    px = swath(spark, granule=1, value=lambda la, lo: la).union(swath(spark, granule=2, value=lambda la, lo: lo))
    px.repartition(2, "granule_id").write.parquet(src)
    ingest.stream_grid(ingest.read_stream(spark, src, px.schema, 1), GRID, str(tmp_path / "out"), str(tmp_path / "led"),
                       str(tmp_path / "cp")).awaitTermination()
    pick = ["granule_id", "i", "j", F.round("value", 9).alias("value"), "count"]
    done = ingest.latest(spark, str(tmp_path / "out"), str(tmp_path / "led"))
    got, want = done.select(*pick), regrid.supersample_regrid(px, GRID).select(*pick)
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0


def test_split_granule_is_kept_whole(spark, tmp_path):
    """Halves of a granule in two batches: both are kept, and the grid is made of both."""
    src, out, led, cp = (str(tmp_path / n) for n in ("in", "out", "led", "cp"))
    px = swath(spark, granule=1, value=lambda la, lo: la).withColumn("n", F.lit(56))
    for half in (0, 1):
        px.where(F.col("col_idx") % 2 == half).coalesce(1).write.mode("append").parquet(src)
    ingest.stream_grid(ingest.read_stream(spark, src, px.schema, 1), GRID, out, led, cp, expected="n").awaitTermination()
    pick = ["granule_id", "i", "j", F.round("value", 9).alias("value"), "count"]
    got, want = ingest.latest(spark, out, led).select(*pick), regrid.supersample_regrid(px, GRID).select(*pick)
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0
    lines = spark.read.parquet(led).orderBy("batch_id").select("status", "n_pixels").collect()
    assert [tuple(r) for r in lines] == [("partial", 32), ("ok", 56)]


def test_repeated_pixel_changes_no_footprint(spark):
    px = swath(spark, granule=1, value=lambda la, lo: la)
    twice = px.union(px.where("row_idx = 3 and col_idx = 3"))
    assert regrid.pixel_footprints(twice).count() == regrid.pixel_footprints(px).count() > 0
    got = regrid.corners_from_centers(twice)
    assert got.where("lat is null").count() == 0 and got.exceptAll(regrid.corners_from_centers(px)).count() == 0
