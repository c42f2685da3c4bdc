import numpy as np
import pytest
from pyspark.sql import functions as F
from swaths import arrays, corners, swath

from skygrid.operators import accumulate, regrid
from skygrid.plans.grid import GridSpec

GRID = GridSpec(20.8763171, 0.25, 12, 118.8809113, 0.25, 10)


def as_dict(df, *keys):
    return {tuple(r[k] for k in keys): r["value"] for r in df.collect()}


@pytest.mark.parametrize("shape", [(3, 3), (3, 5), (4, 3), (8, 7)])
def test_corners_match_the_rule(spark, shape):
    px = swath(spark, *shape, skew=0.05)
    lat, lon, _ = arrays(px)
    got = {(r.k, r.l): (r.lat, r.lon) for r in regrid.corners_from_centers(px).collect()}
    want_lat, want_lon = corners(lat), corners(lon)
    assert set(got) == {(k, m) for k in range(shape[0] + 1) for m in range(shape[1] + 1)}
    for (k, m), (la, lo) in got.items():
        assert la == pytest.approx(want_lat[k, m], abs=1e-12) and lo == pytest.approx(want_lon[k, m], abs=1e-12)


def test_footprints_use_the_same_corners(spark):
    px = swath(spark, 5, 4, skew=0.03)
    lat, lon, _ = arrays(px)
    la, lo = corners(lat), corners(lon)
    for r in regrid.pixel_footprints(px).collect():
        i, j = r.row_idx, r.col_idx
        got = (r.a_lat, r.b_lat, r.c_lat, r.d_lat, r.a_lon, r.c_lon)
        assert got == pytest.approx((la[i, j], la[i + 1, j], la[i + 1, j + 1], la[i, j + 1], lo[i, j], lo[i + 1, j + 1]))


def test_footprint_needs_all_neighbours(spark):
    px = swath(spark, 7, 7).where("not (row_idx = 3 and col_idx = 3)")
    left = {(r.row_idx, r.col_idx) for r in regrid.pixel_footprints(px).collect()}
    assert left == {(r, c) for r in range(7) for c in range(7) if max(abs(r - 3), abs(c - 3)) > 1}


def test_supersample_against_dense_arrays(spark):
    px = swath(spark, 8, 7, value=lambda la, lo: la * 3 + lo).withColumn("qa", F.when(F.col("pixel_id") % 3 == 0, 0.4).otherwise(0.8))
    pdf = px.toPandas().sort_values(["row_idx", "col_idx"])
    lat, lon, val = arrays(px)
    qa = pdf.qa.to_numpy().reshape(lat.shape)
    la, lo = corners(lat), corners(lon)
    num, den, cnt = {}, {}, {}
    u = (np.arange(4) + 0.5) / 4
    for i in range(lat.shape[0]):
        for j in range(lat.shape[1]):
            inside = (GRID.lat_edge0 <= lat[i, j] <= GRID.lat_edge0 + 12 * 0.25) and (GRID.lon_edge0 <= lon[i, j] <= GRID.lon_edge0 + 10 * 0.25)
            if qa[i, j] < 0.5 or not inside:
                continue
            for s in u:
                for t in u:
                    y, x = [(1 - s) * (1 - t) * p[i, j] + s * (1 - t) * p[i + 1, j] + s * t * p[i + 1, j + 1] + (1 - s) * t * p[i, j + 1] for p in (la, lo)]
                    ci, cj = int((y - GRID.lat_edge0) // 0.25), int((x - GRID.lon_edge0) // 0.25)
                    if 0 <= ci < 12 and 0 <= cj < 10:
                        w = qa[i, j] / 16
                        num[ci, cj] = num.get((ci, cj), 0) + w * val[i, j]
                        den[ci, cj] = den.get((ci, cj), 0) + w
                        cnt[ci, cj] = cnt.get((ci, cj), 0) + 1
    got = {(r.i, r.j): (r.value, r["count"]) for r in regrid.supersample_regrid(px, GRID).collect()}
    assert set(got) == set(num)
    for key, (v, n) in got.items():
        assert v == pytest.approx(num[key] / den[key]) and n == cnt[key]


@pytest.mark.parametrize("op", [
    lambda p, g: regrid.supersample_regrid(p, g), lambda p, g: regrid.nearest_regrid(p, g, 0.3),
    lambda p, g: regrid.idw_regrid(p, g, 0.3), lambda p, g: regrid.smooth_regrid(p, g, 0.3),
    lambda p, g: regrid.linear_regrid(p, g, 0.3), lambda p, g: regrid.overwrite_regrid(p, g, 0.3)])
def test_constant_field_stays_constant(spark, op):
    values = [r.value for r in op(swath(spark, value=lambda la, lo: 7.0), GRID).collect()]
    assert values and values == pytest.approx([7.0] * len(values))


def test_linear_reproduces_affine_fields(spark):
    px = swath(spark, value=lambda la, lo: 2 * la - lo + 90)
    rows = GRID.with_coordinates(regrid.linear_regrid(px, GRID, 0.3)).collect()
    assert len(rows) > 20
    for r in rows:
        assert r.value == pytest.approx(2 * r.lat - r.lon + 90, abs=1e-9)


def test_linear_fills_beside_a_hole(spark):
    """A missing corner leaves one triangle of its quad."""
    px = swath(spark, 3, 3, dlat=0.5, dlon=0.5, skew=0.0, lat0=21.0, lon0=119.0, holes={(0, 0)})
    cells = {(round(r.lat, 3), round(r.lon, 3)) for r in GridSpec(21.0, 0.125, 9, 119.0, 0.125, 9).with_coordinates(
        regrid.linear_regrid(px, GridSpec(21.0, 0.125, 9, 119.0, 0.125, 9), 5.0)).collect()}
    assert (21.375, 119.375) in cells and (21.125, 119.125) not in cells


def test_linear_drops_negative_and_far_cells(spark):
    px = swath(spark, value=lambda la, lo: -1.0)
    assert regrid.linear_regrid(px, GRID, 0.3).count() == 0
    near = regrid.linear_regrid(px, GRID, 0.05, drop_negative=False).count()
    assert 0 < near < regrid.linear_regrid(px, GRID, 0.3, drop_negative=False).count()


def test_nearest_against_brute_force(spark):
    px = swath(spark, value=lambda la, lo: la * 100 + lo, holes={(1, 1), (2, 3)})
    lat, lon, val = arrays(px)
    ok = ~np.isnan(val)
    want = {}
    for i, y in enumerate(GRID.lats()):
        for j, x in enumerate(GRID.lons()):
            d = np.hypot(lat[ok] - y, lon[ok] - x)
            if d.min() <= 0.2:
                want[i, j] = val[ok][d.argmin()]
    assert as_dict(regrid.nearest_regrid(px, GRID, 0.2), "i", "j") == pytest.approx(want)


def test_nearest_tie_goes_to_first_pixel(spark):
    px = spark.createDataFrame([(1, 2, 21.0, 119.1, 5.0), (1, 1, 21.0, 118.9, 3.0)],
                               "granule_id long, pixel_id long, lat double, lon double, value double")
    one = GridSpec(21.0, 1.0, 1, 119.0, 1.0, 1)
    assert as_dict(regrid.nearest_regrid(px, one, 0.5), "i", "j") == {(0, 0): 3.0}
    assert as_dict(regrid.overwrite_regrid(px, one, 0.5), "i", "j") == {(0, 0): 5.0}


@pytest.mark.parametrize("scale", [0.4, 0.9, 1.0, 1.3, 1.6])
def test_coarse_granules_against_medians(spark, scale):
    rng = np.random.default_rng(int(scale * 10))
    rows = []
    for g in range(6):
        n = int(rng.integers(2, 60))
        pts = rng.uniform(0, 0.25 * scale * (n ** 0.5), (n, 2)) if g % 2 else rng.normal(0, 0.2 * scale, (n, 2))
        rows += [(g, g * 100 + k, 22 + float(y), 120 + float(x), 1.0) for k, (y, x) in enumerate(pts)]
    px = spark.createDataFrame(rows, "granule_id long, pixel_id long, lat double, lon double, value double")
    got = {r.granule_id: r.coarse for r in regrid.coarse_granules(px, GRID).collect()}
    for g in range(6):
        p = np.array([(r[2], r[3]) for r in rows if r[0] == g])
        d = np.hypot(p[:, None, 0] - p[None, :, 0], p[:, None, 1] - p[None, :, 1]) + np.eye(len(p)) * 1e9
        dist = np.sort(d.min(axis=1))
        assert got[g] == (np.median(dist) > 0.375), (g, np.median(dist))


def test_adaptive_choice(spark):
    full = swath(spark, 9, 9, granule=1, value=lambda la, lo: 2.0)
    few = swath(spark, 9, 9, granule=2, value=lambda la, lo: 3.0).where("row_idx = 4 and col_idx between 3 and 5")
    lone = swath(spark, 9, 9, granule=3, value=lambda la, lo: 4.0).where("row_idx = 4 and col_idx = 4")
    methods = {r.granule_id: r.method for r in regrid.adaptive_regrid(full.union(few).union(lone), GRID).select("granule_id", "method").distinct().collect()}
    assert methods == {1: "linear", 2: "idw", 3: "nearest"}


def test_unknown_method(spark):
    with pytest.raises(ValueError):
        regrid.interpolate(swath(spark), GRID, "spline")


def test_last_column_repeats_the_step(spark):
    px = swath(spark, 3, 4, dlon=0.3, skew=0.0)
    steps = {(r.row_idx, r.col_idx): r.step for r in regrid.scanline_step(px).collect()}
    assert steps[0, 3] == pytest.approx(steps[0, 2]) and steps[0, 0] == pytest.approx(0.3 * np.cos(np.radians(21.03)))


def test_footprint_nn_accepts_only_own_radius(spark):
    """The nearest pixel decides; a farther one with a wider footprint does not step in."""
    px = spark.createDataFrame(
        [(1, 1, 0, 0, 22.0, 120.0, 1.0), (1, 2, 0, 1, 22.0, 120.1, 2.0), (2, 3, 0, 0, 22.3, 120.0, 3.0), (2, 4, 0, 1, 22.3, 120.6, 4.0)],
        "granule_id long, pixel_id long, row_idx int, col_idx int, lat double, lon double, value double").withColumn(
        "obs_time", F.lit("2024-01-01").cast("timestamp"))
    grid = GridSpec(22.12, 0.1, 1, 120.0, 0.1, 1)
    assert regrid.footprint_nn_daily(px, grid).count() == 0
    # 0.12 from pixel 1, whose radius is half a cell diagonal; pixel 3 is 0.18 away but reaches 0.28.


def test_smooth_box_wraps_and_drops_holes(spark):
    grid = GridSpec(0.0, 1.0, 3, 0.0, 1.0, 3)
    full = [(1, i, j, float(i * 3 + j)) for i in range(3) for j in range(3)]
    df = spark.createDataFrame(full, "s int, i int, j int, value double")
    assert set(as_dict(regrid.smooth_box(df, grid, ["s"]), "i", "j").values()) == {4.0}
    assert regrid.smooth_box(df.where("not (i = 0 and j = 0)"), grid, ["s"]).count() == 0
    with pytest.raises(ValueError):
        regrid.smooth_box(df, grid, ["s"], 4)


def test_sample_is_exact_and_repeatable(spark):
    px = spark.range(20_000).select((F.col("id") % 2).alias("granule_id"), F.col("id").alias("pixel_id"))
    px = px.where((F.col("granule_id") == 0) | (F.col("pixel_id") < 100))
    first = regrid.sample_pixels(px, 300)
    counts = {r.granule_id: r["count"] for r in first.groupBy("granule_id").count().collect()}
    assert counts == {0: 300, 1: 50}
    again = regrid.sample_pixels(px.repartition(7), 300)
    assert first.exceptAll(again).count() == 0


def test_tile_mean_default_and_legacy(spark):
    tiles = spark.createDataFrame([("d", g, 0, 0, v) for g, v in ((1, 1.0), (2, 4.0), (3, 7.0))] + [("d", 1, 0, 1, None)],
                                  "obs_date string, granule_id int, i int, j int, value double")
    assert as_dict(accumulate.tile_mean(tiles), "i", "j") == {(0, 0): 4.0}
    assert as_dict(accumulate.tile_mean(tiles, legacy=True), "i", "j") == {(0, 0): 3.25}
    assert as_dict(accumulate.tile_overlay(tiles), "i", "j") == {(0, 0): 7.0}


def test_accumulating_a_field_twice_changes_nothing(spark):
    cells = regrid.supersample_regrid(swath(spark, value=lambda la, lo: la), GRID)
    once = {(r.i, r.j): (r.value, r["count"]) for r in accumulate.accumulate(cells).collect()}
    twice = {(r.i, r.j): (r.value, r["count"], r.std) for r in accumulate.accumulate(cells.union(cells)).collect()}
    for key, (value, n, std) in twice.items():
        assert value == pytest.approx(once[key][0], abs=1e-12) and n == 2 * once[key][1] and std == pytest.approx(0, abs=1e-5)


def test_one_granule_may_hold_most_rows(spark):
    """A granule of 250,000 pixels next to small ones: whole and equal to gridding it alone."""
    big = (spark.range(250_000).select(
        F.lit(9).cast("long").alias("granule_id"), F.col("id").alias("pixel_id"), F.expr("cast(id div 500 as int)").alias("row_idx"),
        F.expr("cast(id % 500 as int)").alias("col_idx"))
        .withColumns({"lat": 21 + F.col("row_idx") * 0.0061, "lon": 119 + F.col("col_idx") * 0.0053, "value": F.col("row_idx") * 1.0, "qa": F.lit(1.0)}))
    small = swath(spark).select(*big.columns)
    both = regrid.supersample_regrid(big.union(small), GRID).where("granule_id = 9")
    alone = regrid.supersample_regrid(big, GRID)
    assert both.select("i", "j", F.round("value", 6), "count").exceptAll(alone.select("i", "j", F.round("value", 6), "count")).count() == 0
    assert both.agg(F.sum("count")).first()[0] > 1_000_000


def test_stored_corners_give_the_same_grid(spark):
    px = swath(spark, 9, 9, value=lambda la, lo: la + lo)
    feet = regrid.pixel_footprints(px.withColumn("qa", F.lit(1.0)))
    pick = ["i", "j", F.round("value", 9).alias("value"), "count"]
    got, want = regrid.supersample_regrid(feet, GRID).select(*pick), regrid.supersample_regrid(px, GRID).select(*pick)
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0


def test_swath_mostly_outside_the_grid(spark):
    """Only the blocks near the grid are exchanged; the cells are those of the whole swath."""
    px = swath(spark, 120, 100, value=lambda la, lo: la + lo, dlon=0.3)
    inside = (F.col("row_idx") < 8) & (F.col("col_idx") < 8)
    near = regrid.near_wanted(px, inside)
    assert near.count() == 64 * 64 and near.where(inside).count() == 64
    assert regrid.supersample_regrid(px, GRID).count() > 0
