"""Outward search against all pairs, and how few pairs it makes."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from skygrid.operators import regrid
from skygrid.plans import neighbours
from skygrid.plans.grid import GridSpec

GRID = GridSpec(20.0, 0.1, 41, 118.0, 0.08, 37)
SCHEMA = "granule_id long, pixel_id long, lat double, lon double, value double, radius double"


def _brute(rows, grid, scale=1.0):
    """(granule, i, j): the value of the closest pixel within its radius, the smaller id at equal distance."""
    best = {}
    for i, la in enumerate(grid.lats()):
        for j, lo in enumerate(grid.lons()):
            for g, p, y, x, v, r in rows:
                d = float(np.sqrt((y - la) ** 2 + ((x - lo) * scale) ** 2))
                if d <= r:
                    best[g, i, j] = min(best.get((g, i, j), (9e9, 0, 0)), (d, p, v))
    return {k: v[2] for k, v in best.items()}


def _swath(rng, n, box, granule=1, radius=0.9):
    return [(granule, int(k), float(y), float(x), float(k), radius)
            for k, (y, x) in enumerate(zip(rng.uniform(box[0], box[1], n), rng.uniform(box[2], box[3], n)))]


def _found(df):
    return {(r.granule_id, r.i, r.j): r.value for r in df.collect()}


@pytest.mark.parametrize("n, box", [(12, (19.0, 25.0, 117.0, 122.0)), (400, (20.5, 22.0, 118.5, 120.0)), (1, (21.0, 21.1, 119.0, 119.1)), (6, (24.3, 24.8, 121.0, 121.4))])
def test_against_all_pairs(spark, n, box):
    rows = _swath(np.random.default_rng(n), n, box)
    got = _found(regrid.nearest_regrid(spark.createDataFrame(rows, SCHEMA), GRID, 0.9))
    want = _brute(rows, GRID)
    assert got.keys() == want.keys() and got == want


def test_exact_ties_and_repeated_rows(spark):
    """A lattice whose cells lie halfway between pixels: the smaller id wins, whichever round finds it."""
    grid = GridSpec(0.0, 0.125, 17, 0.0, 0.125, 17)
    rows = [(1, 50 - k, 0.5 * (k // 5), 0.5 * (k % 5), float(k), 1.0) for k in range(25)]
    rows += [(1, 7, *rows[3][2:4], 77.0, 1.0), rows[4]]
    got = _found(regrid.nearest_regrid(spark.createDataFrame(rows, SCHEMA), grid, 1.0))
    assert got == _brute(rows, grid)


def test_radius_by_granule_and_scaled_longitude(spark):
    rng = np.random.default_rng(8)
    rows = _swath(rng, 40, (20.5, 23.0, 118.2, 120.5), 1, 0.25) + _swath(rng, 10, (20.5, 23.0, 118.2, 120.5), 2, 0.8)
    df = spark.createDataFrame(rows, SCHEMA)
    assert _found(regrid.nearest_regrid(df, GRID, F.col("radius"), most=0.8)) == _brute(rows, GRID)
    scaled = neighbours.outward_nearest(df, GRID, ["granule_id"], "pixel_id", ["value"], F.col("radius"), 0.8, F.lit(0.5))
    assert _found(scaled) == _brute(rows, GRID, 0.5)


def test_dense_swath_makes_few_pairs(spark, monkeypatch):
    """Pixels inside a dense swath meet only the cells around them, although the radius spans hundreds."""
    made = []
    plain = neighbours.window_cells

    def counted(*args):
        out = plain(*args)
        made.append(out)
        return out

    monkeypatch.setattr(neighbours, "window_cells", counted)
    grid = GridSpec(0.0, 0.1, 100, 0.0, 0.1, 100)
    n = 120
    px = spark.range(n * n).selectExpr("1L as granule_id", "id as pixel_id", f"(id div {n}) * 0.1D - 1.0 as lat", f"(id % {n}) * 0.1D - 1.0 as lon",
                                       "cast(id as double) as value")
    assert regrid.nearest_regrid(px, grid, 1.6).count() == grid.size
    pairs = sum(df.count() for df in made)
    assert len(made) == 3 and pairs < 16 * n * n  # a single search makes some 800 a pixel


def test_no_sort_for_the_closest_pixel(spark):
    px = spark.createDataFrame([(1, 1, 20.1, 118.1, 1.0, 0.1)], SCHEMA)
    for df in (regrid.nearest_regrid(px, GRID, 0.1), regrid.nearest_regrid(px, GRID, 0.9)):
        assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString()


def test_some_blocks_finish_and_others_go_on(spark):
    """A dense half swath: its blocks close, those on its rim are searched again; radii differ, one pixel has none and some have no granule."""
    rng = np.random.default_rng(5)
    at = [(19.85 + 0.1 * a, 117.95 + 0.1 * b) for a in range(24) for b in range(31)]
    rows = [(1, k, y + float(rng.normal(0, 0.01)), x, float(k), 0.12 if k % 7 == 0 else 0.6) for k, (y, x) in enumerate(at)]
    df = spark.createDataFrame([*rows, (1, 9999, 23.9, 118.3, 7.0, None), (None, 1, 22.0, 119.0, 5.0, 0.3)], SCHEMA)
    got = _found(neighbours.outward_nearest(df, GRID, ["granule_id"], "pixel_id", ["value"], F.col("radius"), 0.6))
    assert got == _brute([*rows, (1, 9999, 23.9, 118.3, 7.0, 0.15000000000000002), (None, 1, 22.0, 119.0, 5.0, 0.3)], GRID)


def test_later_rounds_shuffle_pixels_and_no_pairs(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "TASK_CELLS", 100, raising=False)
    px = spark.createDataFrame(_swath(np.random.default_rng(3), 12, (19.0, 25.0, 117.0, 122.0)), SCHEMA)
    plan = regrid.nearest_regrid(px, GRID, 0.9)._jdf.queryExecution().executedPlan().toString()
    exchanges = re.findall(r"Exchange hashpartitioning\((.*?)\)", plan)
    assert exchanges and all("_bi" in x and "_bj" in x for x in exchanges)
