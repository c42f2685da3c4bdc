"""Coverage words against dense masks: wide grids, both weights, zones, maps kept as tables."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from skygrid.operators import coverage
from skygrid.operators.region import region_cells
from skygrid.plans.cellmaps import cell_words, covered_weight, region_words, union_words
from skygrid.plans.grid import GridSpec

WIDE = GridSpec(10.0, 0.5, 7, 100.0, 0.25, 150)


def _cube(spark, days=3, slices=2, seed=3, share=0.3):
    """A cube on the wide grid with repeated rows, and its values as dense arrays by (day, slice)."""
    rng, rows, dense = np.random.default_rng(seed), [], {}
    for d in range(days):
        for s in range(slices):
            valid = rng.random((WIDE.nlat, WIDE.nlon)) < share
            dense[d, s] = valid
            time = datetime(2024, 1, 30) + timedelta(days=d, hours=s)
            for i, j in zip(*np.nonzero(rng.random(valid.shape) < 0.9)):
                rows.append((f"{d}-{s}", time, int(i), int(j), 1.5 if valid[i, j] else None))
                valid[i, j] &= True
            missing = set(zip(*np.nonzero(valid))) - {(r[2], r[3]) for r in rows if r[0] == f"{d}-{s}"}
            rows += [(f"{d}-{s}", time, int(i), int(j), 2.5) for i, j in missing]
    rows += rows[::5]
    return spark.createDataFrame(rows, "slice_id string, time timestamp, i int, j int, value double"), dense


def _expected(dense, weights, mask):
    days = {}
    for (d, _), valid in dense.items():
        days[d] = days.get(d, False) | valid
    return {d: round(float(weights[v & mask].sum()), 3) for d, v in days.items()}


@pytest.mark.parametrize("box", [(100.0, 137.25, 10.0, 13.0), (103.1, 131.9, 10.6, 12.4), (115.75, 116.0, 11.0, 11.0), (115.8, 115.9, 10.0, 13.0)])
@pytest.mark.parametrize("weight", ["count", "area"])
def test_wide_grid_against_dense_masks(spark, box, weight):
    cube, dense = _cube(spark)
    lats, lons = WIDE.lats()[:, None], WIDE.lons()[None, :]
    mask = (lats >= box[2]) & (lats <= box[3]) & (lons >= box[0]) & (lons <= box[1])
    weights = np.broadcast_to(np.cos(np.radians(lats)) if weight == "area" else np.ones_like(lats), mask.shape)
    out = coverage.compute_coverage(cube, WIDE, region=box, weight=weight).collect()
    want = _expected(dense, weights, mask)
    got = {(datetime.strptime(r.time, "%Y-%m-%d") - datetime(2024, 1, 30)).days: r for r in out}
    assert set(got) == set(want)
    for d, r in got.items():
        assert r.valid == pytest.approx(want[d], abs=2e-3) and r.n_slices == 2
        assert r.total == pytest.approx(float(weights[mask].sum()), abs=1e-3)


def test_words_round_trip(spark):
    cube, dense = _cube(spark, days=1, slices=1)
    words = cell_words(cube.where("value is not null"), ["slice_id"])
    bits = {(r.i, r.w): r.bits % 2**64 for r in words.collect()}
    got = np.array([[bits.get((i, j // 64), 0) >> (j % 64) & 1 for j in range(WIDE.nlon)] for i in range(WIDE.nlat)], bool)
    assert (got == dense[0, 0]).all()
    again = union_words(words.union(words), ["slice_id"])
    assert sorted(again.collect()) == sorted(words.collect())


def test_zone_words_are_the_zone(spark):
    ring = [(101.05, 10.2), (130.3, 10.2), (120.4, 12.8), (101.05, 10.2)]
    vertices = spark.createDataFrame([("z", "A", 0, k, x, y) for k, (x, y) in enumerate(ring)],
                                     "zone string, county string, ring int, seq int, lon double, lat double")
    full = cell_words(WIDE.cells(spark), [F.lit(1).alias("k")])
    count = covered_weight(region_words(full, WIDE, "z", vertices), WIDE, ["k"]).first()["valid"]
    assert count == region_cells(WIDE, "z", spark, vertices).count() > 0
    with pytest.raises(ValueError, match="outlines"):
        region_words(full, WIDE, "north")


def test_map_grows_by_batches(spark, tmp_path):
    """Two batches that share slices, one of them written twice, equal one run over all; so does the compacted map."""
    cube, _ = _cube(spark, days=4, slices=3)
    box = (103.1, 131.9, 10.6, 12.4)
    path, tight = str(tmp_path / "map"), str(tmp_path / "tight")
    coverage.add_to_map(cube.where("slice_id < '2'"), WIDE, path, "a")
    for _ in range(2):
        coverage.add_to_map(cube.where("slice_id > '1'"), WIDE, path, "b")
    coverage.compact_map(spark, path, tight)
    for kw in ({}, {"weight": "area"}, {"granularity": "monthly"}, {"granularity": "yearly"}, {"start": "2024-01-31", "end": "2024-02-01"}):
        want = sorted(coverage.compute_coverage(cube, WIDE, region=box, **kw).collect())
        assert sorted(coverage.coverage_from_map(spark, path, WIDE, region=box, **kw).collect()) == want and want
        assert sorted(coverage.coverage_from_map(spark, tight, WIDE, region=box, **kw).collect()) == want
    words = spark.read.parquet(f"{tight}/words")
    assert words.count() == words.select("obs_date", "i", "w").distinct().count()


def test_only_words_are_exchanged(spark):
    """No row of the cube is shuffled for the union: the exchange follows the partial bit_or, and nothing is sorted for it."""
    cube, _ = _cube(spark)
    plan = coverage.compute_coverage(cube, WIDE, region=(100.0, 137.25, 10.0, 13.0))._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_or" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    assert plan.index("Exchange hashpartitioning(_t") < plan.index("partial_bit_or")
