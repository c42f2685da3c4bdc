"""Outlines against regions: hand-worked cases and a dense point check."""

import random

import pytest
from pyspark.sql import functions as F

from skygrid.operators.catalog import ring_intersects, search_footprints

BOX = (120.0, 122.0, 22.0, 25.0)
SLANTED = [(118.0, 20.0), (119.0, 20.0), (123.0, 27.0), (122.0, 27.0)]
CASES = [
    ("holds the box", [(110, 10), (130, 10), (130, 40), (110, 40)], True),
    ("inside the box", [(120.5, 23), (121, 23), (121, 23.5)], True),
    ("crosses without a corner inside", [(119, 23), (123, 23), (123, 24), (119, 24)], True),
    ("corner touches corner", [(122, 25), (123, 25), (123, 26)], True),
    ("edge touches edge", [(122, 23), (124, 23), (124, 24), (122, 24)], True),
    ("slanted through", SLANTED, True),
    ("slanted past, boxes meet", [(116, 22), (117, 22), (121, 27), (120, 27)], False),
    ("a triangle whose box covers all", [(115, 20), (124, 30), (115, 30)], False),
    ("closed ring", [(120.5, 23), (121, 23), (121, 23.5), (120.5, 23)], True),
    ("a point", [(121, 24)], True),
    ("a point outside", [(125, 24)], False),
    ("in the notch of a horseshoe", [(115, 20), (130, 20), (130, 30), (126, 30), (126, 21), (116, 21), (116, 30), (115, 30)], False),
    ("a turn further", [(480.5, 23), (481, 23), (481, 23.5)], True),
    ("no vertices", [], False),
    ("null", None, False),
]


def _rings(spark, rings):
    return spark.createDataFrame([(n, None if r is None else [(float(x), float(y)) for x, y in r], "kept") for n, r, *_ in rings],
                                 "name string, footprint array<struct<lon:double,lat:double>>, _edges string")


def test_worked_cases(spark):
    got = {r.name: r.hit for r in _rings(spark, CASES).select("name", ring_intersects(F.col("footprint"), BOX).alias("hit")).collect()}
    assert got == {n: want for n, _, want in CASES}
    found = search_footprints(_rings(spark, CASES), BOX)
    assert found.columns == ["name", "footprint", "_edges"] and {r.name for r in found.collect()} == {n for n, _, want in CASES if want}


@pytest.mark.parametrize("region", [(179.0, 181.0, 0.0, 5.0), (-181.0, -179.0, 0.0, 5.0), [(179, 0), (-179, 0), (-179, 5), (179, 5)]])
def test_antimeridian(spark, region):
    rings = [("west side", [(177, 1), (179.5, 1), (179.5, 2), (177, 2)], True), ("east side", [(-179.5, 1), (-177, 1), (-177, 2)], True),
             ("across", [(178, 3), (-178, 3), (-178, 4), (178, 4)], True), ("across, above", [(178, 6), (-178, 6), (-178, 7), (178, 7)], False),
             ("short of it", [(170, 1), (178, 1), (178, 2)], False), ("across, off", [(-178, 3), (-170, 3), (-170, 4)], False),
             ("other side of the globe", [(-1, 1), (1, 1), (1, 2)], False)]
    got = {r.name: r.hit for r in _rings(spark, rings).select("name", ring_intersects(F.col("footprint"), region).alias("hit")).collect()}
    assert got == {n: want for n, _, want in rings}


def test_triangles_against_points(spark):
    """Random triangles: a fine lattice of points of the region finds every overlap larger than its spacing."""
    rng = random.Random(4)
    rings = [(str(k), [(rng.uniform(116, 126), rng.uniform(18, 29)) for _ in range(3)]) for k in range(150)]
    got = {r.name: r.hit for r in _rings(spark, rings).select("name", ring_intersects(F.col("footprint"), BOX).alias("hit")).collect()}
    lattice = [(120 + 2 * i / 80, 22 + 3 * j / 80) for i in range(81) for j in range(81)]

    def holds(t, p):
        side = [(b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0]) for a, b in zip(t, t[1:] + t[:1])]
        return all(s >= 0 for s in side) or all(s <= 0 for s in side)

    seen = {n: any(holds(t, p) for p in lattice) for n, t in rings}
    assert all(got[n] for n in got if seen[n])
    assert sum(got.values()) - sum(seen.values()) <= 6 and 20 < sum(seen.values()) < 130
