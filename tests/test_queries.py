"""Every registered query against its check SQL, on whole tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from compare import compare, connect  # noqa: E402

import __spark_entry__ as entry_module  # noqa: E402
from skygrid.workload import ORACLE, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf_dir, name):
    ok, note = compare(spark, con, name, sf_dir)
    assert ok, note


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0 and "coverage" in df.columns


def test_contract():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(QUERIES) == set(ORACLE)


def test_adaptive_queries_hand_over_all_pixels(spark, sf_dir):
    """Pixels refused by their granule's filter reach the operator, without a value."""
    from skygrid.workload.fixtures import Tables
    from skygrid.workload.regridding import _thinned

    t = Tables(spark, sf_dir)
    given, all_pixels = _thinned(t), t.pixel
    assert given.count() == all_pixels.count()
    assert given.where("value is not null").count() < all_pixels.where("value is not null").count()
