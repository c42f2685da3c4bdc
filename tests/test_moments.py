"""Mergeable moments against plain arrays, with large values, in any grouping; plans."""

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from skygrid.operators import accumulate, moments

SCHEMA = "obs_date date, granule_id int, i int, j int, value double, count double"


def _cells(spark, offset=1e16, scale=1e10, days=40, granules=4, seed=1):
    rng, rows = np.random.default_rng(seed), []
    for d in range(days):
        for g in range(granules):
            for i in range(2):
                for j in range(3):
                    v = [None, float("nan"), float("inf")][d % 3] if rng.random() < .1 else float(offset + scale * rng.normal())
                    rows.append((date(2023, 11, 20) + timedelta(days=d), d * granules + g, i, j, v, float(rng.integers(0, 5))))
    return spark.createDataFrame(rows, SCHEMA), rows


def _plain(rows, key):
    groups = {}
    for r in rows:
        if r[4] is not None and np.isfinite(r[4]) and r[5] > 0:
            groups.setdefault((key(r[0]), r[2], r[3]), []).append((r[4], r[5]))
    out = {}
    for k, x in groups.items():
        v, w = np.array(x, dtype=np.longdouble).T
        mean = (v * w).sum() / w.sum()
        out[k] = (float(mean), len(x), float(np.sqrt((w * (v - mean) ** 2).sum() / w.sum())))
    return out


def _check(rows, got, key):
    want = _plain(rows, key)
    seen = {(r.period, r.i, r.j): r for r in got if r["count"]}
    assert set(seen) == set(want)
    for k, r in seen.items():
        assert r["count"] == want[k][1] and r.value == pytest.approx(want[k][0], rel=1e-14)
        assert r["std"] == pytest.approx(want[k][2], rel=1e-6, abs=4)


MONTH = lambda d: d.replace(day=1)


def SEASON(d):
    months = d.year * 12 + d.month - 1 - d.month % 3
    return date(months // 12, months % 12 + 1, 1)



@pytest.mark.parametrize("offset, scale", [(1e16, 1e10), (1e16, 1e16), (0.0, 1.0)])
def test_spread_of_large_values(spark, offset, scale):
    cells, rows = _cells(spark, offset, scale)
    out = accumulate.accumulate(cells.withColumn("period", F.to_date(F.date_trunc("month", "obs_date"))), ("period",)).collect()
    _check(rows, out, MONTH)


def test_one_reading_for_all_periods(spark):
    cells, rows = _cells(spark)
    out = accumulate.period_buckets(cells.withColumn("time", F.col("obs_date").cast("timestamp")))
    by = {}
    for r in out.collect():
        by.setdefault(r.bucket, []).append(r)
    for bucket, key in (("day", lambda d: d), ("month", MONTH), ("season", SEASON), ("year", lambda d: date(d.year, 1, 1)),
                        ("fortnight", lambda d: date(1970, 1, 1) + timedelta(days=(d - date(1970, 1, 1)).days // 14 * 14))):
        _check(rows, by[bucket], key)


def test_topped_up_states_equal_one_run(spark, tmp_path):
    cells, rows = _cells(spark)
    path = str(tmp_path / "states")
    for batch, part in (("a", "granule_id % 3 = 0"), ("b", "granule_id % 3 = 1"), ("b", "granule_id % 3 = 1"), ("c", "granule_id % 3 = 2")):
        moments.add_to_states(cells.where(part), path, batch, F.col("obs_date"))
    days = moments.finished(moments.stored_states(spark, path)).withColumnRenamed("obs_date", "period").collect()
    _check(rows, days, lambda d: d)
    some = moments.stored_states(spark, path, "2023-12-01", "2023-12-05").select("obs_date").distinct().count()
    assert some == 5


def test_empty_cells_have_no_value(spark):
    df = spark.createDataFrame([(date(2024, 1, 1), 1, 0, 0, None, 2.0), (date(2024, 1, 1), 1, 0, 1, 3.0, 0.0)], SCHEMA)
    got = {(r.i, r.j): (r.value, r["count"], r["std"]) for r in accumulate.accumulate(df).collect()}
    assert got == {(0, 0): (None, 0, 0.0), (0, 1): (None, 0, 0.0)}


def test_one_exchange_of_states_and_no_sort(spark, tmp_path):
    _cells(spark)[0].write.parquet(str(tmp_path / "cells"))
    cells = spark.read.parquet(str(tmp_path / "cells")).withColumn("time", F.col("obs_date").cast("timestamp"))
    df = accumulate.period_buckets(cells)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "SortAggregate" not in plan and "SortMergeJoin" not in plan
    assert plan.count("ReusedExchange") >= 1 and plan.count("Scan parquet") <= 2
