"""Queries of the folder against their check SQL, on whole tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

from compare import connect, rows_of  # noqa: E402

import __spark_entry__ as entry_module  # noqa: E402
from skygrid.llm import ORACLE, QUERIES  # noqa: E402


@pytest.mark.parametrize("name", list(ORACLE))
def test_query(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = connect(sf_dir).execute(ORACLE[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows_of(columns, cur.fetchall()) and got


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry_module.queries())
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES}
