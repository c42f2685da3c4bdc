"""Run queries next to their check SQL: ``python tools/compare.py [sf_dir] [name prefix ...]``."""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from skygrid.session import local_session  # noqa: E402
from skygrid.workload import ORACLE, QUERIES  # noqa: E402
from skygrid.workload.fixtures import GIVEN  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in GIVEN:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else (0.0 if x == 0 else x)
    if isinstance(x, (datetime.datetime, datetime.date)):
        return str(x)
    return x


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in rows), key=repr)


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    df = QUERIES[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLE:
        return True, f"{len(got)} rows, no check SQL"
    cur = (con or connect(sf_dir)).execute(ORACLE[name])
    cols = [d[0] for d in cur.description]
    want = rows_of(cols, cur.fetchall())
    if sorted(cols) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} vs {sorted(cols)}"
    kinds = dict(df.dtypes)
    types = [(d[0], kinds[d[0]], str(d[1])) for d in cur.description]
    if got == want:
        return True, f"{len(got)} rows"
    diff = [(a, b) for a, b in zip(got, want) if a != b][:3]
    return False, f"{len(got)} vs {len(want)} rows; first differences {diff}; types {types}"


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    names = [n for n in QUERIES if not args or any(n.startswith(a) for a in args)]
    spark, bad = local_session(8), 0
    for name in names:
        t0 = time.time()
        try:
            ok, note = compare(spark, None, name, sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, note = False, f"{type(e).__name__}: {str(e)[:700]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:34s} {time.time() - t0:6.1f}s {note}", flush=True)
    print(f"{len(names) - bad}/{len(names)} equal")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
