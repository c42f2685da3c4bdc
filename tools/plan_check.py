"""Plan facts per query: largest generated method and operators that do not scale.

``python tools/plan_check.py [sf_dir] [name prefix ...]``. The JVM interprets methods
above 8000 bytes instead of compiling them, which shows as a slow stage.
"""

from __future__ import annotations

import contextlib
import io
import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from skygrid import session  # noqa: E402
from skygrid.workload import QUERIES  # noqa: E402

BAD = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroups", "MapInPandas",
       "SinglePartition")


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.001"
    session.RUNTIME_CONF["spark.sql.adaptive.enabled"] = "false"
    spark = session.local_session(8)
    for name, fn in QUERIES.items():
        if args and not any(name.startswith(a) for a in args):
            continue
        text = io.StringIO()
        df = fn(spark, sf_dir)
        with contextlib.redirect_stdout(text):
            df.explain("codegen")
            df.explain("formatted")
        sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())]
        found = [f"{b} x{text.getvalue().count(b)}" for b in BAD if b in text.getvalue()]
        print(f"{name:32s} {max(sizes, default=0):6d} {'LARGE ' if max(sizes, default=0) > 8000 else ''}{', '.join(found)}")


if __name__ == "__main__":
    main()
