"""Time the registered queries: one JSON line on stdout.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores and
``BENCH_QUERIES`` (comma separated) a choice of queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

from skygrid.session import local_session
from skygrid.workload import QUERIES

HEADLINE = (
    "A1_scan_cube", "A3_explode_grid", "A15_write_cube", "F_swath_qc_chain", "B1_granule_time", "B6_sinusoidal_to_lonlat",
    "G6_cell_index", "J1_region_mask", "W2_pixel_footprints", "R2_supersample_regrid", "R3_nearest_regrid", "R4_idw_regrid",
    "R6_linear_regrid", "R7_coarse_granules", "R8_adaptive_regrid", "R10_footprint_nn_daily", "R13_interpolate",
    "R14_smooth3x3", "W3_sample_pixels", "T1_accumulate", "T2_period_bucket", "T6_daily_cube", "T9_file_expiry_report",
    "V1_coverage_per_file", "V2_coverage_daily", "V2_coverage_daily_zone", "V3_coverage_monthly", "H2_extract_point",
    "H3_extract_3x3", "H7_station_series", "C1_search_granules", "C7_pending_granules", "U1_merge_cubes",
    "X3_stream_daily_mean",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else [n for n in wanted.split(",") if n] or list(HEADLINE)
    spark = local_session(cpus, "skygrid-bench")
    # One untimed query loads classes and warms the scan.
    QUERIES["V2_coverage_daily"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    print(json.dumps({"metric": "total query time", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
