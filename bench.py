"""Time the headline queries: one warm-up, then the median of three runs, as one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark import session  # noqa: E402
from tidemark.catalog import load_all  # noqa: E402

HEADLINE = [
    "p03_flat_map", "p06_take_while",
    "j02_count_with_zeros", "j09_asof_dim", "j10_star", "j12_wide_row", "j14_nest", "j17_assemble",
    "a01_summary", "a04_top_row", "a05_group_list", "a13_rollup", "a17_percentile",
    "w01_row_number", "w03_top2_per_nation", "w04_neighbors", "w05_running_rows", "w09_ntile_global",
    "w12_global_row_number", "w13_trailing_sum",
    "q01_rules", "q04_audit", "q12_stages", "q16_job_status",
    "d02_scd2", "r02_exposure", "r04_daily_pnl",
    "m05_decide", "m10_policies", "f20_obfuscate", "f21_scan",
    "k03_chunk", "k05_bm25", "k06_knn",
    "t03_latest_by_key", "t09_meter",
]


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    load_all()[name].run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = list(load_all()) if "--all" in sys.argv else HEADLINE
    spark = session.local(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        run(spark, name, folder)
        times[name] = round(statistics.median(run(spark, name, folder) for _ in range(runs)), 4)
    print(
        json.dumps(
            {
                "metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
                "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cpus, "runs": runs, "spark": spark.version,
                "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
                "driver_memory": spark.conf.get("spark.driver.memory"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
