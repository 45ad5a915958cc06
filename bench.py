"""Times the headline queries; prints one JSON line.

Every query writes all its columns to a sink that discards them. Best of
``BENCH_RUNS`` runs (default 2) after the session has warmed up on the first.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riverloom import registry  # noqa: E402
from riverloom.session import drop_run_folder, local_session  # noqa: E402

HEADLINE = [
    "prepare_landcover_area",
    "prepare_continuity_width",
    "prepare_elevation_profiles",
    "find_duplicates",
    "keep_longest",
    "link_to_swaths",
    "landcover_full_side",
    "network_metrics",
    "replace_by_key",
    "points_in_regions",
    "lines_in_regions",
    "measure_from_outlet",
    "split_lines_by_swaths",
    "merge_lines",
    "snap_to_lines",
    "locate_points_on_axis",
    "prepare_swaths",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    registry.load()
    spark = local_session("riverloom-bench", cpus, partitions=int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            spent = time.perf_counter() - start
            best = spent if best is None else min(best, spent)
            drop_run_folder(spark)
        seconds[name] = round(best, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "shuffle_partitions": int(cpus),
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
