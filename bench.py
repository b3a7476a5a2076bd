"""Time the headline reports; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS warm runs per query (default 3, the median counts), BENCH_QUERIES a comma list.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from perilgrid.plans.catalog import QUERIES  # noqa: E402
from perilgrid.session import build_session  # noqa: E402

HEADLINE = (
    "grid_count",
    "grid_enrich",
    "hex_azimuth",
    "hex_bin",
    "hex_bin_counts",
    "bbox_lookup",
    "scan_bbox_projection",
    "fire_lookup_site",
    "fire_semi_join",
    "fire_contains",
    "fire_exposure",
    "cov_histogram",
    "cov_histogram_alias",
    "loss_by_portfolio",
    "loss_by_site_bucket",
    "ingest_site_exposure",
    "ingest_wildfire_geojson",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
            "spark.log.level": "ERROR",
        },
    )

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.mode("overwrite").format("noop").save()
        return time.perf_counter() - start

    timings = {}
    for name in names:
        run(name)  # warm-up: class loading and code generation
        timings[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
        print(f"{name}: {timings[name]}", file=sys.stderr)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total wall time of headline reports, median of warm runs",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
