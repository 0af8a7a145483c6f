"""Time the headline queries and print one JSON line.

Folder of parquet tables: $BENCH_SF_DIR; cores: $BENCH_CPUS.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tilth.plans import catalog  # noqa: E402
from tilth.session import build_session  # noqa: E402

HEADLINE = (
    "seasonal_curve",
    "asof_nearest_join",
    "fill_forward_backward",
    "interpolate_linear",
    "daily_midrange",
    "calendar_densify",
    "cumulative_gdd",
    "stage_from_gdd",
    "crop_height",
    "lut_inversion",
    "derive_bounds",
    "refined_lee",
    "focal_mean_var_3x3",
    "zonal_median",
    "pivot_bands_mean",
    "dedupe_by_time",
    "grouped_metrics",
    "match_observed_predicted",
    "crop_station_year_pivot",
    "crop_coverage",
    "freeze_spans",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalog.QUERIES["crop_coverage"](spark, sf_dir).count()  # warm the JVM
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
