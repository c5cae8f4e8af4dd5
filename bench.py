"""Time the headline queries (median of three runs) and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from histoframe.session import get_session  # noqa: E402
from histoframe.workloads import registered  # noqa: E402

HEADLINE = (
    "mean_marker",
    "mean_marker_edge",
    "mean_marker_overlap",
    "tissue_prop",
    "cell_table",
    "cell_mean_marker",
    "channel_percentiles",
    "otsu_threshold",
    "pool_stats",
    "pseudo_rgb",
    "morph_close",
    "marker_match",
    "vocab_cascade",
    "cohort_status",
    "macro_metrics",
    "roc_auc_ovr",
)

#: Runs of each query; the median counts, so the first one is its warm-up.
RUNS = 3


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.log.level": "ERROR"}
    )
    spark.read.parquet(f"{sf}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    known, times = registered(), {}
    for name in HEADLINE:
        runs = []
        for _ in range(RUNS):
            start = time.perf_counter()
            known[name].build(spark, sf).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(median(runs), 3)
    spark.stop()
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf.rstrip("/"))}))


if __name__ == "__main__":
    main()
