"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
A query that isn't listed warms the session up first. Every query's full result is
written to a no-op sink; a query of under ``SHORT`` seconds is run three times and
its median counts. Caches are dropped between runs. ``rows_per_sec`` relates the
order lines behind a query to its time.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import time

from lendmark.registry.catalog import load
from lendmark.session import local_session

HEADLINE = [
    "gold_features", "vintage_summary", "dq_report", "latest_per_key", "upsert_by_key", "scd2_apply",
    "scd2_from_history", "stratified_sample", "median_imputer", "mode_imputer", "vif_filter", "quantile_edges",
    "monotone_bins", "iv_rating", "woe_transform", "fit_scorecard", "score_scale", "points_table", "decile_table",
    "incremental_upsert_stream", "attribution_long", "roc_auc", "evaluate_all", "psi_by_epoch", "adverse_action_notice", "lifecycle_3_epochs",
]
WARM_UP = "scan_table"
SHORT = 3.0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "lendmark-bench", memory="12g")
    spark.sparkContext.setLogLevel("OFF")
    queries, _ = load()
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()

    def timed(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took = time.perf_counter() - start
        spark.catalog.clearCache()
        return took

    timed(WARM_UP)
    timings = {}
    for name in HEADLINE:
        runs = [timed(name)]
        if runs[0] < SHORT:
            runs += [timed(name), timed(name)]
        timings[name] = round(statistics.median(runs), 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "rows_per_sec": {name: round(lines / took) for name, took in timings.items()},
                "sf": float(scale.group(1)) if scale else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
