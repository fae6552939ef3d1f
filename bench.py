"""Benchmark the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is built and fully executed (``noop`` sink, so nothing is
collected); its wall time includes any eager checkpoint it performs.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from verdant.plans import registry  # noqa: E402
from verdant.session import build_session  # noqa: E402

HEADLINE = [
    "dedupe_first",
    "clean_dataset",
    "clip_quantile",
    "lineitem_scale",
    "order_series_clean",
    "sliding_windows",
    "ensemble_weights",
    "hybrid_forecast",
    "model_comparison",
    "threshold_actions",
    "crop_results",
    "linear_regression",
    "stream_window_counts",
    "raw_ingest",
    "bundle_rows",
    "knn_forecast",
    "random_forest",
    "gbt",
    "rbf_regression",
    "hybrid_all_models",
    "long_windows",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus)
    qs = registry.queries()
    spark.range(1 << 16).selectExpr("sum(id)").collect()  # JVM warm-up, not timed
    times: dict[str, float] = {}
    for name in names:
        t = time.time()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_query_seconds_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
