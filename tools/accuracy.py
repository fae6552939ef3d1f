"""Run the full model set on CSV inputs and print per-model mean accuracy (overall ranking).

Usage: python tools/accuracy.py [--models m1,m2,...] <csv file or folder> [...]
"""
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from verdant.operators.metrics import overall_ranking  # noqa: E402
from verdant.plans.forecast import ForecastRun  # noqa: E402
from verdant.session import build_session  # noqa: E402
from verdant.sources.ingest import load_sources  # noqa: E402

MODELS = ("naive_persistence", "linear_baseline", "knn_regressor", "linear_regression", "random_forest",
          "gradient_boosting", "svr_rbf")


def main():
    args = sys.argv[1:]
    models = MODELS
    if args and args[0] == "--models":
        models, args = tuple(args[1].split(",")), args[2:]
    spark = build_session(shuffle_partitions=8)
    run = ForecastRun(load_sources(spark, args), model_set=models)
    run.comparison.orderBy("crop_type", "rank").show(100, truncate=False)
    overall_ranking(run.comparison).orderBy("rank").show(truncate=False)
    run.crop_results.select("crop_type", "mae", "rmse", "mape_pct", "r2", "model_coordination").show(truncate=False)


if __name__ == "__main__":
    main()
