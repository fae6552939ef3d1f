"""Print the physical plan tree of registered queries (and of the large-data paths).

Usage: python tools/plans.py [sf_dir] [name ...]
"""
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from verdant.config import ExecutionConfig  # noqa: E402
from verdant.plans import registry  # noqa: E402
from verdant.plans.forecast import ForecastRun, event_config  # noqa: E402
from verdant.session import build_session  # noqa: E402
from verdant.sources.tables import event_observations  # noqa: E402


def tree(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "\n".join(line for line in plan.splitlines() if line.strip())


def main():
    args = sys.argv[1:]
    sf = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if not os.path.isdir(a)]
    spark = build_session(shuffle_partitions=8)
    qs = registry.queries()
    for name in names or ["dedupe_first", "clean_dataset", "sliding_windows", "hybrid_forecast",
                          "linear_regression", "knn_forecast"]:
        print(f"### {name}\n```\n{tree(qs[name](spark, sf))}\n```\n")
    # Large-data paths: tiny blocks/thresholds force range positions, block carries, sort quantiles.
    run = ForecastRun(event_observations(spark, sf), event_config(),
                      ExecutionConfig(block_rows=97, single_task_values=10))
    print(f"### clean_dataset (large-data path)\n```\n{tree(run.cleaned)}\n```\n")
    print(f"### sliding_windows (large-data path)\n```\n{tree(run.all_windows)}\n```\n")


if __name__ == "__main__":
    main()
