"""Full workflow: observations in, every artifact out (the batch entry point).

``run_workflow`` writes, under one output folder: per-key cleaned inputs,
selected and scaled features, scaling parameters, window tables, predictions,
control actions, results / comparison / ranking tables, per-key UI payloads,
the payload index, and text summaries.  ``load_bundle`` reads the index and
payloads back and assembles the dashboard bundle.

CLI::

    python -m verdant.plans.workflow --inputs data/raw --out /shared/run1
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_EXEC, ExecutionConfig, ForecastConfig
from ..operators import metrics, reports, windows
from ..operators.series import POS, SIZE
from ..session import materialize
from ..sources import sinks
from .forecast import ForecastRun


def _lines(df: DataFrame, fmt: str, *cols: str) -> DataFrame:
    return df.select(F.format_string(fmt, *cols).alias("line"))


def run_workflow(spark: SparkSession, observations: DataFrame, out_dir: str,
                 cfg: ForecastConfig | None = None, exec_cfg: ExecutionConfig = DEFAULT_EXEC,
                 model_set: tuple[str, ...] = ("naive_persistence", "linear_baseline"),
                 page_rows: int = 10000) -> dict[str, str]:
    run = ForecastRun(observations, cfg or ForecastConfig(), exec_cfg, model_set)
    run.require_results()
    # Read by every report below: cut once.
    run.weights, run.test_original = materialize(run.weights), materialize(run.test_original)
    run.comparison, run.actions = materialize(run.comparison), materialize(run.actions)
    k = run.cfg.key
    p = {name: os.path.join(out_dir, name) for name in (
        "classified_inputs", "features_cleaned", "features_scaled", "scaling_parameters", "windows",
        "predictions", "control_actions", "overall_crop_results", "overall_model_comparison",
        "overall_model_ranking", "ui_payload", "payload_index", "payload_index_head", "skip_reasons",
        "model_registry", "data_summary", "pipeline_status")}
    sinks.export_by_key(run.cleaned.drop(POS, SIZE), p["classified_inputs"], k)             # K1
    sinks.export_by_key(run.selected.drop(POS, SIZE), p["features_cleaned"], k)             # K2
    sinks.export_by_key(run.scaled.drop(POS, SIZE), p["features_scaled"], k)                # K2
    sinks.write_params(windows.params_long(run.params, [k], run.features), p["scaling_parameters"])  # K3
    sinks.write_windows(run.windows, p["windows"], k)                                       # K4
    models_ = sorted(run.model_set)
    piv = (run.test_original.filter(F.col("model") != "hybrid_coordinated")
           .groupBy(k, "timestamp").pivot("model", models_).agg(F.first("yhat")))
    piv = piv.select(k, "timestamp", *[F.col(m).alias(f"pred_{m}_c") for m in models_])
    sinks.export_by_key(run.forecast.join(piv, [k, "timestamp"], "left"), p["predictions"], k)  # K5
    sinks.export_by_key(run.actions, p["control_actions"], k)                              # K5
    sinks.write_table_csv(run.crop_results, p["overall_crop_results"])                       # K6
    sinks.write_table_csv(run.comparison, p["overall_model_comparison"])                     # K6
    sinks.write_table_csv(metrics.overall_ranking(run.comparison), p["overall_model_ranking"])
    payload = materialize(run.payload(page_rows))
    sinks.export_by_key(payload, p["ui_payload"], k, fmt="json")                           # K7
    index = reports.payload_index(run.label, payload, k, p["ui_payload"])                   # R5
    sinks.write_json_documents(index, p["payload_index"])                                  # K7
    tables = {name: p[name] for name in ("overall_crop_results", "overall_model_comparison", "overall_model_ranking")}
    sinks.write_json_documents(reports.index_document(index, tables, k), p["payload_index_head"])
    sinks.write_table_csv(run.eligibility, p["skip_reasons"])
    sinks.write_table_csv(run.registry, p["model_registry"])
    summary = metrics.dataset_summary(run.observations, run.cleaned, run.selected, run.scaled, run.features)
    sinks.write_text_report(_lines(summary.orderBy("section", "column"), "%s %s: %s",
                                   "section", "column", "value").coalesce(1), p["data_summary"])  # K8
    status = metrics.run_status(run.cleaned, run.grouped, run.forecast, k)
    sinks.write_text_report(_lines(status, "Crops discovered: %d | processed: %d | exported: %d",
                                   "keys_discovered", "keys_processed", "keys_exported"), p["pipeline_status"])
    return p


def load_bundle(spark: SparkSession, paths: dict[str, str], thresholds: dict[str, float],
                key: str = "crop_type") -> DataFrame:
    """S6 + R7: read the index and payloads back and join them with the per-key metrics."""
    index = sinks.read_json(spark, paths["payload_index"])
    payloads = sinks.read_json(spark, paths["ui_payload"])
    results = sinks.read_csv(spark, paths["overall_crop_results"])
    return reports.dashboard_bundle(index, payloads, results, thresholds, key)


def main(argv: list[str] | None = None) -> None:
    from ..session import build_session
    from ..sources.ingest import load_sources

    ap = argparse.ArgumentParser(description="Run the keyed forecasting and control workflow.")
    ap.add_argument("--inputs", nargs="+", required=True, help="CSV files or folders")
    ap.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    args = ap.parse_args(argv)
    spark = build_session()
    paths = run_workflow(spark, load_sources(spark, args.inputs), args.out)
    for name, path in paths.items():
        print(f"{name}: {path}")


if __name__ == "__main__":
    main()
