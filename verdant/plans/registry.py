"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver's tables (or data Spark derives from them) in
full.  Outputs are normalised for comparison with the DuckDB oracles in
``oracle.py``: doubles rounded to 6 decimals, integral columns as BIGINT,
internal position columns exposed as ``row_pos``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import HYBRID_MODEL
from ..functions.names import display_key, lookup_key, normalize_col, slug_col
from ..functions.values import json_number
from ..operators import clean, ensemble, kernel, metrics, models, reports, trees, windows
from ..operators.series import POS, SIZE
from ..sources import tables
from ..sources.ingest import standardize, union_all
from .forecast import ForecastRun, event_config

Query = Callable[[SparkSession, str], DataFrame]
INTEGRAL = ("int", "bigint", "smallint", "tinyint")


def finish(df: DataFrame, digits: int = 6) -> DataFrame:
    out = []
    for c, t in df.dtypes:
        name = "row_pos" if c == POS else c
        if t in ("double", "float"):
            out.append(F.round(F.col(f"`{c}`").cast("double"), digits).alias(name))
        elif t in INTEGRAL:
            out.append(F.col(f"`{c}`").cast("long").alias(name))
        else:
            out.append(F.col(f"`{c}`").alias(name))
    return df.select(*out)


def event_run(spark: SparkSession, sf_dir: str, **kw) -> ForecastRun:
    return ForecastRun(tables.event_observations(spark, sf_dir), event_config(), **kw)


def sinks_path(spark, name: str) -> str:
    from ..sources import sinks
    return sinks.shared_path(spark, name)


OBS_COLS = ["crop_type", "timestamp", "indoor_temperature_c", "humidity_pct"]
FEATURES = ["indoor_temperature_c", "humidity_pct"]


# ------------------------------------------------------------ ingest / functions

def q_missing_report(spark, d):
    return finish(clean.missing_report(tables.event_observations(spark, d, blanks=True).select(*OBS_COLS)))


def q_slugify(spark, d):
    part = tables.read_table(spark, d, "part")
    return finish(part.select(
        "p_partkey", slug_col(F.col("p_name")).alias("name_slug"), slug_col(F.col("p_type")).alias("type_slug"),
        normalize_col(F.col("p_brand")).alias("brand_norm"), display_key(F.col("p_brand")).alias("brand_display"),
        lookup_key(F.col("p_type")).alias("type_lookup")))


def raw_event_file(spark, d) -> DataFrame:
    """events re-expressed as a raw sensor file with free-form headers, all text."""
    ev = tables.read_table(spark, d, "events")
    return ev.select(
        F.col("ts").cast("string").alias("Recorded At"),
        F.col("event_type").alias("class"),
        F.col("value").cast("string").alias("Temp (C)"),
        F.get_json_object("props", "$.k").alias("RH"),
        F.col("user_id").cast("string").alias("Batch No"),
        F.col("event_id").alias("_order"),
    )


def q_alias_standardize(spark, d):
    std = standardize(raw_event_file(spark, d), "events.csv")
    return finish(std.select("timestamp", "crop_type", "indoor_temperature_c", "humidity_pct",
                             F.col("`Batch No`").alias("batch_no")))


def q_union_by_name(spark, d):
    ev = tables.event_observations(spark, d).select(*OBS_COLS)
    od = tables.order_day_series(spark, d)
    return finish(union_all([ev, od]))


# ------------------------------------------------------------------- cleaning

def _deduped(spark, d, obs=None):
    obs = obs if obs is not None else tables.event_observations(spark, d, blanks=True)
    return clean.dedupe_first(clean.drop_null_time(obs), ["crop_type", "timestamp"]).select(*OBS_COLS)


def q_dedupe_first(spark, d):
    return finish(_deduped(spark, d, tables.event_observations_twice(spark, d)))


def q_interpolate_linear(spark, d):
    from ..config import DEFAULT_EXEC
    from ..operators.series import group_size_bound, positions
    dd = _deduped(spark, d)
    bound = group_size_bound(dd, ["crop_type"])
    ranked = positions(dd, ["crop_type"], ["timestamp"], max_group=bound,
                       single_task_rows=DEFAULT_EXEC.block_rows)
    out = clean.interpolate_linear(ranked, "crop_type", FEATURES, DEFAULT_EXEC.block_rows,
                                   single_block=bound <= DEFAULT_EXEC.block_rows)
    return finish(out.select("crop_type", "timestamp", POS, *FEATURES))


def q_impute_median(spark, d):
    return finish(clean.fill_group_median(_deduped(spark, d), "crop_type", FEATURES))


def q_global_median_fill(spark, d):
    return finish(clean.fill_global_median(_deduped(spark, d), FEATURES))


LI_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _lineitem(spark, d):
    return tables.read_table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", *LI_MEASURES)


def q_clip_quantile(spark, d):
    return finish(clean.clip_quantile(_lineitem(spark, d), LI_MEASURES))


def q_clean_dataset(spark, d):
    run = event_run(spark, d)
    return finish(run.cleaned.select("crop_type", "timestamp", POS, *FEATURES))


def q_order_series_clean(spark, d):
    obs = tables.order_day_series(spark, d).withColumn("_order", F.lit(0))
    out = clean.clean_dataset(obs)
    return finish(out.select("crop_type", "timestamp", POS, "indoor_temperature_c", "n_orders"))


def q_correlation_matrix(spark, d):
    run = event_run(spark, d)
    return finish(models.correlation_matrix(run.cleaned, "crop_type", FEATURES))


# ------------------------------------------------------------------- windows

def q_min_group_filter(spark, d):
    run = event_run(spark, d)
    return finish(run.grouped.groupBy("crop_type").agg(F.max(SIZE).alias("samples_total")))


def q_minmax_fit(spark, d):
    run = event_run(spark, d)
    return finish(windows.params_long(run.params, ["crop_type"], run.features))


def q_minmax_scale(spark, d):
    run = event_run(spark, d)
    return finish(run.scaled.select("crop_type", "timestamp", *run.features))


def q_minmax_inverse(spark, d):
    run = event_run(spark, d)
    t = run.target
    j = run.scaled.join(run.params, ["crop_type"])
    restored = windows.inverse_expr(F.col(t), F.col(f"{t}__min"), F.col(f"{t}__max"))
    return finish(j.select("crop_type", "timestamp", restored.alias("restored_temperature_c")))


def q_global_scale(spark, d):
    run = event_run(spark, d)
    scaled, _ = windows.minmax_scale(run.selected, [], run.features)
    return finish(scaled.select("crop_type", "timestamp", *run.features))


def q_lineitem_scale(spark, d):
    scaled, _ = windows.minmax_scale(_lineitem(spark, d), ["l_returnflag"], LI_MEASURES)
    return finish(scaled)


def q_chrono_split(spark, d):
    run = event_run(spark, d)
    return finish(windows.chrono_split(run.grouped).select("crop_type", "timestamp", POS, "split"))


def q_sliding_windows(spark, d):
    run = event_run(spark, d)
    w = run.windows
    n = len(run.features) * run.cfg.sequence_length
    xs = [F.element_at("x", i + 1).alias(f"x{i + 1:02d}") for i in range(n)]
    return finish(w.select("crop_type", "timestamp", "split", "win", *xs, "y"))


LONG_STEPS = 168


def q_long_windows(spark, d):
    """W7 with 168 steps (a week of hours): windows as slices of blocks; sums over their slots."""
    run = ForecastRun(tables.event_observations(spark, d), replace(event_config(), sequence_length=LONG_STEPS))
    w = run.all_windows
    n = len(run.features)

    def total(f):
        return F.aggregate(F.filter("x", lambda _, i: i % n == f), F.lit(0.0), lambda a, v: a + v)

    sums = [total(f).alias(f"sum_{name}") for f, name in enumerate(run.features)]
    return finish(w.select("crop_type", "timestamp", "split", "win", F.size("x").alias("slots"), F.element_at("x", 1).alias("oldest"),
                           F.element_at("x", -n).alias("newest"), *sums, "y", "is_fit", "is_val"), 4)


def q_fit_val_split(spark, d):
    run = event_run(spark, d)
    return finish(windows.window_counts(run.windows))


# -------------------------------------------------------------------- models

def q_persistence_forecast(spark, d):
    run = event_run(spark, d)
    return finish(run.predictions_for("naive_persistence"))


def q_ar1_forecast(spark, d):
    run = event_run(spark, d)
    return finish(run.predictions_for("linear_baseline"))


def q_validation_rmse(spark, d):
    run = event_run(spark, d)
    return finish(ensemble.validation_rmse(run.predictions, "crop_type"))


def q_ensemble_weights(spark, d):
    return finish(event_run(spark, d).weights)


def q_hybrid_forecast(spark, d):
    return finish(event_run(spark, d).forecast)


def q_coordination_label(spark, d):
    return finish(event_run(spark, d).label)


# ------------------------------------------------------------------- metrics

def q_regression_metrics(spark, d):
    run = event_run(spark, d)
    return finish(metrics.regression_metrics(run.forecast, ["crop_type"], "actual_temperature_c",
                                             "predicted_temperature_c"))


def q_model_comparison(spark, d):
    return finish(event_run(spark, d).comparison)


def q_overall_ranking(spark, d):
    return finish(metrics.overall_ranking(event_run(spark, d).comparison))


def q_top_ranking(spark, d):
    return finish(metrics.top_ranking(metrics.overall_ranking(event_run(spark, d).comparison), 5))


def q_best_model(spark, d):
    return finish(metrics.best_model(event_run(spark, d).comparison, "crop_type"))


def q_threshold_actions(spark, d):
    return finish(event_run(spark, d).actions)


def q_control_summary(spark, d):
    return finish(metrics.control_summary(event_run(spark, d).actions, ["crop_type"]))


def q_crop_results(spark, d):
    return finish(event_run(spark, d).crop_results)


def q_performance_report(spark, d):
    perf = event_run(spark, d).performance
    line = F.format_string("%s: off by %.4f on average (root mean square %.4f, %.2f percent), r2 %.4f over %d rows",
                           "crop_type", "mae", "rmse", "mape_pct", "r2", F.col("sample_count").cast("long"))
    return finish(perf.withColumn("report_line", line))


def q_dataset_summary(spark, d):
    run = event_run(spark, d)
    return finish(metrics.dataset_summary(run.observations.select(*OBS_COLS), run.cleaned, run.selected,
                                          run.scaled, run.features))


def q_run_status(spark, d):
    run = event_run(spark, d)
    return finish(metrics.run_status(run.cleaned, run.grouped, run.forecast, "crop_type"))


# ------------------------------------------------------------------- reports

def q_prediction_pivot(spark, d):
    run = event_run(spark, d)
    model_names = sorted(run.model_set)
    piv = (run.test_original.filter(F.col("model") != HYBRID_MODEL)
           .groupBy("crop_type", "timestamp").pivot("model", model_names).agg(F.first("yhat")))
    piv = piv.select("crop_type", "timestamp", *[F.col(m).alias(f"pred_{m}_c") for m in model_names])
    return finish(run.forecast.join(piv, ["crop_type", "timestamp"], "left"))


def q_last_k_rows(spark, d, k: int = 8, step: int | None = None):
    """The newest k forecast rows per key up to a step (1-based position; the last by default), with actions.

    A bare ``row_number() <= k`` lets Spark keep k rows per key before the shuffle.
    """
    run = event_run(spark, d)
    return finish(reports.last_rows(run.forecast.join(
        run.actions.select("crop_type", "timestamp", "action"), ["crop_type", "timestamp"]), "crop_type", k, step))


def q_last_k_rows_at_step(spark, d):
    """R8 with a step: the 8 forecast rows per key up to its 100th."""
    return q_last_k_rows(spark, d, 8, 100)


def q_hybrid_gain(spark, d):
    cmp = event_run(spark, d).comparison
    single = cmp.filter(F.lower("model") != HYBRID_MODEL).groupBy("crop_type").agg(
        F.min_by("model", F.struct("rmse", "model")).alias("best_single_model"),
        F.min("rmse").alias("best_single_rmse"))
    hyb = cmp.filter(F.lower("model") == HYBRID_MODEL).select("crop_type", F.col("rmse").alias("hybrid_rmse"))
    return finish(single.join(hyb, ["crop_type"]).withColumn(
        "hybrid_gain", F.col("best_single_rmse") - F.col("hybrid_rmse")))


def q_dashboard_metrics(spark, d):
    """Per-key metrics, null-safe numbers, joined on the lower-cased key."""
    run = event_run(spark, d)
    perf = run.performance.alias("p")
    keys = run.grouped.select("crop_type").distinct().alias("k")
    j = keys.join(perf, lookup_key(F.col("k.crop_type")) == lookup_key(F.col("p.crop_type")), "left")
    return finish(j.select(
        display_key(F.col("k.crop_type")).alias("crop_label"), F.col("k.crop_type").alias("crop_type"),
        *[json_number(F.col(f"p.{c}")).alias(c) for c in ("mae", "rmse", "mape_pct", "r2")]))


def q_plot_series(spark, d):
    run = event_run(spark, d)
    t = run.test_original
    actual = t.filter(F.col("model") == HYBRID_MODEL).select(
        "crop_type", "timestamp", F.lit("actual").alias("series"), F.col("y").alias("value"))
    models_ = t.select("crop_type", "timestamp", F.col("model").alias("series"), F.col("yhat").alias("value"))
    return finish(actual.unionByName(models_))


def q_plot_tables(spark, d):
    """The data behind every chart, long form."""
    run = event_run(spark, d)
    return finish(reports.plot_tables(run.cleaned, run.selected, run.scaled, run.forecast, run.comparison,
                                      metrics.overall_ranking(run.comparison), run.actions, run.target))


def q_dashboard_bundle(spark, d):
    """K1-K8 + S6 + R5/R7 + J4/J5: write every artifact, read index and payloads back, assemble."""
    from ..sources import sinks
    from .forecast import EVENT_THRESHOLDS
    from .workflow import load_bundle, run_workflow
    paths = run_workflow(spark, tables.event_observations(spark, d), sinks.shared_path(spark, "workflow"),
                         event_config())
    return load_bundle(spark, paths, EVENT_THRESHOLDS)


def q_ui_payload(spark, d):
    return event_run(spark, d).payload()


def comparison_reports(run) -> DataFrame:
    """Per key a JSON document of its models, best first, and the same as text."""
    cmp = run.comparison
    rows = cmp.groupBy("crop_type").agg(
        F.array_sort(F.collect_list(F.struct(F.col("rank").alias("place"), "model", "rmse", "mae", "r2"))).alias("models"))
    best = F.get("models", F.lit(0))
    doc = F.struct(F.col("crop_type").alias("key"), best["model"].alias("winner"), best["rmse"].alias("winner_rmse"), "models")
    lines = F.transform("models", lambda r: F.format_string(
        "%d. %s (rmse %.4f, mae %.4f, r2 %.4f)", r["place"].cast("int"), r["model"], r["rmse"], r["mae"], r["r2"]))
    text = F.concat(F.lit("Models of "), F.col("crop_type"), F.lit(", best first:\n"), F.array_join(lines, "\n"))
    return rows.select("crop_type", F.to_json(doc).alias("document"), text.alias("text"))


def q_comparison_report(spark, d):
    """Documents and text."""
    return comparison_reports(event_run(spark, d))


def q_comparison_report_rows(spark, d):
    """R3, K7 checked by value: the documents written as JSON lines, read back and flattened; text lines counted."""
    from ..sources import sinks
    reports_ = comparison_reports(event_run(spark, d))
    path = sinks.write_json_documents(reports_.select("crop_type", "document", F.size(F.split("text", "\n")).alias("lines")),
                                      sinks.shared_path(spark, "reports"))
    back = sinks.read_json(spark, path, "crop_type string, document string, lines int")
    shape = "key string, winner string, winner_rmse double, models array<struct<place: int, model: string, rmse: double, mae: double, r2: double>>"
    doc = back.select("crop_type", "lines", F.from_json("document", shape).alias("j"))
    each = doc.select("crop_type", "lines", "j.winner", "j.winner_rmse", F.explode("j.models").alias("m"))
    return finish(each.select("crop_type", "lines", "winner", "winner_rmse", F.col("m.place").alias("place"), "m.model", "m.rmse", "m.mae", "m.r2"))


def q_scaled_export(spark, d):
    """K2 + S6: scaled features exported by key as CSV, read back."""
    from ..sources import sinks
    run = event_run(spark, d)
    path = sinks.export_by_key(run.scaled.select("crop_type", "timestamp", *run.features), sinks.shared_path(spark, "scaled"))
    return finish(sinks.read_csv(spark, path, "crop_type string, timestamp timestamp_ntz, indoor_temperature_c double, humidity_pct double"
                                 ).drop("key_slug"))


def q_params_export(spark, d):
    """K3 + S6: scaling parameters as JSON lines, read back."""
    from ..sources import sinks
    run = event_run(spark, d)
    path = sinks.write_params(windows.params_long(run.params, ["crop_type"], run.features), sinks.shared_path(spark, "params"))
    return finish(sinks.read_json(spark, path, "crop_type string, feature string, min_val double, max_val double"))


def q_windows_export(spark, d):
    """K4 + S6: the window table by key, read back; targets and sums over the slots."""
    from ..sources import sinks
    path = sinks.write_windows(event_run(spark, d).windows, sinks.shared_path(spark, "windows"))
    back = spark.read.parquet(path)
    return finish(back.select("crop_type", "timestamp", "split", "win", F.size("x").alias("slots"),
                              F.aggregate("x", F.lit(0.0), lambda a, v: a + v).alias("total"), "y"))


def q_actions_export(spark, d):
    """K5 + S6: control actions exported by key as CSV, read back."""
    from ..sources import sinks
    path = sinks.export_by_key(event_run(spark, d).actions, sinks.shared_path(spark, "actions"))
    schema = ("timestamp timestamp_ntz, crop_type string, predicted_temperature_c double, action string, fan_on int, spray_on int, "
              "status_note string")
    return finish(sinks.read_csv(spark, path, schema).drop("key_slug"))


def q_predictions_export(spark, d):
    """K5 + S6: the forecast with a column a model, exported by key as CSV, read back."""
    from ..sources import sinks
    path = sinks.export_by_key(q_prediction_pivot(spark, d), sinks.shared_path(spark, "predictions"))
    schema = ("crop_type string, timestamp timestamp_ntz, actual_temperature_c double, predicted_temperature_c double, "
              "absolute_error_c double, pred_linear_baseline_c double, pred_naive_persistence_c double")
    return finish(sinks.read_csv(spark, path, schema).drop("key_slug"))


def q_status_text(spark, d):
    """K8: the run's status as a text report, read back."""
    from ..sources import sinks
    run = event_run(spark, d)
    status = metrics.run_status(run.cleaned, run.grouped, run.forecast, "crop_type")
    line = F.format_string("keys: %d found, %d processed, %d exported", "keys_discovered", "keys_processed", "keys_exported")
    path = sinks.write_text_report(status.select(line.alias("line")), sinks.shared_path(spark, "status"))
    return spark.read.text(path).select(F.col("value").alias("line"))


def q_export_roundtrip(spark, d):
    """K1 + S6: per-key CSV export of the cleaned series, read back from the shared folder."""
    from ..sources import sinks
    cleaned = event_run(spark, d).cleaned.select("crop_type", "timestamp", POS, *FEATURES)
    path = sinks.export_by_key(cleaned, sinks.shared_path(spark, "export"), "crop_type", "csv")
    schema = "crop_type string, timestamp timestamp_ntz, _pos long, indoor_temperature_c double, humidity_pct double"
    return finish(sinks.read_csv(spark, path, schema))


def q_external_predictions(spark, d):
    """Predictions produced elsewhere (here: persisted persistence forecasts) join the windows."""
    from ..sources import sinks
    run = event_run(spark, d)
    made = run.predictions_for("naive_persistence").select(
        "crop_type", "timestamp", "split", F.lit("external_persistence").alias("model"), "yhat")
    path = sinks.shared_path(spark, "external")
    made.write.mode("overwrite").parquet(path)
    external = spark.read.parquet(path)
    return finish(models.external_predictions(run.windows, external, "crop_type"))


def q_model_registry_notes(spark, d):
    """(key, model, predictions, bad ones, note) for every model of the run."""
    return finish(event_run(spark, d).registry)


def q_key_eligibility(spark, d):
    """Window counts per key and, for skipped keys, the reason (keys: users, so that many are short)."""
    ev = tables.read_table(spark, d, "events")
    sizes = ev.groupBy(F.col("user_id").cast("string").alias("crop_type")).agg(F.count(F.lit(1)).alias(SIZE))
    return finish(windows.eligibility(sizes, "crop_type", 12))


def q_external_ensemble(spark, d):
    """M10 in the ensemble: a model made elsewhere (mean of the two baselines, persisted) gets weights too."""
    from ..sources import sinks
    run = event_run(spark, d)
    made = run.predictions.groupBy("crop_type", "timestamp", "split").agg(F.avg("yhat").alias("yhat")).withColumn(
        "model", F.lit("external_mean"))
    path = sinks.shared_path(spark, "external-mean")
    made.write.parquet(path)
    return finish(event_run(spark, d, external=spark.read.parquet(path)).weights)


def q_raw_ingest(spark, d):
    """Events written as raw CSV folders of four headers and time formats, read back.

    ``okra.csv`` has neither key nor time (P5: the key is in its name, P8: hours by row position, hence one file);
    ``days`` has day offsets instead of times (P7).
    """
    from ..sources import sinks
    from ..sources.ingest import load_sources
    ev = tables.read_table(spark, d, "events")
    part = F.col("event_id") % 4
    code = F.get_json_object("props", "$.k")
    value = F.col("value").cast("string")
    parts = {
        "us": ev.filter(part == 0).select(
            F.date_format("ts", "MM/dd/yyyy HH:mm:ss").alias("Recorded At"), F.col("event_type").alias("Class"),
            value.alias("Temp (C)"), code.alias("RH")),
        "iso": ev.filter(part == 1).select(
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("time"), F.upper("event_type").alias("crop"),
            F.when(code.try_cast("double") >= tables.EVENT_INVALID_CODE, F.lit("NA")).otherwise(value).alias("temperature"),
            code.alias("humidity")),
        "named": ev.filter(part == 2).coalesce(1).sortWithinPartitions("event_id").select(value.alias("air_temperature")),
        "days": ev.filter(part == 3).select((F.col("event_id") / 8).cast("string").alias("Day"), F.col("event_type").alias("Species"),
                                            value.alias("Temp C"), code.alias("Humidity")),
    }
    folders = []
    for name, rows in parts.items():
        folders.append(sinks.shared_path(spark, "raw", name))
        rows.write.option("header", True).csv(folders[-1])
    sinks.rename_part(spark, folders[2], "okra.csv")
    return finish(load_sources(spark, folders).select("crop_type", "timestamp", "indoor_temperature_c", "humidity_pct"))


def q_json_documents(spark, d):
    """One indented JSON document a key, one of them cut off, read back over several lines each."""
    from ..sources import sinks
    ev = tables.read_table(spark, d, "events")
    per = ev.groupBy(F.col("event_type").alias("crop_type")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.round("value", 2).cast("decimal(18,2)")).cast("double").alias("total"),
        F.array_sort(F.collect_set(F.get_json_object("props", "$.k").try_cast("int"))).alias("codes"))
    doc = per.select(F.col("crop_type").alias("name"), F.struct("crop_type", F.struct("rows", "total").alias("summary"), "codes").alias("doc"))
    path = sinks.write_documents(doc.filter("name <> 'error'"), sinks.shared_path(spark, "documents"), "name", "doc")
    broken = doc.filter("name = 'error'").select("name", F.expr("left(to_json(doc, map('pretty', 'true')), 40)").alias("value"))
    broken.write.mode("append").partitionBy("name").text(path)
    schema = "crop_type string, summary struct<rows: bigint, total: double>, codes array<int>"
    back = sinks.read_documents(spark, path, schema)
    return finish(back.select("name", "crop_type", F.coalesce("summary.rows", F.lit(-1)).alias("rows"), "summary.total",
                              F.coalesce(F.size("codes"), F.lit(-1)).alias("n_codes"),
                              F.col(sinks.CORRUPT).isNotNull().alias("broken")))


def q_payload_rows(spark, d, page_rows: int = 500):
    """R4 flattened: one row per (key, page, position), with small pages so that keys have several."""
    rows = reports.payload_rows(event_run(spark, d).payload(page_rows), "crop_type", ("model_coordination", "best_model"))
    return finish(rows.withColumn("row_pos", F.col("row_pos").cast("long")))


def q_bundle_rows(spark, d, page_rows: int = 500):
    """K1-K8, R5, R7, J5 flattened: artifacts written, index and payload pages read back and assembled."""
    from ..sources import sinks
    from .forecast import EVENT_THRESHOLDS
    from .workflow import load_bundle, run_workflow
    paths = run_workflow(spark, tables.event_observations(spark, d), sinks.shared_path(spark, "workflow"),
                         event_config(), page_rows=page_rows)
    bundle = load_bundle(spark, paths, EVENT_THRESHOLDS).withColumn("rmse", F.col("metrics.rmse").cast("double"))
    rows = reports.payload_rows(bundle, "crop_type", ("crop_label", "pages", "rmse"))
    return finish(rows.select("crop_type", "crop_label", "pages", "page", "row_pos", "timestamps", "actions",
                              F.col("predicted_temperature_c").cast("double").alias("predicted_temperature_c"), "rmse"))


ALL_MODELS = ("knn_regressor", "linear_regression", "random_forest", "gradient_boosting", "svr_rbf")


def q_hybrid_all_models(spark, d):
    """The full model set of the source workflow through the ensemble; per key x model accuracy."""
    return finish(event_run(spark, d, model_set=ALL_MODELS).comparison)


def q_all_models_ensemble(spark, d):
    """The full model set checked by what must hold: its weights sum to 1, stay in their bounds, and rank every model."""
    run = event_run(spark, d, model_set=ALL_MODELS)
    w = run.weights.groupBy("crop_type").agg(
        F.count(F.lit(1)).alias("models"), F.sum("weight").alias("total"),
        F.count_if((F.col("weight") < 0.03 - 1e-6) | (F.col("weight") > 0.70 + 1e-6)).alias("outside"))
    ranked = run.comparison.groupBy("crop_type").agg(F.max("rank").alias("ranked"), F.count_if(F.col("rmse").isNull()).alias("unscored"))
    n = run.forecast.groupBy("crop_type").agg(F.count(F.lit(1)).alias("forecast_rows"))
    return finish(w.join(ranked, ["crop_type"]).join(n, ["crop_type"]))


# ------------------------------------------------- fitted models, all keys together

def _model(spark, d, name, **kw):
    run = event_run(spark, d, model_set=(name,), **kw)
    return finish(run.predictions_for(name))


def q_linear_regression(spark, d):
    return _model(spark, d, "linear_regression")


def q_random_forest(spark, d):
    """M2."""
    return _model(spark, d, "random_forest")


def q_gbt(spark, d):
    """M3."""
    return _model(spark, d, "gradient_boosting")


def q_rbf_regression(spark, d):
    """M5."""
    return _model(spark, d, "svr_rbf")


def q_second_boosting(spark, d):
    """M6: the second boosted configuration."""
    return _model(spark, d, "xgboost")


def _per_window(run, name) -> DataFrame:
    """(crop_type, split, model, n, unusual): predictions per split, and how many are null or not finite."""
    p = run.predictions_for(name)
    bad = F.col("yhat").isNull() | F.isnan("yhat") | (F.abs("yhat") == float("inf"))
    return p.groupBy("crop_type", "split", "model").agg(F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("unusual"))


def q_boosting_loss(spark, d):
    """M3, M6: per key the training loss after each quarter of the rounds; it falls from quarter to quarter.

    ``falls`` compares the mean squared residual of the fit windows after 1/4, 2/4, 3/4 and all rounds
    with the one after the first round.
    """
    run = event_run(spark, d)
    out = []
    for name, rounds in (("gradient_boosting", run.boost_rounds), ("xgboost", run.second_rounds)):
        nodes = run.fitted(name)
        loss = trees.staged_loss(run.windows, nodes, "crop_type", run.dim, [1, *[rounds * q // 4 for q in (1, 2, 3, 4)]])
        at = [F.get("loss", F.lit(i)) for i in range(5)]
        falls = (at[1] < at[0]) & (at[2] < at[1]) & (at[3] < at[2]) & (at[4] < at[3])
        out.append(loss.select("crop_type", F.lit(name).alias("model"), F.col("n").alias("fit_windows"), falls.alias("falls")))
    return finish(out[0].unionByName(out[1]))


def q_model_rows(spark, d):
    """M2, M3, M5, M6: every fitted model gives every validation and test window one finite prediction."""
    run = event_run(spark, d)
    out = [_per_window(run, name) for name in ("random_forest", "gradient_boosting", "xgboost", "svr_rbf")]
    return finish(out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3]))


def q_kernel_first_order(spark, d):
    """M5 checked by its first-order condition: the mean gradient of its loss is zero in every slot of every key."""
    run = event_run(spark, d)
    moments = kernel.first_order(run.windows, run.fitted("svr_rbf"), "crop_type", run.dim)
    return finish(moments.select("crop_type", "slot", F.abs(F.round("moment", 6)).alias("moment")))


def q_linear_regression_normal(spark, d):
    """M1 checked by its normal equations: mean of residual times each centred slot over fit windows is zero."""
    run = event_run(spark, d)
    dim = len(run.features) * run.cfg.sequence_length
    fit = run.windows.filter("is_fit").join(models.ols_coefficients(run.windows, "crop_type", dim), ["crop_type"])
    res = F.col("y") - (F.col("intercept") + models.dot_product(F.col("x"), F.col("coef"), dim))
    slots = F.explode(F.array(F.struct(F.lit(0).alias("slot"), res.alias("v")), *[
        F.struct(F.lit(i).alias("slot"), (res * F.element_at("x", i)).alias("v")) for i in range(1, dim + 1)]))
    return finish(fit.select("crop_type", slots.alias("s")).groupBy("crop_type", F.col("s.slot").alias("slot")).agg(
        F.abs(F.round(F.avg("s.v"), 6)).alias("moment")))


def q_forest_bounds(spark, d):
    """M2 checked by what must hold for any forest: one prediction per window, none outside the fit targets."""
    run = event_run(spark, d, model_set=("random_forest",))
    span = run.windows.filter("is_fit").groupBy("crop_type").agg(F.min("y").alias("lo"), F.max("y").alias("hi"))
    j = run.predictions.join(span, ["crop_type"])
    return finish(j.groupBy("crop_type", "split").agg(
        F.count(F.lit(1)).alias("n"), F.count_if((F.col("yhat") < F.col("lo") - 1e-9) | (F.col("yhat") > F.col("hi") + 1e-9)).alias("outside")))


def q_feature_importance(spark, d):
    """M13."""
    run = event_run(spark, d)
    return finish(trees.importances(run.fitted("random_forest"), "crop_type", models.feature_names(run.features, run.cfg.sequence_length)))


def q_importance_shares(spark, d):
    """M13 checked: per key one importance a slot, none negative, and they sum to 1."""
    run = event_run(spark, d)
    imp = trees.importances(run.fitted("random_forest"), "crop_type", models.feature_names(run.features, run.cfg.sequence_length))
    return finish(imp.groupBy("crop_type").agg(F.count_distinct("feature").alias("features"), F.sum("importance").alias("total"),
                                               F.count_if(F.col("importance") < 0).alias("negative")))


def q_stored_linear_forecast(spark, d):
    """The AR(1) model stored as a version, read back and scored by join, without a fit."""
    from . import store
    run = event_run(spark, d)
    folder = store.save(run, sinks_path(spark, "models"), ("linear_baseline",))
    return finish(store.score(run.windows, store.load(spark, folder), run.cfg.key))


def q_stored_models_match(spark, d):
    """Models of every kind stored, read back and scored against the run that fitted them."""
    from . import store
    names = ("linear_regression", "gradient_boosting", "xgboost", "svr_rbf")
    run = event_run(spark, d, model_set=names)
    folder = store.save(run, sinks_path(spark, "models"), names)
    scored = store.score(run.windows, store.load(spark, folder), run.cfg.key).select(
        "crop_type", "timestamp", "split", "model", F.col("yhat").alias("stored"))
    j = run.predictions.join(scored, ["crop_type", "timestamp", "split", "model"], "full")
    return finish(j.groupBy("crop_type", "split", "model").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.coalesce(F.abs(F.col("yhat") - F.col("stored")), F.lit(1.0))).alias("worst")))


def queries() -> dict[str, Query]:
    from ..operators.knn import q_knn_forecast, q_knn_recall
    from ..streaming.control_stream import stream_queries
    out = {name[2:]: fn for name, fn in globals().items() if name.startswith("q_") and callable(fn)}
    from ..streaming.event_time import q_event_time_counts, q_event_time_dedupe
    out |= {"event_time_counts": q_event_time_counts, "event_time_dedupe": q_event_time_dedupe}
    return out | {"knn_forecast": q_knn_forecast, "knn_recall": q_knn_recall} | stream_queries()
