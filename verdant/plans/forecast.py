"""End-to-end forecasting and control flow as lazy DataFrame stages.

``ForecastRun`` builds every stage of the flow once per run and exposes them
as DataFrames; nothing is collected to the driver but single counts.  The
stages are keyed by the series key column, so the same run handles five keys
or five million, with every model.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_EXEC, GB_ROUNDS, HYBRID_MODEL, RF_TREES, XGB_ROUNDS, ExecutionConfig, ForecastConfig
from ..functions.values import iso_text
from ..operators import clean, control, ensemble, kernel, metrics, models, trees, windows
from ..operators.series import SIZE, join_small
from ..session import materialize

# Fixed values for the driver's events table: thresholds on its value scale.
EVENT_THRESHOLDS = {"low": 20.0, "high": 60.0, "spray": 100.0}


def event_config() -> ForecastConfig:
    return ForecastConfig(preferred_model="linear_baseline", **EVENT_THRESHOLDS)


@dataclass
class ForecastRun:
    observations: DataFrame
    cfg: ForecastConfig = field(default_factory=ForecastConfig)
    exec_cfg: ExecutionConfig = DEFAULT_EXEC
    model_set: tuple[str, ...] = ("naive_persistence", "linear_baseline")
    forest_trees: int = RF_TREES
    boost_rounds: int = GB_ROUNDS
    second_rounds: int = XGB_ROUNDS
    # (key, timestamp, split, model, yhat) in scaled units, produced elsewhere.
    external: DataFrame | None = None

    # ------------------------------------------------------------- cleaning
    @cached_property
    def cleaned(self) -> DataFrame:
        self._stats: dict = {}
        return clean.clean_dataset(self.observations, self.cfg.key, self.cfg.time,
                                   block_rows=self.exec_cfg.block_rows,
                                   single_task_values=self.exec_cfg.single_task_values,
                                   stats=self._stats)

    @property
    def n_keys(self) -> int | None:
        """Measured upper bound on the number of keys (from the cleaning stats job)."""
        self.cleaned
        return self._stats.get("groups")

    @cached_property
    def _selection(self):
        return clean.select_features(self.cleaned, self.cfg.target, self.cfg.time, self.cfg.key)

    @property
    def selected(self) -> DataFrame:
        return self._selection[0]

    @property
    def target(self) -> str:
        return self._selection[1]

    @property
    def features(self) -> list[str]:
        return self._selection[2]

    @property
    def target_index(self) -> int:
        return self.features.index(self.target)

    # -------------------------------------------------------------- windows
    @cached_property
    def grouped(self) -> DataFrame:
        return windows.min_group_filter(self.selected, self.cfg.effective_min_samples)

    @cached_property
    def _scaling(self):
        return windows.minmax_scale(self.grouped, [self.cfg.key], self.features, n_keys=self.n_keys)

    @property
    def scaled(self) -> DataFrame:
        return self._scaling[0]

    @property
    def params(self) -> DataFrame:
        return self._scaling[1]

    @cached_property
    def all_windows(self) -> DataFrame:
        return windows.sliding_windows(self.scaled, self.cfg.key, self.target, self.features,
                                       self.cfg.sequence_length, self.cfg.test_ratio,
                                       self.cfg.validation_ratio, self.exec_cfg.block_rows, self.cfg.time)

    @cached_property
    def windows(self) -> DataFrame:
        # Read by every model and by the validation bookkeeping: cut lineage once.
        return materialize(windows.eligible(self.all_windows))

    # --------------------------------------------------------------- models
    def predictions_for(self, name: str) -> DataFrame:
        k, nf, ti = self.cfg.key, len(self.features), self.target_index
        if name == "naive_persistence":
            return models.persistence_forecast(self.windows, k, nf, ti, self.cfg.sequence_length)
        if name == "linear_baseline":
            return models.ar1_forecast(self.windows, k, nf, ti, n_keys=self.n_keys)
        if name == "linear_regression":
            return models.ols_forecast(self.windows, k, nf * self.cfg.sequence_length, n_keys=self.n_keys)
        if name == "knn_regressor":
            from ..operators.knn import knn_forecast
            return knn_forecast(self.windows, k, nf * self.cfg.sequence_length)
        if name == "svr_rbf":
            return kernel.kernel_forecast(self.windows, self.fitted(name), k, self.dim)
        return trees.tree_forecast(self.windows, self.fitted(name), k, self.dim, name)

    @property
    def dim(self) -> int:
        """Slots of a flattened window."""
        return len(self.features) * self.cfg.sequence_length

    @cached_property
    def _fits(self) -> dict:
        return {}

    def fitted(self, name: str) -> DataFrame:
        """Model table of a tree, kernel or linear model, fitted once a run (M9): see ``plans.store``."""
        fits = {
            "random_forest": lambda: trees.forest(self.windows, self.cfg.key, self.dim, self.forest_trees),
            "gradient_boosting": lambda: trees.boosted(self.windows, self.cfg.key, self.dim, self.boost_rounds),
            "xgboost": lambda: trees.second_boosted(self.windows, self.cfg.key, self.dim, self.second_rounds),
            "svr_rbf": lambda: kernel.kernel_models(self.windows, self.cfg.key, self.dim),
            "linear_regression": lambda: models.ols_coefficients(self.windows, self.cfg.key, self.dim, n_keys=self.n_keys),
            "linear_baseline": lambda: models.ar1_params(self.windows, self.cfg.key, len(self.features), self.target_index),
        }
        if name not in fits:
            raise ValueError(f"{name} is not a fitted model")
        if name not in self._fits:
            self._fits[name] = fits[name]()
        return self._fits[name]

    @cached_property
    def eligibility(self) -> DataFrame:
        """One row per key of the cleaned data: window counts and, where it is skipped, why."""
        k = self.cfg.key
        sizes = self.cleaned.groupBy(k).agg(F.max(SIZE).alias(SIZE))
        return windows.eligibility(sizes, k, self.cfg.effective_min_samples, self.cfg.sequence_length, self.cfg.test_ratio)

    @cached_property
    def predictions(self) -> DataFrame:
        parts = [self.predictions_for(m) for m in self.model_set]
        if self.external is not None:
            parts.append(models.external_predictions(self.windows, self.external, self.cfg.key))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return materialize(out)

    @cached_property
    def registry(self) -> DataFrame:
        """What happened to every requested model of every key."""
        names = list(self.model_set)
        if self.external is not None:
            names += [r[0] for r in self.external.select("model").distinct().collect()]  # one row per model
        return models.registry_notes(self.predictions, self.weights, self.eligibility, self.cfg.key, names)

    def require_results(self) -> None:
        """Raise where nothing could be forecast: no key goes on, or no key has a valid model."""
        if self.windows.isEmpty():
            raise ValueError("no key has enough rows to forecast; see the eligibility table")
        if self.weights.isEmpty():
            raise ValueError("no model has complete, finite predictions; see the registry table")

    # ------------------------------------------------------------- ensemble
    @cached_property
    def weights(self) -> DataFrame:
        return ensemble.coordinate(self.predictions, self.cfg.key, self.cfg.preferred_model)

    @cached_property
    def hybrid(self) -> DataFrame:
        n = self.n_keys * (len(self.model_set) + 1) if self.n_keys is not None else None
        return ensemble.hybrid_forecast(self.predictions, self.weights, self.cfg.key, n)

    @cached_property
    def label(self) -> DataFrame:
        return ensemble.coordination_label(self.weights, self.cfg.key)

    # ------------------------------------------------- original-unit tables
    def to_original(self, preds: DataFrame) -> DataFrame:
        """Join the target's scaling params and invert y and yhat."""
        t = self.target
        p = self.params.select(self.cfg.key, F.col(f"{t}__min").alias("_mn"), F.col(f"{t}__max").alias("_mx"))
        j = join_small(preds, p, [self.cfg.key], "left", self.n_keys)
        inv = windows.inverse_expr
        return j.select(self.cfg.key, "timestamp", "split", "model",
                        inv(F.col("y"), F.col("_mn"), F.col("_mx")).alias("y"),
                        inv(F.col("yhat"), F.col("_mn"), F.col("_mx")).alias("yhat"))

    @cached_property
    def test_original(self) -> DataFrame:
        """All test predictions (models + hybrid) in original units."""
        test = self.predictions.filter(F.col("split") == "test").unionByName(self.hybrid)
        return self.to_original(test)

    @cached_property
    def forecast(self) -> DataFrame:
        """Per key and time: actual, hybrid prediction and absolute error (original units)."""
        h = self.test_original.filter(F.col("model") == HYBRID_MODEL)
        return h.select(self.cfg.key, "timestamp",
                        F.col("y").alias("actual_temperature_c"),
                        F.col("yhat").alias("predicted_temperature_c"),
                        metrics.absolute_error(F.col("y"), F.col("yhat")).alias("absolute_error_c"))

    @cached_property
    def comparison(self) -> DataFrame:
        return metrics.model_comparison(self.test_original, self.cfg.key)

    @cached_property
    def actions(self) -> DataFrame:
        return control.simulate_actions(self.forecast, self.cfg.low, self.cfg.high, self.cfg.spray,
                                        self.cfg.time, self.cfg.key)

    @cached_property
    def performance(self) -> DataFrame:
        """R2 rows: hybrid accuracy per key in original units plus the coordination label."""
        m = metrics.regression_metrics(self.forecast, [self.cfg.key], "actual_temperature_c",
                                       "predicted_temperature_c")
        return m.join(self.label, [self.cfg.key], "left").withColumnRenamed("model_coordination", "backend")

    @cached_property
    def crop_results(self) -> DataFrame:
        """One row per processed key."""
        k = self.cfg.key
        sizes = self.grouped.groupBy(k).agg(F.max(SIZE).alias("samples_total"))
        counts = self.windows.groupBy(k).agg(
            F.count_if(F.col("split") == "train").alias("train_sequences"),
            F.count_if(F.col("split") == "test").alias("test_sequences")).join(sizes, [k])
        best = metrics.best_model(self.comparison, k)
        summary = metrics.control_summary(self.actions, [k])
        return (counts.join(self.label, [k]).join(best, [k]).join(self.performance.drop("backend"), [k])
                .join(summary, [k])
                .withColumn("target_column", F.lit(self.target)))

    def payload(self, page_rows: int = 10000) -> DataFrame:
        """Nested rows with parallel arrays, weight maps and comparison rows.

        Arrays hold at most ``page_rows`` consecutive forecast rows: one row
        per (key, page), so no task ever gathers a whole large series.
        """
        from ..operators.series import group_size_bound, positions
        k = self.cfg.key
        f = self.forecast.join(self.actions.select(k, "timestamp", "action", "fan_on", "spray_on"),
                               [k, "timestamp"])
        bound = group_size_bound(f, [k])
        f = positions(f, [k], ["timestamp"], max_group=bound, single_task_rows=self.exec_cfg.block_rows)
        f = f.withColumn("page", F.floor((F.col("_pos") - 1) / F.lit(page_rows)).cast("long"))
        rows = F.array_sort(F.collect_list(F.struct(
            "timestamp", "actual_temperature_c", "predicted_temperature_c", "absolute_error_c",
            "action", "fan_on", "spray_on")))
        series = f.groupBy(k, "page").agg(rows.alias("r")).select(
            k, "page",
            F.transform("r", lambda s: iso_text(s["timestamp"])).alias("timestamps"),
            F.transform("r", lambda s: F.bround(s["actual_temperature_c"], 4)).alias("actual_temperature_c"),
            F.transform("r", lambda s: F.bround(s["predicted_temperature_c"], 4)).alias("predicted_temperature_c"),
            F.transform("r", lambda s: F.bround(s["absolute_error_c"], 4)).alias("absolute_error_c"),
            F.transform("r", lambda s: s["action"]).alias("actions"),
            F.transform("r", lambda s: s["fan_on"]).alias("fan_on"),
            F.transform("r", lambda s: s["spray_on"]).alias("spray_on"))
        w = self.weights.groupBy(k).agg(
            F.map_from_entries(F.collect_list(F.struct("model", "weight"))).alias("model_weights"),
            F.map_from_entries(F.collect_list(F.struct("model", "validation_rmse"))).alias("validation_rmse"))
        cmp = self.comparison.groupBy(k).agg(F.array_sort(F.collect_list(
            F.struct("rank", "model", "mae", "rmse", "r2"))).alias("model_comparison"))
        pages = f.select(k, "timestamp", "page")
        model_series = self.test_original.join(pages, [k, "timestamp"]).groupBy(k, "page", "model").agg(
            F.array_sort(F.collect_list(F.struct("timestamp", "yhat"))).alias("s")
        ).groupBy(k, "page").agg(F.map_from_entries(F.collect_list(F.struct(
            "model", F.transform("s", lambda e: F.bround(e["yhat"], 4))))).alias("model_prediction_series"))
        best = metrics.best_model(self.comparison, k).select(k, "best_model")
        single = F.filter(F.array_sort(F.map_keys("model_prediction_series")), lambda m: m != HYBRID_MODEL)
        columns = F.transform(single, lambda m: F.concat(F.lit("pred_"), m, F.lit("_c")))
        return (series.join(self.label, [k], "left").join(w, [k], "left").join(cmp, [k], "left")
                .join(best, [k], "left").join(model_series, [k, "page"], "left")
                .withColumn("model_prediction_columns", columns))
