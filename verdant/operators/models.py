"""Forecasting models (M1, M7-M11, M14) over the window table.

Persistence, AR(1) and linear regression by TSQR run for any number of keys as
joins, grouped aggregates and per-task numpy reductions; so do the models in
``trees`` (M2, M3, M6, M13), ``knn`` (M4) and ``kernel`` (M5).

Every predictor returns the long prediction table
``(key, timestamp, split, model, y, yhat)`` with split in {val, test}.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .series import join_small

PRED_COLS = ["split", "model", "y", "yhat"]


def scored_rows(windows: DataFrame) -> DataFrame:
    """Validation and test windows, one row per (window, split role).

    A train window that is also validation appears as split='val'; test
    windows as split='test'.
    """
    val = windows.filter(F.col("is_val")).withColumn("split", F.lit("val"))
    test = windows.filter(F.col("split") == "test")
    return val.unionByName(test)


def _long(df: DataFrame, key: str, model: str, yhat: Column, time_col: str = "timestamp") -> DataFrame:
    return df.select(F.col(key), F.col(time_col), F.col("split"), F.lit(model).alias("model"),
                     F.col("y"), yhat.alias("yhat"))


def persistence_forecast(windows: DataFrame, key: str, n_features: int, target_index: int = 0,
                         length: int | None = None) -> DataFrame:
    """M7: yhat(t) = y(t-1), i.e. the target in the newest step of the window."""
    idx = F.lit((length - 1) * n_features + target_index + 1) if length else \
        (F.size("x") - F.lit(n_features) + F.lit(target_index + 1))
    return _long(scored_rows(windows), key, "naive_persistence", F.element_at("x", idx))


def ar1_params(windows: DataFrame, key: str, n_features: int, target_index: int = 0) -> DataFrame:
    """M8 fit: OLS of y on its previous value over fit windows (partial aggregation)."""
    lag1 = F.element_at("x", F.size("x") - F.lit(n_features) + F.lit(target_index + 1))
    fit = windows.filter(F.col("is_fit")).select(key, lag1.alias("lag1"), "y")
    return fit.groupBy(key).agg(F.regr_slope("y", "lag1").alias("slope"),
                                F.regr_intercept("y", "lag1").alias("intercept"))


def ar1_forecast(windows: DataFrame, key: str, n_features: int, target_index: int = 0,
                 n_keys: int | None = None) -> DataFrame:
    """M8: linear autoregressive baseline."""
    params = ar1_params(windows, key, n_features, target_index)
    lag1 = F.element_at("x", F.size("x") - F.lit(n_features) + F.lit(target_index + 1))
    rows = join_small(scored_rows(windows), params, [key], "left", n_keys)
    return _long(rows, key, "linear_baseline", F.col("intercept") + F.col("slope") * lag1)


def external_predictions(windows: DataFrame, external: DataFrame, key: str) -> DataFrame:
    """Attach predictions computed elsewhere, ``(key, timestamp, split, model, yhat)``."""
    rows = scored_rows(windows).select(key, "timestamp", "split", "y")
    return rows.join(external, [key, "timestamp", "split"], "inner").select(
        key, "timestamp", "split", "model", "y", "yhat")


# ---------------------------------------------------------------- least squares

def dot_product(a: Column, b: Column, dim: int) -> Column:
    """sum(a[i] * b[i]) as plain arithmetic (whole-stage codegen; array HOFs are interpreted)."""
    total = None
    for i in range(1, dim + 1):
        t = F.element_at(a, i) * F.element_at(b, i)
        total = t if total is None else total + t
    return total


def ols_coefficients(windows: DataFrame, key: str, dim: int, fan_in: int = 32,
                     n_keys: int | None = None) -> DataFrame:
    """M1 fit: least squares with intercept on the fit windows of every key, via TSQR.

    The rows are centred per key (means from one grouped aggregation), each
    task reduces its rows to the R factor of ``[X | y]`` (numpy QR over Arrow
    batches), R factors are combined per (key, task bucket) and then per key,
    and the minimum-norm solution of the small triangular system is taken
    inside the final group task.  This equals an SVD least-squares solve of
    the whole key, handles rank-deficient windows, needs no per-key driver
    loop, and moves at most (dim+1)^2 numbers per key and task.
    """
    width = dim + 1
    fit = windows.filter(F.col("is_fit")).select(key, "x", "y")
    means = fit.groupBy(key).agg(
        F.array(*[F.avg(F.element_at("x", i + 1)) for i in range(dim)]).alias("xm"), F.avg("y").alias("ym"))
    centred = join_small(fit, means, [key], "inner", n_keys).select(key, "x", "y", "xm", "ym")
    out_schema = f"{key} string, part long, r array<double>"

    # Task-side helpers are closures (shipped by value): workers need no package import.
    def _qr_rows(blocks, width):
        a = np.vstack([np.asarray(b).reshape(-1, width) for b in blocks])
        return np.linalg.qr(a, mode="r") if len(a) else np.zeros((0, width))

    def local(batches):
        from pyspark import TaskContext
        acc: dict = {}
        for pdf in batches:
            for kv, g in pdf.groupby(key, sort=False):
                xm, ym = np.asarray(g["xm"].iloc[0]), float(g["ym"].iloc[0])
                a = np.column_stack([np.vstack(g["x"].to_numpy()) - xm, g["y"].to_numpy() - ym])
                acc[kv] = _qr_rows([acc[kv], a], width) if kv in acc else _qr_rows([a], width)
        part = TaskContext.get().partitionId()
        if acc:  # a frame without rows has no type that turns into an array column
            yield pd.DataFrame({key: list(acc), "part": [part] * len(acc),
                                "r": [r.ravel() for r in acc.values()]}, columns=[key, "part", "r"])

    def combine(pdf: pd.DataFrame) -> pd.DataFrame:
        r = _qr_rows([np.asarray(v) for v in pdf["r"]], width)
        return pd.DataFrame({key: [pdf[key].iloc[0]], "part": [int(pdf["part"].iloc[0]) % fan_in],
                             "r": [r.ravel()]})

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        r = _qr_rows([np.asarray(v) for v in pdf["r"]], width)
        coef = np.linalg.lstsq(r[:, :dim], r[:, dim], rcond=None)[0] if len(r) else np.full(dim, np.nan)
        return pd.DataFrame({key: [pdf[key].iloc[0]], "coef": [coef]})

    partial = centred.mapInPandas(local, out_schema)
    level = partial.groupBy(key, (F.col("part") % F.lit(fan_in)).alias("_b")).applyInPandas(
        combine, out_schema) if fan_in > 1 else partial
    coef = level.groupBy(key).applyInPandas(solve, f"{key} string, coef array<double>")
    intercept = F.col("ym") - F.aggregate(F.zip_with("xm", "coef", lambda a, b: a * b), F.lit(0.0),
                                          lambda acc, v: acc + v)
    # Fitted here and once: a broadcast that has to fit first runs into its time limit on large tables.
    return materialize(coef.join(means, [key]).select(key, intercept.alias("intercept"), "coef"))


def ols_forecast(windows: DataFrame, key: str, dim: int, n_keys: int | None = None) -> DataFrame:
    """M1: linear regression on the flattened window, scored on validation and test windows."""
    params = ols_coefficients(windows, key, dim, n_keys=n_keys)
    rows = join_small(scored_rows(windows), params, [key], "left", n_keys)
    dot = dot_product(F.col("x"), F.col("coef"), dim)
    return _long(rows, key, "linear_regression", F.col("intercept") + dot)


def feature_names(features: Sequence[str], length: int) -> list[str]:
    """Names of flattened window slots: time-major, oldest step first."""
    return [f"{f}_t-{lag}" for lag in range(length, 0, -1) for f in features]


def correlation_matrix(df: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """Pearson correlation of every feature pair per key (one grouped aggregation)."""
    pairs = [(a, b) for i, a in enumerate(features) for b in features[i + 1:]]
    aggs = [F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)]
    wide = df.groupBy(key).agg(*aggs)
    kv = F.explode(F.array(*[F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"),
                                      F.col(f"c{i}").alias("corr")) for i, (a, b) in enumerate(pairs)]))
    return wide.select(key, kv.alias("p")).select(key, "p.feature_a", "p.feature_b", "p.corr")


def registry_notes(predictions: DataFrame, weights: DataFrame, eligibility: DataFrame, key: str,
                   requested: Sequence[str]) -> DataFrame:
    """(key, model, n_predictions, n_bad, note): what happened to every requested model of every key.

    Facts only: keys that were skipped and why, models without predictions, models
    whose predictions the ensemble refused, and models in use.
    """
    made = predictions.groupBy(key, "model").agg(
        F.count(F.lit(1)).alias("n_predictions"),
        F.count_if(F.col("yhat").isNull() | F.isnan("yhat")).alias("n_bad"))
    used = weights.select(key, "model", F.lit(True).alias("_used"))
    rows = eligibility.select(key, "reason", F.explode(F.array(*[F.lit(m) for m in requested])).alias("model"))
    rows = rows.join(made, [key, "model"], "left").join(used, [key, "model"], "left")
    note = (F.when(F.col("reason").isNotNull(), F.concat(F.lit("skipped: "), F.col("reason")))
            .when(F.col("n_predictions").isNull(), F.lit("no predictions"))
            .when(F.col("_used").isNull(), F.lit("refused by the ensemble"))
            .otherwise(F.lit("in use")))
    zero = F.lit(0).cast("long")
    return rows.select(key, "model", F.coalesce("n_predictions", zero).alias("n_predictions"),
                       F.coalesce("n_bad", zero).alias("n_bad"), note.alias("note"))

