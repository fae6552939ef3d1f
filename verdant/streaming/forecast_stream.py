"""Incremental refresh of forecasts (ST1) with keyed state.

The combined forecast of linear models is itself linear: with weights w_m, intercepts b_m and
coefficients c_m it is sum(w_m b_m) + sum(w_m c_m) . x.  So a key's whole model is one row,
``combined`` makes that table from a stored version and the ensemble's weights, and the stream
joins it by key.  The state of a key is the last L scaled observations and their last time;
a new observation is forecast from them at once, gets its control action, and moves the state
on.  Only new files are read, and the state of a key never grows.

Files may be cut anywhere as long as a key's observations come in time order over
micro-batches (within one they are sorted).  An observation not later than its key's last one
is given back with ``late`` set and no forecast, and leaves the state as it is: a refit takes it
in.  Keys without a model have no rows here.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ..plans.store import StoredModels

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no package import

STATE = "history binary, last long"


def combined(stored: StoredModels, weights: DataFrame, key: str) -> DataFrame:
    """(key, intercept, coef, low, span, t_low, t_span): one linear model a key, with its scaling parameters."""
    j = stored.linear.join(weights.select(key, "model", "weight"), [key, "model"])
    sums = [F.sum(F.element_at("coef", i + 1) * F.col("weight")) for i in range(stored.dim)]
    one = j.groupBy(key).agg(F.sum(F.col("intercept") * F.col("weight")).alias("intercept"), F.array(*sums).alias("coef"))
    low = [F.col(f"{f}__min") for f in stored.features]
    span = [F.col(f"{f}__max") - F.col(f"{f}__min") for f in stored.features]
    t = stored.target_index
    return one.join(stored.scaling.select(key, F.array(*low).alias("low"), F.array(*span).alias("span")), key).select(
        key, "intercept", "coef", "low", "span", F.get("low", F.lit(t)).alias("t_low"), F.get("span", F.lit(t)).alias("t_span"))


def _refresh(key: str, width: int, length: int, target: int):
    def run(name, batches, state):
        rows = pd.concat(list(batches)).sort_values("at", kind="stable")
        history, last = (state.get if state.exists else (b"", -(1 << 62)))
        past = np.frombuffer(history, dtype="<f8").reshape(-1, width)
        at = rows["at"].to_numpy()
        values = np.vstack(rows["v"].to_numpy())
        first = rows.iloc[0]
        low, span, coef = (np.asarray(first[c], dtype=float) for c in ("low", "span", "coef"))
        late = np.zeros(len(rows), dtype=bool)
        for i, t in enumerate(at):  # equal times: the first row counts
            late[i] = t <= last
            last = max(last, t)
        with np.errstate(divide="ignore", invalid="ignore"):
            scaled = np.where(span == 0, 0.0, (values - low) / span)
        scaled = np.where(np.isfinite(scaled), scaled, 0.0).astype(np.float32).astype(float)
        known = np.vstack((past, scaled[~late]))
        begin = len(past)
        yhat = np.full(len(rows), np.nan)
        place = np.flatnonzero(~late)
        ready = [j for j in range(len(place)) if begin + j >= length]
        if ready:
            x = np.stack([known[begin + j - length:begin + j].ravel() for j in ready])
            yhat[place[ready]] = (x @ coef + first["intercept"]) * first["t_span"] + first["t_low"]
        # the actual value in single precision, as the batch windows hold it
        actual = np.full(len(rows), np.nan)
        actual[place] = scaled[place, target] * first["t_span"] + first["t_low"]
        state.update((known[-length:].astype("<f8").tobytes(), int(last)))
        yield pd.DataFrame({key: [name[0]] * len(rows), "at": at, "actual": actual, "predicted": yhat, "late": late})
    return run


def refresh_forecasts(stream: DataFrame, models: DataFrame, stored: StoredModels, key: str, time_col: str = "timestamp") -> DataFrame:
    """(key, time, actual, predicted, late) of every new observation; nothing is predicted before a key has L rows."""
    values = F.array(*[F.col(f).cast("double") for f in stored.features])
    at = F.unix_micros(F.col(time_col).cast("timestamp"))
    rows = stream.select(key, at.alias("at"), values.alias("v")).join(models, key)
    out = rows.groupBy(key).applyInPandasWithState(
        _refresh(key, len(stored.features), stored.length, stored.target_index),
        f"{key} string, at long, actual double, predicted double, late boolean", STATE, "append", GroupStateTimeout.NoTimeout)
    return out.select(key, F.timestamp_micros("at").cast("timestamp_ntz").alias(time_col), "actual",
                      F.when(~F.isnan("predicted"), F.col("predicted")).alias("predicted"), "late")


def observation_stream(folder: DataFrame | str, like: DataFrame, files_per_trigger: int = 64) -> DataFrame:
    """New Parquet files of a folder of observations shaped as ``like``."""
    return (like.sparkSession.readStream.schema(like.schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder))


def q_stream_forecast(spark, sf_dir, pieces: int = 4):
    """ST1: models stored by a batch run; the test observations arrive in files and are forecast one micro-batch after another."""
    from ..plans import store
    from ..plans.registry import event_run, finish
    from ..sources.sinks import shared_path
    from .control_stream import drain
    run = event_run(spark, sf_dir)
    folder = store.save(run, shared_path(spark, "models"), run.model_set)
    stored = store.load(spark, folder)
    models = combined(stored, run.weights, "crop_type")
    models.write.parquet(f"{folder}/combined")
    models = spark.read.parquet(f"{folder}/combined")
    from ..operators.windows import chrono_split
    test = chrono_split(run.grouped).filter("split = 'test'")
    arrivals = shared_path(spark, "arrivals")
    for i in range(pieces):  # files of one write come together; each key's rows of a piece are in one of them
        part = test.filter(F.floor((F.col("_pos") - F.col("_k") - 1) * pieces / (F.col("_n") - F.col("_k"))) == i)
        part.select("crop_type", "timestamp", *run.features).repartition("crop_type").write.mode("append").parquet(arrivals)
    arriving = observation_stream(arrivals, run.grouped.select("crop_type", "timestamp", *run.features), 2)
    made = drain(refresh_forecasts(arriving, models, stored, "crop_type"), "forecast").filter("predicted is not null")
    return finish(made.select("crop_type", "timestamp", F.col("actual").alias("actual_temperature_c"),
                              F.col("predicted").alias("predicted_temperature_c"),
                              F.abs(F.col("actual") - F.col("predicted")).alias("absolute_error_c")))
