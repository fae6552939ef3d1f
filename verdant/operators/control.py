"""Threshold control rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import (ACTION_FAN, ACTION_IDLE, ACTION_OFF, ACTION_SPRAY, DEFAULT_KEY, HIGH_THRESHOLD,
                      LOW_THRESHOLD, SPRAY_THRESHOLD)


def _pick(t: Column, low: float, high: float, spray: float, field: int) -> Column:
    # NaN compares greater than everything in Spark SQL; the rule treats it as no reading.
    missing = t.isNull() | F.isnan(t)
    return (F.when(missing, F.lit(ACTION_IDLE[field]))
            .when(t >= F.lit(spray), F.lit(ACTION_SPRAY[field]))
            .when(t >= F.lit(high), F.lit(ACTION_FAN[field]))
            .when(t <= F.lit(low), F.lit(ACTION_OFF[field]))
            .otherwise(F.lit(ACTION_IDLE[field])))


def threshold_action(t: Column, low: float = LOW_THRESHOLD, high: float = HIGH_THRESHOLD,
                     spray: float = SPRAY_THRESHOLD) -> dict[str, Column]:
    """First match of spray / high / low, else idle."""
    t = t.cast("double")
    return {
        "action": _pick(t, low, high, spray, 0),
        "fan_on": _pick(t, low, high, spray, 1).cast("int"),
        "spray_on": _pick(t, low, high, spray, 2).cast("int"),
        "status_note": _pick(t, low, high, spray, 3),
    }


def simulate_actions(forecast: DataFrame, low: float = LOW_THRESHOLD, high: float = HIGH_THRESHOLD,
                     spray: float = SPRAY_THRESHOLD, time_col: str = "timestamp",
                     key: str = "crop_type", prediction: str = "predicted_temperature_c") -> DataFrame:
    """One control row per forecast row."""
    missing = [c for c in (time_col, prediction) if c not in forecast.columns]
    if missing:
        raise ValueError(f"a forecast to control needs the columns {', '.join(missing)}")
    key_col = F.col(key) if key in forecast.columns else F.lit(DEFAULT_KEY)
    acts = threshold_action(F.col(prediction), low, high, spray)
    return forecast.select(
        F.col(time_col), key_col.alias(key), F.col(prediction).cast("double").alias("predicted_temperature_c"),
        acts["action"].alias("action"), acts["fan_on"].alias("fan_on"), acts["spray_on"].alias("spray_on"),
        acts["status_note"].alias("status_note"))
