"""Group-size edge cases for filtering, splitting, windowing and eligibility."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from verdant.operators import control, metrics, windows
from verdant.operators.series import positions


def _series(spark, sizes):
    t0 = dt.datetime(2025, 1, 1)
    rows = [(f"g{n}", t0 + dt.timedelta(hours=i), float(i % 5), float(i)) for n in sizes for i in range(n)]
    df = spark.createDataFrame(rows, "crop_type string, timestamp timestamp_ntz, t double, h double")
    return positions(df, ["crop_type"], ["timestamp"], num_partitions=3)


def test_min_filter_split_windows_and_eligibility(spark):
    sizes = [1, 6, 7, 12, 30, 31]
    ranked = _series(spark, sizes)
    kept = {r[0] for r in windows.min_group_filter(ranked, 12).select("crop_type").distinct().collect()}
    assert kept == {"g12", "g30", "g31"}
    split = windows.chrono_split(ranked).groupBy("crop_type").agg(
        F.count_if(F.col("split") == "train").alias("tr")).collect()
    train = {r["crop_type"]: r["tr"] for r in split}
    assert train == {"g1": 1, "g6": 4, "g7": 5, "g12": 9, "g30": 24, "g31": 24}
    w = windows.sliding_windows(ranked, "crop_type", "t", ["t", "h"], block_rows=5)
    counts = {r["crop_type"]: (r["train_sequences"], r["test_sequences"]) for r in windows.window_counts(w).collect()}
    assert counts.get("g30") == (18, 0) and counts.get("g31") == (18, 1)
    assert "g1" not in counts and "g6" not in counts
    ok = {r[0] for r in windows.eligible(w).select("crop_type").distinct().collect()}
    assert ok == {"g31"}


def test_ratio_must_be_open_interval():
    for bad in (0.0, 1.0, -0.5, 1.5):
        with pytest.raises(ValueError):
            windows.split_index(bad)


def test_simulation_requires_columns_and_summary_of_empty(spark):
    df = spark.createDataFrame([(1.0,)], "predicted_temperature_c double")
    with pytest.raises(ValueError):
        control.simulate_actions(df)
    empty = spark.createDataFrame([], "action string, fan_on int, spray_on int")
    row = metrics.control_summary(empty, []).first().asDict()
    assert row == {"total_records": 0, "fan_on_events": 0, "spray_on_events": 0,
                   "fan_and_spray_events": 0, "idle_events": 0}
