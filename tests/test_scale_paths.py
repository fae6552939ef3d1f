"""The sort-based (any group size) and single-task paths must agree."""
import pandas as pd
from pyspark.sql import functions as F

from conftest import SF01, needs
from verdant.operators import clean
from verdant.operators.series import POS, SIZE, positions
from verdant.sources.tables import event_observations, read_table


@needs(SF01)
def test_hot_key_positions_spread_over_tasks(spark):
    li = read_table(spark, SF01, "lineitem")
    # one key holds every row: the sort-based path must still split it
    hot = li.select(F.lit("hot").alias("k"), "l_shipdate", "l_orderkey", "l_linenumber")
    order = ["l_shipdate", "l_orderkey", "l_linenumber"]
    a = positions(hot, ["k"], order, num_partitions=8)
    parts = a.select(F.spark_partition_id().alias("p")).distinct().count()
    b = positions(hot, ["k"], order, max_group=10**9, single_task_rows=10**9)
    # rows tied on the whole order may swap positions; the (order, position) multiset may not change
    pa = a.select(*order, POS, SIZE).toPandas().sort_values([*order, POS]).reset_index(drop=True)
    pb = b.select(*order, POS, SIZE).toPandas().sort_values([*order, POS]).reset_index(drop=True)
    assert len(pa) == li.count()
    assert pa.equals(pb)
    assert sorted(pa[POS]) == list(range(1, len(pa) + 1))
    assert parts > 1


@needs(SF01)
def test_clean_multi_block_equals_single_block(spark):
    obs = event_observations(spark, SF01)
    cols = ["crop_type", "timestamp", "indoor_temperature_c", "humidity_pct"]
    small = clean.clean_dataset(obs, block_rows=37).select(*cols).toPandas()
    big = clean.clean_dataset(obs).select(*cols).toPandas()
    m = small.merge(big, on=["crop_type", "timestamp"])
    assert len(m) == len(big) == len(small)
    for c in cols[2:]:
        assert ((m[c + "_x"] - m[c + "_y"]).abs() < 1e-9).all()


@needs(SF01)
def test_forecast_identical_on_scale_paths(spark):
    """Tiny blocks and quantile thresholds force every large-data path; results must not move."""
    from verdant.config import ExecutionConfig
    from verdant.plans.forecast import ForecastRun, event_config
    obs = event_observations(spark, SF01)
    small = ForecastRun(obs, event_config(), ExecutionConfig(block_rows=97, single_task_values=10))
    big = ForecastRun(obs, event_config())
    a = small.forecast.toPandas().sort_values(["crop_type", "timestamp"]).reset_index(drop=True)
    b = big.forecast.toPandas().sort_values(["crop_type", "timestamp"]).reset_index(drop=True)
    assert len(a) == len(b) > 0
    assert (a[["crop_type", "timestamp"]] == b[["crop_type", "timestamp"]]).all().all()
    for c in ("actual_temperature_c", "predicted_temperature_c"):
        assert ((a[c] - b[c]).abs() < 1e-9).all(), c
    wa = small.weights.toPandas().sort_values(["crop_type", "model"])["weight"].values
    wb = big.weights.toPandas().sort_values(["crop_type", "model"])["weight"].values
    assert abs(wa - wb).max() < 1e-12


@needs(SF01)
def test_quantile_paths_agree_exactly_and_split_equal_values(spark):
    from verdant.operators.quantiles import cumulative_counts, exact_quantiles
    li = read_table(spark, SF01, "lineitem").select("l_returnflag", "l_discount", "l_extendedprice")
    cols, probs = ["l_discount", "l_extendedprice"], [0.01, 0.5, 0.99]
    for groups in ([], ["l_returnflag"]):
        pick = lambda limit: sorted(map(tuple, exact_quantiles(li, groups, cols, probs, single_task_values=limit).collect()))
        assert pick(0) == pick(1 << 30)
    long = li.select(F.lit("d").alias("column"), F.col("l_discount").alias("value"))
    counted = cumulative_counts(long, ["column"], partitions=4)
    assert counted.count() == 11 and counted.agg(F.sum("_count")).first()[0] == li.count()  # one row per value, however many rows share it


def test_regression_of_partitions_without_fit_windows(spark):
    """Tasks that see no fit window give no factor, and the fit is over before its table is broadcast."""
    from test_trees import made_windows
    from verdant.operators import models
    w = made_windows(spark, {"a": 40, "b": 30})
    few, many = (models.ols_coefficients(d, "crop_type", 3, n_keys=2).orderBy("crop_type").collect()
                 for d in (w.coalesce(1), w.repartitionByRange(60, "is_fit", "crop_type", "_pos")))
    for a, b in zip(few, many):
        assert abs(a.intercept - b.intercept) < 1e-9 and max(abs(x - y) for x, y in zip(a.coef, b.coef)) < 1e-9
    plan = models.ols_forecast(w, "crop_type", 3, n_keys=2)._jdf.queryExecution().executedPlan().toString()
    assert "InPandas" not in plan


def test_regression_of_kept_partitions_without_fit_windows(spark):
    """A checkpointed window table: its partitions stay as they are, so that some tasks see no fit window."""
    from test_trees import made_windows
    from verdant.operators import models
    from verdant.session import materialize
    w = materialize(made_windows(spark, {"a": 40, "b": 30}))
    kept = materialize(w.repartitionByRange(60, "is_fit", "crop_type", "_pos"))
    held = kept.filter("is_fit").select(F.spark_partition_id()).distinct().count()
    assert held < kept.select(F.spark_partition_id()).distinct().count()
    few, many = (models.ols_coefficients(d, "crop_type", 3, n_keys=2).orderBy("crop_type").collect() for d in (w.coalesce(1), kept))
    assert len(few) == len(many) == 2
    for a, b in zip(few, many):
        assert abs(a.intercept - b.intercept) < 1e-9 and max(abs(x - y) for x, y in zip(a.coef, b.coef)) < 1e-9


def test_scaling_broadcasts_the_parameters_of_few_keys(spark):
    """Rows of a hot key stay where they are."""
    from verdant.operators import windows
    df = spark.range(1000).selectExpr("if(id % 10 = 0, 'b', 'a') AS k", "cast(id AS double) AS v")
    scaled, params = windows.minmax_scale(df, ["k"], ["v"])
    plan = scaled._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert params.count() == 2 and scaled.agg({"v": "max"}).first()[0] == 1.0


def test_bounds_of_cleaning_are_computed_once(spark):
    """Readers of the cleaned table do not rank its values again."""
    from verdant.operators import clean
    df = spark.range(500).selectExpr("cast(id AS double) AS v")
    for out in (clean.clip_quantile(df, ["v"]), clean.fill_global_median(df, ["v"])):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Aggregate" not in plan and "Generate" not in plan
