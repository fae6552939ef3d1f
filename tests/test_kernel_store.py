"""Kernel regression of all keys, and the model store."""
import numpy as np
import pytest
from conftest import SF001, needs
from pyspark.sql import functions as F

from test_trees import made_windows
from verdant.operators import kernel
from verdant.plans import store
from verdant.plans.registry import event_run
from verdant.sources.sinks import shared_path


def coefs(models):
    return {r.crop_type: np.array(r.coef) for r in models.collect()}


def test_kernel_fit_is_the_same_in_one_task_and_over_blocks(spark, monkeypatch):
    monkeypatch.setattr("verdant.operators.trees.BLOCK", 50)
    w = made_windows(spark, {"a": 240, "b": 40})
    one = coefs(kernel.kernel_models(w, "crop_type", 3, components=24))
    many = coefs(kernel.kernel_models(w, "crop_type", 3, components=24, local_rows=60))
    assert set(one) == set(many) == {"a", "b"}
    for k in one:
        assert np.abs(one[k] - many[k]).max() < 1e-7


def test_kernel_fit_meets_its_first_order_condition_and_bounds_outliers(spark):
    w = made_windows(spark, {"a": 200}).withColumn("y", F.when(F.col("_pos") == 3, 40.0).otherwise(F.col("y")))
    m = kernel.kernel_models(w, "crop_type", 3, components=32)
    assert kernel.first_order(w, m, "crop_type", 3, components=32).filter(F.abs("moment") > 1e-7).count() == 0
    p = kernel.kernel_forecast(w, m, "crop_type", 3, components=32).toPandas()
    assert len(p) == 50 and np.abs(p.y - p.yhat).median() < 0.5


def test_kernel_fit_ends_in_few_rounds(spark, monkeypatch):
    monkeypatch.setattr(kernel, "ROUNDS", 10)
    monkeypatch.setattr("verdant.operators.trees.BLOCK", 50)
    w = made_windows(spark, {"a": 200, "b": 40}).withColumn("y", F.when(F.col("_pos") % 9 == 3, 40.0 + F.col("_pos")).otherwise(F.col("y")))
    for local_rows in (1000, 60):
        m = kernel.kernel_models(w, "crop_type", 3, components=32, local_rows=local_rows)
        assert m.count() == 2
        assert kernel.first_order(w, m, "crop_type", 3, components=32).filter(F.abs("moment") > 1e-9).count() == 0


def test_a_newton_step_that_raises_the_loss_is_halved():
    one = np.ones(2)
    state = {"coef": one, "delta": 1.0, "base": one * 0.5, "move": one * 0.5, "loss": 1.0, "done": False}
    after = kernel.advance(state, np.concatenate(([2.0], np.zeros(6))), 4, 1.0, 1.35)
    assert not after["done"] and (after["coef"] == 0.75).all() and (after["move"] == 0.25).all() and (after["base"] == 0.5).all()


@needs(SF001)
def test_store_keeps_versions_and_scores_them(spark):
    run = event_run(spark, SF001, forest_trees=5, boost_rounds=4, second_rounds=3)
    names = ("naive_persistence", "linear_baseline", "linear_regression", "random_forest", "gradient_boosting", "svr_rbf")
    folder = shared_path(spark, "store-test")
    assert store.versions(spark, folder).count() == 0
    with pytest.raises(ValueError):
        store.load(spark, folder)
    store.save(run, folder, ("linear_baseline",))
    store.save(run, folder, names)
    latest = store.load(spark, folder)
    assert latest.version == 2 and set(latest.names) == set(names) and latest.features == run.features
    assert store.load(spark, folder, 1).names == ["linear_baseline"]
    got = store.score(run.windows, latest, "crop_type").select("crop_type", "timestamp", "split", "model", F.col("yhat").alias("stored"))
    for name in names:
        j = run.predictions_for(name).join(got, ["crop_type", "timestamp", "split", "model"])
        assert j.count() == run.predictions_for(name).count()
        assert j.filter(F.abs(F.col("yhat") - F.col("stored")) > 1e-9).count() == 0, name
    with pytest.raises(ValueError):
        store.save(run, folder, ("knn_regressor",))
    # scaled by the version's own parameters
    a = store.scale(run.grouped, latest, "crop_type").select("crop_type", "timestamp", *run.features)
    assert a.exceptAll(run.scaled.select("crop_type", "timestamp", *run.features)).count() == 0
