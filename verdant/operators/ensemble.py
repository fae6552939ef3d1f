"""Ensemble coordination (E1-E8) over the long prediction table.

Weights are computed per key from a handful of model scores; the per-key
model list is collected into one small array (bounded by the number of
models, never by rows) and the ten clip-and-renormalise rounds run as array
higher-order functions, which keeps the plan shallow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import (BLEND_MODEL, BLEND_UNIFORM, ENSEMBLE_METHOD, HYBRID_MODEL, MAX_WEIGHT_BONUS,
                      MAX_WEIGHT_CAP, MAX_WEIGHT_FLOOR, MIN_WEIGHT_FEW, MIN_WEIGHT_MANY,
                      PREFERRED_BOOST, RMSE_FLOOR, WEIGHT_ITERATIONS, WEIGHT_TOLERANCE)


def _is_bad(c: Column) -> Column:
    return c.isNull() | F.isnan(c)


def validation_rmse(preds: DataFrame, key: str) -> DataFrame:
    """RMSE on validation windows per (key, model), in scaled units."""
    val = preds.filter(F.col("split") == "val")
    return val.groupBy(key, "model").agg(
        F.sqrt(F.avg(F.pow(F.col("y") - F.col("yhat"), 2))).alias("validation_rmse"))


def scores(rmse: DataFrame, preferred: str | None = None) -> DataFrame:
    """1 / max(rmse, floor), boosted for the preferred model."""
    base = F.lit(1.0) / F.greatest(F.col("validation_rmse"), F.lit(RMSE_FLOOR))
    boost = F.when(F.col("model") == F.lit(preferred), F.lit(PREFERRED_BOOST)).otherwise(F.lit(1.0)) \
        if preferred else F.lit(1.0)
    return rmse.withColumn("score", base * boost)


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda a, x: a + x)


def ensemble_weights(scored: DataFrame, key: str) -> DataFrame:
    """Stabilised weights per (key, model); also returns rmse and score."""
    grouped = scored.groupBy(key).agg(F.sort_array(F.collect_list(
        F.struct("model", "score", "validation_rmse"))).alias("m"))
    n = F.size("m").cast("double")
    raw = F.transform("m", lambda s: s["score"])
    finite = F.transform(raw, lambda x: F.when(_is_bad(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(0.0))
                         .otherwise(x))
    all_nonpos = F.forall(finite, lambda x: x <= F.lit(0.0))
    damped = F.transform(finite, lambda x: F.log1p(F.greatest(x, F.lit(0.0))))
    d_total = F.greatest(_sum(damped), F.lit(1e-12))
    blended = F.transform(damped, lambda x: F.lit(BLEND_MODEL) * (x / d_total)
                          + F.lit(BLEND_UNIFORM) * (F.lit(1.0) / n))
    max_w = F.least(F.greatest(F.lit(MAX_WEIGHT_FLOOR), F.lit(1.0) / n + F.lit(MAX_WEIGHT_BONUS)),
                    F.lit(MAX_WEIGHT_CAP))
    min_w = F.when(n >= 5, F.lit(MIN_WEIGHT_MANY)).otherwise(F.lit(MIN_WEIGHT_FEW))
    uniform = F.transform(raw, lambda x: F.lit(1.0) / n)

    def step(acc, _i):
        w = acc["w"]
        clipped = F.transform(w, lambda x: F.least(F.greatest(x, F.col("_minw")), F.col("_maxw")))
        total = _sum(clipped)
        normed = F.transform(clipped, lambda x: x / total)
        over = F.aggregate(normed, F.lit(0.0), lambda a, x: a + F.greatest(x - F.col("_maxw"), F.lit(0.0)))
        under = F.aggregate(normed, F.lit(0.0), lambda a, x: a + F.greatest(F.col("_minw") - x, F.lit(0.0)))
        nxt = F.struct(
            F.when(total <= 0, F.col("_uniform")).otherwise(normed).alias("w"),
            ((total <= 0) | ((over < F.lit(WEIGHT_TOLERANCE)) & (under < F.lit(WEIGHT_TOLERANCE)))).alias("done"),
        )
        return F.when(acc["done"], acc).otherwise(nxt)

    staged = grouped.select(
        key, "m", blended.alias("_blended"), max_w.alias("_maxw"), min_w.alias("_minw"),
        uniform.alias("_uniform"), all_nonpos.alias("_allnonpos"))
    start = F.struct(F.col("_blended").alias("w"), F.lit(False).alias("done"))
    looped = F.aggregate(F.sequence(F.lit(1), F.lit(WEIGHT_ITERATIONS)), start, step)["w"]
    final_total = F.greatest(_sum(F.col("_w")), F.lit(1e-12))
    weights = F.when(F.col("_allnonpos"), F.col("_uniform")).otherwise(
        F.transform("_w", lambda x: x / final_total))
    out = staged.withColumn("_w", looped).withColumn("_w", weights)
    zipped = F.arrays_zip(F.col("m").alias("m"), F.col("_w").alias("w"))
    return out.select(key, F.explode(zipped).alias("z")).select(
        key, F.col("z.m.model").alias("model"), F.col("z.m.validation_rmse").alias("validation_rmse"),
        F.col("z.m.score").alias("score"), F.col("z.w").alias("weight"))


def coordinate(preds: DataFrame, key: str, preferred: str | None = None) -> DataFrame:
    """E1-E6 in one: weights table for the valid models of each key.

    Validity checks and validation RMSE come from one grouped aggregation;
    the expected validation length is a window over that (key x model)
    table, which is tiny.
    """
    from pyspark.sql import Window
    is_val = F.col("split") == "val"
    per = preds.groupBy(key, "model").agg(
        F.count_if(is_val).alias("n_val"),
        F.count_if(F.col("split") == "test").alias("n_test"),
        F.count_if(_is_bad(F.col("yhat"))).alias("n_bad"),
        F.sqrt(F.avg(F.when(is_val, F.pow(F.col("y") - F.col("yhat"), 2)))).alias("validation_rmse"))
    expected = F.max(F.when(F.col("n_val") > 0, F.col("n_val"))).over(Window.partitionBy(key))
    ok = per.withColumn("n_expected", expected).filter(
        (F.col("n_bad") == 0) & (F.col("n_test") > 0) & (F.col("n_val") == F.col("n_expected")))
    return ensemble_weights(scores(ok.select(key, "model", "validation_rmse"), preferred), key)


def hybrid_forecast(preds: DataFrame, weights: DataFrame, key: str, n_rows: int | None = None) -> DataFrame:
    """Weighted sum of the test predictions of the weighted models.

    ``n_rows`` bounds the weights table (keys x models) for an explicit broadcast.
    """
    from .series import join_small
    test = join_small(preds.filter(F.col("split") == "test"), weights.select(key, "model", "weight"),
                      [key, "model"], "inner", n_rows)
    return test.groupBy(key, "timestamp").agg(
        F.first("y").alias("y"), F.sum(F.col("weight") * F.col("yhat")).alias("yhat")
    ).select(key, "timestamp", F.lit("test").alias("split"), F.lit(HYBRID_MODEL).alias("model"), "y", "yhat")


def coordination_label(weights: DataFrame, key: str, method: str = ENSEMBLE_METHOD) -> DataFrame:
    """``method[model:0.42, ...]`` sorted by weight (desc), then model."""
    items = F.sort_array(F.collect_list(F.struct((-F.col("weight")).alias("nw"), F.col("model"),
                                                 F.col("weight"))))
    text = F.array_join(F.transform(items, lambda s: F.format_string("%s:%.2f", s["model"], s["weight"])), ", ")
    return weights.groupBy(key).agg(
        F.concat(F.lit(method + "["), text, F.lit("]")).alias("model_coordination"))
