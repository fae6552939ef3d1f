"""Accuracy metrics, rankings and summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import MAPE_EPSILON


def metric_aggs(y: Column, yhat: Column) -> list[Column]:
    """A1-A3 as aggregate expressions (MAE, RMSE, MAPE %, R2)."""
    e = y - yhat
    sse = F.sum(e * e)
    sst = F.count(F.lit(1)) * F.var_pop(y)
    mape = F.avg(F.when(F.abs(y) > F.lit(MAPE_EPSILON), F.abs(e / y)))
    return [
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.coalesce(mape * F.lit(100.0), F.lit(0.0)).alias("mape_pct"),
        F.when(sst == 0, F.lit(0.0)).otherwise(F.lit(1.0) - sse / sst).alias("r2"),
        F.count(F.lit(1)).alias("sample_count"),
    ]


def regression_metrics(df: DataFrame, group_cols: Sequence[str], y: str = "y", yhat: str = "yhat") -> DataFrame:
    return df.groupBy(*group_cols).agg(*metric_aggs(F.col(y), F.col(yhat)))


def absolute_error(y: Column, yhat: Column) -> Column:
    """A4."""
    return F.abs(y - yhat)


def model_comparison(preds: DataFrame, key: str) -> DataFrame:
    """Per (key, model) MAE/RMSE/R2 on test rows, rank 1..n by RMSE then model."""
    test = preds.filter(F.col("split") == "test")
    m = regression_metrics(test, [key, "model"]).select(key, "model", "mae", "rmse", "r2")
    w = Window.partitionBy(key).orderBy(F.col("rmse").asc_nulls_last(), F.col("model"))
    return m.withColumn("rank", F.row_number().over(w)).select(key, "rank", "model", "mae", "rmse", "r2")


def best_model(comparison: DataFrame, key: str) -> DataFrame:
    """Best model, its RMSE and the number of models evaluated per key."""
    return comparison.groupBy(key).agg(
        F.min_by("model", F.struct("rank")).alias("best_model"),
        F.min_by("rmse", F.struct("rank")).alias("best_model_rmse"),
        F.count(F.lit(1)).alias("models_evaluated"),
    )


def overall_ranking(comparison: DataFrame) -> DataFrame:
    """Mean MAE/RMSE/R2 per model across keys, ranked by mean RMSE then model."""
    m = comparison.groupBy("model").agg(F.avg("mae").alias("mae"), F.avg("rmse").alias("rmse"),
                                        F.avg("r2").alias("r2"))
    w = Window.orderBy(F.col("rmse").asc_nulls_last(), F.col("model"))
    return m.withColumn("rank", F.row_number().over(w)).select("rank", "model", "mae", "rmse", "r2")


def top_ranking(ranking: DataFrame, k: int = 5) -> DataFrame:
    """The first k ranking rows."""
    return ranking.orderBy("rank").limit(k)


def control_summary(actions: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """A10: totals of the simulated actions (always all five counters)."""
    aggs = [
        F.count(F.lit(1)).alias("total_records"),
        F.coalesce(F.sum("fan_on"), F.lit(0)).cast("long").alias("fan_on_events"),
        F.coalesce(F.sum("spray_on"), F.lit(0)).cast("long").alias("spray_on_events"),
        F.count_if(F.col("action") == "fan_and_spray_on").alias("fan_and_spray_events"),
        F.count_if(F.col("action") == "idle").alias("idle_events"),
    ]
    return actions.groupBy(*group_cols).agg(*aggs) if group_cols else actions.agg(*aggs)


def dataset_summary(raw: DataFrame, cleaned: DataFrame, selected: DataFrame, scaled: DataFrame,
                    features: Sequence[str]) -> DataFrame:
    """(section, column, value) rows: shapes, NULL counts raw/cleaned, scaled min/max (4 dp)."""
    from .clean import INTERNAL, missing_report

    def shape(df, name):
        cols = len([c for c in df.columns if c not in INTERNAL])
        return df.agg(F.count(F.lit(1)).cast("double").alias("rows")).select(
            F.explode(F.array(
                F.struct(F.lit(f"{name}_shape").alias("section"), F.lit("rows").alias("column"),
                         F.col("rows").alias("value")),
                F.struct(F.lit(f"{name}_shape").alias("section"), F.lit("columns").alias("column"),
                         F.lit(float(cols)).alias("value")))).alias("r")).select("r.*")

    def nulls(df, name):
        return missing_report(df).select(F.lit(f"{name}_missing").alias("section"), "column",
                                          F.col("missing").cast("double").alias("value"))

    rng = scaled.agg(*[F.min(c).alias(f"{c}__min") for c in features],
                     *[F.max(c).alias(f"{c}__max") for c in features])
    kv = F.explode(F.array(*[F.struct(F.lit(f"scaled_{s}").alias("section"), F.lit(c).alias("column"),
                                      F.bround(F.col(f"{c}__{s}"), 4).alias("value"))
                             for c in features for s in ("min", "max")]))
    parts = [shape(raw, "raw"), shape(cleaned, "cleaned"), shape(selected, "selected"), shape(scaled, "scaled"),
             nulls(raw, "raw"), nulls(cleaned, "cleaned"), rng.select(kv.alias("r")).select("r.*")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_status(observations: DataFrame, eligible_keys: DataFrame, processed_keys: DataFrame,
               key: str) -> DataFrame:
    """Keys discovered (passing the size filter), processed, and exported."""
    return (observations.agg(F.countDistinct(key).alias("keys_exported"))
            .crossJoin(eligible_keys.agg(F.countDistinct(key).alias("keys_discovered")))
            .crossJoin(processed_keys.agg(F.countDistinct(key).alias("keys_processed"))))
