"""Report and dashboard tables (R5, R7, R10) and joins J4/J5.

Reports are DataFrames of one row per key, or per (key, page) where a key's
series would not fit one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_EXEC
from ..functions.names import display_key, lookup_key, slug_col
from ..functions.values import json_number
from .series import POS, SIZE, group_size_bound, positions


def payload_index(labels: DataFrame, payloads: DataFrame, key: str, folder: str) -> DataFrame:
    """R5 entries: one row per key with its number of pages and the folder its payload pages are in."""
    pages = payloads.groupBy(key).agg(F.count(F.lit(1)).alias("pages"))
    return labels.join(pages, [key]).select(
        key, "model_coordination", "pages",
        F.concat(F.lit(f"{folder}/key_slug="), slug_col(F.col(key))).alias("payload_file"))


def index_document(index: DataFrame, table_paths: dict[str, str], key: str) -> DataFrame:
    """R5 head: one row with the number of processed keys and the paths of the shared tables."""
    paths = F.create_map(*[F.lit(x) for pair in sorted(table_paths.items()) for x in pair])
    return index.agg(F.count(key).alias("processed_count")).withColumn("tables", paths)


def dashboard_bundle(index: DataFrame, payloads: DataFrame, performance: DataFrame,
                     thresholds: dict[str, float], key: str = "crop_type") -> DataFrame:
    """J5 (index with the payload pages that exist) + J4 (metrics by lower-cased key, missing -> NULL).

    One row per (key, page), upper-cased label, thresholds attached, ordered by key and page.
    """
    rest = [c for c in payloads.columns if c not in (key, "model_coordination", "payload_file", "key_slug")]
    present = index.alias("i").join(payloads.alias("p"), F.col(f"i.{key}") == F.col(f"p.{key}"), "inner") \
        .select(F.col(f"i.{key}").alias(key), "i.model_coordination", "i.payload_file", "i.pages", *[F.col(f"p.{c}") for c in rest])
    perf = performance.alias("m")
    j = present.join(perf, lookup_key(present[key]) == lookup_key(F.col(f"m.{key}")), "left")
    metrics = F.struct(*[json_number(F.col(f"m.{c}")).alias(c) for c in ("mae", "rmse", "mape_pct", "r2")])
    out = j.select(present[key].alias(key), display_key(present[key]).alias("crop_label"),
                   *[present[c] for c in present.columns if c != key], metrics.alias("metrics"),
                   F.struct(*[F.lit(float(v)).alias(k) for k, v in thresholds.items()]).alias("thresholds"))
    return out.orderBy(key, "page")


PAYLOAD_ARRAYS = ("timestamps", "actual_temperature_c", "predicted_temperature_c", "absolute_error_c", "actions",
                  "fan_on", "spray_on")


def payload_rows(payloads: DataFrame, key: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Payload pages flattened: one row per (key, page, position in the page), with the ``keep`` columns."""
    zipped = F.posexplode(F.arrays_zip(*PAYLOAD_ARRAYS)).alias("row_pos", "z")
    flat = payloads.select(key, "page", *keep, zipped)
    return flat.select(key, "page", *keep, "row_pos", *[F.col(f"z.{c}").alias(c) for c in PAYLOAD_ARRAYS])


def last_rows(rows: DataFrame, key: str, k: int = 8, step: int | None = None, time_col: str = "timestamp") -> DataFrame:
    """The newest ``k`` rows per key at or before position ``step``, with ``recent_rank`` 1 for the newest.

    Without a step Spark keeps k rows a key before the shuffle; with one, positions come from a range-partitioned
    sort wherever a key is larger than a block, so that no task ranks a whole key.
    """
    from pyspark.sql import Window
    if step is None:
        newest = Window.partitionBy(key).orderBy(F.col(time_col).desc())
        return rows.withColumn("recent_rank", F.row_number().over(newest)).filter(F.col("recent_rank") <= k)
    placed = positions(rows, [key], [time_col], max_group=group_size_bound(rows, [key]), single_task_rows=DEFAULT_EXEC.block_rows)
    rank = F.least(F.lit(step), F.col(SIZE)) - F.col(POS) + 1
    return placed.withColumn("recent_rank", rank).filter(F.col("recent_rank").between(1, k)).drop(POS, SIZE)


def plot_tables(cleaned: DataFrame, selected: DataFrame, scaled: DataFrame, forecast: DataFrame,
                comparison: DataFrame, ranking: DataFrame, actions: DataFrame, target: str,
                key: str = "crop_type") -> DataFrame:
    """The data behind every chart as one long table (chart, key, timestamp, label, value)."""
    def rows(df, chart, series_key, ts, label, value):
        return df.select(F.lit(chart).alias("chart"), series_key.alias(key), ts.alias("timestamp"),
                         label.alias("label"), value.cast("double").alias("value"))

    null_ts = F.lit(None).cast("timestamp_ntz")
    parts = [
        rows(cleaned, "temperature_trend", F.col(key), F.col("timestamp"), F.lit(target), F.col(target)),
        rows(selected, "before_scaling", F.col(key), F.col("timestamp"), F.lit(target), F.col(target)),
        rows(scaled, "after_scaling", F.col(key), F.col("timestamp"), F.lit(target), F.col(target)),
        rows(forecast, "actual_vs_predicted", F.col(key), F.col("timestamp"), F.lit("actual"),
             F.col("actual_temperature_c")),
        rows(forecast, "actual_vs_predicted", F.col(key), F.col("timestamp"), F.lit("predicted"),
             F.col("predicted_temperature_c")),
        rows(comparison, "model_rmse_by_key", F.col(key), null_ts, F.col("model"), F.col("rmse")),
        rows(ranking, "model_rmse_overall", F.lit(None).cast("string"), null_ts, F.col("model"), F.col("rmse")),
        rows(actions, "action_fan", F.col(key), F.col("timestamp"), F.col("action"), F.col("fan_on")),
        rows(actions, "action_spray", F.col(key), F.col("timestamp"), F.col("action"), F.col("spray_on")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
