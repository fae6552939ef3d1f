"""Driver tables and their mapping onto the observation schema.

Observation schema (one row per key and time):
``crop_type`` string key, ``timestamp`` timestamp_ntz, numeric measures,
and ``_order`` (the input order used to pick the first of duplicate rows).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import clean_key_col

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Fixed value of the queries whose feature is missing values: a device quality
# code k at or above this level marks the reading invalid (the table has no NULLs).
EVENT_INVALID_CODE = 90
# Distance in input order of the altered second copy that the de-duplication query adds.
SECOND_COPY_ORDER = 1 << 40


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def event_observations(spark: SparkSession, sf_dir: str, blanks: bool = False) -> DataFrame:
    """events -> observations at their own times: key=event_type, time=ts, target=value, humidity=props.k.

    Every event is one observation.  ``blanks`` makes readings of invalid
    quality NULL, for the queries about missing values.
    """
    ev = read_table(spark, sf_dir, "events")
    code = F.get_json_object("props", "$.k").try_cast("double")
    value = F.when(code >= F.lit(EVENT_INVALID_CODE), F.lit(None).cast("double")).otherwise(F.col("value")) \
        if blanks else F.col("value")
    return ev.select(
        clean_key_col(F.col("event_type")).alias("crop_type"),
        F.col("ts").cast("timestamp_ntz").alias("timestamp"),
        value.alias("indoor_temperature_c"),
        code.alias("humidity_pct"),
        F.col("event_id").alias("_order"),
    )


def event_observations_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every observation and, later in input order, an altered copy of it with the same key and time."""
    obs = event_observations(spark, sf_dir)
    later = obs.withColumn("indoor_temperature_c", F.col("indoor_temperature_c") + 1000).withColumn(
        "humidity_pct", F.lit(None).cast("double")).withColumn("_order", F.col("_order") + SECOND_COPY_ORDER)
    return later.unionByName(obs)


def order_day_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders -> daily revenue and count per priority (a second keyed series source)."""
    o = read_table(spark, sf_dir, "orders")
    return o.groupBy(
        F.coalesce("o_orderpriority", F.lit("nan")).alias("crop_type"), F.col("o_orderdate").alias("timestamp")
    ).agg(F.sum("o_totalprice").alias("indoor_temperature_c"), F.count(F.lit(1)).cast("double").alias("n_orders"))
