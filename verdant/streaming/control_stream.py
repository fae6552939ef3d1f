"""Structured Streaming forms of the control flow (ST1-ST3).

The batch flow recomputes everything; these process only files that are new
since the last run (file source + checkpoint), with ``availableNow`` so a run
drains what is there and stops.

Windowed counts and first-per-hour de-duplication must not depend on how files
are cut or ordered.  So no watermark decides what counts: each micro-batch
reduces its own rows to partial results (one row per window and key), written
under its batch id (a retried batch replaces its own part), and a reader merges
the partials.  Late files simply add partials; nothing is dropped, no state is
kept in memory, and open windows are visible at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.control import threshold_action
from ..plans.forecast import EVENT_THRESHOLDS
from ..sources.sinks import shared_path
from ..sources.tables import read_table

FILES_PER_TRIGGER = 64
COUNTS = ("total_records", "fan_on_events", "spray_on_events", "fan_and_spray_events", "idle_events")


def event_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Stream of event observations from the table's folder (new files only)."""
    schema = read_table(spark, sf_dir, "events").schema
    raw = (spark.readStream.format("parquet").schema(schema)
           .option("pathGlobFilter", "*.parquet").option("maxFilesPerTrigger", files_per_trigger)
           .load(f"{sf_dir.rstrip('/')}/events*.parquet"))
    return raw.select(F.col("event_type").alias("crop_type"), F.col("ts").cast("timestamp").alias("ts"),
                      F.col("value").alias("reading"), "event_id")


def control_actions(stream: DataFrame, low: float, high: float, spray: float) -> DataFrame:
    """ST1: the threshold rule applied to each arriving reading."""
    acts = threshold_action(F.col("reading"), low, high, spray)
    return stream.select("crop_type", "ts", "event_id", "reading", *[v.alias(k) for k, v in acts.items()])


def action_counts(rows: DataFrame, low: float, high: float, spray: float, window: str = "1 hour") -> DataFrame:
    """ST2 partials: tumbling-window action counts per key of the given rows."""
    acts = control_actions(rows, low, high, spray)
    return acts.groupBy(F.window("ts", window).alias("w"), "crop_type").agg(
        F.count(F.lit(1)).alias("total_records"),
        F.sum("fan_on").cast("long").alias("fan_on_events"),
        F.sum("spray_on").cast("long").alias("spray_on_events"),
        F.count_if(F.col("action") == "fan_and_spray_on").alias("fan_and_spray_events"),
        F.count_if(F.col("action") == "idle").alias("idle_events")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "crop_type", *COUNTS)


def merge_counts(partials: DataFrame) -> DataFrame:
    """ST2: counts over all micro-batches."""
    return partials.groupBy("window_start", "window_end", "crop_type").agg(*[F.sum(c).alias(c) for c in COUNTS])


def first_per_hour(rows: DataFrame) -> DataFrame:
    """ST3, partial or merged: the earliest reading per (key, hour), ties by event id."""
    first = F.min_by(F.struct("ts", "event_id", "reading"), F.struct("ts", "event_id"))
    return rows.groupBy("crop_type", F.date_trunc("hour", "ts").alias("hour")).agg(first.alias("f")).select(
        "crop_type", "hour", "f.ts", "f.event_id", "f.reading")


def drain(stream: DataFrame, name: str, reduce=None, out: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Process everything that is new into Parquet under the shared folder; return what the table has then.

    ``reduce`` turns a micro-batch into its partial result.
    """
    spark = stream.sparkSession
    out = out or shared_path(spark, "streams", name, "out")
    checkpoint = checkpoint or shared_path(spark, "streams", name, "checkpoint")
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if reduce is None:
        writer.format("parquet").option("path", out).start().awaitTermination()
        return spark.read.parquet(out)

    def write(batch: DataFrame, batch_id: int) -> None:
        reduce(batch).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
    writer.foreachBatch(write).start().awaitTermination()
    return spark.read.parquet(out).drop("batch")


def stream_queries() -> dict:
    t = EVENT_THRESHOLDS
    limits = (t["low"], t["high"], t["spray"])

    from ..plans.registry import finish

    def stream_control(spark, d):
        return finish(drain(control_actions(event_stream(spark, d), *limits), "control"))

    def stream_window_counts(spark, d):
        return finish(merge_counts(drain(event_stream(spark, d), "window_counts", lambda b: action_counts(b, *limits))))

    def stream_dedupe(spark, d):
        return finish(first_per_hour(drain(event_stream(spark, d), "dedupe", first_per_hour)).drop("hour"))

    from .forecast_stream import q_stream_forecast

    return {"stream_control": stream_control, "stream_window_counts": stream_window_counts,
            "stream_dedupe": stream_dedupe, "stream_forecast": q_stream_forecast}
