"""ST1: a re-run only processes files that are new since the last run (checkpointed file source)."""
import os
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF001, needs
from verdant.plans.forecast import EVENT_THRESHOLDS as T
from verdant.sources.sinks import shared_path
from verdant.streaming.control_stream import (action_counts, control_actions, drain, event_stream, first_per_hour,
                                               merge_counts)


@needs(SF001)
def test_incremental_refresh_processes_only_new_files(spark):
    src = tempfile.mkdtemp(prefix="verdant-stream-src-")
    shutil.copy(os.path.join(SF001, "events.parquet"), os.path.join(src, "events.parquet"))
    out, ckpt = shared_path(spark, "test-stream", "out"), shared_path(spark, "test-stream", "ckpt")

    def run_once():
        acts = control_actions(event_stream(spark, src), T["low"], T["high"], T["spray"])
        q = (acts.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
             .trigger(availableNow=True).start())
        q.awaitTermination()
        return spark.read.parquet(out).count()

    first = run_once()
    assert first == spark.read.parquet(os.path.join(SF001, "events.parquet")).count()
    assert run_once() == first                       # nothing new: nothing processed
    shutil.copy(os.path.join(SF001, "events.parquet"), os.path.join(src, "events_2.parquet"))
    assert run_once() == 2 * first                   # only the new file is added


def _pieces(spark, folder, n):
    """The events, dealt at random over n files."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.parquet as pq
    table = pq.read_table(os.path.join(SF001, "events.parquet"))
    order = np.random.default_rng(3).permutation(table.num_rows)
    for i, part in enumerate(np.array_split(order, n)):
        pq.write_table(table.take(pa.array(part)), os.path.join(folder, f"events_{i:03d}.parquet"))


@needs(SF001)
@pytest.mark.parametrize("files", [1, 60])
def test_streams_equal_the_batch_answer_for_any_cut(spark, tmp_path, files):
    limits = (T["low"], T["high"], T["spray"])
    _pieces(spark, str(tmp_path), files)
    batch = spark.read.parquet(os.path.join(SF001, "events.parquet")).select(
        F.col("event_type").alias("crop_type"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("reading"), "event_id")

    def stream():
        schema = spark.read.parquet(os.path.join(SF001, "events.parquet")).schema
        raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", 8).parquet(str(tmp_path))
        return raw.select(F.col("event_type").alias("crop_type"), F.col("ts").cast("timestamp").alias("ts"),
                          F.col("value").alias("reading"), "event_id")
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    counts = merge_counts(drain(stream(), "test-counts", lambda b: action_counts(b, *limits)))
    assert same(counts, action_counts(batch, *limits))
    assert counts.agg(F.sum("total_records")).first()[0] == batch.count()
    firsts = first_per_hour(drain(stream(), "test-first", first_per_hour))
    assert same(firsts, first_per_hour(batch))


def _weighted_line(spark, length=3):
    """A stored line a key: AR(1) 0.5 + 0.5 x at the newest step, scaled from [0, 10]."""
    from verdant.plans.store import StoredModels
    linear = spark.createDataFrame([(k, m, 0.25, [0.0] * (length - 1) + [c]) for k in "ab" for m, c in (("m1", 0.25), ("m2", 0.75))],
                                   "crop_type string, model string, intercept double, coef array<double>")
    scaling = spark.createDataFrame([("a", 0.0, 10.0), ("b", 0.0, 10.0)], "crop_type string, t__min double, t__max double")
    weights = spark.createDataFrame([(k, m, 0.5) for k in "ab" for m in ("m1", "m2")], "crop_type string, model string, weight double")
    return StoredModels(1, ["m1", "m2"], ["t"], length, "t", 0, scaling, linear, None, None), weights


def test_forecast_refresh_does_not_depend_on_cuts_and_flags_late_rows(spark):
    from verdant.sources.sinks import shared_path
    from verdant.streaming.control_stream import drain
    from verdant.streaming.forecast_stream import combined, observation_stream, refresh_forecasts
    stored, weights = _weighted_line(spark)
    models = combined(stored, weights, "crop_type").cache()
    assert [round(c, 6) for c in models.first()["coef"]] == [0.0, 0.0, 0.5]
    t = F.timestamp_seconds(F.col("i") * 60).cast("timestamp_ntz").alias("timestamp")
    rows = spark.createDataFrame([(k, i, float((i * 7 + n) % 10)) for n, k in enumerate("abz") for i in range(20)],
                                 "crop_type string, i long, t double")
    whole = None
    for cuts in ([20], [1, 2, 3, 9, 20], list(range(1, 21))):
        folder, begin = shared_path(spark, "arrivals-test"), 0
        out, checkpoint = shared_path(spark, "out-test"), shared_path(spark, "checkpoint-test")
        for end in cuts:  # a run for every cut: the state is found again, old files are not read again
            rows.filter(F.col("i").between(begin, end - 1)).select("crop_type", t, "t").repartition(2, "crop_type").write.mode("append").parquet(folder)
            stream = observation_stream(folder, rows.select("crop_type", t, "t"))
            made = drain(refresh_forecasts(stream, models, stored, "crop_type"), "refresh", out=out, checkpoint=checkpoint)
            begin = end
        got = sorted((r.crop_type, str(r.timestamp), round(r.actual, 4), None if r.predicted is None else round(r.predicted, 4), r.late)
                     for r in made.collect())
        whole = whole or got
        assert got == whole and len(got) == 40  # the key without a model has no rows
    a = [r for r in whole if r[0] == "a"]
    assert [r[3] for r in a[:3]] == [None] * 3 and a[3][3] == round((0.25 + 0.5 * a[2][2] / 10) * 10, 4)
    # a row that comes too late changes nothing but is told
    rows.filter("i = 5").select("crop_type", t, F.lit(9.0).alias("t")).write.mode("append").parquet(folder)
    made = drain(refresh_forecasts(observation_stream(folder, rows.select("crop_type", t, "t")), models, stored, "crop_type"),
                 "refresh", out=out, checkpoint=checkpoint)
    late = made.filter("late").collect()
    assert sorted(r.crop_type for r in late) == ["a", "b"] and all(r.predicted is None for r in late)
    assert made.filter("not late").count() == 40


@needs(SF001)
@pytest.mark.parametrize("files", [1, 11])
def test_event_time_state_gives_the_batch_answer_and_stays_small(spark, files):
    from datetime import timedelta

    from verdant.streaming.control_stream import COUNTS, merge_counts
    from verdant.streaming.event_time import counts_table, drain_table, shuffled_events
    limits = (T["low"], T["high"], T["spray"])
    table = counts_table(spark, shared_path(spark, "event-test"), *limits, timedelta(days=1), keep=4)
    got = drain_table(shuffled_events(spark, SF001, files), table).select("window_start", "crop_type", *COUNTS)
    batch = spark.read.parquet(f"{SF001}/events.parquet").select(
        F.col("event_type").alias("crop_type"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("reading"), "event_id")
    want = merge_counts(action_counts(batch, *limits)).select(*got.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert len(table.parts("closed")) <= 5 and len(table.parts("late")) <= 5 and len(table.numbers("open")) <= 2
    hours = {r[0] for r in spark.read.parquet(table._part("open", table.numbers("open")[-1])).select("window_start").distinct().collect()}
    assert len(hours) <= 26  # open windows end within a day of the latest event
    # a batch that is repeated overwrites its own parts
    table.write(batch.limit(0), table.numbers("open")[-1] + 1)
    again = table.read().select(*got.columns)
    assert again.exceptAll(want).count() == 0 and want.exceptAll(again).count() == 0
