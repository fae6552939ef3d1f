"""Event-time state for windowed results that never lose a late row (ST2, ST3).

Spark's own watermarked aggregations drop rows that come after their window was closed.
Here a micro-batch is reduced once, and its partial results go one of three ways:

* windows still open: merged with the open windows of the batch before into a new snapshot;
* windows that the watermark (latest event time so far less ``delay``) now closes: written
  out once, and they leave the snapshot;
* windows closed before: late rows, written to a side table and merged by the reader.

So the state is the open windows, however long the stream runs, a retried batch overwrites
its own parts, and the answer equals the batch one for files in any cut and order.  Every
``keep`` batches the closed and late parts so far are merged into one (``compact``), so that
a reader opens at most one merged part and ``keep`` small ones of each kind.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import shared_path
from .control_stream import (COUNTS, EVENT_THRESHOLDS, action_counts, event_stream, first_per_hour, merge_counts)

KEEP = 16


class EventTimeTable:
    """A folder with the open snapshot, closed windows, late parts and progress of one stream.

    ``reduce`` turns rows into partial results, ``merge`` merges partial results, ``end`` is the column with
    a window's end and ``top`` its start, which stands for the latest event time; ``merge`` keeps both columns.
    """

    def __init__(self, spark: SparkSession, folder: str, reduce: Callable, merge: Callable, delay: timedelta, keep: int = KEEP):
        self.spark, self.folder, self.reduce, self.merge, self.delay, self.keep = spark, folder, reduce, merge, delay, keep

    # ------------------------------------------------------------ folders
    def _fs(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def numbers(self, kind: str) -> list[int]:
        """Batch numbers that have a complete part of this kind, in order."""
        base, fs = self._fs()
        path = self.spark._jvm.org.apache.hadoop.fs.Path(base, kind)
        if not fs.exists(path):
            return []
        done = self.spark._jvm.org.apache.hadoop.fs.Path
        return sorted(int(x.getPath().getName().split("=")[1]) for x in fs.listStatus(path)
                      if fs.exists(done(x.getPath(), "_SUCCESS")))

    def _part(self, kind: str, number: int) -> str:
        return f"{self.folder}/{kind}/n={number}"

    def _drop(self, kind: str, numbers: list[int]) -> None:
        _, fs = self._fs()
        for n in numbers:
            fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(self._part(kind, n)), True)

    def parts(self, kind: str) -> list[str]:
        """The newest merged part and the parts after it."""
        merged = self.numbers(f"{kind}_merged")[-1:]
        after = merged[0] if merged else -1
        return [self._part(f"{kind}_merged", n) for n in merged] + [self._part(kind, n) for n in self.numbers(kind) if n > after]

    # ------------------------------------------------------------ batches
    def write(self, batch: DataFrame, number: int) -> None:
        """One micro-batch (for foreachBatch); running it again gives the same parts."""
        self.reduce(batch).write.mode("overwrite").parquet(self._part("parts", number))
        parts = self.spark.read.parquet(self._part("parts", number))
        earlier = [n for n in self.numbers("progress") if n < number]
        top = parts.agg(F.max("top")).first()[0]
        before = self.spark.read.parquet(self._part("progress", earlier[-1])).first()[0] if earlier else None
        tops = [t for t in (top, before) if t is not None]
        now = max(tops) if tops else None  # the latest event time so far

        def closed_by(latest):
            return F.lit(False) if latest is None else F.col("end") <= F.lit(latest - self.delay)

        parts.filter(closed_by(before)).write.mode("overwrite").parquet(self._part("late", number))
        merged = parts.filter(~closed_by(before))
        if earlier:
            merged = self.merge(self.spark.read.parquet(self._part("open", earlier[-1])).unionByName(merged))
        merged.filter(closed_by(now)).write.mode("overwrite").parquet(self._part("closed", number))
        merged.filter(~closed_by(now)).write.mode("overwrite").parquet(self._part("open", number))
        self.spark.createDataFrame([(now,)], "top timestamp").coalesce(1).write.mode("overwrite").parquet(self._part("progress", number))
        for kind in ("parts", "open", "progress"):  # the batch before is kept: this one may have to be repeated
            self._drop(kind, [n for n in self.numbers(kind) if n < number - 1])
        if (number + 1) % self.keep == 0:
            self.compact(number)

    def compact(self, number: int) -> None:
        """Merge the closed and the late parts up to a batch into one of each, then drop what they replace."""
        for kind in ("closed", "late"):
            if number in self.numbers(f"{kind}_merged"):
                continue  # a repeated batch: done before
            paths = [p for p in self.parts(kind) if int(p.rsplit("=", 1)[1]) <= number]
            if not paths:
                continue
            self.merge(self.spark.read.parquet(*paths)).write.mode("overwrite").parquet(self._part(f"{kind}_merged", number))
            self._drop(f"{kind}_merged", [n for n in self.numbers(f"{kind}_merged") if n < number])
            self._drop(kind, [n for n in self.numbers(kind) if n < number])

    def read(self) -> DataFrame:
        """The answer so far: closed, late and open windows merged."""
        newest = self.numbers("open")[-1:]
        paths = self.parts("closed") + self.parts("late") + [self._part("open", n) for n in newest]
        return self.merge(self.spark.read.parquet(*paths))


def counts_table(spark: SparkSession, folder: str, low: float, high: float, spray: float, delay: timedelta, keep: int = KEEP) -> EventTimeTable:
    """ST2: tumbling-hour action counts per key."""
    def reduce(rows):
        return action_counts(rows, low, high, spray).withColumn("end", F.col("window_end")).withColumn("top", F.col("window_start"))

    def merge(partials):
        sums = merge_counts(partials)
        return sums.withColumn("end", F.col("window_end")).withColumn("top", F.col("window_start"))

    return EventTimeTable(spark, folder, reduce, merge, delay, keep)


def first_table(spark: SparkSession, folder: str, delay: timedelta, keep: int = KEEP) -> EventTimeTable:
    """ST3: the first reading per (key, hour)."""
    def keyed(rows):
        return first_per_hour(rows).withColumn("end", F.col("hour") + F.expr("INTERVAL 1 HOUR")).withColumn("top", F.col("hour"))

    return EventTimeTable(spark, folder, keyed, keyed, delay, keep)


def drain_table(stream: DataFrame, table: EventTimeTable, checkpoint: str | None = None) -> DataFrame:
    """Process everything that is new and return the answer so far."""
    checkpoint = checkpoint or shared_path(stream.sparkSession, "streams", "event-time")
    (stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
     .foreachBatch(table.write).start().awaitTermination())
    return table.read()


def shuffled_events(spark: SparkSession, sf_dir: str, files: int) -> DataFrame:
    """Stream of the events dealt over ``files`` files at random, one a micro-batch: most rows come late."""
    from ..sources.tables import read_table
    folder = shared_path(spark, "shuffled")
    read_table(spark, sf_dir, "events").repartition(files, F.xxhash64("event_id")).write.parquet(f"{folder}/events.parquet")
    return event_stream(spark, folder, 1)


def q_event_time_counts(spark, sf_dir, files: int = 5):
    """ST2 by event-time state: events shuffled over files, two days of delay, late windows merged."""
    from ..plans.registry import finish
    t = EVENT_THRESHOLDS
    table = counts_table(spark, shared_path(spark, "event-counts"), t["low"], t["high"], t["spray"], timedelta(days=2), keep=3)
    return finish(drain_table(shuffled_events(spark, sf_dir, files), table).select("window_start", "window_end", "crop_type", *COUNTS))


def q_event_time_dedupe(spark, sf_dir, files: int = 5):
    """ST3 by event-time state."""
    from ..plans.registry import finish
    table = first_table(spark, shared_path(spark, "event-first"), timedelta(days=2), keep=3)
    return finish(drain_table(shuffled_events(spark, sf_dir, files), table).select("crop_type", "ts", "event_id", "reading"))
