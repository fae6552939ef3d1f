"""Session construction and lineage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "verdant",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Session with the settings every module assumes (UTC, AQE, no UI).

    Master, memory and partition counts are set only when asked for, or when the
    process was not submitted to a cluster (a plain local run); ``spark-submit``
    settings stay as they are.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Checkpointed lineage cuts are written with Kryo and compressed.
        .config("spark.serializer", "org.apache.spark.serializer.KryoSerializer")
        .config("spark.checkpoint.compress", "true")
        # Remove checkpoint files of datasets that are no longer referenced.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    submitted = "PYSPARK_GATEWAY_PORT" in os.environ
    if master or not submitted:
        cpus = int(os.environ.get("BENCH_CPUS", "8"))
        builder = builder.master(master or f"local[{cpus}]").config("spark.driver.memory", "16g")
        shuffle_partitions = shuffle_partitions or cpus
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Use the cluster's ``spark.checkpoint.dir``; create one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="verdant-ckpt-"))
        return sc.getCheckpointDir()
    return None


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage: reliable checkpoint to the shared checkpoint directory.

    Used where two branches of one plan must see the very same rows (for
    example ids assigned after a range sort).
    """
    if not ensure_checkpoint_dir(df.sparkSession):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return df.checkpoint(eager=True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
