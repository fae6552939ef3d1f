"""Sinks (K1-K8) and read-back.

Every sink is a full overwrite of a directory written by Spark tasks in
parallel; per-key exports use ``partitionBy`` so each key lands in its own
folder without a driver-side loop.
"""

from __future__ import annotations

import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import slug_col
from ..session import ensure_checkpoint_dir


# Times in CSV keep their microseconds (the default format stops at milliseconds).
CSV_TIMES = {f: "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]" for f in ("timestampFormat", "timestampNTZFormat")}


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark)
    if base is None:
        raise RuntimeError("no shared directory: set spark.checkpoint.dir")
    return os.path.join(base, "verdant", *parts, uuid.uuid4().hex)


def export_by_key(df: DataFrame, path: str, key: str = "crop_type", fmt: str = "csv") -> str:
    """K1/K2/K5: one folder per key slug (keys whose slugs collide share a folder, no row is lost)."""
    # Clustered by folder and time first, else each task writes a file into every folder;
    # ranges, so that a hot key is spread over several tasks and files.
    out = df.withColumn("key_slug", slug_col(F.col(key)))
    order = ["key_slug"] + [c for c in ("timestamp",) if c in df.columns]
    writer = out.repartitionByRange(*order).write.mode("overwrite").partitionBy("key_slug")
    if fmt == "csv":
        writer.options(header=True, **CSV_TIMES).csv(path)
    else:
        writer.format(fmt).save(path)
    return path


def write_params(params_long: DataFrame, path: str) -> str:
    """K3: scaling parameters as JSON lines (key, feature, min_val, max_val)."""
    params_long.write.mode("overwrite").json(path)
    return path


def write_windows(windows: DataFrame, path: str, key: str = "crop_type") -> str:
    """K4: the window table (arrays of doubles) as Parquet, partitioned by key slug."""
    return export_by_key(windows, path, key, fmt="parquet")


def write_table_csv(df: DataFrame, path: str) -> str:
    """K6: results / comparison / ranking tables with a header (kept for empty tables)."""
    df.write.mode("overwrite").options(header=True, **CSV_TIMES).csv(path)
    return path


def write_json_documents(df: DataFrame, path: str) -> str:
    """K7: one JSON document per row (nested arrays/maps kept)."""
    df.write.mode("overwrite").json(path)
    return path


def write_text_report(lines: DataFrame, path: str, column: str = "line") -> str:
    """K8: plain-text report lines."""
    lines.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)
    return path


def read_json(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Read JSON documents back; malformed records become NULL rows, a missing path is empty."""
    reader = spark.read.option("mode", "PERMISSIVE").option("multiLine", False)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema or "value string")


CORRUPT = "_corrupt"


def read_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON document a file, over any number of lines; ``_corrupt`` has the text of one that cannot be read.

    ``schema`` is explicit, so nothing is inferred; a missing path is empty.
    """
    shape = f"{schema}, {CORRUPT} string"
    try:
        return spark.read.schema(shape).options(mode="PERMISSIVE", multiLine=True, columnNameOfCorruptRecord=CORRUPT).json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], shape)


def write_documents(df: DataFrame, path: str, name: str, document: str) -> str:
    """K7, indented: one file a row, in a folder named by the value of ``name``."""
    indented = F.to_json(document, {"pretty": "true", "ignoreNullFields": "false"})
    df.select(F.col(name), indented.alias("value")).write.mode("overwrite").partitionBy(name).option("maxRecordsPerFile", 1).text(path)
    return path


def rename_part(spark: SparkSession, folder: str, name: str) -> str:
    """Give the single part file of a folder a name of its own (some readers take meaning from file names)."""
    base = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = [x.getPath() for x in fs.listStatus(base) if x.getPath().getName().startswith("part-")]
    if len(parts) != 1:
        raise ValueError(f"{folder} has {len(parts)} part files, not one")
    fs.rename(parts[0], spark._jvm.org.apache.hadoop.fs.Path(base, name))
    return f"{folder}/{name}"


def read_csv(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Read a CSV table back (header row)."""
    reader = spark.read.options(header=True, **CSV_TIMES)
    return reader.schema(schema).csv(path) if schema is not None else reader.option("inferSchema", True).csv(path)
