"""Ingest edge rows: free-form headers, lenient casts, key and time synthesis, skipped files."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from verdant.operators.clean import clean_dataset, missing_report
from verdant.sources.ingest import alias_mapping, discover_files, load_sources, resolve_target


def _write(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w") as fh:
        fh.write(text)
    return path


@pytest.fixture(scope="module")
def raw_dir():
    d = tempfile.mkdtemp(prefix="verdant-ingest-")
    _write(d, "a_tomato_sensor.csv",
           "Recorded At,Temp (C),RH,Soil Moisture\n"
           "2025-01-01 00:00:00,20.5,70,30\n"
           "2025-01-01 01:00:00,abc,71,31\n"        # text in a numeric column
           "not a time,21.0,72,32\n"                # bad timestamp -> dropped by cleaning
           "2025-01-01T02:00:00,22.0,NA,33\n"       # 'T' separator, NA token
           "2025-01-01 02:00:00,99.0,73,34\n")      # duplicate time: first row wins
    _write(d, "b_mixed.csv",
           "class,temperature,humidity\n"
           "Okra ,25,60\n"
           ",26,61\n"                                # missing key -> text of a missing value
           "   ,26.5,61\n"                             # whitespace-only key -> default key
           "OKRA,27,62\n")                           # no time column: hourly by row position
    _write(d, "c_chilli_days.csv",
           "day,air_temperature\n0,30\n0.5,31\n1,32\n")   # time from day offset, key from file name
    _write(d, "d_no_temperature.csv", "timestamp,humidity\n2025-01-01,50\n")  # skipped
    _write(d, "notes.txt", "ignored")
    return d


def test_discovery_and_aliases(spark, raw_dir):
    files = discover_files(spark, ["file://" + raw_dir, os.path.join(raw_dir, "missing.csv")])
    assert [os.path.basename(f) for f in files] == ["a_tomato_sensor.csv", "b_mixed.csv",
                                                    "c_chilli_days.csv", "d_no_temperature.csv"]
    m = alias_mapping(["Recorded At", "Temp (C)", "RH", "class", "Temperature", "temp"])
    assert m["Recorded At"] == "timestamp" and m["class"] == "crop_type" and m["RH"] == "humidity_pct"
    assert m["Temperature"] == "indoor_temperature_c" and "Temp (C)" not in m  # earlier alias wins
    assert resolve_target(["timestamp", "leaf_temp_x"], "indoor_temperature_c") == "leaf_temp_x"
    with pytest.raises(ValueError):
        resolve_target(["timestamp", "humidity"], "indoor_temperature_c")


def test_load_standardize_and_clean(spark, raw_dir):
    raw = load_sources(spark, [raw_dir])
    pdf = raw.toPandas()
    pdf["_order"] = pdf["_order"].apply(lambda d: (d["src"], d["block"], d["row"]))
    assert "humidity" not in pdf.columns and "d_no_temperature" not in "".join(map(str, pdf.get("source", [])))
    a = pdf[pdf.crop_type == "tomato"].sort_values("_order")
    assert list(a["indoor_temperature_c"].isna()) == [False, True, False, False, False]
    assert a["timestamp"].isna().sum() == 1
    b = pdf[pdf.crop_type.isin(["okra", "mixed_crop", "nan"])].sort_values("_order")
    assert list(b.crop_type) == ["okra", "nan", "mixed_crop", "okra"]
    assert list(b.timestamp.astype(str)) == ["2025-01-01 00:00:00", "2025-01-01 01:00:00",
                                             "2025-01-01 02:00:00", "2025-01-01 03:00:00"]
    c = pdf[pdf.crop_type == "green_chilli"].sort_values("timestamp")
    assert list(c.timestamp.astype(str)) == ["2025-01-01 00:00:00", "2025-01-01 12:00:00", "2025-01-02 00:00:00"]
    rep = {r["column"]: r["missing"] for r in missing_report(raw).collect()}
    assert rep["timestamp"] == 1
    cleaned = clean_dataset(raw, block_rows=2).toPandas()
    t = cleaned[cleaned.crop_type == "tomato"].sort_values("timestamp")
    assert len(t) == 3                                     # bad time dropped, duplicate hour removed
    assert t["indoor_temperature_c"].notna().all()
    assert cleaned["soil_moisture_pct"].notna().all()     # all-null in other keys -> global median


@pytest.mark.parametrize("text,want", [
    ("03/15/2025", "2025-03-15 00:00:00"), ("3/5/2025 4:05", "2025-03-05 04:05:00"), ("15-03-2025 10:00", "2025-03-15 10:00:00"),
    ("2025/03/15 10:00", "2025-03-15 10:00:00"), ("Mar 15, 2025", "2025-03-15 00:00:00"), ("20250315", "2025-03-15 00:00:00"),
    ("2025-03-15T10:00:00", "2025-03-15 10:00:00"), ("15 March 2025 1:05 PM", "2025-03-15 13:05:00"), ("13/13/2025", None), ("soon", None)])
def test_time_formats(spark, text, want):
    from verdant.functions.values import lenient_timestamp
    got = spark.createDataFrame([(text,)], "t string").select(lenient_timestamp(F.col("t")).cast("string")).first()[0]
    assert got == want


def test_files_of_one_header_are_one_scan(spark, tmp_path):
    for i in range(12):
        _write(str(tmp_path), f"okra_{i:02d}.csv", f"time,temp\n2025-01-{i + 1:02d} 00:00:00,{i}\n")
    raw = load_sources(spark, [f"file://{tmp_path}"])
    assert raw._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    rows = raw.orderBy("timestamp").collect()
    assert [r.indoor_temperature_c for r in rows] == list(range(12)) and {r.crop_type for r in rows} == {"ladysfinger"}
    assert [r["_order"]["src"] for r in rows] == list(range(12))


def test_dropped_rows_are_counted(spark, raw_dir):
    from verdant.sources.ingest import dropped_rows
    got = {r.crop_type: (r["rows"], r.dropped) for r in dropped_rows(load_sources(spark, [raw_dir])).collect()}
    assert got["tomato"] == (5, 1) and got["okra"] == (2, 0)


def test_headers_of_many_files_come_from_one_job(spark, tmp_path):
    from verdant.sources.ingest import read_headers
    n = 2000
    for i in range(n):
        _write(str(tmp_path), f"f{i:05d}.csv", "﻿time,temp\r\n" if i % 3 == 0 else '"temp","a,b"\n1,2\n' if i % 3 == 1 else "")
    files = list(enumerate(discover_files(spark, [f"file://{tmp_path}"])))
    tracker, sc = spark.sparkContext.statusTracker(), spark.sparkContext
    sc.setJobGroup("headers", "headers")
    found = read_headers(spark, files)
    sc.setJobGroup("", "")
    assert len(tracker.getJobIdsForGroup("headers")) <= 4  # whatever the number of files
    assert {h: len(p) for h, p in found.items()} == {("time", "temp"): 667, ("temp", "a,b"): 667, (): 666}
    assert found[("time", "temp")][:2] == [(0, files[0][1]), (3, files[3][1])]


def test_long_header_lines_and_text_reader_agree(spark, tmp_path, monkeypatch):
    from verdant.sources import ingest
    wide = ",".join(f"column {i}" for i in range(20_000))
    _write(str(tmp_path), "a.csv", wide + "\n1\n")
    _write(str(tmp_path), "b.csv", "temp,time\n" + "1,2025-01-01\n" * 50)
    _write(str(tmp_path), "c.csv", "")
    files = list(enumerate(discover_files(spark, [f"file://{tmp_path}"])))
    by_tasks = ingest.read_headers(spark, files)
    monkeypatch.setattr(ingest, "TASK_SCHEMES", ())
    assert ingest.read_headers(spark, files) == by_tasks
    assert [len(h) for h in by_tasks] == [20_000, 2, 0]


def test_documents_over_several_lines(spark, tmp_path):
    from verdant.sources import sinks
    _write(str(tmp_path), "a.json", '{\n  "name": "okra",\n  "values": [1,\n 2]\n}\n')
    _write(str(tmp_path), "b.json", '{\n  "name": "cut off",\n  "values": [1,')
    _write(str(tmp_path), "c.json", '[\n {"name": "one"},\n {"name": "two", "values": null, "more": 3}\n]')
    rows = sinks.read_documents(spark, f"file://{tmp_path}", "name string, values array<int>").collect()
    good = sorted((r.name, r["values"]) for r in rows if r._corrupt is None)
    assert good == [("okra", [1, 2]), ("one", None), ("two", None)]
    assert [r._corrupt.startswith('{\n  "name": "cut off"') for r in rows if r._corrupt is not None] == [True]
    assert sinks.read_documents(spark, "/nonexistent/verdant/path", "name string").columns == ["name", "_corrupt"]
