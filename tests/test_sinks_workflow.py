import os

from conftest import SF001, needs
from verdant.plans.forecast import EVENT_THRESHOLDS, event_config
from verdant.plans.workflow import load_bundle, run_workflow
from verdant.sources import sinks
from verdant.sources.tables import event_observations


def test_empty_table_keeps_header(spark):
    path = sinks.shared_path(spark, "test-empty")
    sinks.write_table_csv(spark.createDataFrame([], "rank int, model string, rmse double"), path)
    local = path.replace("file:", "", 1)
    text = "".join(open(os.path.join(local, f)).read() for f in os.listdir(local) if f.endswith(".csv"))
    assert text.strip() == "rank,model,rmse"


def test_read_json_missing_is_empty(spark):
    assert sinks.read_json(spark, "/nonexistent/verdant/path").count() == 0


@needs(SF001)
def test_workflow_writes_everything(spark):
    out = sinks.shared_path(spark, "test-workflow")
    paths = run_workflow(spark, event_observations(spark, SF001), out, event_config())
    for name, path in paths.items():
        assert os.path.isdir(path.replace("file:", "", 1)), name
    keys = spark.read.option("header", True).csv(paths["classified_inputs"]).select("key_slug").distinct().count()
    assert keys == 5
    rows = load_bundle(spark, paths, EVENT_THRESHOLDS).collect()
    assert [r["crop_label"] for r in rows] == sorted(r["crop_type"].upper() for r in rows)
    assert all(os.path.isdir(r["payload_file"].replace("file:", "", 1)) for r in rows)
    assert all(r["model_prediction_columns"] == ["pred_linear_baseline_c", "pred_naive_persistence_c"] for r in rows)
    head = sinks.read_json(spark, paths["payload_index_head"]).first()
    assert head["processed_count"] == 5 and head["tables"]["overall_crop_results"] == paths["overall_crop_results"]
    assert all(r["metrics"]["rmse"] is not None for r in rows)
    status = spark.read.text(paths["pipeline_status"]).first()[0]
    assert status.startswith("Crops discovered: 5")


@needs(SF001)
def test_paths_follow_slugs_and_pages_are_not_multiplied(spark):
    from pyspark.sql import functions as F
    out = sinks.shared_path(spark, "test-pages")
    obs = event_observations(spark, SF001).withColumn("crop_type", F.concat(F.lit("Zone 1/"), F.col("crop_type")))
    paths = run_workflow(spark, obs, out, event_config(), page_rows=10)
    rows = load_bundle(spark, paths, EVENT_THRESHOLDS).collect()
    assert len(rows) == sinks.read_json(spark, paths["ui_payload"]).count() > 5
    assert len({(r["crop_type"], r["page"]) for r in rows}) == len(rows)
    assert all(os.path.isdir(r["payload_file"].replace("file:", "", 1)) and "key_slug=zone_1_" in r["payload_file"] for r in rows)


def test_unreadable_input_is_not_an_empty_table(spark, tmp_path):
    import pytest
    with pytest.raises(Exception, match="nosuchscheme"):
        sinks.read_json(spark, f"nosuchscheme://{tmp_path}/x")


def test_submitted_settings_survive(tmp_path):
    import subprocess
    import sys

    import pyspark
    script = tmp_path / "job.py"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script.write_text(f"import sys; sys.path.insert(0, {root!r})\n"
                      "from verdant.session import build_session\n"
                      "s = build_session()\n"
                      "print('GOT', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'))\n")
    submit = os.path.join(os.path.dirname(pyspark.__file__), "bin", "spark-submit")
    done = subprocess.run([submit, "--master", "local[2]", "--conf", "spark.sql.shuffle.partitions=77", "--conf", "spark.ui.enabled=false",
                           str(script)], capture_output=True, text=True, timeout=180, env=os.environ | {"PYSPARK_PYTHON": sys.executable})
    assert "GOT local[2] 77" in done.stdout, done.stderr[-2000:]


def test_nothing_to_forecast_is_an_error(spark):
    import pytest
    from verdant.plans.forecast import ForecastRun
    few = spark.createDataFrame([("a", 1, 1.0, 2.0)], "crop_type string, d int, indoor_temperature_c double, humidity_pct double").selectExpr(
        "crop_type", "cast(make_date(2025, 1, d) as timestamp_ntz) AS timestamp", "indoor_temperature_c", "humidity_pct", "1L AS _order")
    run = ForecastRun(few, event_config())
    assert run.eligibility.first().reason == "1 rows, 12 needed"
    with pytest.raises(ValueError):
        run.require_results()
