"""Property tests (many generated cases per Spark call) and partition invariance."""
import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF001, needs
from verdant.operators import ensemble, windows

rmse_lists = st.lists(
    st.lists(st.one_of(st.floats(min_value=0.0, max_value=50.0), st.just(0.0), st.just(float("nan"))),
             min_size=1, max_size=8),
    min_size=1, max_size=25)


@settings(max_examples=6, deadline=None)
@given(rmse_lists)
def test_weights_are_a_bounded_ordered_share(spark, cases):
    rows = [(f"k{i}", f"m{j}", float(v)) for i, case in enumerate(cases) for j, v in enumerate(case)]
    df = spark.createDataFrame(rows, "crop_type string, model string, validation_rmse double")
    got = ensemble.ensemble_weights(ensemble.scores(df, "m0"), "crop_type").toPandas()
    for i, case in enumerate(cases):
        g = got[got.crop_type == f"k{i}"].sort_values("model")
        assert len(g) == len(case)
        assert abs(g["weight"].sum() - 1.0) < 1e-9
        w, score = g["weight"].to_numpy(), np.nan_to_num(g["score"].to_numpy(), nan=0.0)
        assert (w >= 0).all() and (w <= 1 + 1e-12).all()
        if (score <= 0).all():
            assert np.allclose(w, 1 / len(w))
        order = np.argsort(score)
        assert (np.diff(w[order]) >= -1e-9).all()  # a better score never weighs less


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(st.floats(min_value=-1e6, max_value=1e6), min_size=1, max_size=30),
                min_size=1, max_size=10))
def test_scale_then_inverse_is_identity(spark, series):
    rows = [(f"k{i}", j, float(v)) for i, s in enumerate(series) for j, v in enumerate(s)]
    df = spark.createDataFrame(rows, "crop_type string, rid long, v double")
    scaled, params = windows.minmax_scale(df, ["crop_type"], ["v"])
    back = scaled.withColumnRenamed("v", "s").join(params, ["crop_type"]).select(
        "crop_type", "rid", "s", windows.inverse_expr(F.col("s"), F.col("v__min"), F.col("v__max")).alias("back"),
        "v__min", "v__max").toPandas()
    assert len(back) == len(rows)
    assert back["s"].between(0.0, 1.0).all()
    orig = {(k, j): v for k, j, v in rows}
    for r in back.itertuples():
        want = r.v__min if r.v__min == r.v__max else orig[(r.crop_type, r.rid)]
        assert abs(r.back - want) <= 1e-9 * max(1.0, abs(want), abs(r.v__max - r.v__min))


@needs(SF001)
def test_partition_invariance(spark):
    import __spark_entry__ as E
    names = ["clean_dataset", "sliding_windows", "crop_results", "knn_forecast"]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    out = {}
    try:
        for n in ("1", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            out[n] = {q: E.queries()[q](spark, SF001).toPandas() for q in names}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for q in names:
        a, b = out["1"][q], out["16"][q]
        cols = sorted(a.columns)
        a = a[cols].sort_values(cols).reset_index(drop=True)
        b = b[cols].sort_values(cols).reset_index(drop=True)
        pd.testing.assert_frame_equal(a, b, check_exact=False, rtol=1e-9)
