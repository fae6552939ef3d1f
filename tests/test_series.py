import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from verdant.operators.quantiles import exact_quantiles
from verdant.operators.series import POS, SIZE, positions, with_lags, with_neighbours


def _frame(spark):
    rows = []
    for key, n in (("a", 37), ("b", 5), ("c", 1), ("d", 64)):
        for i in range(n):
            v = None if (i * 7 + len(key)) % 5 == 0 or (key == "d" and 10 <= i < 40) else float(i * i % 13)
            rows.append((key, i * 3 + (1 if key == "b" else 0), v))
    rows.append(("e", 1, None))
    rows.append(("e", 2, None))
    return spark.createDataFrame(rows, "k string, t long, v double")


def test_positions_match_row_number(spark):
    df = _frame(spark)
    got = positions(df, ["k"], ["t"], num_partitions=7).toPandas().sort_values(["k", "t"])
    exp = df.toPandas().sort_values(["k", "t"])
    exp["rn"] = exp.groupby("k").cumcount() + 1
    exp["n"] = exp.groupby("k")["t"].transform("size")
    assert list(got[POS]) == list(exp["rn"])
    assert list(got[SIZE]) == list(exp["n"])


def test_lags_cross_blocks(spark):
    df = positions(_frame(spark), ["k"], ["t"], num_partitions=3)
    got = with_lags(df, ["k"], ["t"], 4, block_rows=6).toPandas().sort_values(["k", "t"])
    for k in range(1, 5):
        exp = got.groupby("k")["t"].shift(k)
        assert np.allclose(got[f"t__lag{k}"].fillna(-1), exp.fillna(-1))
    assert len(got) == 109


def test_neighbours_interpolate_like_pandas(spark):
    df = positions(_frame(spark), ["k"], ["t"], num_partitions=3)
    nb = with_neighbours(df, ["k"], ["v"], block_rows=4)
    pv, pp, nv, np_ = (F.col(c) for c in ("_pv_v", "_pp_v", "_nv_v", "_np_v"))
    filled = (F.when(F.col("v").isNotNull(), F.col("v")).when(pv.isNull(), nv)
              .when(nv.isNull(), pv).otherwise(pv + (nv - pv) * (F.col(POS) - pp) / (np_ - pp)))
    got = nb.select("k", "t", filled.alias("f")).toPandas().sort_values(["k", "t"])
    src = _frame(spark).toPandas().sort_values(["k", "t"])
    exp = src.groupby("k")["v"].transform(lambda s: s.reset_index(drop=True).interpolate(
        method="linear", limit_direction="both").set_axis(s.index))
    assert np.allclose(got["f"].astype(float).fillna(-99).values, exp.fillna(-99).values)


def test_exact_quantiles_match_pandas(spark):
    df = _frame(spark)
    got = exact_quantiles(df, ["k"], ["v", "t"], [0.01, 0.5, 0.99]).toPandas()
    src = df.toPandas()
    for _, r in got.iterrows():
        s = src[src.k == r["k"]][r["column"]].dropna().astype(float)
        for p, name in ((0.01, "q_0_01"), (0.5, "q_0_5"), (0.99, "q_0_99")):
            assert abs(s.quantile(p) - r[name]) < 1e-9
    assert set(got[got.column == "v"]["k"]) == {"a", "b", "c", "d"}


def test_sort_based_quantiles_match_pandas(spark):
    df = _frame(spark)
    got = exact_quantiles(df, ["k"], ["v"], [0.01, 0.5, 0.99], single_task_values=0).toPandas()
    fast = exact_quantiles(df, ["k"], ["v"], [0.01, 0.5, 0.99]).toPandas()
    m = got.merge(fast, on=["k", "column"])
    for q in ("q_0_01", "q_0_5", "q_0_99"):
        assert np.allclose(m[q + "_x"], m[q + "_y"], atol=1e-12)


def test_positions_descending_order_both_paths(spark):
    df = _frame(spark)
    a = positions(df, ["k"], [F.col("t").desc()], num_partitions=5).toPandas().sort_values(["k", "t"])
    b = positions(df, ["k"], [F.col("t").desc()], max_group=100, single_task_rows=100).toPandas() \
        .sort_values(["k", "t"])
    assert list(a[POS]) == list(b[POS])
    exp = df.toPandas().sort_values(["k", "t"], ascending=[True, False])
    exp["rn"] = exp.groupby("k").cumcount() + 1
    assert list(exp.sort_values(["k", "t"])["rn"]) == list(a[POS])


def test_null_key_is_a_series(spark):
    rows = [(None, t, float(t) if t % 3 else None) for t in range(1, 30)] + [("a", t, float(t)) for t in range(1, 5)]
    df = spark.createDataFrame(rows, "k string, t long, v double")
    ranked = positions(df, ["k"], ["t"], num_partitions=4)
    assert ranked.count() == len(rows)
    nb = with_neighbours(ranked, ["k"], ["v"], block_rows=4).toPandas()
    nulls = nb[nb.k.isna()].sort_values("t")
    assert len(nulls) == 29 and nulls["_pv_v"].iloc[3:].notna().all()


def test_long_windows_equal_the_lag_path(spark):
    """168 steps as slices of blocks equal a lag column each, in blocks of any size, with as few columns as 6 steps."""
    from verdant.operators import windows
    rows = [(k, i, float((i * 37 + n) % 101), float(i % 13)) for n, k in enumerate(("a", "b")) for i in range(900 - 300 * n)]
    ranked = positions(spark.createDataFrame(rows, "crop_type string, i long, t double, h double").withColumn(
        "timestamp", F.timestamp_seconds("i").cast("timestamp_ntz")), ["crop_type"], ["i"], num_partitions=3)

    def made(lag_slots, length=168, block_rows=250):
        return windows.sliding_windows(ranked, "crop_type", "t", ["t", "h"], length, block_rows=block_rows, lag_slots=lag_slots)
    lags = made(10_000)
    for block_rows in (10, 250, 1 << 17):
        long = made(0, block_rows=block_rows)
        assert long.columns == lags.columns and long.count() == lags.count() > 0
        assert long.exceptAll(lags).count() == 0

    def width(df):
        return max(len(line.split(",")) for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines())
    assert width(made(0)) == width(made(0, length=6)) < width(lags) / 5
