import numpy as np
import pytest

from conftest import SF001, needs
from verdant.operators.knn import knn_forecast
from verdant.plans.registry import event_run


def _brute(w, k=7):
    out = {}
    for key, g in w.groupby("crop_type"):
        fit = g[g.is_fit]
        xf = np.vstack(fit.x.values)
        mu, sd = xf.mean(0), xf.std(0)
        sd[sd == 0] = 1
        zf = (xf - mu) / sd
        q = g[g.is_val | (g.split == "test")]
        for _, row in q.iterrows():
            d = np.sqrt(((zf - (np.asarray(row.x) - mu) / sd) ** 2).sum(1))
            idx = np.lexsort((fit._pos.values, d))[:k]
            dd, yy = d[idx], fit.y.values[idx]
            pred = yy[dd == 0].mean() if (dd == 0).any() else (yy / dd).sum() / (1 / dd).sum()
            for split in (["val"] if row.is_val else []) + (["test"] if row.split == "test" else []):
                out[(key, row.timestamp, split)] = pred
    return out


@needs(SF001)
@pytest.mark.parametrize("sizes", [{}, {"pivot_rows": 9, "fit_rows": 7, "query_rows": 5}])
def test_knn_matches_brute_force(spark, sizes):
    run = event_run(spark, SF001)
    w = run.windows
    exp = _brute(w.toPandas())
    got = knn_forecast(w, "crop_type", 12, **sizes).toPandas()
    assert len(got) == len(exp)
    for _, r in got.iterrows():
        assert abs(r.yhat - exp[(r.crop_type, r.timestamp, r.split)]) < 1e-9


def test_autocorrelated_series_need_few_pairs(spark):
    """A slow wave with little noise: most cells are ruled out, and the answer stays exact."""
    import pandas as pd
    from pyspark.sql import functions as F

    from verdant.operators.knn import knn_neighbours
    rng = np.random.default_rng(1)
    n, dim = 4000, 6
    wave = np.sin(np.arange(n + dim) / 40) + rng.normal(0, 0.002, n + dim)
    x = np.stack([wave[i:i + dim] for i in range(n)])
    pdf = pd.DataFrame({"crop_type": "a", "_pos": np.arange(n), "timestamp": pd.to_datetime(np.arange(n), unit="s"),
                        "split": np.where(np.arange(n) < 3000, "train", "test"), "x": list(x), "y": wave[dim:],
                        "is_fit": np.arange(n) < 3000, "is_val": False})
    w = spark.createDataFrame(pdf).withColumn("_pos", F.col("_pos").cast("long"))
    stats: dict = {}
    got = knn_neighbours(w, "crop_type", dim, stats=stats, pivot_rows=50).toPandas()
    assert stats["all_pairs"] == 3000 * 1000 and stats["pairs"] < stats["all_pairs"] / 5
    z = (x - x[:3000].mean(0)) / x[:3000].std(0)
    for t in (3000, 3500, 3999):
        d = np.sqrt(((z[:3000] - z[t]) ** 2).sum(1))
        mine = got[got.id == 2 * t + 1].sort_values("dist")
        assert np.allclose(mine["dist"], np.sort(d)[:7], atol=1e-9)


def test_blocks_keep_ties_and_equal_points():
    from verdant.operators.knn import nearest
    rng = np.random.default_rng(3)
    fit = rng.integers(0, 2, size=(300, 3)).astype(float)  # many equal rows: ties decide
    query, fid = rng.integers(0, 2, size=(40, 3)).astype(float), rng.permutation(300)
    row, col, dist = nearest(query, fit, fid, 5)
    for i in range(40):
        d = np.sqrt(((fit - query[i]) ** 2).sum(1))
        assert list(fid[col[row == i]]) == list(fid[np.lexsort((fid, d))[:5]])
    few = nearest(query, fit[:3], fid[:3], 5)
    assert len(few[0]) == 40 * 3


@needs(SF001)
def test_approximate_neighbours_find_nine_in_ten(spark):
    from pyspark.sql import functions as F

    from verdant.operators.knn import approximate_neighbours, knn_neighbours
    w = event_run(spark, SF001).windows
    exact = knn_neighbours(w, "crop_type", 12).select("crop_type", "id", "fid")
    close = approximate_neighbours(w, "crop_type", 12)
    assert close.groupBy("crop_type", "id").count().filter("count <> 7").count() == 0
    assert exact.join(close, ["crop_type", "id", "fid"]).count() >= 0.9 * exact.count()
    # hardly any candidates: the rest is compared exactly
    poor = approximate_neighbours(w, "crop_type", 12, tables=1, bucket_rows=1)
    assert poor.groupBy("crop_type", "id").agg(F.count(F.lit(1)).alias("n")).filter("n <> 7").count() == 0
    assert poor.select("crop_type", "id").distinct().count() == exact.select("crop_type", "id").distinct().count()


def test_groups_of_blocks_travel_once_a_group(spark, monkeypatch):
    """Many groups of few blocks give the answer of one, and no pair of blocks is shipped by itself."""
    import pandas as pd
    from pyspark.sql import functions as F

    from verdant.operators import knn
    rng = np.random.default_rng(5)
    n, dim = 900, 4
    x = rng.integers(0, 3, size=(n, dim)).astype(float)  # ties and equal points
    pdf = pd.DataFrame({"crop_type": "a", "_pos": np.arange(n), "timestamp": pd.to_datetime(np.arange(n), unit="s"),
                        "split": np.where(np.arange(n) < 600, "train", "test"), "x": list(x), "y": rng.random(n),
                        "is_fit": np.arange(n) < 600, "is_val": False})
    w = spark.createDataFrame(pdf).withColumn("_pos", F.col("_pos").cast("long"))
    small = {"pivot_rows": 60, "fit_rows": 20, "query_rows": 10}
    one = sorted(map(tuple, knn.knn_neighbours(w, "crop_type", dim).collect()))
    monkeypatch.setattr(knn, "GROUP_BLOCKS", 4)
    assert sorted(map(tuple, knn.knn_neighbours(w, "crop_type", dim, **small).collect())) == one


def test_nearest_is_exact_far_from_the_origin():
    """Distances far below single precision: the product in double precision decides."""
    from verdant.operators.knn import nearest
    rng = np.random.default_rng(4)
    fit, query = 50 + rng.normal(0, 1e-4, size=(3000, 5)), 50 + rng.normal(0, 1e-4, size=(20, 5))
    row, col, _ = nearest(query, fit, np.arange(3000), 7)
    for i in range(20):
        assert list(col[row == i]) == list(np.argsort(((fit - query[i]) ** 2).sum(1), kind="stable")[:7])


def _made(spark, n, fit, dim, seed):
    import pandas as pd
    from pyspark.sql import functions as F
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 4, size=(n, dim)) + rng.integers(0, 2, size=(n, 1)) * rng.normal(size=(n, dim))  # some equal points
    pdf = pd.DataFrame({"crop_type": "a", "_pos": np.arange(n), "timestamp": pd.to_datetime(np.arange(n), unit="s"),
                        "split": np.where(np.arange(n) < fit, "train", "test"), "x": list(x), "y": rng.random(n),
                        "is_fit": np.arange(n) < fit, "is_val": False})
    return spark.createDataFrame(pdf).withColumn("_pos", F.col("_pos").cast("long"))


def test_pairs_of_blocks_are_read_and_not_written(spark):
    """Blocks of other pivots come from a product of kept tables: nothing is dealt out once a group of the other side."""
    from verdant.operators.knn import knn_neighbours
    w = _made(spark, 900, 600, 4, 6)
    plan = knn_neighbours(w, "crop_type", 4, pivot_rows=60, fit_rows=20, query_rows=10)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "FlatMapGroupsInPandas" not in plan


def test_a_vector_travels_once_a_group_and_not_once_a_table(spark, monkeypatch):
    """What the look-up is given does not grow with the tables, and its answer not with the groups or the way of comparing."""
    from verdant.operators import knn
    w = _made(spark, 900, 600, 4, 7)
    whole, given = knn._look_up, {}
    for tables in (2, 16):
        def counted(key, dim, k, planes):
            import pandas as pd

            def run(pdf):
                return pd.DataFrame({key: ["a"], "id": [-1], "fid": [sum(map(len, pdf["id"]))], "dist": [0.0], "y_f": [0.0]})
            return run
        monkeypatch.setattr(knn, "_look_up", counted)
        given[tables] = knn.approximate_neighbours(w, "crop_type", 4, tables=tables).filter("id = -1").first().fid
    assert given == {2: 900, 16: 900}
    monkeypatch.setattr(knn, "_look_up", whole)
    one = sorted(map(tuple, knn.approximate_neighbours(w, "crop_type", 4, tables=8, bucket_rows=30).collect()))
    for name, value in (("CROWDED", 1 << 20), ("CROWDED", 1), ("CHUNK", 50)):
        monkeypatch.setattr(knn, name, value)
        assert sorted(map(tuple, knn.approximate_neighbours(w, "crop_type", 4, tables=8, bucket_rows=30).collect())) == one
    monkeypatch.setattr(knn, "FIT_ROWS", 50)
    monkeypatch.setattr(knn, "QUERY_ROWS", 20)
    monkeypatch.setattr(knn, "GROUP_ROWS", 150)
    assert sorted(map(tuple, knn.approximate_neighbours(w, "crop_type", 4, tables=8, bucket_rows=30).collect())) == one


def test_look_up_finds_the_nearest_of_shared_buckets():
    import pandas as pd

    from verdant.operators.knn import _look_up
    rng = np.random.default_rng(8)
    zf, zq, planes = rng.normal(size=(300, 3)), rng.normal(size=(40, 3)), rng.normal(size=(4, 3, 3))
    pdf = pd.DataFrame({"k": "a", "side": [0, 1], "mask": 7, "id": [np.arange(40), np.arange(300)], "y": [np.zeros(40), np.arange(300) / 2],
                        "z": [zq.ravel(), zf.ravel()]})
    got = _look_up("k", 3, 5, planes)(pdf)
    shared = ((np.einsum("nd,tbd->ntb", zq, planes) > 0)[:, None] == (np.einsum("nd,tbd->ntb", zf, planes) > 0)[None]).all(3).any(2)
    for i in range(40):
        d = np.where(shared[i], np.sqrt(((zf - zq[i]) ** 2).sum(1)), np.inf)
        best = np.argsort(d, kind="stable")[:5]
        mine = got[got.id == i]
        assert list(mine.fid) == [j for j in best if np.isfinite(d[j])] and (mine.y_f == mine.fid / 2).all()
