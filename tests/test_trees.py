"""Trees of all keys: the same nodes wherever they grow, and what must hold of any forest or boosting."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from verdant.operators import trees

DIM = 3


def made_windows(spark, sizes, seed=0):
    """Windows of keys of the given sizes; y follows the first slot in steps."""
    rng = np.random.default_rng(seed)
    rows = []
    for key, n in sizes.items():
        for i in range(n):
            x = [round(float(v), 3) for v in rng.random(DIM)]
            y = float(np.float32(min(1.0, round(x[0], 1) * 0.8 + 0.2 * x[1])))
            fit = i < n * 3 // 4
            rows.append((key, i, "train" if fit else "test", x, y, fit, False))
    df = spark.createDataFrame(rows, "crop_type string, _pos long, split string, x array<double>, y double, is_fit boolean, is_val boolean")
    return df.withColumn("timestamp", F.timestamp_seconds("_pos").cast("timestamp_ntz")).repartition(4)


def table(nodes):
    return sorted(tuple(r) for r in nodes.drop("threshold").collect())


@pytest.fixture(scope="module")
def windows(spark):
    return made_windows(spark, {"a": 400, "b": 90, "c": 8, "d": 2}).persist()


def test_forest_is_the_same_in_one_task_and_level_by_level(spark, windows):
    kw = {"trees": 23, "depth": 5}
    one = trees.forest(windows, "crop_type", DIM, **kw)
    assert table(one) == table(trees.forest(windows, "crop_type", DIM, local_rows=20, **kw))
    assert one.select("crop_type", "tree").distinct().count() == 4 * 23


def test_forest_does_not_depend_on_partitioning(spark, windows):
    a = trees.forest(windows.repartition(1), "crop_type", DIM, trees=5)
    assert table(a) == table(trees.forest(windows.repartition(7, "y"), "crop_type", DIM, trees=5))


def test_boosting_is_the_same_in_one_task_and_level_by_level(spark, windows):
    for kw in ({"rounds": 7}, {"rounds": 4, "depth": 4, "columns": 0.7}):
        one = trees.boosted(windows, "crop_type", DIM, **kw)
        assert table(one) == table(trees.boosted(windows, "crop_type", DIM, local_rows=20, cut_every=2, **kw))


def test_splits_equal_a_scan_of_all_cuts(spark):
    rng = np.random.default_rng(1)
    bins = rng.integers(0, trees.BINS, size=(200, DIM)).astype(np.uint8)
    target = rng.integers(0, 1 << 30, size=200)
    weights = rng.integers(0, 3, size=(1, 200))
    top = trees.grow(bins, target, weights, 1, 5, np.arange(DIM))[0]
    w, best = weights[0], (0.0,)
    for f in range(DIM):
        for c in range(trees.BINS - 1):
            left = bins[:, f] <= c
            n, m = w[left].sum(), w[~left].sum()
            if min(n, m) >= 5:
                s, t = float((w * target)[left].sum()), float((w * target)[~left].sum())
                gain = s * s / n + t * t / m - (s + t) ** 2 / (n + m)
                if gain > best[0]:
                    best = (gain, f, c)
    assert (top[2], top[3]) == best[1:]


def test_predictions_stay_within_targets_and_follow_them(spark, windows):
    nodes = trees.forest(windows, "crop_type", DIM, trees=40)
    p = trees.tree_forecast(windows, nodes, "crop_type", DIM, "random_forest").toPandas()
    assert len(p) == windows.filter("split = 'test'").count()
    span = windows.filter("is_fit").groupBy("crop_type").agg(F.min("y").alias("lo"), F.max("y").alias("hi")).toPandas()
    j = p.merge(span, on="crop_type")
    assert ((j.yhat >= j.lo - 1e-9) & (j.yhat <= j.hi + 1e-9)).all()
    big = p[p.crop_type == "a"]
    assert np.sqrt(((big.y - big.yhat) ** 2).mean()) < 0.05


def test_boosting_lowers_the_training_loss_and_a_constant_key_has_no_split(spark):
    w = made_windows(spark, {"a": 300}).unionByName(made_windows(spark, {"flat": 60}).withColumn("y", F.lit(0.25)))
    nodes = trees.boosted(w, "crop_type", DIM, rounds=60)
    fit = w.filter("is_fit").withColumn("split", F.lit("fit"))
    loss = [trees.predict(fit, nodes.filter(F.col("tree") < r), "crop_type", DIM).filter("crop_type = 'a'").select(
        F.avg((F.col("y") - F.col("prediction")) ** 2)).first()[0] for r in (1, 20, 60)]
    assert loss[0] > loss[1] > loss[2]
    flat = trees.predict(fit, nodes, "crop_type", DIM).filter("crop_type = 'flat'")
    assert flat.filter(F.abs(F.col("prediction") - 0.25) > 1e-8).count() == 0
    assert nodes.filter("crop_type = 'flat' AND feature >= 0").count() == 0


def test_two_hundred_keys_take_one_job_each_step(spark):
    w = made_windows(spark, {f"k{i}": 12 for i in range(200)})
    nodes = trees.forest(w, "crop_type", DIM, trees=4, depth=3)
    p = trees.tree_forecast(w, nodes, "crop_type", DIM, "random_forest")
    assert p.groupBy("crop_type").count().filter("count = 3").count() == 200


def test_no_fit_windows_give_no_nodes(spark):
    empty = made_windows(spark, {"a": 8}).filter("false")
    assert trees.forest(empty, "crop_type", DIM, trees=2).count() == 0
    assert trees.boosted(empty, "crop_type", DIM, rounds=2).count() == 0


def test_counts_of_joint_slots_and_of_the_smaller_child_equal_plain_counts():
    """Histograms by three, two and one slots at a time are the same, and every row's leaf is the one a walk finds."""
    rng = np.random.default_rng(2)
    bins = rng.integers(0, trees.BINS, size=(300_000, 4)).astype(np.uint8)
    target, weights = rng.integers(0, 1 << 30, size=300_000), rng.integers(0, 2, size=300_000)
    row = np.flatnonzero(weights)
    got = trees._counts(bins, np.zeros(len(row), dtype=np.int64), 1, row, None, target[row].astype(float), np.array([0, 2, 3]), {})
    for i, f in enumerate((0, 2, 3)):
        assert (got[0, i, 0] == np.bincount(bins[row, f], minlength=trees.BINS)).all()
        assert (got[1, i, 0] == np.bincount(bins[row, f], target[row], trees.BINS)).all()
    leaves = np.zeros(300_000, dtype=np.int64)
    nodes = trees.grow(bins, target, weights[None], 4, 1, np.arange(4), leaves=leaves)
    assert (leaves[row] == trees.leaf_of(bins, nodes, 4)[row]).all()


def test_each_tree_is_walked_once_for_all_stops(spark, windows):
    nodes = trees.boosted(windows, "crop_type", DIM, rounds=12)
    got = {r.crop_type: r for r in trees.staged_loss(windows, nodes, "crop_type", DIM, [1, 5, 12]).collect()}
    fit = windows.filter("is_fit").withColumn("split", F.lit("fit"))
    for i, stop in enumerate((1, 5, 12)):
        p = trees.predict(fit, nodes.filter(F.col("tree") < stop), "crop_type", DIM)
        for r in p.groupBy("crop_type").agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("y") - F.col("prediction")) ** 2).alias("l")).collect():
            assert got[r.crop_type].n == r.n and abs(got[r.crop_type].loss[i] - r.l) < 1e-12


def test_large_models_meet_blocks_by_group_of_trees(spark, windows, monkeypatch):
    nodes = trees.forest(windows, "crop_type", DIM, trees=45)
    def scores():
        return {(r.crop_type, r.timestamp): r.yhat for r in trees.tree_forecast(windows, nodes, "crop_type", DIM, "random_forest").collect()}
    one = scores()
    monkeypatch.setattr(trees, "SCORE_NODES", 10)
    many = scores()
    assert one.keys() == many.keys() and all(abs(one[k] - many[k]) < 1e-12 for k in one)
