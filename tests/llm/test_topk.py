import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from verdant.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, r int, c int"


def brute(rows, k=5):
    fine = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in fine:
        if i % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in fine if j != i and len(v) == len(q))
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 0, 1, 2) for i, v in rows], SCHEMA)
    return sorted(tuple(r) for r in topk.top_k(topk.integer_vectors(df), F.col("vec_id") % 50 == 0, **kw).collect())


@pytest.mark.parametrize("block,queries", [(8192, 2048), (37, 2)])
def test_equals_brute_force(spark, block, queries):
    rng = np.random.default_rng(3)
    v = rng.normal(0, 0.2, (400, 16)).astype(np.float32)
    v[100:160] = v[100]  # ties
    v[200:220] = 0
    rows = [(int(i), [float(x) for x in v[i]]) for i in range(400)]
    assert run(spark, rows, block=block, queries=queries) == brute(rows)


def test_edges(spark):
    rows = [(0, [1.0, -1.0]), (50, [0.5, 0.5]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]),
            (None, [1.0, 1.0]), (5, [1.0, 2.0, 3.0]), (6, [0.25, 0.75]), (100, [1.0, 1.0, 1.0]), (150, []), (7, [])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0])]) == []


def test_repeated_ids_and_rows(spark):
    rng = np.random.default_rng(8)
    v = [[float(x) for x in row] for row in rng.normal(0, 0.5, (300, 4))]
    one_id = [(50, v[i]) for i in range(120)] + [(7, x) for x in v[120:200]]
    same = [(7, v[200])] * 40 + [(100, v[201])] * 30 + [(i, v[i]) for i in range(202, 300)]
    rows = one_id + same
    want = {}
    for i, n, j, s in brute(rows):
        want.setdefault(i, []).append((-s, j))
    want = [(i, n + 1, j, -s) for i, best in want.items() for n, (s, j) in enumerate(sorted(best)[:5])]
    assert run(spark, rows, block=16, queries=8) == sorted(want)


def test_stops_before_reading_all_lists():
    rng = np.random.default_rng(5)
    vectors = rng.integers(-10, 10, (5000, 4))
    vectors[:20] *= 50

    class Counted(np.ndarray):
        read = 0

        def __getitem__(self, item):
            out = super().__getitem__(item)
            if isinstance(item, np.ndarray) and item.ndim == 1 and out.ndim == 2:
                Counted.read += len(out)
            return out
    order = np.argsort(vectors, axis=0, kind="stable").T
    found, scores = topk.threshold_search(np.array([3, 1, 2, 4]), vectors.view(Counted), order, np.arange(5000), -1, 5)
    want = np.sort(vectors @ np.array([3, 1, 2, 4]))[::-1][:5]
    assert sorted(map(int, scores), reverse=True) == list(map(int, want)) and Counted.read < 2500
