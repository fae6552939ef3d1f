"""Connected components by alternating large and small stars, as joins and partial aggregates.

Before the rounds the edges of each task, ``TASK_EDGES`` of them, shrink to a spanning forest, so
that edges which fit one task need no round and others go on as fewer.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no package import

TASK_EDGES = 1 << 17


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(a, b): each node of these edges but the least of its component with that least node."""
    parent: dict = {}

    def find(x):
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    for batch in batches:
        for a, b in zip(batch["a"], batch["b"]):
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    nodes = [x for x in parent if find(x) != x]
    yield pd.DataFrame({"a": nodes, "b": [find(x) for x in nodes]}, columns=["a", "b"])


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b); the root is the least node of the component.

    Loops and repeated edges are harmless, rows with a null end are ignored; no edges give no rows.
    """
    now = cut(edges.filter("a is not null and b is not null and a <> b").select("a", "b").distinct())
    tasks = -(-now.count() // TASK_EDGES)
    dealt = now.repartition(tasks, "a", "b") if tasks > 1 else now.coalesce(1)
    now = cut(dealt.mapInPandas(_forest, now.schema))
    mark = None
    while tasks > 1:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # cut, so that the join reads two plain shuffles and Spark can split a hot node
        least = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        large = both.join(least, "a").filter("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = cut(large)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b")))
        now = cut(small.filter("a <> b").distinct())
        seen = now.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first()  # one row
        if seen == mark:
            break
        mark = seen
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
