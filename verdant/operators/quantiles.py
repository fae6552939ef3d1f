"""Exact, linearly interpolated quantiles without per-group value buffers.

Spark's ``percentile`` keeps every distinct value of a group in one task's
hash map; for a hot group that is unbounded.  Here equal values are counted
first, with map-side partial counts, so a value that very many rows share is
one row; distinct values are then range-partitioned, cumulative counts come
from partition totals, and only the two order statistics around each requested
quantile are picked.  No task ever holds a group or all rows of a value.
Semantics equal pandas ``quantile`` / DuckDB ``quantile_cont``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, shuffle_partitions
from .series import _join_on, group_size_bound

# Groups up to this many values are ranked by Spark's exact ``percentile``
# (its buffer holds the group's distinct values, bounded by this count).
SINGLE_TASK_VALUES = 1 << 20


def _long(df: DataFrame, group_cols: Sequence[str], value_cols: Sequence[str]) -> DataFrame:
    kv = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in value_cols
    ])).alias("_kv")
    long = df.select(*group_cols, kv).select(*group_cols, "_kv.column", "_kv.value")
    return long.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def quantile_name(p: float) -> str:
    return "q_" + f"{p:g}".replace(".", "_")


def cumulative_counts(long: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """(keys, value, _count, _before, _n): per distinct value its count, the rows below it and the group's rows."""
    counts = long.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("_count"))
    order = [*keys, "value"]
    n = partitions or shuffle_partitions(long.sparkSession)
    # The range partition of a row must stay what it is: checkpoint once.
    tagged = materialize(counts.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()))
    inside = Window.partitionBy(*keys, "_part").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = tagged.groupBy(*keys, "_part").agg(F.sum("_count").alias("_rows")).select(
        *keys, "_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_off"),
        F.sum("_rows").over(Window.partitionBy(*keys)).alias("_n"))
    own = tagged.withColumn("_own", F.coalesce(F.sum("_count").over(inside), F.lit(0)))
    return _join_on(own, parts, [*keys, "_part"]).withColumn("_before", F.col("_own") + F.col("_off")).drop("_own", "_off", "_part")


def exact_quantiles(df: DataFrame, group_cols: Sequence[str], value_cols: Sequence[str],
                    probs: Sequence[float], method: str = "exact",
                    single_task_values: int | None = None,
                    size_hint: int | None = None) -> DataFrame:
    """One row per (group, column) with a ``q_<p>`` column per probability.

    The largest (group, column) is measured first: up to
    ``single_task_values`` values Spark's exact ``percentile`` is used,
    beyond that counts of distinct values.  ``size_hint`` is an upper bound on the
    rows of any group that the caller already measured (skips that job).
    ``method="approx"`` switches to ``percentile_approx`` (bounded sketches,
    not exact).
    """
    group_cols = list(group_cols)
    long = _long(df, group_cols, value_cols)
    keys = [*group_cols, "column"]
    if method == "approx":
        return long.groupBy(*keys).agg(*[
            F.percentile_approx("value", p, 100000).alias(quantile_name(p)) for p in probs])
    limit = SINGLE_TASK_VALUES if single_task_values is None else single_task_values
    # A group's row count bounds the values of each of its columns: measure on the input.
    if size_hint is not None:
        bound = size_hint
    elif group_cols:
        bound = group_size_bound(df, group_cols)
    else:
        bound = df.count()
    if bound <= limit:
        q = F.percentile("value", F.array(*[F.lit(float(p)) for p in probs]))
        agg = long.groupBy(*keys).agg(q.alias("_q"))
        return agg.select(*keys, *[F.col("_q")[i].alias(quantile_name(p)) for i, p in enumerate(probs)])
    ranked = cumulative_counts(long, keys)
    picks = []
    for p in probs:
        h = (F.col("_n") - F.lit(1)) * F.lit(float(p))
        picks.append((F.floor(h) + 1, F.ceil(h) + 1, h - F.floor(h), F.ceil(h) - h))

    def at(rank):
        return (F.col("_before") < rank) & (rank <= F.col("_before") + F.col("_count"))
    wanted = None
    for lo, hi, *_ in picks:
        cond = at(lo) | at(hi)
        wanted = cond if wanted is None else (wanted | cond)
    picked = ranked.filter(wanted)
    aggs = []
    for i, (lo, hi, above, below) in enumerate(picks):
        aggs += [
            F.max(F.when(at(lo), F.col("value"))).alias(f"_lo{i}"),
            F.max(F.when(at(hi), F.col("value"))).alias(f"_hi{i}"),
            F.max(above).alias(f"_up{i}"), F.max(below).alias(f"_dn{i}"),
        ]
    agg = picked.groupBy(*keys).agg(*aggs)
    out = [F.col(k) for k in keys]
    for i, p in enumerate(probs):
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        # the arithmetic of Spark's percentile, so that both ways agree to the last bit
        out.append(F.when(lo == hi, lo).otherwise(F.col(f"_dn{i}") * lo + F.col(f"_up{i}") * hi).alias(quantile_name(p)))
    return agg.select(*out)


def wide_quantiles(df: DataFrame, value_cols: Sequence[str], probs: Sequence[float],
                   method: str = "exact", size_hint: int | None = None,
                   single_task_values: int | None = None) -> DataFrame:
    """Global quantiles as a single row: ``<col>__q_<p>`` columns (null when a column is all-null)."""
    long = exact_quantiles(df, [], value_cols, probs, method, single_task_values=single_task_values,
                           size_hint=size_hint)
    aggs = []
    for c in value_cols:
        for p in probs:
            qn = quantile_name(p)
            aggs.append(F.max(F.when(F.col("column") == c, F.col(qn))).alias(f"{c}__{qn}"))
    return long.agg(*aggs)
