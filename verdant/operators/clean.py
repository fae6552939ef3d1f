"""Cleaning operators (C1-C8, P12, P14) on a keyed observation table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import (CLIP_HIGH_Q, CLIP_LOW_Q, DEFAULT_EXEC, DEFAULT_KEY_COLUMN, DEFAULT_TARGET,
                      DEFAULT_TIME, PREFERRED_FEATURES)
from ..sources.ingest import resolve_target
from .quantiles import exact_quantiles, quantile_name, wide_quantiles
from ..session import materialize
from .series import POS, SIZE, group_sizes, positions, with_neighbours

INTERNAL = {POS, SIZE, "_order"}


def numeric_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    skip = set(exclude) | INTERNAL
    return [c for c, t in df.dtypes if c not in skip and t in ("double", "float", "int", "bigint",
                                                               "smallint", "tinyint")]


def missing_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, missing) for every column: one aggregation pass, then unpivot."""
    cols = [c for c in (columns or df.columns) if c not in INTERNAL]
    dtypes = dict(df.dtypes)

    def missing(c):
        col = F.col(f"`{c}`")
        if dtypes[c] in ("double", "float"):
            return F.count_if(col.isNull() | F.isnan(col))
        return F.count_if(col.isNull())

    wide = df.agg(*[missing(c).cast("long").alias(f"m{i}") for i, c in enumerate(cols)])
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing")) for i, c in enumerate(cols)
    ]))
    return wide.select(pairs.alias("p")).select("p.column", "p.missing")


def drop_null_time(df: DataFrame, time_col: str = DEFAULT_TIME) -> DataFrame:
    """P12."""
    return df.filter(F.col(time_col).isNotNull())


FIXED_WIDTH = {"double", "float", "bigint", "int", "smallint", "tinyint", "boolean", "date",
               "timestamp", "timestamp_ntz"}


def dedupe_first(df: DataFrame, keys: Sequence[str], order_col: str = "_order") -> DataFrame:
    """Keep the first row (lowest ``order_col``) of each ``keys`` group.

    A grouped ``min_by`` rather than a window: copies are merged map-side
    before the shuffle, so a key with very many copies never lands whole in
    one task.  Fixed-width columns get one ``min_by`` each (hash aggregation);
    otherwise the row is carried as one struct (sort-based aggregation).
    """
    others = [c for c in df.columns if c not in keys]
    types = dict(df.dtypes)
    order = F.col(order_col)
    if all(types[c] in FIXED_WIDTH for c in others):
        aggs = [F.min(order).alias(c) if c == order_col else F.min_by(F.col(c), order).alias(c) for c in others]
        return df.groupBy(*keys).agg(*aggs).select(*keys, *others)
    agg = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in others]), order).alias("_first"))
    return agg.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in others])


def interpolate_linear(df: DataFrame, key: str, cols: Sequence[str], block_rows: int,
                       pos_col: str = POS, single_block: bool = False) -> DataFrame:
    """Linear interpolation by row position inside each key, both directions (C4).

    Leading and trailing gaps take the nearest valid value; the spacing is the
    row position, not the time difference.
    """
    nb = with_neighbours(df, [key], cols, block_rows, pos_col, single_block)
    pos = F.col(pos_col)
    filled = []
    for c in cols:
        pv, pp, nv, np_ = (F.col(f"_{p}_{c}") for p in ("pv", "pp", "nv", "np"))
        val = (F.when(F.col(c).isNotNull(), F.col(c))
               .when(pv.isNull(), nv)
               .when(nv.isNull() | (np_ == pp), pv)
               .otherwise(pv + (nv - pv) * (pos - pp) / (np_ - pp)))
        filled.append(val.alias(c))
    keep = [c for c in df.columns if c not in cols]
    return nb.select(*keep, *filled).select(*df.columns)


def fill_group_median(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Replace NULLs by the key's exact median of the column."""
    med = exact_quantiles(df, [key], cols, [0.5])
    wide = med.groupBy(key).agg(*[
        F.max(F.when(F.col("column") == c, F.col(quantile_name(0.5)))).alias(f"_med_{c}") for c in cols])
    joined = df.join(wide, [key], "left")
    return joined.select(*[F.coalesce(F.col(c), F.col(f"_med_{c}")).alias(c) if c in cols else F.col(c)
                           for c in df.columns])


def fill_global_median(df: DataFrame, cols: Sequence[str], size_hint: int | None = None,
                       single_task_values: int | None = None) -> DataFrame:
    """Replace remaining NULLs by the exact median over all keys (C6). One-row side table."""
    # One row, computed once: every reader of the result would rank all values again.
    med = materialize(wide_quantiles(df, cols, [0.5], size_hint=size_hint, single_task_values=single_task_values))
    joined = df.crossJoin(F.broadcast(med))
    q = quantile_name(0.5)
    return joined.select(*[F.coalesce(F.col(c), F.col(f"{c}__{q}")).alias(c) if c in cols else F.col(c)
                           for c in df.columns])


def clip_bounds(df: DataFrame, cols: Sequence[str], low_q: float = CLIP_LOW_Q,
                high_q: float = CLIP_HIGH_Q, method: str = "exact", size_hint: int | None = None,
                single_task_values: int | None = None) -> DataFrame:
    """One row: ``<c>__q_<low>`` / ``<c>__q_<high>`` over all keys."""
    return wide_quantiles(df, cols, [low_q, high_q], method, size_hint=size_hint,
                          single_task_values=single_task_values)


def clip_quantile(df: DataFrame, cols: Sequence[str], low_q: float = CLIP_LOW_Q,
                  high_q: float = CLIP_HIGH_Q, method: str = "exact", size_hint: int | None = None,
                  single_task_values: int | None = None) -> DataFrame:
    """Clip every column to its global [q_low, q_high] (C7). NULL stays NULL."""
    bounds = materialize(clip_bounds(df, cols, low_q, high_q, method, size_hint, single_task_values))
    lo_n, hi_n = quantile_name(low_q), quantile_name(high_q)
    joined = df.crossJoin(F.broadcast(bounds))

    def clipped(c):
        v = F.col(c)
        lo, hi = F.col(f"{c}__{lo_n}"), F.col(f"{c}__{hi_n}")
        inner = F.when(hi.isNotNull() & (v > hi), hi).otherwise(v)
        return F.when(v.isNull(), v).when(lo.isNotNull() & (inner < lo), lo).otherwise(inner).alias(c)

    return joined.select(*[clipped(c) if c in cols else F.col(c) for c in df.columns])


def clean_dataset(df: DataFrame, key: str = DEFAULT_KEY_COLUMN, time_col: str = DEFAULT_TIME,
                  order_col: str = "_order", block_rows: int = DEFAULT_EXEC.block_rows,
                  group_median: bool = False, clip_method: str = "exact",
                  single_task_values: int = DEFAULT_EXEC.single_task_values,
                  stats: dict | None = None) -> DataFrame:
    """C8 = P12 -> C3 -> C4 -> (C5) -> C6 -> C7.

    Output keeps ``_pos`` (1-based time rank inside the key) and ``_n`` (rows
    of the key) for the windowing operators.  C5 is off by default: after
    two-sided interpolation a key's column is either complete or entirely
    NULL, and the median of an all-NULL column is NULL, so C5 cannot change
    any value.  ``stats`` (optional) receives the measured key statistics
    (``max_group``, ``rows``, ``groups``; upper bounds for the cleaned table).
    """
    cols = numeric_columns(df, [key, time_col, order_col])
    base = drop_null_time(df, time_col)
    # Raw per-key counts bound the de-duplicated ones from above: measuring
    # them needs only a scan with map-side counting, not the de-dup shuffle.
    bound, total = group_sizes(base, [key], stats)
    deduped = dedupe_first(base, [key, time_col], order_col).drop(order_col)
    ranked = positions(deduped, [key], [time_col], max_group=bound, single_task_rows=block_rows)
    filled = interpolate_linear(ranked, key, cols, block_rows, single_block=bound <= block_rows)
    if group_median:
        filled = fill_group_median(filled, key, cols)
    # Two global passes (median, then clip quantiles) read the repaired
    # series: checkpoint it once instead of re-running dedupe + windows.
    filled = fill_global_median(materialize(filled), cols, size_hint=total,
                                single_task_values=single_task_values)
    return clip_quantile(filled, cols, method=clip_method, size_hint=total,
                         single_task_values=single_task_values)


def select_features(df: DataFrame, target: str = DEFAULT_TARGET, time_col: str = DEFAULT_TIME,
                    key: str = DEFAULT_KEY_COLUMN) -> tuple[DataFrame, str, list[str]]:
    """Time, key, target, preferred measures in fixed order, then other numerics."""
    cols = [c for c in df.columns if c not in INTERNAL]
    resolved = resolve_target(cols, target)
    feats = [c for c in [resolved, *PREFERRED_FEATURES] if c in cols]
    feats = list(dict.fromkeys(feats))
    for c in numeric_columns(df, [time_col, key, resolved]):
        if c not in feats:
            feats.append(c)
    keep = [time_col] + ([key] if key in cols else []) + feats
    keep += [c for c in (POS, SIZE) if c in df.columns]
    return df.select(*keep), resolved, feats
