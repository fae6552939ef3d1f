"""Group filter, min-max scaling, chronological split and sliding windows.

All of these are arithmetic on the position columns produced by cleaning
(``_pos``, ``_n``), plus one halo-window pass for the lags.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_EXEC, DEFAULT_KEY_COLUMN, MIN_TRAIN_WINDOWS, SEQUENCE_LENGTH, TEST_RATIO, VALIDATION_RATIO
from ..functions.values import finite_or_zero
from ..session import materialize
from .series import POS, SIZE, join_small, with_history, with_lags

# Slots of a window up to which a lag column each is the cheaper plan.
LAG_SLOTS = 64


def min_group_filter(df: DataFrame, min_rows: int, size_col: str = SIZE) -> DataFrame:
    """Keep keys with at least ``min_rows`` rows."""
    return df.filter(F.col(size_col) >= F.lit(min_rows))


def minmax_fit(df: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Wide params, one row per key: ``<f>__min`` / ``<f>__max`` (partial aggregation)."""
    aggs = []
    for f in features:
        aggs += [F.min(f).alias(f"{f}__min"), F.max(f).alias(f"{f}__max")]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def params_long(params: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Wide params -> (key, feature, min_val, max_val)."""
    kv = F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f"{f}__min").alias("min_val"),
                 F.col(f"{f}__max").alias("max_val")) for f in features]))
    return params.select(*keys, kv.alias("p")).select(*keys, "p.feature", "p.min_val", "p.max_val")


def scale_expr(c: Column, mn: Column, mx: Column) -> Column:
    """Zero range -> 0.0 for every row; otherwise (c - min) / (max - min)."""
    return F.when(mx == mn, F.lit(0.0)).otherwise((c - mn) / (mx - mn))


def inverse_expr(v: Column, mn: Column, mx: Column) -> Column:
    """W4."""
    return v * (mx - mn) + mn


def minmax_scale(df: DataFrame, keys: Sequence[str], features: Sequence[str],
                 params: DataFrame | None = None, n_keys: int | None = None) -> tuple[DataFrame, DataFrame]:
    """W3 (and W5 when ``keys`` is empty): returns (scaled, params).

    Parameters fitted here are computed once and counted, unless ``n_keys`` (measured
    number of keys) is given; a small table is broadcast, so that the rows of a hot
    key are not sent to one task.
    """
    if params is None:
        params = materialize(minmax_fit(df, keys, features))
        if keys and n_keys is None:
            n_keys = params.count()
    joined = join_small(df, params, list(keys), "left", n_keys) if keys else df.crossJoin(F.broadcast(params))
    out = [scale_expr(F.col(c), F.col(f"{c}__min"), F.col(f"{c}__max")).alias(c) if c in features
           else F.col(c) for c in df.columns]
    return joined.select(*out), params


def split_index(ratio: float = TEST_RATIO, size_col: str = SIZE) -> Column:
    """k = int(n * (1 - ratio)) clamped to [1, n - 1]."""
    if not 0 < ratio < 1:
        raise ValueError(f"the test share lies strictly between 0 and 1, not {ratio}")
    n = F.col(size_col)
    k = F.floor(n.cast("double") * F.lit(1.0 - ratio)).cast("long")
    return F.greatest(F.lit(1), F.least(k, n - F.lit(1)))


def chrono_split(df: DataFrame, ratio: float = TEST_RATIO) -> DataFrame:
    """Adds ``split`` = train|test and ``_k`` (train size)."""
    k = split_index(ratio)
    return (df.withColumn("_k", k)
            .withColumn("split", F.when(F.col(POS) <= F.col("_k"), F.lit("train")).otherwise(F.lit("test"))))


def sliding_windows(df: DataFrame, key: str, target: str, features: Sequence[str],
                    length: int = SEQUENCE_LENGTH, ratio: float = TEST_RATIO,
                    val_ratio: float = VALIDATION_RATIO,
                    block_rows: int = DEFAULT_EXEC.block_rows, time_col: str = "timestamp",
                    lag_slots: int = LAG_SLOTS) -> DataFrame:
    """One row per window, never crossing the train/test split.

    Windows of up to ``lag_slots`` slots are gathered by lags, longer ones as slices of blocks.

    Row at position p predicts its own target from rows p-L..p-1.  Output:
    key, time, ``_pos``, split, ``win`` (1-based index inside its split),
    ``x`` (time-major then feature, NaN/inf -> 0), ``y``, ``is_fit``,
    ``is_val`` and per-key counts ``n_train_windows`` / ``n_test_windows``.
    """
    if length < 1:
        raise ValueError(f"a window needs one step or more, not {length}")
    if target not in features:
        raise ValueError(f"the target {target} is not one of the features")
    split = chrono_split(df, ratio)
    pos, k, n = F.col(POS), F.col("_k"), F.col(SIZE)
    in_train = pos <= k
    win = F.when(in_train, pos - F.lit(length)).otherwise(pos - k - F.lit(length))
    # Window values are single precision, as in the source workflow; besides
    # matching its numbers this breaks exact collinearities between features.
    def f32(c):
        return finite_or_zero(c).cast("float").cast("double")

    if length * len(features) <= lag_slots:
        lagged = with_lags(split, [key], list(features), length, block_rows)
        x = F.array(*[f32(F.col(f"{f}__lag{lag}")) for lag in range(length, 0, -1) for f in features])
    else:
        lagged = with_history(split, [key], F.array(*[f32(F.col(f)) for f in features]), len(features), length, block_rows, name="_x")
        x = F.col("_x")
    n_tr = F.greatest(k - F.lit(length), F.lit(0))
    n_te = F.greatest(n - k - F.lit(length), F.lit(0))
    val_size = F.greatest(F.lit(1), F.floor(n_tr.cast("double") * F.lit(val_ratio)).cast("long"))
    small = n_tr < F.lit(5)
    is_val = in_train & (small | (win > n_tr - val_size))
    is_fit = in_train & (small | (win <= n_tr - val_size))
    return (
        lagged.filter(win >= F.lit(1))
        .select(
            F.col(key), F.col(time_col), pos.alias(POS),
            F.when(in_train, F.lit("train")).otherwise(F.lit("test")).alias("split"),
            win.alias("win"), x.alias("x"), f32(F.col(target)).alias("y"),
            is_fit.alias("is_fit"), is_val.alias("is_val"),
            n_tr.alias("n_train_windows"), n_te.alias("n_test_windows"),
        )
    )


def eligible(windows: DataFrame, min_train: int = MIN_TRAIN_WINDOWS) -> DataFrame:
    """Keep keys with >= ``min_train`` train windows and at least one test window."""
    return windows.filter((F.col("n_train_windows") >= F.lit(min_train)) & (F.col("n_test_windows") > 0))


def eligibility(sizes: DataFrame, key: str, min_rows: int, length: int = SEQUENCE_LENGTH,
                ratio: float = TEST_RATIO, min_train: int = MIN_TRAIN_WINDOWS, size_col: str = SIZE) -> DataFrame:
    """W1/W10 with reasons: (key, rows, train and test windows, reason); ``reason`` is null for keys that go on.

    ``sizes`` has one row per key with its number of rows.
    """
    n, k = F.col(size_col), split_index(ratio, size_col)
    train, test = F.greatest(k - length, F.lit(0)), F.greatest(n - k - length, F.lit(0))
    reason = (F.when(n < min_rows, F.format_string("%d rows, %d needed", n, F.lit(min_rows)))
              .when(train < min_train, F.format_string("%d training windows, %d needed", train, F.lit(min_train)))
              .when(test < 1, F.lit("no test window")))
    return sizes.select(key, n.cast("long").alias("samples_total"), train.alias("train_sequences"),
                        test.alias("test_sequences"), reason.alias("reason"))


def window_counts(windows: DataFrame, key: str = DEFAULT_KEY_COLUMN) -> DataFrame:
    return windows.groupBy(key).agg(
        F.count_if(F.col("split") == "train").alias("train_sequences"),
        F.count_if(F.col("split") == "test").alias("test_sequences"),
        F.count_if(F.col("is_fit")).alias("fit_windows"),
        F.count_if(F.col("is_val")).alias("val_windows"),
    )
