"""Ordered per-series primitives.

A series is every row of one key in time order.  Nothing here partitions by
the key alone, because a single key may hold a large share of all rows:

* ``positions`` numbers rows 1..n inside each key from a range-partitioned
  sort.  Spark samples the range boundaries, so a hot key is spread over many
  tasks; a tiny per-(key, partition) count table turns partition-local ids
  into global positions.
* Order-dependent windows then run per ``(key, block)`` where a block is a
  fixed number of consecutive positions, which bounds the rows one window
  task sees.  Values that cross a block border travel either as halo rows
  (``with_lags``: the last ``max_lag`` rows of a block are copied into the
  next one) or through a small per-block summary table (``with_neighbours``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, shuffle_partitions

POS = "_pos"
SIZE = "_n"
BLOCK = "_blk"


def _window(keys: Sequence[str]):
    return Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))


def _join_on(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``cols`` treating NULL keys as equal (a NULL key is still a series)."""
    lt, rt = left.alias("_l"), right.alias("_r")
    cond = None
    for c in cols:
        e = F.col(f"_l.`{c}`").eqNullSafe(F.col(f"_r.`{c}`"))
        cond = e if cond is None else (cond & e)
    extra = [F.col(f"_r.`{c}`") for c in right.columns if c not in cols]
    return lt.join(rt, cond, how).select(*[F.col(f"_l.`{c}`") for c in left.columns], *extra)


# Per-key side tables (parameters, coefficients, weights) up to this many bytes,
# measured rows times fixed column widths, are broadcast explicitly; beyond it the
# join is left to AQE's runtime choice.
BROADCAST_BYTES = 32 << 20
TEXT_BYTES = 64  # allowance for a string value


def group_size_bound(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the largest ``keys`` group (one small aggregation job)."""
    return group_sizes(df, keys)[0]


def group_sizes(df: DataFrame, keys: Sequence[str], stats: dict | None = None) -> tuple[int, int]:
    """(rows of the largest ``keys`` group, total rows) in one aggregation job.

    ``stats`` (optional) also receives ``groups``: the number of groups.
    """
    counts = df.groupBy(*keys).count() if keys else df.select(F.count(F.lit(1)).alias("count"))
    row = counts.agg(F.max("count"), F.sum("count"), F.count(F.lit(1))).first()
    if stats is not None:
        stats.update(max_group=int(row[0] or 0), rows=int(row[1] or 0), groups=int(row[2] or 0))
    return int(row[0] or 0), int(row[1] or 0)


def row_bytes(df: DataFrame, array_items: int = 1024) -> int:
    """Allowance for one row of a side table; an array counts as ``array_items`` numbers."""
    return sum(TEXT_BYTES if t == "string" else 8 * array_items if t.startswith("array") else 16 for _, t in df.dtypes)


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               small_rows: int | None = None) -> DataFrame:
    """Join a side table whose row count is measured: broadcast it only when its bytes are proven small."""
    if small_rows is not None and small_rows * row_bytes(small) <= BROADCAST_BYTES:
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)


def positions(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
              pos_col: str = POS, size_col: str = SIZE,
              num_partitions: int | None = None, max_group: int | None = None,
              single_task_rows: int | None = None) -> DataFrame:
    """Add 1-based ``pos_col`` (rank in ``order`` within ``keys``) and the key size.

    ``order`` should be a total order inside each key for reproducible
    numbering; equal rows get distinct consecutive positions.

    When ``max_group`` (the largest group, measured by the caller) is at most
    ``single_task_rows`` a plain ``row_number`` window is used: every group is
    proven small enough for one task.  Otherwise rows are ranked from a
    range-partitioned sort so that no group is ever held by a single task.
    """
    keys = list(keys)
    if max_group is not None and single_task_rows is not None and max_group <= single_task_rows:
        w = _window(keys).orderBy(*order)
        return (df.withColumn(pos_col, F.row_number().over(w).cast("long"))
                .withColumn(size_col, F.count(F.lit(1)).over(_window(keys))))
    n_parts = num_partitions or shuffle_partitions(df.sparkSession)
    sort_cols = [*keys, *order]
    tagged = (
        df.repartitionByRange(n_parts, *sort_cols)
        .sortWithinPartitions(*sort_cols)
        .withColumn("_rid", F.monotonically_increasing_id())
    )
    # Both branches below must see identical ids: checkpoint once.
    tagged = materialize(tagged).withColumn("_part", F.shiftright(F.col("_rid"), 33))
    stats = tagged.groupBy(*keys, "_part").agg(
        F.count(F.lit(1)).alias("_cnt"), F.min("_rid").alias("_rid0"))
    w = _window(keys).orderBy("_part")
    stats = stats.select(
        *keys, "_part", "_rid0",
        F.coalesce(F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.sum("_cnt").over(_window(keys)).alias(size_col),
    )
    return (
        _join_on(tagged, stats, [*keys, "_part"])
        .withColumn(pos_col, F.col("_rid") - F.col("_rid0") + F.col("_off") + F.lit(1))
        .drop("_rid", "_part", "_rid0", "_off")
    )


def block_of(pos: Column, block_rows: int) -> Column:
    return F.floor((pos - F.lit(1)) / F.lit(block_rows)).cast("long")


def with_lags(df: DataFrame, keys: Sequence[str], cols: Sequence[str], max_lag: int,
              block_rows: int, pos_col: str = POS,
              name=lambda c, k: f"{c}__lag{k}") -> DataFrame:
    """Add ``lag(c, k)`` for k = 1..max_lag inside each key's position order.

    Each window task holds one block plus ``max_lag`` halo rows.
    """
    keys = list(keys)
    b = max(int(block_rows), int(max_lag))
    pos = F.col(pos_col)
    own = block_of(pos, b)
    tail = ((pos - F.lit(1)) % F.lit(b)) >= F.lit(b - max_lag)
    tagged = df.withColumn("_own", own).withColumn(
        BLOCK, F.explode(F.when(tail, F.array(own, own + F.lit(1))).otherwise(F.array(own))))
    w = Window.partitionBy(*keys, BLOCK).orderBy(pos_col)
    lags = [F.lag(F.col(c), k).over(w).alias(name(c, k)) for k in range(1, max_lag + 1) for c in cols]
    return (
        tagged.select("*", *lags)
        .filter(F.col("_own") == F.col(BLOCK))
        .drop("_own", BLOCK)
    )


HISTORY_VALUES = 1 << 21  # numbers that the windows of one block may hold


def with_history(df: DataFrame, keys: Sequence[str], values: Column, width: int, length: int, block_rows: int,
                 pos_col: str = POS, name: str = "x") -> DataFrame:
    """Add ``name``: the ``values`` (an array of ``width`` numbers) of the ``length`` rows before, oldest first, flat.

    For long histories: a block of consecutive rows and the ``length`` halo rows before it become one array, and a
    row's history is a slice of it, so that the plan has one column whatever ``length`` is.  Blocks shrink as
    windows grow, which bounds the task's memory.  Rows with fewer than ``length`` predecessors are left out.
    """
    keys = list(keys)
    b = max(int(length), min(int(block_rows), HISTORY_VALUES // (length * width)))
    pos = F.col(pos_col)
    own = block_of(pos, b)
    tail = ((pos - F.lit(1)) % F.lit(b)) >= F.lit(b - length)
    rest = [c for c in df.columns if c not in (*keys, pos_col)]
    tagged = df.withColumn("_v", values).withColumn("_own", own).withColumn(
        BLOCK, F.explode(F.when(tail, F.array(own, own + F.lit(1))).otherwise(F.array(own))))
    row = F.struct(pos_col, "_own", "_v", *rest)
    rows = tagged.groupBy(*keys, BLOCK).agg(F.array_sort(F.collect_list(row)).alias("_r"))

    def slices(flat):
        return F.transform(F.sequence(F.lit(length + 1), F.size("_r")), lambda i: F.struct(
            F.get("_r", i - 1).alias("r"), F.slice(flat, (i - 1 - length) * width + 1, length * width).alias(name)))

    made = F.element_at(F.transform(F.array(F.flatten(F.col("_r._v"))), slices), 1)
    each = rows.filter(F.size("_r") > length).select(*keys, BLOCK, F.explode(made).alias("_w"))
    kept = each.filter(F.col("_w.r._own") == F.col(BLOCK))
    return kept.select(*[F.col(c) if c in keys else F.col(f"_w.r.`{c}`").alias(c) for c in df.columns], F.col(f"_w.{name}").alias(name))


def with_neighbours(df: DataFrame, keys: Sequence[str], cols: Sequence[str],
                    block_rows: int, pos_col: str = POS, single_block: bool = False) -> DataFrame:
    """For each column add the nearest non-null value at/before and at/after the row.

    Adds ``_pv_<c>``/``_pp_<c>`` (previous value / its position) and
    ``_nv_<c>``/``_np_<c>`` (next value / position).  Gaps may span any number
    of blocks: block summaries carry the last/first valid value across.
    """
    keys = list(keys)
    pos = F.col(pos_col)
    tagged = df.withColumn(BLOCK, block_of(pos, block_rows))
    # Both directions use running frames (linear); a frame reaching to
    # "unbounded following" is re-aggregated per row by Spark (quadratic), so
    # the forward look-up is a backward running frame over descending order.
    w_prev = Window.partitionBy(*keys, BLOCK).orderBy(F.col(pos_col).asc()) \
        .rowsBetween(Window.unboundedPreceding, 0)
    w_next = Window.partitionBy(*keys, BLOCK).orderBy(F.col(pos_col).desc()) \
        .rowsBetween(Window.unboundedPreceding, 0)

    def valid_pos(c):
        return F.when(F.col(c).isNotNull(), pos)

    local = []
    summary_aggs = []
    for c in cols:
        local += [
            F.last(F.col(c), ignorenulls=True).over(w_prev).alias(f"_lpv_{c}"),
            F.last(valid_pos(c), ignorenulls=True).over(w_prev).alias(f"_lpp_{c}"),
            F.last(F.col(c), ignorenulls=True).over(w_next).alias(f"_lnv_{c}"),
            F.last(valid_pos(c), ignorenulls=True).over(w_next).alias(f"_lnp_{c}"),
        ]
        summary_aggs += [
            F.max_by(F.col(c), valid_pos(c)).alias(f"_bl_v_{c}"),
            F.max(valid_pos(c)).alias(f"_bl_p_{c}"),
            F.min_by(F.col(c), valid_pos(c)).alias(f"_bf_v_{c}"),
            F.min(valid_pos(c)).alias(f"_bf_p_{c}"),
        ]
    if single_block:
        out = tagged.select("*", *local)
        final = []
        for c in cols:
            final += [F.col(f"_l{p}_{c}").alias(f"_{p}_{c}") for p in ("pv", "pp", "nv", "np")]
        drop = [BLOCK] + [f"_l{p}_{c}" for c in cols for p in ("pv", "pp", "nv", "np")]
        return out.select("*", *final).drop(*drop)
    summary = tagged.groupBy(*keys, BLOCK).agg(*summary_aggs)
    before = _window(keys).orderBy(F.col(BLOCK).asc()).rowsBetween(Window.unboundedPreceding, -1)
    after = _window(keys).orderBy(F.col(BLOCK).desc()).rowsBetween(Window.unboundedPreceding, -1)
    carry_cols = []
    for c in cols:
        carry_cols += [
            F.last(f"_bl_v_{c}", ignorenulls=True).over(before).alias(f"_cpv_{c}"),
            F.last(f"_bl_p_{c}", ignorenulls=True).over(before).alias(f"_cpp_{c}"),
            F.last(f"_bf_v_{c}", ignorenulls=True).over(after).alias(f"_cnv_{c}"),
            F.last(f"_bf_p_{c}", ignorenulls=True).over(after).alias(f"_cnp_{c}"),
        ]
    carry = summary.select(*keys, BLOCK, *carry_cols)
    out = _join_on(tagged.select("*", *local), carry, [*keys, BLOCK], "left")
    final = []
    for c in cols:
        final += [
            F.coalesce(f"_lpv_{c}", f"_cpv_{c}").alias(f"_pv_{c}"),
            F.coalesce(f"_lpp_{c}", f"_cpp_{c}").alias(f"_pp_{c}"),
            F.coalesce(f"_lnv_{c}", f"_cnv_{c}").alias(f"_nv_{c}"),
            F.coalesce(f"_lnp_{c}", f"_cnp_{c}").alias(f"_np_{c}"),
        ]
    drop = [BLOCK] + [f"_{p}_{c}" for c in cols for p in
                      ("lpv", "lpp", "lnv", "lnp", "cpv", "cpp", "cnv", "cnp")]
    return out.select("*", *final).drop(*drop)

