"""Random forests and boosted trees for all keys together.

Every slot of the window is cut into at most ``BINS`` quantile bins per key, and targets are
fixed-point integers, so that counts and sums of a node's histogram are exact whatever the
partitioning; the split of a node follows from its histogram alone.  Bootstrap weights and
subsamples are hashes of (row position, tree).  So a tree does not depend on where it grows:

* Keys of up to ``local_rows`` fit windows (28 bytes each): one task a (key, group of trees), or
  a key where rounds follow each other; all keys in one job.
* Larger keys: level by level.  Fit windows stay in
  blocks with the node of each (row, tree) as a column; a level is one partial aggregate of
  (key, tree, node, feature, bin) and a window over bins; the splits come back to the blocks
  by join.  Nodes of up to ``local_rows`` rows are shipped to one task each and finished there.
  Boosting updates residuals in the blocks by the tree's leaves, cut every few rounds.

A model is a table, one row per node (see ``NODES``); scoring joins blocks of windows with
it, a group of trees at a time, and adds up leaf values.  Tables can be stored and scored
later (``plans.store``).
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import (GB_DEPTH, GB_RATE, GB_ROUNDS, GB_SUBSAMPLE, RANDOM_SEED, RF_DEPTH, RF_MIN_LEAF, RF_TREES, XGB_COLSAMPLE,
                      XGB_DEPTH, XGB_RATE, XGB_ROUNDS, XGB_SUBSAMPLE)
from ..session import materialize
from .models import _long, scored_rows

# Helpers of tasks are shipped by value: workers need no package import.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS = 32
SCALE = float(1 << 30)  # fixed point of targets
BLOCK = 1 << 14  # windows of a fit block
SCORE_BLOCK = 1 << 16
COUNT_ROWS = 1 << 20
SCORE_ROWS = 1 << 12  # windows walked through a tree at once, so that they stay in the cache
SCORE_NODES = 1 << 17  # nodes of a key up to which its trees are one model
GROUP = 20  # trees of a group
LOCAL_ROWS = 6_000_000  # sums of so many fixed-point targets stay below 2^53, exact as doubles
LEAF = -1
NODES = "tree int, node int, feature int, threshold double, value double, gain double, n long"


# ------------------------------------------------------ helpers inside tasks

def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def draws(pos: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """A 64-bit hash of each (row, tree)."""
    salt = _mix(np.array([tree * 0x9E3779B9 + seed + 1], dtype=np.uint64))
    return _mix(pos.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + salt)


def bootstrap(pos: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """Poisson(1) weights, the limit of drawing n of n with replacement."""
    p, steps, total = np.exp(-1.0), [], 0.0
    for k in range(1, 12):
        total += p
        steps.append(total)
        p /= k
    return np.searchsorted(np.array(steps), (draws(pos, tree, seed) >> np.uint64(11)) * 2.0 ** -53, side="right").astype(np.int64)


def subsample(pos: np.ndarray, tree: int, seed: int, share: float) -> np.ndarray:
    return ((draws(pos, tree, seed) >> np.uint64(11)) * 2.0 ** -53 < share).astype(np.int64)


def tree_features(tree: int, seed: int, dim: int, share: float) -> np.ndarray:
    """The slots that a tree may split on, least hashes first."""
    keep = max(1, round(dim * share))
    return np.sort(np.argsort(draws(np.arange(dim), tree, seed + 7), kind="stable")[:keep])


def gains(left_n, left_s, n, s):
    """Reduction of squared error by a split; plain arithmetic that SQL repeats exactly."""
    right_n, right_s = n - left_n, s - left_s
    return left_s * left_s / left_n + right_s * right_s / right_n - s * s / n


def _codes(bins: np.ndarray, width: int, cache: dict) -> list:
    """(first slot, slots, code) of groups of ``width`` slots: their bins as one number, made once a ``cache``."""
    if width not in cache:
        made = []
        for f in range(0, bins.shape[1], width):
            group = range(f, min(f + width, bins.shape[1]))
            code = bins[:, f].astype(np.uint16)
            for g in group[1:]:
                code = code * np.uint16(BINS) + bins[:, g]
            made.append((f, len(group), code))
        cache[width] = made
    return cache[width]


def _counts(bins, at, k: int, row, w, wt, features, cache: dict) -> np.ndarray:
    """(2, features, k, BINS): sums of weights and of weighted targets by node ``at``, slot and bin.

    Few nodes: slots are counted up to three at a time as one joint number and the sums taken apart after;
    all sums are whole numbers below 2^53, so that the way does not change them.
    """
    width = next((x for x in (3, 2) if k * BINS ** x * 4 <= len(row)), 1)
    out = np.zeros((2, len(features), k, BINS))
    place_of = {int(f): i for i, f in enumerate(features)}
    step = max(COUNT_ROWS, 4 * k * BINS ** width)  # rows at once, so that they stay in the cache
    for first, slots, code in _codes(bins, width, cache):
        used = [j for j in range(slots) if first + j in place_of]
        if not used:
            continue
        cells, joint = BINS ** slots, [0.0, 0.0]
        for begin in range(0, len(row), step):
            part = slice(begin, begin + step)
            place = code[row[part]].astype(np.int64)
            if k > 1:
                place += at[part] * cells
            for i, values in enumerate((w, wt)):
                joint[i] = joint[i] + np.bincount(place, None if values is None else values[part], k * cells)
        for i in range(2):
            apart = joint[i].reshape((k,) + (BINS,) * slots)
            for j in used:
                out[i, place_of[first + j]] = apart.sum(axis=tuple(1 + x for x in range(slots) if x != j))
    return out


def grow(bins: np.ndarray, target: np.ndarray, weights: np.ndarray, depth: int, min_leaf: int, features: np.ndarray,
         base: int = 0, cache: dict | None = None, leaves: np.ndarray | None = None) -> np.ndarray:
    """Trees of one task: rows (tree, node, feature, bin, n, sum, gain) with heap node numbers.

    ``weights`` is (trees, rows); ``base`` is the node that the trees' roots stand for.  Of two large
    children the smaller is counted, the other is what it leaves of their parent.  ``cache`` keeps joint bins of the same
    ``bins`` between calls; ``leaves`` (one tree) receives the leaf of every row with a weight.
    """
    cache = {} if cache is None else cache
    if len(weights) == 1:
        row = np.flatnonzero(weights[0])
        tree, w = np.zeros(len(row), dtype=np.int64), weights[0][row].astype(np.float64)
    else:
        tree, row = np.nonzero(weights)
        w = weights[tree, row].astype(np.float64)
    wt = w * target[row]
    ones = not len(w) or w.max() <= 1
    flat = bins.reshape(-1)
    owner = np.arange(len(weights))
    heap = np.full(len(weights), base, dtype=np.int64)
    node, out, parents = tree, [], None
    for level in range(depth + 1):
        a = len(owner)
        n, s = np.bincount(node, None if ones else w, a).astype(np.float64), np.bincount(node, wt, a)
        best, feature, cut = np.zeros(a), np.full(a, LEAF), np.full(a, LEAF)
        open_ = n >= 2 * min_leaf if level < depth else np.zeros(a, dtype=bool)
        k = int(open_.sum())
        if k:
            if k * BINS > len(row):  # many small nodes: counting each is less than taking it apart
                parents = None
            if parents is None:
                counted = open_
            else:
                small = 2 * np.arange(a // 2) + (n[1::2] < n[::2])
                counted = np.zeros(a, dtype=bool)
                counted[small[open_[::2] | open_[1::2]]] = True
            number = np.where(counted, np.cumsum(counted) - 1, -1)
            at = number[node]
            rows = at >= 0
            every = rows.all()
            hist = _counts(bins, at if every else at[rows], int(counted.sum()), row if every else row[rows],
                           None if ones else w if every else w[rows], wt if every else wt[rows], features, cache)
            if parents is not None:
                where = np.flatnonzero(open_)
                own = counted[where]
                full = np.empty((2, len(features), k, BINS))
                full[:, :, own] = hist[:, :, number[where[own]]]
                rest = where[~own]
                full[:, :, ~own] = parents[:, :, rest // 2] - hist[:, :, number[rest ^ 1]]
                hist = full
            n0, s0 = n[open_][:, None], s[open_][:, None]
            top, f_top, c_top = np.zeros(k), np.full(k, LEAF), np.full(k, LEAF)
            for i, f in enumerate(features):
                left_n, left_s = hist[0, i].cumsum(axis=1)[:, :-1], hist[1, i].cumsum(axis=1)[:, :-1]
                fits = (left_n >= min_leaf) & (n0 - left_n >= min_leaf)
                with np.errstate(divide="ignore", invalid="ignore"):
                    g = np.where(fits, gains(left_n, left_s, n0, s0), -1.0)
                c = g.argmax(axis=1)
                g = g[np.arange(k), c]
                better = g > top
                top[better], f_top[better], c_top[better] = g[better], f, c[better]
            real = top > 1e-12 * (s0[:, 0] * s0[:, 0] / n0[:, 0] + 1.0)
            best[open_] = np.where(real, top, 0.0)
            feature[open_] = np.where(real, f_top, LEAF)
            cut[open_] = np.where(real, c_top, LEAF)
            parents = hist[:, :, real]
        out.append(np.column_stack((owner, heap, feature, cut, n, s, best)))
        split = feature != LEAF
        rows = split[node]
        if leaves is not None:
            leaves[row[~rows]] = heap[node[~rows]]
        if not split.any():
            break
        if not rows.all():
            node, row, w, wt = node[rows], row[rows], w[rows], wt[rows]
        right = flat[row * bins.shape[1] + feature[node]] > cut[node]
        node = 2 * (np.cumsum(split) - 1)[node] + right
        owner = np.repeat(owner[split], 2)
        heap = 2 * np.repeat(heap[split], 2) + np.tile([1, 2], int(split.sum()))
    return np.concatenate(out)


def leaf_of(bins: np.ndarray, nodes: np.ndarray, depth: int) -> np.ndarray:
    """Heap number of the leaf of every row in one tree; ``nodes`` as ``grow`` gives them."""
    size = int(nodes[:, 1].max()) + 1
    feature, cut = np.full(size, LEAF), np.zeros(size, dtype=np.int64)
    feature[nodes[:, 1].astype(np.int64)] = nodes[:, 2].astype(np.int64)
    cut[nodes[:, 1].astype(np.int64)] = nodes[:, 3].astype(np.int64)
    at = np.zeros(len(bins), dtype=np.int64)
    for _ in range(depth):
        f = feature[at]
        inner = f != LEAF
        if not inner.any():
            break
        right = bins[np.arange(len(bins)), np.maximum(f, 0)] > cut[at]
        at = np.where(inner, 2 * at + 1 + right, at)
    return at


def step_values(nodes: np.ndarray, rate: float) -> np.ndarray:
    """Fixed-point leaf value of every node: the learning rate's share of the mean residual."""
    return np.rint(rate * nodes[:, 5] / nodes[:, 4]).astype(np.int64)


def _frame(key: str, value, nodes: np.ndarray, edges: np.ndarray, values: np.ndarray) -> pd.DataFrame:
    f, c = nodes[:, 2].astype(int), nodes[:, 3].astype(int)
    threshold = np.where(f == LEAF, np.nan, edges[np.maximum(f, 0), np.maximum(c, 0)])
    return pd.DataFrame({key: [value] * len(nodes), "tree": nodes[:, 0].astype(np.int32), "node": nodes[:, 1].astype(np.int32),
                         "feature": f.astype(np.int32), "threshold": threshold, "value": values,
                         "gain": nodes[:, 6] / (SCALE * SCALE), "n": nodes[:, 4].astype(np.int64)})


# ------------------------------------------------------------- binned blocks

def _edges(fit: DataFrame, key: str, dim: int) -> DataFrame:
    """(key, edges): dim x (BINS - 1) quantiles, flat; one partial aggregation."""
    at = [i / BINS for i in range(1, BINS)]
    return fit.groupBy(key).agg(F.flatten(F.array(*[
        F.percentile_approx(F.element_at("x", i + 1), at, 10000) for i in range(dim)])).alias("edges"))


def _binned(dim: int):
    def run(x: pd.Series, edges: pd.Series) -> pd.Series:
        out = []
        for flat, e in zip(x, edges):
            m, e = np.asarray(flat).reshape(-1, dim), np.asarray(e).reshape(dim, BINS - 1)
            out.append(np.column_stack([np.searchsorted(e[i], m[:, i], side="left") for i in range(dim)]).astype(np.uint8).tobytes())
        return pd.Series(out, dtype=object)
    return run


def packed_fit(windows: DataFrame, key: str) -> DataFrame:
    """(key, blk, pos, y, x): fit windows in blocks of ``BLOCK`` positions, ``x`` flat."""
    fit = windows.filter("is_fit").select(key, F.col("_pos").alias("pos"), "x", "y")
    return fit.groupBy(key, F.floor(F.col("pos") / BLOCK).alias("blk")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "y", "x"))).alias("r")).select(
        key, "blk", F.col("r.pos").alias("pos"), F.col("r.y").alias("y"), F.flatten("r.x").alias("x"))


def fit_blocks(windows: DataFrame, key: str, dim: int) -> DataFrame:
    """(key, blk, pos, y, bins, edges, n_key): packed fit windows with their slots cut into bins."""
    fit = windows.filter("is_fit")
    sizes = fit.groupBy(key).agg(F.count(F.lit(1)).alias("n_key"))
    binned = F.pandas_udf(_binned(dim), "binary")
    return materialize(packed_fit(windows, key).join(_edges(fit, key, dim).join(sizes, key), key).select(
        key, "blk", "pos", "y", binned("x", "edges").alias("bins"), "edges", "n_key"))


def _unpack(pdf: pd.DataFrame, dim: int):
    """(bins, fixed-point targets, positions, edges) of the blocks of one key."""
    pdf = pdf.sort_values("blk")
    bins = np.concatenate([np.frombuffer(b, dtype=np.uint8).reshape(-1, dim) for b in pdf["bins"]])
    y = np.rint(np.concatenate([np.asarray(v) for v in pdf["y"]]) * SCALE).astype(np.int64)
    return bins, y, np.concatenate([np.asarray(v) for v in pdf["pos"]]), np.asarray(pdf["edges"].iloc[0]).reshape(dim, BINS - 1)


# ------------------------------------------------------------------- forests

def forest(windows: DataFrame, key: str, dim: int, trees: int = RF_TREES, depth: int = RF_DEPTH, min_leaf: int = RF_MIN_LEAF,
           seed: int = RANDOM_SEED, local_rows: int = LOCAL_ROWS) -> DataFrame:
    """M2: bagged regression trees of every key as a node table; leaf values are shares of the forest's mean."""
    blocks = fit_blocks(windows, key, dim)
    groups = F.explode(F.sequence(F.lit(0), F.lit((trees - 1) // GROUP)))
    schema = f"{key} string, {NODES}"

    def local(pdf: pd.DataFrame) -> pd.DataFrame:
        bins, y, pos, edges = _unpack(pdf, dim)
        value, g = pdf[key].iloc[0], int(pdf["tg"].iloc[0])
        numbers = list(range(g * GROUP, min(trees, (g + 1) * GROUP)))
        at_once, out, cache = max(1, 100_000 // len(pos)), [], {}
        for i in range(0, len(numbers), at_once):
            weights = np.stack([bootstrap(pos, t, seed) for t in numbers[i:i + at_once]])
            weights[weights.sum(axis=1) == 0] = 1  # a tiny key of which nothing was drawn
            nodes = grow(bins, y, weights, depth, min_leaf, np.arange(dim), cache=cache)
            nodes[:, 0] += numbers[i]
            out.append(nodes)
        nodes = np.concatenate(out)
        return _frame(key, value, nodes, edges, nodes[:, 5] / nodes[:, 4] / SCALE / trees)

    small = blocks.filter(F.col("n_key") <= local_rows).withColumn("tg", groups)
    table = small.groupBy(key, "tg").applyInPandas(local, schema)
    large = blocks.filter(F.col("n_key") > local_rows)
    if not large.isEmpty():
        def weigh(pos, tree):
            return bootstrap(pos, tree, seed)

        state = _start(large.withColumn("tg", groups), dim, trees, weigh)
        grown = _grow_large(state, key, dim, depth, min_leaf, local_rows, weigh)
        value = F.col("s") / F.col("n") / F.lit(SCALE) / F.lit(trees)
        table = table.unionByName(_named(grown, blocks, key, value))
    return materialize(table)


def _start(blocks: DataFrame, dim: int, trees: int, weigh) -> DataFrame:
    """Blocks with fixed-point targets and the node of each (tree of the group, row): 0, or -1 where the weight is 0."""
    def run(pos: pd.Series, y: pd.Series, tg: pd.Series) -> pd.DataFrame:
        out = []
        for p, v, g in zip(pos, y, tg):
            numbers = range(int(g) * GROUP, min(trees, (int(g) + 1) * GROUP))
            node = np.stack([np.where(weigh(np.asarray(p), t) > 0, 0, -1) for t in numbers]).astype("<i4")
            out.append((np.rint(np.asarray(v) * SCALE).astype("<i8").tobytes(), node.tobytes()))
        return pd.DataFrame(out, columns=["t", "node"])

    made = F.pandas_udf(run, "t binary, node binary")("pos", "y", "tg")
    return blocks.withColumn("_m", made).select(
        *[c for c in blocks.columns if c != "y"], F.col("_m.t").alias("t"), F.col("_m.node").alias("node"))


def _histograms(state: DataFrame, key: str, dim: int, weigh, features=None) -> DataFrame:
    """(key, tree, heap, feature, bin, n, s) summed over blocks: partial aggregation of each block's counts."""
    names = ["tree", "heap", "feature", "bin", "n", "s"]

    def run(batches):
        for pdf in batches:
            for value, g, pos, bins, t, node in zip(pdf[key], pdf["tg"], pdf["pos"], pdf["bins"], pdf["t"], pdf["node"]):
                bins = np.frombuffer(bins, dtype=np.uint8).reshape(-1, dim)
                node = np.frombuffer(node, dtype="<i4").reshape(-1, len(bins))
                t, pos = np.frombuffer(t, dtype="<i8"), np.asarray(pos)
                for i in range(len(node)):
                    tree, rows = int(g) * GROUP + i, np.flatnonzero(node[i] >= 0)
                    if not len(rows):
                        continue
                    heaps, at = np.unique(node[i][rows], return_inverse=True)
                    w = weigh(pos[rows], tree).astype(np.float64)
                    wt = w * t[rows]
                    for f in range(dim) if features is None else features(tree):
                        place = at * BINS + bins[rows, f]
                        n = np.bincount(place, w, len(heaps) * BINS)
                        s = np.bincount(place, wt, len(heaps) * BINS)
                        hit = np.flatnonzero(n)
                        yield pd.DataFrame({key: [value] * len(hit), "tree": tree, "heap": heaps[hit // BINS], "feature": int(f),
                                            "bin": hit % BINS, "n": n[hit].astype(np.int64), "s": s[hit].astype(np.int64)})

    rows = state.select(key, "tg", "pos", "bins", "t", "node").mapInPandas(
        run, f"{key} string, tree int, heap int, feature int, bin int, n long, s long")
    return rows.groupBy(key, *names[:4]).agg(F.sum("n").alias("n"), F.sum("s").alias("s"))


def _best_splits(hist: DataFrame, key: str, min_leaf: int) -> DataFrame:
    """(key, tree, heap, n, s, best): best (gain, feature, bin, left_n, left_s) is null for a leaf."""
    node = [key, "tree", "heap"]
    up = Window.partitionBy(*node, "feature").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    all_ = Window.partitionBy(*node, "feature")
    d = {c: F.col(c).cast("double") for c in ("ln", "ls", "n0", "s0")}
    cum = hist.select(*node, "feature", "bin", F.sum("n").over(up).alias("ln"), F.sum("s").over(up).alias("ls"),
                      F.sum("n").over(all_).alias("n0"), F.sum("s").over(all_).alias("s0"))
    gain = gains(d["ln"], d["ls"], d["n0"], d["s0"])
    fits = (F.col("ln") >= min_leaf) & (F.col("n0") - F.col("ln") >= min_leaf)
    real = gain > 1e-12 * (d["s0"] * d["s0"] / d["n0"] + 1.0)
    found = F.when(fits & real, F.struct(gain.alias("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"),
                                         F.col("ln").alias("left_n"), F.col("ls").alias("left_s")))
    return cum.groupBy(*node).agg(F.first("n0").alias("n"), F.first("s0").alias("s"), F.max(found).alias("best"))


def _move(dim: int, deeper: bool, local_rows: int, min_leaf: int):
    """New nodes of every row: the open child's heap number, -2 - heap for a child to be finished elsewhere, -1 for a leaf."""
    def mode(n):
        if not deeper or n < 2 * min_leaf:
            return 0
        return 1 if n > local_rows else 2

    def run(tg: pd.Series, bins: pd.Series, node: pd.Series, splits: pd.Series) -> pd.Series:
        out = []
        for g, b, held, made in zip(tg, bins, node, splits):
            b = np.frombuffer(b, dtype=np.uint8).reshape(-1, dim)
            now = np.frombuffer(held, dtype="<i4").reshape(-1, len(b)).copy()
            by_tree: dict = {}
            for x in made if made is not None else ():
                by_tree.setdefault(x["tree"] - int(g) * GROUP, []).append(x)
            for i in range(len(now)):
                rows = np.flatnonzero(now[i] >= 0)
                size = int(now[i].max()) + 1
                if not len(rows):
                    continue
                feature, cut = np.full(size, LEAF), np.zeros(size, dtype=np.int64)
                kind = np.zeros((size, 2), dtype=np.int64)
                for x in by_tree.get(i, ()):
                    if x["heap"] < size:
                        feature[x["heap"]], cut[x["heap"]] = x["feature"], x["bin"]
                        kind[x["heap"]] = mode(x["left_n"]), mode(x["n"] - x["left_n"])
                at = now[i][rows]
                inner = feature[at] != LEAF
                right = (b[rows, np.maximum(feature[at], 0)] > cut[at]).astype(np.int64)
                child, k = 2 * at + 1 + right, kind[at, right]
                now[i][rows] = np.where(inner & (k == 1), child, np.where(inner & (k == 2), -2 - child, -1))
            out.append(now.astype("<i4").tobytes())
        return pd.Series(out, dtype=object)
    return run


def _grow_large(state: DataFrame, key: str, dim: int, depth: int, min_leaf: int, local_rows: int, weigh, features=None) -> DataFrame:
    """Level by level for keys over ``local_rows``: rows (key, tree, heap, feature, bin, n, s, gain)."""
    rows, state = [], materialize(state)
    node_cols = [key, "tree", "heap", "feature", "bin", "n", "s", "gain"]
    for level in range(depth):
        best = materialize(_best_splits(_histograms(state, key, dim, weigh, features), key, min_leaf).select(
            key, "tree", "heap", "n", "s", (-F.col("best.f")).alias("feature"), (-F.col("best.b")).alias("bin"),
            F.col("best.gain").alias("gain"), F.col("best.left_n").alias("left_n"), F.col("best.left_s").alias("left_s")))
        if best.isEmpty():
            break
        rows.append(best.select(key, "tree", "heap", F.coalesce("feature", F.lit(LEAF)).alias("feature"),
                                F.coalesce("bin", F.lit(LEAF)).alias("bin"), "n", "s", F.coalesce("gain", F.lit(0.0)).alias("gain")))
        split = best.filter("feature is not null")
        deeper = level + 1 < depth
        child = F.explode(F.array(*[F.struct((2 * F.col("heap") + 1 + i).cast("int").alias("heap"), n.alias("n"), s.alias("s"))
                                    for i, (n, s) in enumerate(((F.col("left_n"), F.col("left_s")),
                                                                (F.col("n") - F.col("left_n"), F.col("s") - F.col("left_s"))))]))
        done = split.select(key, "tree", child.alias("c")).select(key, "tree", "c.*")
        if deeper:
            done = done.filter(F.col("n") < 2 * min_leaf)
        rows.append(done.select(key, "tree", "heap", F.lit(LEAF).alias("feature"), F.lit(LEAF).alias("bin"), "n", "s",
                                F.lit(0.0).alias("gain")))
        listed = split.groupBy(key, F.floor(F.col("tree") / GROUP).cast("int").alias("tg")).agg(F.collect_list(
            F.struct("tree", "heap", "feature", "bin", "n", "left_n")).alias("splits"))
        moved = F.pandas_udf(_move(dim, deeper, local_rows, min_leaf), "binary")("tg", "bins", "node", "splits")
        kept = [c for c in state.columns if c != "node"]
        state = materialize(state.join(listed, [key, "tg"], "left").select(*kept, moved.alias("node")))

    def pieces(batches):
        for pdf in batches:
            for value, g, pos, bins, t, node in zip(pdf[key], pdf["tg"], pdf["pos"], pdf["bins"], pdf["t"], pdf["node"]):
                b = np.frombuffer(bins, dtype=np.uint8).reshape(-1, dim)
                node, t, pos = np.frombuffer(node, dtype="<i4").reshape(-1, len(b)), np.frombuffer(t, dtype="<i8"), np.asarray(pos)
                for i in range(len(node)):
                    tree = int(g) * GROUP + i
                    for heap in np.unique(node[i][node[i] <= -2]):
                        r = np.flatnonzero(node[i] == heap)
                        yield pd.DataFrame({key: [value], "tree": [tree], "heap": [-2 - int(heap)], "bins": [b[r].tobytes()],
                                            "t": [t[r].tobytes()], "w": [weigh(pos[r], tree).astype("<i8").tobytes()]})

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        bins = np.concatenate([np.frombuffer(b, dtype=np.uint8).reshape(-1, dim) for b in pdf["bins"]])
        t, w = (np.concatenate([np.frombuffer(b, dtype="<i8") for b in pdf[c]]) for c in ("t", "w"))
        heap, tree = int(pdf["heap"].iloc[0]), int(pdf["tree"].iloc[0])
        used = np.arange(dim) if features is None else features(tree)
        nodes = grow(bins, t, w[None, :], depth - int(np.log2(heap + 1)), min_leaf, used, heap)
        return pd.DataFrame({key: [pdf[key].iloc[0]] * len(nodes), "tree": tree, "heap": nodes[:, 1].astype(int),
                             "feature": nodes[:, 2].astype(int), "bin": nodes[:, 3].astype(int), "n": nodes[:, 4].astype(int),
                             "s": nodes[:, 5].astype(int), "gain": nodes[:, 6]})

    shape = f"{key} string, tree int, heap int, feature int, bin int, n long, s long, gain double"
    shipped = state.select(key, "tg", "pos", "bins", "t", "node").mapInPandas(
        pieces, f"{key} string, tree int, heap int, bins binary, t binary, w binary")
    rows.append(shipped.groupBy(key, "tree", "heap").applyInPandas(finish, shape))
    out = rows[0].select(*node_cols)
    for r in rows[1:]:
        out = out.unionByName(r.select(*node_cols))
    return materialize(out)


def _named(grown: DataFrame, blocks: DataFrame, key: str, value) -> DataFrame:
    """Nodes with real thresholds instead of bins."""
    edges = blocks.groupBy(key).agg(F.first("edges").alias("edges"))
    at = F.col("feature") * (BINS - 1) + F.col("bin")
    threshold = F.when(F.col("feature") != LEAF, F.get("edges", at)).otherwise(F.lit(float("nan")))
    return grown.join(edges, key).select(
        key, "tree", F.col("heap").alias("node"), "feature", threshold.alias("threshold"), value.alias("value"),
        (F.col("gain") / F.lit(SCALE * SCALE)).alias("gain"), "n")


# ------------------------------------------------------------------ boosting

def boosted(windows: DataFrame, key: str, dim: int, rounds: int = GB_ROUNDS, rate: float = GB_RATE, depth: int = GB_DEPTH,
            share: float = GB_SUBSAMPLE, columns: float = 1.0, min_leaf: int = 1, seed: int = RANDOM_SEED,
            local_rows: int = LOCAL_ROWS, cut_every: int = 5) -> DataFrame:
    """M3/M6: least-squares boosting of every key as a node table; tree -1 is the mean it starts from."""
    blocks = fit_blocks(windows, key, dim)
    schema = f"{key} string, {NODES}"

    def weigh(pos, tree):
        return subsample(pos, tree, seed, share)

    def used(tree):
        return tree_features(tree, seed, dim, columns) if columns < 1 else np.arange(dim)

    def local(pdf: pd.DataFrame) -> pd.DataFrame:
        bins, y, pos, edges = _unpack(pdf, dim)
        start = int(np.rint(y.sum() / len(y)))
        out = [np.array([[-1, 0, LEAF, LEAF, len(y), 0, 0]], dtype=float)]
        values, rest, cache = [np.array([start])], y - start, {}
        for r in range(rounds):
            drawn, leaves = weigh(pos, r), np.zeros(len(y), dtype=np.int64)
            nodes = grow(bins, rest, drawn[None, :], depth, min_leaf, used(r), cache=cache, leaves=leaves)
            nodes[:, 0] = r
            if not nodes[0, 4]:  # nobody drawn in a tiny key
                continue
            step = step_values(nodes, rate)
            by_heap = np.zeros(int(nodes[:, 1].max()) + 1, dtype=np.int64)
            by_heap[nodes[:, 1].astype(int)] = step
            left_out = np.flatnonzero(drawn == 0)
            leaves[left_out] = leaf_of(bins[left_out], nodes, depth)
            rest = rest - by_heap[leaves]
            out.append(nodes)
            values.append(step)
        return _frame(key, pdf[key].iloc[0], np.concatenate(out), edges, np.concatenate(values) / SCALE)

    table = blocks.filter(F.col("n_key") <= local_rows).groupBy(key).applyInPandas(local, schema)
    large = blocks.filter(F.col("n_key") > local_rows)
    if not large.isEmpty():
        table = table.unionByName(_boost_large(large, key, dim, rounds, rate, depth, min_leaf, weigh, used, cut_every))
    return materialize(table)


def _boost_large(blocks: DataFrame, key: str, dim: int, rounds: int, rate: float, depth: int, min_leaf: int, weigh, used,
                 cut_every: int) -> DataFrame:
    """Rounds over blocks: a tree by levels, then each block's residuals move by its leaves (a join on the key)."""
    fixed = F.rint(F.col("v") * SCALE).cast("long")
    start = blocks.select(key, F.explode("y").alias("v")).groupBy(key).agg(
        F.sum(fixed).alias("s"), F.count(F.lit(1)).alias("n"))
    start = materialize(start.select(key, F.rint(F.col("s") / F.col("n")).cast("long").alias("start"), "n"))

    def begin(y: pd.Series, start: pd.Series) -> pd.Series:
        return pd.Series([(np.rint(np.asarray(v) * SCALE).astype("<i8") - s).astype("<i8").tobytes() for v, s in zip(y, start)], dtype=object)

    def root(tree):
        def run(pos: pd.Series) -> pd.Series:
            return pd.Series([np.where(weigh(np.asarray(p), tree) > 0, 0, -1).astype("<i4").tobytes() for p in pos], dtype=object)
        return run

    def step(bins: pd.Series, t: pd.Series, nodes: pd.Series) -> pd.Series:
        out = []
        for b, held, made in zip(bins, t, nodes):
            b = np.frombuffer(b, dtype=np.uint8).reshape(-1, dim)
            table = np.array([(0, x["heap"], x["feature"], x["bin"], x["n"], x["s"], 0) for x in made], dtype=float)
            by_heap = np.zeros(int(table[:, 1].max()) + 1, dtype=np.int64)
            by_heap[table[:, 1].astype(int)] = step_values(table, rate)
            out.append((np.frombuffer(held, dtype="<i8") - by_heap[leaf_of(b, table, depth)]).astype("<i8").tobytes())
        return pd.Series(out, dtype=object)

    rest = materialize(blocks.join(start, key).select(key, "blk", "pos", "bins", F.pandas_udf(begin, "binary")("y", "start").alias("t")))
    made = [start.select(key, F.lit(-1).alias("tree"), F.lit(0).alias("heap"), F.lit(LEAF).alias("feature"), F.lit(LEAF).alias("bin"),
                         "n", F.lit(0).cast("long").alias("s"), F.lit(0.0).alias("gain"), (F.col("start") / SCALE).alias("value"))]
    for r in range(rounds):
        # one tree a round, as tree 0 of group 0 until it is grown
        state = rest.select(key, "pos", "bins", "t", F.pandas_udf(root(r), "binary")("pos").alias("node"), F.lit(0).alias("tg"))
        grown = _grow_large(state, key, dim, depth, min_leaf, 0, _only(weigh, r), _only(used, r)).withColumn("tree", F.lit(r))
        made.append(grown.withColumn("value", F.rint(rate * F.col("s") / F.col("n")) / SCALE))
        listed = grown.groupBy(key).agg(F.collect_list(F.struct("heap", "feature", "bin", "n", "s")).alias("nodes"))
        rest = rest.join(listed, key).select(key, "blk", "pos", "bins", F.pandas_udf(step, "binary")("bins", "t", "nodes").alias("t"))
        if (r + 1) % cut_every == 0:
            rest = materialize(rest)
            made = [materialize(_union(made))]
    return _named(_union(made), blocks, key, F.col("value"))


def _only(fn, tree: int):
    """``fn`` for one tree, wherever the group numbers it."""
    return (lambda pos, _: fn(pos, tree)) if fn.__code__.co_argcount == 2 else (lambda _: fn(tree))


def _union(tables: Sequence[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def second_boosted(windows: DataFrame, key: str, dim: int, rounds: int = XGB_ROUNDS, **kw) -> DataFrame:
    """M6: the second boosted configuration (deeper trees, a share of the slots per tree)."""
    return boosted(windows, key, dim, rounds, XGB_RATE, XGB_DEPTH, XGB_SUBSAMPLE, XGB_COLSAMPLE, **kw)


# ------------------------------------------------------------------- scoring

def _heaps(trees, nodes, features, thresholds, values):
    """(levels, feature, threshold, value) by (tree, heap number): leaves above the last level go on to their left."""
    _, tree = np.unique(trees, return_inverse=True)
    levels = int(np.log2(nodes.max() + 1))
    shape = (int(tree.max()) + 1, (2 << levels) - 1)
    feature, threshold, value = np.zeros(shape, dtype=np.int64), np.full(shape, np.inf), np.zeros(shape)
    inner = features != LEAF
    feature[tree[inner], nodes[inner]] = features[inner]
    threshold[tree[inner], nodes[inner]] = thresholds[inner]
    leaf = np.zeros(shape, dtype=bool)
    leaf[tree[~inner], nodes[~inner]] = True
    value[tree[~inner], nodes[~inner]] = values[~inner]
    for level in range(levels):
        up = slice((1 << level) - 1, (2 << level) - 1)
        down = slice((2 << level) - 1, (4 << level) - 1, 2)
        value[:, down] = np.where(leaf[:, up], value[:, up], value[:, down])
        leaf[:, down] |= leaf[:, up]
    return levels, feature, threshold, value


def walk(m: np.ndarray, heaps, use) -> None:
    """Calls ``use(rows, tree, values)`` for every slice of rows of ``m`` and every tree in order."""
    levels, feature, threshold, value = heaps
    dim = m.shape[1]
    for i in range(0, len(m), SCORE_ROWS):
        part = m[i:i + SCORE_ROWS]
        flat, place = np.ascontiguousarray(part).reshape(-1), np.arange(len(part)) * dim
        for t in range(len(value)):
            at = np.zeros(len(part), dtype=np.int64)
            for _ in range(levels):
                at = 2 * at + 1 + (flat[place + feature[t][at]] > threshold[t][at])
            use(slice(i, i + len(part)), t, value[t][at])


def _score(dim: int):
    def run(x: pd.Series, trees: pd.Series, nodes: pd.Series, features: pd.Series, thresholds: pd.Series, values: pd.Series) -> pd.Series:
        out = []
        for flat, *model in zip(x, trees, nodes, features, thresholds, values):
            m = np.asarray(flat).reshape(-1, dim)
            total = np.zeros(len(m))

            def add(rows, _, v):
                total[rows] += v

            walk(m, _heaps(*(np.asarray(c) for c in model)), add)
            out.append(total)
        return pd.Series(out, dtype=object)
    return run


MODEL = ("tree", "node", "feature", "threshold", "value")


def _models(nodes: DataFrame, key: str, whole: bool) -> DataFrame:
    """(key, _g, _model): node lists of a key's trees, or of ``GROUP`` of them."""
    group = F.lit(0) if whole else F.floor((F.col("tree") + 1) / GROUP).cast("int")
    return nodes.groupBy(key, group.alias("_g")).agg(F.collect_list(F.struct(*MODEL)).alias("_model"))


def _largest(nodes: DataFrame, key: str) -> int:
    return nodes.groupBy(key).count().agg(F.max("count")).first()[0] or 0


def predict(rows: DataFrame, nodes: DataFrame, key: str, dim: int, time_col: str = "timestamp") -> DataFrame:
    """(key, time, split, y, prediction) of windows ``rows`` by a node table, a group of trees and a block of rows at a time.

    Small models go to the blocks whole; large ones meet them a (key, group of trees) a task.
    """
    blocks = rows.withColumn("_b", F.floor(F.col("_pos") / SCORE_BLOCK)).groupBy(key, "_b").agg(
        F.collect_list(F.struct(time_col, "split", "y", "x")).alias("r")).select(
        key, F.col(f"r.{time_col}").alias(time_col), F.col("r.split").alias("split"), F.col("r.y").alias("y"), F.flatten("r.x").alias("x"))
    whole = _largest(nodes, key) <= SCORE_NODES
    models, on = _models(nodes, key, whole), [key]
    if not whole:
        groups = nodes.select(key, F.floor((F.col("tree") + 1) / GROUP).cast("int").alias("_g")).distinct()
        blocks, on = blocks.join(groups, key), [key, "_g"]
    score = F.pandas_udf(_score(dim), "array<double>")
    scored = blocks.join(models, on).select(key, time_col, "split", "y", score("x", *[F.col(f"_model.{c}") for c in MODEL]).alias("p"))
    each = scored.select(key, F.explode(F.arrays_zip(time_col, "split", "y", "p")).alias("z")).select(key, "z.*")
    return each.groupBy(key, time_col, "split").agg(F.first("y").alias("y"), F.sum("p").alias("prediction"))


def staged_loss(windows: DataFrame, nodes: DataFrame, key: str, dim: int, stops: Sequence[int]) -> DataFrame:
    """(key, n, loss): fit windows and, for every stop, their mean squared residual by the trees before it; each tree is walked once."""
    stops = list(stops)

    def run(x: pd.Series, y: pd.Series, trees: pd.Series, nodes: pd.Series, features: pd.Series, thresholds: pd.Series,
            values: pd.Series) -> pd.Series:
        out = []
        for flat, target, *model in zip(x, y, trees, nodes, features, thresholds, values):
            model = [np.asarray(c) for c in model]
            stage = np.searchsorted(stops, np.unique(model[0]), side="right")  # the stops that a tree comes before follow
            parts = np.zeros((len(stops) + 1, len(target)))

            def add(rows, t, v):
                parts[stage[t], rows] += v

            walk(np.asarray(flat).reshape(-1, dim), _heaps(*model), add)
            rest = np.asarray(target) - np.cumsum(parts[:-1], axis=0)
            out.append((rest * rest).sum(axis=1))
        return pd.Series(out, dtype=object)

    made = packed_fit(windows, key).join(_models(nodes, key, True), key).select(
        key, F.size("y").alias("n"), F.pandas_udf(run, "array<double>")("x", "y", *[F.col(f"_model.{c}") for c in MODEL]).alias("l"))
    n = F.sum("n")
    return made.groupBy(key).agg(n.alias("n"), F.array(*[F.sum(F.get("l", F.lit(i))) / n for i in range(len(stops))]).alias("loss"))


def tree_forecast(windows: DataFrame, nodes: DataFrame, key: str, dim: int, model: str) -> DataFrame:
    """Validation and test predictions of a node table in the long layout."""
    return _long(predict(scored_rows(windows), nodes, key, dim), key, model, F.col("prediction"))


def importances(nodes: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    """(key, feature, importance): each tree's gains as shares, averaged over its trees that split; they sum to 1."""
    split = nodes.filter(F.col("feature") != LEAF)
    per_tree = split.withColumn("share", F.col("gain") / F.sum("gain").over(Window.partitionBy(key, "tree")))
    trees = split.groupBy(key).agg(F.count_distinct("tree").alias("trees"))
    mean = per_tree.groupBy(key, "feature").agg(F.sum("share").alias("total")).join(trees, key)
    named = F.explode(F.array(*[F.struct(F.lit(i).alias("feature"), F.lit(n).alias("name")) for i, n in enumerate(names)]))
    every = nodes.select(key).distinct().select(key, named.alias("f")).select(key, "f.*")
    return every.join(mean, [key, "feature"], "left").select(
        key, F.col("name").alias("feature"), F.coalesce(F.col("total") / F.col("trees"), F.lit(0.0)).alias("importance"))
