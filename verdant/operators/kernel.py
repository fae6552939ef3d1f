"""Kernel regression for all keys together (M5).

Random Fourier features of the standardised window stand for the RBF kernel; their weights
come from a seed and are the same for every key.  The fit minimises

    sum of huber(y - z . w - b, delta) + |w|^2 / (2 C),   delta = epsilon * sigma

with ``sigma`` the residual deviation of the squared-loss fit.  The loss is piecewise quadratic
and convex, so Newton's method, halving a step that raises the loss, ends at the minimum after a
few rounds.  A round adds up, over chunks of windows, the loss, the gradient and the products of
the features of windows inside ``delta``; features are made anew each round and never kept.

* Keys of up to ``local_rows`` fit windows: all rounds in one task a key, all keys in one job.
* Larger keys: a round is one job; the sums of each block are added per (key, bucket), then
  per key, so that a hot key's windows are spread over as many tasks as it has blocks.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import HUBER_EPSILON, RANDOM_SEED, SVR_C
from ..session import materialize, shuffle_partitions
from .models import _long, scored_rows
from .series import join_small
from .trees import packed_fit

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no package import

COMPONENTS = 256
LOCAL_ROWS = 1 << 17
SCORE_BLOCK = 1 << 12
CHUNK = 1 << 11  # windows whose features are held at once
ROUNDS = 100
TOLERANCE = 1e-10
NEAR = 1e-6  # steps below it that no longer shrink are rounding
ROUNDING = 1e-12
FAN_IN = 32
MODEL = "mean array<double>, sd array<double>, coef array<double>, delta double"
STATE = "base array<double>, move array<double>, loss double, done boolean"


def fourier(dim: int, components: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(directions, phases) for gamma = 1 / dim, the kernel width of standardised inputs."""
    rng = np.random.default_rng(seed)
    return rng.normal(0.0, np.sqrt(2.0 / dim), size=(dim, components)), rng.uniform(0.0, 2.0 * np.pi, size=components)


def features(x: np.ndarray, mean, sd, waves) -> np.ndarray:
    """Fourier features and a constant 1."""
    directions, phases = waves
    z = np.sqrt(2.0 / len(phases)) * np.cos(((x - np.asarray(mean)) / np.asarray(sd)) @ directions + phases)
    return np.column_stack((z, np.ones(len(z))))


def round_sums(x: np.ndarray, y: np.ndarray, mean, sd, waves, coef, delta) -> np.ndarray:
    """What a round needs of some windows, one after the other; sums of parts add up.

    The first round: z'y and z'z.  The second, with ``coef``: the squared residuals.  The others, with
    ``delta``: the Huber loss, its pull z'clip(residual) and z'z of the windows inside ``delta``.
    """
    k = len(waves[1]) + 1
    out = np.zeros(k + k * k if coef is None else 1 if delta is None else 1 + k + k * k)
    for at in range(0, len(y), CHUNK):
        z, t = features(x[at:at + CHUNK], mean, sd, waves), y[at:at + CHUNK]
        if coef is None:
            out[:k] += z.T @ t
            out[k:] += (z.T @ z).ravel()
            continue
        r = t - z @ coef
        if delta is None:
            out[0] += r @ r
            continue
        held = np.clip(r, -delta, delta)
        near = z[held == r]
        out[0] += held @ (r - held / 2)
        out[1:k + 1] += held @ z
        out[k + 1:] += (near.T @ near).ravel()
    return out


def advance(state: dict, sums: np.ndarray, n: int, penalty: float, epsilon: float) -> dict:
    """The state of a key after a round: ``coef`` is where the next one looks, or the fit when ``done``.

    ``base`` is the best point so far, ``loss`` the loss there and ``move`` the step from it to ``coef``.
    The constant is not penalised.
    """
    if state["coef"] is None:
        k = int(np.sqrt(len(sums)))
        return state | {"coef": _solve(sums[k:].reshape(k, k), sums[:k], penalty)}
    if state["delta"] is None:
        return state | {"delta": epsilon * max(float(np.sqrt(sums[0] / max(n, 1))), 1e-12)}
    coef, base, move = state["coef"], state["base"], state["move"]
    held = penalty * np.append(coef[:-1], 0.0)
    loss = float(sums[0] + held @ coef / 2)
    if base is not None and not loss <= state["loss"] * (1 + ROUNDING):
        move = move / 2
        if np.abs(move).max() < TOLERANCE:
            return state | {"coef": base, "done": True}
        return state | {"coef": base + move, "move": move}
    k = len(coef)
    step = _solve(sums[k + 1:].reshape(k, k), sums[1:k + 1] - held, penalty)
    size = np.abs(step).max()
    done = size < TOLERANCE or (move is not None and size < NEAR and size > np.abs(move).max() / 2)
    return state | {"coef": coef + step, "base": coef, "move": step, "loss": loss, "done": bool(done)}


def _solve(gram: np.ndarray, right: np.ndarray, penalty: float) -> np.ndarray:
    ridge = penalty * np.eye(len(gram))
    ridge[-1, -1] = 0.0
    return np.linalg.lstsq(gram + ridge, right, rcond=None)[0]


def _standard(windows: DataFrame, key: str, dim: int) -> DataFrame:
    """(key, n, mean, sd) of the fit windows; a constant slot has deviation 1."""
    el = [F.element_at("x", i + 1) for i in range(dim)]
    sds = [F.stddev_pop(e) for e in el]
    return windows.filter("is_fit").groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.avg(e) for e in el]).alias("mean"),
        F.array(*[F.when(s > 0, s).otherwise(1.0) for s in sds]).alias("sd"))


def kernel_models(windows: DataFrame, key: str, dim: int, components: int = COMPONENTS, c: float = SVR_C,
                  epsilon: float = HUBER_EPSILON, seed: int = RANDOM_SEED, local_rows: int = LOCAL_ROWS) -> DataFrame:
    """(key, mean, sd, coef, delta) of every key; ``coef`` ends with the constant."""
    waves = fourier(dim, components, seed)
    standard = materialize(_standard(windows, key, dim))
    blocks = packed_fit(windows, key)
    penalty, schema = 1.0 / c, f"{key} string, {MODEL}"
    large = standard.filter(F.col("n") > local_rows)
    n_large = large.count()
    if n_large:
        # a stated number: a block is a row, but stands for many windows
        blocks = materialize(blocks.repartition(shuffle_partitions(windows.sparkSession), key, "blk"))

    def local(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("blk")
        parts = [(np.asarray(x).reshape(-1, dim), np.asarray(y)) for x, y in zip(pdf["x"], pdf["y"])]
        mean, sd, n = pdf["mean"].iloc[0], pdf["sd"].iloc[0], int(pdf["n"].iloc[0])
        state = {"coef": None, "delta": None, "base": None, "move": None, "loss": None, "done": False}
        for _ in range(ROUNDS):
            sums = sum(round_sums(x, y, mean, sd, waves, state["coef"], state["delta"]) for x, y in parts)
            state = advance(state, sums, n, penalty, epsilon)
            if state["done"]:
                break
        return pd.DataFrame({key: [pdf[key].iloc[0]], "mean": [mean], "sd": [sd], "coef": [state["coef"]], "delta": [state["delta"]]})

    small = blocks.join(standard.filter(F.col("n") <= local_rows), key)
    models = small.groupBy(key).applyInPandas(local, schema)
    if n_large:
        models = models.unionByName(_large(blocks, large, n_large, key, dim, waves, penalty, epsilon))
    return materialize(models)


def _large(blocks: DataFrame, standard: DataFrame, n_large: int, key: str, dim: int, waves, penalty: float,
           epsilon: float) -> DataFrame:
    """Rounds of jobs over the blocks of large keys."""
    shape = f"{key} string, bucket int, sums binary"
    schema = f"{key} string, n long, {MODEL}, {STATE}"

    def reduce_blocks(batches):
        for pdf in batches:
            for value, row in zip(pdf[key], pdf.drop(columns=key).itertuples(index=False)):
                known = None if row.coef is None else np.asarray(row.coef)
                sums = round_sums(np.asarray(row.x).reshape(-1, dim), np.asarray(row.y), row.mean, row.sd, waves, known,
                                  None if pd.isna(row.delta) else row.delta)
                yield pd.DataFrame({key: [value], "bucket": [int(row.blk) % FAN_IN], "sums": [sums.tobytes()]})

    def added(values) -> np.ndarray:
        return sum(np.frombuffer(v) for v in values)

    def combine(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.iloc[:1].assign(sums=[added(pdf["sums"]).tobytes()])

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        row = pdf.iloc[0]
        state = {c: None if row[c] is None else np.asarray(row[c]) for c in ("coef", "base", "move")}
        state |= {c: None if pd.isna(row[c]) else float(row[c]) for c in ("delta", "loss")} | {"done": False}
        state = advance(state, added(pdf["sums"]), int(row["n"]), penalty, epsilon)
        return pd.DataFrame({c: [row[c]] for c in (key, "n", "mean", "sd")} | {c: [v] for c, v in state.items()})

    fresh = {"coef": "array<double>", "delta": "double", "base": "array<double>", "move": "array<double>", "loss": "double",
             "done": "boolean"}
    now = standard.select(key, "n", "mean", "sd", *[F.lit(False if c == "done" else None).cast(t).alias(c) for c, t in fresh.items()])
    for _ in range(ROUNDS):
        going = now.filter(~F.col("done"))
        looked = join_small(blocks, going.select(key, "mean", "sd", "coef", "delta"), key, "inner", n_large)
        sums = looked.select(key, "blk", "x", "y", "mean", "sd", "coef", "delta").mapInPandas(reduce_blocks, shape)
        buckets = sums.groupBy(key, "bucket").applyInPandas(combine, shape)
        moved = buckets.drop("bucket").join(going, key).groupBy(key).applyInPandas(finish, schema)
        now = materialize(now.filter("done").unionByName(moved))
        if now.filter(~F.col("done")).isEmpty():
            break
    return now.select(key, "mean", "sd", "coef", "delta")


def predict(rows: DataFrame, models: DataFrame, key: str, dim: int, components: int = COMPONENTS, seed: int = RANDOM_SEED,
            time_col: str = "timestamp") -> DataFrame:
    """(key, time, split, y, prediction) of windows by stored models, block by block."""
    waves = fourier(dim, components, seed)

    def score(x: pd.Series, mean: pd.Series, sd: pd.Series, coef: pd.Series) -> pd.Series:
        return pd.Series([features(np.asarray(v).reshape(-1, dim), m, s, waves) @ np.asarray(c)
                          for v, m, s, c in zip(x, mean, sd, coef)], dtype=object)

    blocks = rows.withColumn("_b", F.floor(F.col("_pos") / SCORE_BLOCK)).groupBy(key, "_b").agg(
        F.collect_list(F.struct(time_col, "split", "y", "x")).alias("r"))
    scored = blocks.join(models, key).select(
        key, F.col(f"r.{time_col}").alias(time_col), F.col("r.split").alias("split"), F.col("r.y").alias("y"),
        F.pandas_udf(score, "array<double>")(F.flatten("r.x"), "mean", "sd", "coef").alias("prediction"))
    return scored.select(key, F.explode(F.arrays_zip(time_col, "split", "y", "prediction")).alias("z")).select(key, "z.*")


def kernel_forecast(windows: DataFrame, models: DataFrame, key: str, dim: int, **kw) -> DataFrame:
    """Validation and test predictions in the long layout (model ``svr_rbf``)."""
    return _long(predict(scored_rows(windows), models, key, dim, **kw), key, "svr_rbf", F.col("prediction"))


def first_order(windows: DataFrame, models: DataFrame, key: str, dim: int, c: float = SVR_C, components: int = COMPONENTS,
                seed: int = RANDOM_SEED) -> DataFrame:
    """(key, slot, moment): the mean gradient of the loss at the fitted coefficients, zero at the minimum."""
    waves = fourier(dim, components, seed)

    def pull(x: pd.Series, y: pd.Series, mean: pd.Series, sd: pd.Series, coef: pd.Series, delta: pd.Series) -> pd.Series:
        out = []
        for v, t, m, s, w, d in zip(x, y, mean, sd, coef, delta):
            z = features(np.asarray(v).reshape(-1, dim), m, s, waves)
            out.append(np.clip(np.asarray(t) - z @ np.asarray(w), -d, d) @ z)
        return pd.Series(out, dtype=object)

    blocks = packed_fit(windows, key).join(models, key)
    pulls = blocks.select(key, F.size("y").alias("n"), "coef", F.pandas_udf(pull, "array<double>")(
        "x", "y", "mean", "sd", "coef", "delta").alias("g"))
    slots = pulls.select(key, "n", "coef", F.posexplode("g").alias("slot", "g")).groupBy(key, "slot").agg(
        F.sum("g").alias("g"), F.sum("n").alias("n"), F.first("coef").alias("coef"))
    held = F.when(F.col("slot") < components, F.get("coef", F.col("slot")) / c).otherwise(0.0)
    return slots.select(key, "slot", ((F.col("g") - held) / F.col("n")).alias("moment"))
