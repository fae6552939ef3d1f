"""Model store (M12): versions of fitted models as tables, scored by join without a fit.

A store is a folder.  ``save`` writes one version: linear models as (key, model, intercept,
coef) over the slots of the flattened window, trees as node tables, kernel models as their
coefficients, and the scaling parameters of the run, each model's rows under its own name.
The version is listed in ``versions`` last, so that a save that failed half way is never
read.  ``load`` takes the newest version, or any other; ``score`` joins windows with it.

Nearest neighbours have no model but the fit windows themselves; they are not stored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import kernel, trees, windows
from ..operators.models import dot_product, scored_rows
from .forecast import ForecastRun

VERSIONS = "version long, models array<string>, features array<string>, length int, target string, target_index int"
TREES = ("random_forest", "gradient_boosting", "xgboost")
LINEAR = ("naive_persistence", "linear_baseline", "linear_regression")


@dataclass
class StoredModels:
    """One version: its names and its tables (an absent kind is None)."""

    version: int
    names: list[str]
    features: list[str]
    length: int
    target: str
    target_index: int
    scaling: DataFrame
    linear: DataFrame | None
    nodes: DataFrame | None
    kernels: DataFrame | None

    @property
    def dim(self) -> int:
        return len(self.features) * self.length


def versions(spark: SparkSession, folder: str) -> DataFrame:
    """Complete versions of a store; empty where there is none."""
    try:
        return spark.read.schema(VERSIONS).parquet(f"{folder}/versions")
    except AnalysisException:
        return spark.createDataFrame([], VERSIONS)


def linear_table(run: ForecastRun, name: str) -> DataFrame:
    """(key, model, intercept, coef) of a linear model; AR(1) and persistence use the target's newest slot."""
    k = run.cfg.key
    if name == "linear_regression":
        return run.fitted(name).select(k, F.lit(name).alias("model"), "intercept", "coef")
    newest = run.dim - len(run.features) + run.target_index
    if name == "linear_baseline":
        rows, slope, intercept = run.fitted(name), F.col("slope"), F.col("intercept")
    else:
        rows, slope, intercept = run.windows.select(k).distinct(), F.lit(1.0), F.lit(0.0)
    coef = F.array(*[slope if i == newest else F.lit(0.0) for i in range(run.dim)])
    return rows.select(k, F.lit(name).alias("model"), intercept.alias("intercept"), coef.alias("coef"))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def save(run: ForecastRun, folder: str, names: tuple[str, ...]) -> str:
    """Write the models ``names`` of a run as the next version; returns the store's folder."""
    unknown = set(names) - {*TREES, *LINEAR, "svr_rbf"}
    if unknown:
        raise ValueError(f"cannot store {sorted(unknown)}")
    spark = run.windows.sparkSession
    last = versions(spark, folder).agg(F.max("version")).first()[0]
    version = (last or 0) + 1
    base = f"{folder}/version={version}"
    linear = [linear_table(run, n) for n in names if n in LINEAR]
    nodes = [run.fitted(n).withColumn("model", F.lit(n)) for n in names if n in TREES]
    if linear:
        _union(linear).write.mode("overwrite").parquet(f"{base}/linear")
    if nodes:
        _union(nodes).write.mode("overwrite").partitionBy("model").parquet(f"{base}/nodes")
    if "svr_rbf" in names:
        run.fitted("svr_rbf").write.mode("overwrite").parquet(f"{base}/kernels")
    run.params.write.mode("overwrite").parquet(f"{base}/scaling")
    row = [(version, list(names), list(run.features), run.cfg.sequence_length, run.target, run.target_index)]
    spark.createDataFrame(row, VERSIONS).coalesce(1).write.mode("append").parquet(f"{folder}/versions")
    return folder


def load(spark: SparkSession, folder: str, version: int | None = None) -> StoredModels:
    """The newest complete version, or the given one."""
    known = versions(spark, folder)
    row = (known if version is None else known.filter(F.col("version") == version)).orderBy(F.desc("version")).first()
    if row is None:
        raise ValueError(f"no version {'' if version is None else version} in {folder}")
    base = f"{folder}/version={row.version}"

    def table(name, wanted):
        return spark.read.parquet(f"{base}/{name}") if wanted else None

    return StoredModels(
        row.version, list(row.models), list(row.features), row.length, row.target, row.target_index, table("scaling", True),
        table("linear", set(row.models) & set(LINEAR)), table("nodes", set(row.models) & set(TREES)),
        table("kernels", "svr_rbf" in row.models))


def score(rows: DataFrame, stored: StoredModels, key: str, names: list[str] | None = None) -> DataFrame:
    """Validation and test predictions of windows ``rows`` by stored models, in the long layout."""
    names = stored.names if names is None else names
    parts = []
    linear = [n for n in names if n in LINEAR]
    if linear:
        j = scored_rows(rows).join(stored.linear.filter(F.col("model").isin(linear)), key)
        yhat = F.col("intercept") + dot_product(F.col("x"), F.col("coef"), stored.dim)
        parts.append(j.select(key, "timestamp", "split", "model", "y", yhat.alias("yhat")))
    for n in names:
        if n in TREES:
            nodes = stored.nodes.filter(F.col("model") == n)
            parts.append(trees.tree_forecast(rows, nodes, key, stored.dim, n))
        elif n == "svr_rbf":
            parts.append(kernel.kernel_forecast(rows, stored.kernels, key, stored.dim))
    return _union(parts)


def scale(observations: DataFrame, stored: StoredModels, key: str) -> DataFrame:
    """Observations scaled by a version's own parameters (keys that it does not know are left out)."""
    scaled, _ = windows.minmax_scale(observations.join(stored.scaling.select(key), key, "left_semi"), [key], stored.features, stored.scaling)
    return scaled
