"""k-nearest-neighbour regression (M4) by blocks of distances, exact by default.

Semantics: features standardised per key on the fit windows (population
std, zero std -> 1), Euclidean distance, the k nearest fit windows (ties by
window position), prediction = sum(y/d) / sum(1/d); when some of the k
neighbours are at distance 0 only those count (their mean).

Execution: some fit windows of a key are pivots (one in ``pivot_rows``, at most
``MAX_PIVOTS``); fit windows and queries go to the blocks of their nearest pivot,
which have a bounded number of rows, so a hot key is many blocks.  A pair of blocks
is one matrix product; each query keeps the candidates that its k-th value cannot
rule out within rounding, and their distances are computed again from the
differences.  First every query block meets the fit blocks of its own pivot, by a join.
By the triangle inequality the blocks of another pivot are at least the pivots' distance less
both radii away; they are compared only where that is within the k-th distance found.
For these a task takes a group of query blocks and reads all kept fit blocks one after the
other (a product of the two kept tables), so that no copies of blocks are written however
many pairs there are.  On autocorrelated series that is a small part of all pairs; on noise
no exact method prunes, and the matrix products carry the work.

``approximate=True`` is an opt-in: signed random projections, several tables of
bucket keys, candidates only from equal buckets (queries with fewer than k
candidates are compared exactly).  Groups of queries and of fit windows meet in a task each,
which looks up all tables there: a vector does not travel once a table.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import KNN_NEIGHBOURS, RANDOM_SEED
from ..session import materialize, shuffle_partitions
from .models import _long, scored_rows
from .series import join_small

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no package import

MAX_PIVOTS = 64
PIVOT_ROWS = 2048
FIT_ROWS = 4096
QUERY_ROWS = 1024
GROUP_BLOCKS = 64  # query blocks of a task that reads all fit blocks, and fit blocks that it reads at once
GROUP_ROWS = 1 << 18  # queries, and fit windows, of a task that looks up buckets
CROWDED = 1 << 6  # fit windows of a bucket from which it is compared by products
CHUNK = 1 << 19  # distances of one product
MAX_BITS = 16


def _standardize(windows: DataFrame, key: str, dim: int) -> tuple[DataFrame, DataFrame]:
    """(key, id, y, z) of fit windows and of queries; a query's id also tells its split."""
    fit = windows.filter(F.col("is_fit"))
    el = [F.element_at("x", i + 1) for i in range(dim)]
    sds = [F.stddev_pop(e) for e in el]
    mom = materialize(fit.groupBy(key).agg(F.array(*[F.avg(e) for e in el]).alias("mu"),
                                           F.array(*[F.when(s > 0, s).otherwise(1.0) for s in sds]).alias("sd")))
    n_keys = mom.count()

    def z(df, id_):
        # Plain arithmetic per dimension (codegen) rather than array higher-order functions.
        parts = [(F.element_at("x", i) - F.element_at("mu", i)) / F.element_at("sd", i) for i in range(1, dim + 1)]
        return join_small(df, mom, [key], "inner", n_keys).select(key, id_.alias("id"), "y", F.array(*parts).alias("z"))

    queries = scored_rows(windows)
    return z(fit, F.col("_pos")), z(queries, F.col("_pos") * 2 + (F.col("split") == "test").cast("long"))


def _dist(zq, zf, dim: int):
    """Euclidean distance as plain arithmetic (whole-stage codegen; array HOFs are interpreted)."""
    total = None
    for i in range(1, dim + 1):
        d = F.element_at(zq, i) - F.element_at(zf, i)
        total = d * d if total is None else total + d * d
    return F.sqrt(total)


def _top_k(cand: DataFrame, key: str, k: int) -> DataFrame:
    """k nearest per query; a bare ``row_number <= k`` lets Spark limit each group map-side."""
    w = Window.partitionBy(key, "id").orderBy("dist", "fid")
    return cand.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= k).drop("rn")


def nearest(zq: np.ndarray, zf: np.ndarray, fid: np.ndarray, k: int, known: np.ndarray | None = None):
    """(query rows, fit rows, distances): the k nearest of every query, ties by ``fid``.

    ``known`` (optional) is a distance per query beyond which nothing is wanted.
    """
    out = []
    chunk = max(1, CHUNK // max(len(zf), 1))
    size = (zf * zf).sum(axis=1)
    most = size.max() if len(size) else 0.0
    # squared distance less the query's own size as one product, in single precision where that rules out enough
    right = np.vstack((-2.0 * zf.T, size))
    short = right.astype(np.float32)
    for begin in range(0, len(zq), chunk):
        q = zq[begin:begin + chunk]
        own = (q * q).sum(axis=1)
        left = np.column_stack((q, np.ones(len(q))))
        limit = np.full(len(q), np.inf) if known is None else known[begin:begin + chunk] ** 2 - own
        open_ = np.isinf(limit)
        for matrix, rounding in ((short, 1e-5), (right, 1e-9)):
            near = left.astype(matrix.dtype) @ matrix
            slack = rounding * (own + most + 1.0)  # far above the rounding of the product, twice where the limit comes from it
            top = limit + slack
            if len(zf) > k and open_.any():
                top[open_] = np.partition(near[open_], k - 1, axis=1)[:, k - 1] + 2 * slack[open_]
            hit = np.flatnonzero((near <= np.nextafter(top.astype(matrix.dtype), matrix.dtype.type(np.inf))[:, None]).reshape(-1))
            if len(hit) <= len(q) * 4 * k + near.size // 64:
                break
        row, col = np.divmod(hit, max(len(zf), 1))
        total = np.zeros(len(row))
        for i in range(zq.shape[1]):  # the exact distance, in the order of the dimensions
            d = q[row, i] - zf[col, i]
            total += d * d
        out.append((row + begin, col, np.sqrt(total)))
    row, col, dist = (np.concatenate(x) for x in zip(*out))
    keep = _first_k(row, dist, fid[col], k)
    return row[keep], col[keep], dist[keep]


def _first_k(row: np.ndarray, dist: np.ndarray, fid: np.ndarray, k: int) -> np.ndarray:
    """Places of the k least (distance, fid) of each row, in that order."""
    order = np.lexsort((fid, dist, row))
    sorted_rows = row[order]
    return order[np.arange(len(order)) - np.searchsorted(sorted_rows, sorted_rows) < k]


FOUND = "id long, fid long, dist double, y_f double"


def _compare(key: str, dim: int, k: int):
    """Pairs of blocks -> the k nearest of each query among the pairs of its block that the task sees.

    ``known`` of a query is a distance beyond which nothing is wanted; no neighbour is given beyond it.
    """
    def run(batches):
        held: dict = {}

        def give(name):
            ids, _, _, best = held.pop(name)
            if best is not None:
                row, fid, dist, y = best
                yield pd.DataFrame({key: np.full(len(row), name[0], dtype=object), "id": ids[row], "fid": fid, "dist": dist, "y_f": y})

        for b in batches:
            for name, qid, qz, limit, f, y, fz in zip(zip(b[key], b["qp"], b["qc"]), b["qid"], b["qz"], b["known"], b["fid"], b["fy"], b["fz"]):
                if name not in held:
                    if len(held) >= 2 * GROUP_BLOCKS:
                        yield from give(next(iter(held)))
                    held[name] = [np.array(qid), np.array(qz).reshape(-1, dim), np.array(limit, dtype=float), None]
                _, zq, known, best = held[name]
                f, y = np.asarray(f), np.asarray(y)
                row, col, dist = nearest(zq, np.asarray(fz).reshape(-1, dim), f, k, known)
                if not len(row):
                    continue
                new = (row, f[col], dist, y[col])
                if best is not None:
                    new = tuple(np.concatenate(x) for x in zip(best, new))
                    keep = _first_k(new[0], new[2], new[1], k)
                    new = tuple(x[keep] for x in new)
                held[name][3] = new
                worst = np.zeros(len(zq))
                np.maximum.at(worst, new[0], new[2])
                full = np.bincount(new[0], minlength=len(zq)) >= k
                known[full] = np.minimum(known[full], worst[full])
        for name in list(held):
            yield from give(name)
    return run


def _packed(rows: DataFrame, key: str, span: int) -> DataFrame:
    """(key, blk, id, y, z): rows whose ids lie in the same ``span``; z flat."""
    packed = rows.groupBy(key, F.floor(F.col("id") / span).alias("blk")).agg(F.collect_list(F.struct("id", "y", "z")).alias("r"))
    return packed.select(key, "blk", F.col("r.id").alias("id"), F.col("r.y").alias("y"), F.flatten("r.z").alias("z"))


def _by_pivot(key: str, dim: int):
    """Packed rows -> (key, pid, blk, n, d, id, y, z): their rows of each nearest pivot, the first of equally near ones."""
    def run(batches):
        for b in batches:
            out = []
            for name, blk, ids, y, z, pids, zp in zip(b[key], b["blk"], b["id"], b["y"], b["z"], b["pids"], b["zp"]):
                ids, y, z, zp = np.asarray(ids), np.asarray(y), np.asarray(z).reshape(-1, dim), np.asarray(zp).reshape(-1, dim)
                total = np.zeros((len(z), len(zp)))
                for i in range(dim):
                    d = z[:, i, None] - zp[:, i]
                    total += d * d
                near = total.argmin(axis=1)
                dist = np.sqrt(total[np.arange(len(z)), near])
                for p in np.unique(near):
                    rows = np.flatnonzero(near == p)
                    out.append((name, int(pids[p]), blk, len(rows), dist[rows].max(), ids[rows], y[rows], z[rows].ravel()))
            yield pd.DataFrame(out, columns=[key, "pid", "blk", "n", "d", "id", "y", "z"])
    return run


def _blocks(rows: DataFrame, key: str, pivots: DataFrame, n_pivots: int, dim: int, size: int, span: int) -> DataFrame:
    """(key, pid, chunk, n, radius, id, y, z): rows by nearest pivot, in blocks of about ``size`` rows; z flat.

    ``span`` of the ids has ``size`` rows at most.  Partitions hold ``GROUP_BLOCKS`` blocks or fewer on average.
    """
    listed = pivots.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pid", "zp"))).alias("p")).select(
        key, F.col("p.pid").alias("pids"), F.flatten("p.zp").alias("zp"))
    near = materialize(join_small(_packed(rows, key, span), listed, [key], "inner", n_pivots).mapInPandas(
        _by_pivot(key, dim), f"{key} string, pid int, blk long, n int, d double, id array<long>, y array<double>, z array<double>"))
    counts = materialize(near.groupBy(key, "pid").agg(F.ceil(F.sum("n") / size).cast("int").alias("chunks")))
    n_blocks = counts.agg(F.sum("chunks")).first()[0] or 0
    parts = max(1, -(-n_blocks // GROUP_BLOCKS), min(n_blocks, shuffle_partitions(rows.sparkSession)))
    dealt = join_small(near, counts, [key, "pid"], "inner", n_pivots).withColumn("chunk", F.pmod(F.hash("blk"), "chunks"))
    packed = dealt.repartition(parts, key, "pid", "chunk").groupBy(key, "pid", "chunk").agg(
        F.collect_list(F.struct("id", "y", "z")).alias("r"), F.sum("n").alias("n"), F.max("d").alias("radius"))
    return materialize(packed.select(key, "pid", "chunk", "n", "radius", F.flatten("r.id").alias("id"),
                                     F.flatten("r.y").alias("y"), F.flatten("r.z").alias("z")))


def knn_neighbours(windows: DataFrame, key: str, dim: int, k: int = KNN_NEIGHBOURS, pivot_rows: int = PIVOT_ROWS,
                   max_pivots: int = MAX_PIVOTS, fit_rows: int = FIT_ROWS, query_rows: int = QUERY_ROWS,
                   stats: dict | None = None) -> DataFrame:
    """Top-k fit windows per query: (key, id, fid, dist, y_f); id = 2 * position + (1 for a test query).

    ``stats`` (optional) receives ``pairs`` (distances computed) and ``all_pairs``.
    """
    fit_z, q_z = _standardize(windows, key, dim)
    sizes = fit_z.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    wanted = F.least(F.lit(max_pivots), F.ceil(F.col("n") / pivot_rows)).cast("int")
    order = Window.partitionBy(key).orderBy(F.xxhash64("id"), "id")
    chosen = fit_z.withColumn("pid", F.row_number().over(order)).filter(F.col("pid") <= max_pivots)
    pivots = materialize(chosen.join(sizes, [key]).filter(F.col("pid") <= wanted).select(key, "pid", F.col("z").alias("zp")))
    n_pivots = pivots.count()

    fits = _blocks(fit_z, key, pivots, n_pivots, dim, fit_rows, fit_rows)
    queries = _blocks(q_z, key, pivots, n_pivots, dim, query_rows, 2 * query_rows)
    block = [key, "qp", "qc"]
    asking = queries.select(key, F.col("pid").alias("qp"), F.col("chunk").alias("qc"), F.col("id").alias("qid"), F.col("z").alias("qz"))
    asked = fits.select(F.col(key).alias("_fk"), F.col("pid").alias("fp"), F.col("id").alias("fid"), F.col("y").alias("fy"), F.col("z").alias("fz"))
    pair = [*block, "qid", "qz", "known", "fid", "fy", "fz"]
    found = f"{key} string, {FOUND}"

    # query blocks and pivots with the least distance that their rows can have
    a = queries.select(key, F.col("pid").alias("qp"), F.col("chunk").alias("qc"), F.col("radius").alias("qr"), F.col("n").alias("qn"))
    b = fits.groupBy(key, F.col("pid").alias("fp")).agg(F.max("radius").alias("fr"), F.sum("n").alias("fn"))
    apart = pivots.alias("x").join(pivots.alias("y"), [key]).select(
        key, F.col("x.pid").alias("qp"), F.col("y.pid").alias("fp"), _dist(F.col("x.zp"), F.col("y.zp"), dim).alias("apart"))
    pairs = materialize(join_small(join_small(a, materialize(b), [key], "inner", n_pivots), materialize(apart), [key, "qp", "fp"], "inner",
                                   n_pivots * max_pivots).withColumn("least", F.col("apart") - F.col("qr") - F.col("fr")))
    far = F.lit(float("inf"))
    own = asking.withColumn("known", F.transform("qid", lambda _: far)).join(
        asked.withColumnsRenamed({"_fk": key, "fp": "qp"}), [key, "qp"])
    first = materialize(_top_k(own.select(*pair).mapInPandas(_compare(key, dim, k), found), key, k))
    place = asking.select(*block, F.posexplode("qid").alias("at", "id"))
    kth = first.groupBy(key, "id").agg(F.max("dist").alias("dk"), F.count(F.lit(1)).alias("found"))
    # a query with fewer than k neighbours so far rules nothing out
    dk = F.when(F.col("found") >= k, F.col("dk")).otherwise(far)
    limit = materialize(place.join(kth, [key, "id"], "left").groupBy(*block).agg(
        F.max(dk).alias("limit"), F.array_sort(F.collect_list(F.struct("at", dk.alias("dk")))).alias("known")).withColumn(
        "known", F.col("known.dk")))
    rest = pairs.filter("qp <> fp").join(limit.drop("known"), block).filter(
        F.col("least") <= F.col("limit") * (1 + 1e-9) + 1e-9)
    rest = materialize(rest.groupBy(*block).agg(F.collect_list("fp").alias("wanted"), F.sum(F.col("qn") * F.col("fn")).alias("n_pairs")))
    if stats is not None:
        count = F.sum(F.col("qn") * F.col("fn"))
        stats["pairs"] = pairs.filter("qp = fp").agg(count).first()[0] + (rest.agg(F.sum("n_pairs")).first()[0] or 0)
        stats["all_pairs"] = pairs.agg(count).first()[0]
    n_open = rest.count()
    if not n_open:
        return first
    tasks = max(-(-n_open // GROUP_BLOCKS), min(n_open, 3 * windows.sparkSession.sparkContext.defaultParallelism))
    open_ = materialize(asking.join(rest.drop("n_pairs"), block).join(limit.drop("limit"), block).repartitionByRange(tasks, *block))
    # a task of the product stays with its query blocks and reads the kept fit blocks, partition by partition
    met = open_.join(asked.hint("shuffle_replicate_nl"), (F.col(key) == F.col("_fk")) & F.array_contains("wanted", F.col("fp"))).coalesce(tasks)
    return _top_k(first.unionByName(met.select(*pair).mapInPandas(_compare(key, dim, k), found)), key, k)


def _look_up(key: str, dim: int, k: int, planes: np.ndarray):
    """A group of packed queries and one of packed fit windows -> the k nearest of each query among those that share a bucket."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        mask = int(pdf["mask"].iloc[0])
        bits = mask.bit_length()

        def rows_of(side):
            part = pdf[pdf["side"] == side]
            none = np.zeros(0)
            return (np.concatenate([none.astype(np.int64), *part["id"]]), np.concatenate([none, *part["y"]]),
                    np.concatenate([none, *part["z"]]).reshape(-1, dim))

        (qid, _, zq), (fid, y, zf) = rows_of(0), rows_of(1)
        best, best_at = np.full((len(zq), k), np.inf), np.full((len(zq), k), -1)

        def merge(row, col, dist):
            keep = dist <= best[row, k - 1]
            row, col, dist = row[keep], col[keep], dist[keep]
            some = np.unique(row)
            old = best_at[some].ravel()
            row = np.concatenate((row, np.repeat(some, k)[old >= 0]))
            dist = np.concatenate((dist, best[some].ravel()[old >= 0]))
            col = np.concatenate((col, old[old >= 0]))
            order = np.lexsort((fid[col], dist, row))
            row, col, dist = row[order], col[order], dist[order]
            new = np.ones(len(row), dtype=bool)  # a pair may share several buckets
            new[1:] = (row[1:] != row[:-1]) | (col[1:] != col[:-1])
            row, col, dist = row[new], col[new], dist[new]
            rank = np.arange(len(row)) - np.searchsorted(row, row)
            row, col, dist, rank = row[rank < k], col[rank < k], dist[rank < k], rank[rank < k]
            best[row, rank], best_at[row, rank] = dist, col

        for plane in planes[:, :bits]:
            code_q, code_f = (((np.einsum("nd,bd->nb", z, plane) > 0) * (1 << np.arange(bits))).sum(axis=1) for z in (zq, zf))
            order = np.argsort(code_f, kind="stable")
            lo, hi = (np.searchsorted(code_f[order], code_q, side=s) for s in ("left", "right"))
            crowded = hi - lo >= CROWDED
            asking = np.flatnonzero(crowded)
            asking = asking[np.argsort(code_q[asking], kind="stable")]
            listed, n_listed = [], 0
            for rows in np.split(asking, np.flatnonzero(np.diff(code_q[asking])) + 1) if len(asking) else []:
                for i in range(lo[rows[0]], hi[rows[0]], FIT_ROWS):
                    cols = order[i:min(i + FIT_ROWS, hi[rows[0]])]
                    row, col, dist = nearest(zq[rows], zf[cols], fid[cols], k, best[rows, k - 1])
                    listed.append((rows[row], cols[col], dist))
                    n_listed += len(row)
                    if n_listed >= CHUNK:
                        merge(*(np.concatenate(x) for x in zip(*listed)))
                        listed, n_listed = [], 0
            if listed:
                merge(*(np.concatenate(x) for x in zip(*listed)))
            few = np.flatnonzero(~crowded & (hi > lo))
            ends = np.cumsum((hi - lo)[few])
            cuts = np.searchsorted(ends, np.arange(CHUNK, ends[-1] + CHUNK if len(ends) else 0, CHUNK), side="left")
            for rows in np.split(few, np.unique(cuts + 1)):  # so many that about CHUNK pairs are listed at once
                n = (hi - lo)[rows]
                row = np.repeat(rows, n)
                col = order[np.repeat(lo[rows] - np.cumsum(n) + n, n) + np.arange(len(row))]
                total = np.zeros(len(row))
                for i in range(dim):  # the exact distance, in the order of the dimensions
                    d = zq[row, i] - zf[col, i]
                    total += d * d
                merge(row, col, np.sqrt(total))
        row, rank = np.nonzero(best_at >= 0)
        col = best_at[row, rank]
        return pd.DataFrame({key: np.full(len(row), pdf[key].iloc[0], dtype=object), "id": qid[row], "fid": fid[col],
                             "dist": best[row, rank], "y_f": y[col]})
    return run


def approximate_neighbours(windows: DataFrame, key: str, dim: int, k: int = KNN_NEIGHBOURS, tables: int = 24,
                           bucket_rows: int = 64, seed: int = RANDOM_SEED) -> DataFrame:
    """Top-k fit windows per query among those that share a bucket, laid out as ``knn_neighbours``.

    A bucket is the signs of random projections, as many as cut a key's fit windows into buckets of about
    ``bucket_rows``, in one of ``tables`` draws of them.  ``GROUP_ROWS`` queries and as many fit windows meet in a task,
    so no bucket is one task.  A query with fewer than k candidates is compared exactly.
    """
    fit_z, q_z = _standardize(windows, key, dim)
    rng = np.random.default_rng(seed)
    bits = MAX_BITS
    planes = rng.normal(size=(tables, bits, dim))
    cuts = F.greatest(F.lit(1), F.least(F.lit(bits), F.floor(F.log2(F.count(F.lit(1)) / bucket_rows)))).cast("int")
    groups = F.ceil(F.count(F.lit(1)) / GROUP_ROWS).cast("int")
    of_fits = fit_z.groupBy(key).agg((F.pow(F.lit(2), cuts) - 1).cast("int").alias("mask"), groups.alias("fits"))
    plan = materialize(q_z.groupBy(key).agg(groups.alias("queries")).join(of_fits, [key]))
    n_keys = plan.count()

    def dealt(rows, side, span, mine, others):
        """Packed rows, once for every group of the other side."""
        own, other = ("gq", "gf") if side == 0 else ("gf", "gq")
        out = join_small(_packed(rows, key, span), plan, [key], "inner", n_keys).withColumn(own, F.pmod(F.hash("blk"), mine))
        return out.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(others) - 1))).select(
            key, "gq", "gf", F.lit(side).alias("side"), "mask", "id", "y", "z")

    both = dealt(q_z, 0, 2 * QUERY_ROWS, "queries", "fits").unionByName(dealt(fit_z, 1, FIT_ROWS, "fits", "queries"))
    each = both.groupBy(key, "gq", "gf").applyInPandas(_look_up(key, dim, k, planes), f"{key} string, {FOUND}")
    found = materialize(_top_k(each, key, k))
    enough = found.groupBy(key, "id").agg(F.count(F.lit(1)).alias("n"))
    least = fit_z.groupBy(key).agg(F.least(F.count(F.lit(1)), F.lit(k)).alias("least"))
    short = q_z.select(key, "id").join(enough, [key, "id"], "left").join(least, [key]).filter(
        F.coalesce("n", F.lit(0)) < F.col("least")).select(key, "id")
    if short.isEmpty():
        return found
    again = windows.withColumn("_test", F.when(F.col("split") == "test", 1).otherwise(0))
    ids = short.select(key, F.floor(F.col("id") / 2).alias("_pos"), F.pmod("id", F.lit(2)).cast("int").alias("_asked")).distinct()
    asked = again.join(ids, [key, "_pos"], "left")
    left = asked.filter(F.col("is_fit") | F.col("_asked").isNotNull()).withColumn(
        "is_val", F.col("is_val") & (F.col("_asked") == 0)).withColumn(
        "split", F.when((F.col("split") == "test") & F.col("_asked").isNull(), "train").otherwise(F.col("split")))
    exact = knn_neighbours(left.drop("_asked", "_test"), key, dim, k).join(short, [key, "id"], "left_semi")
    return found.join(short, [key, "id"], "left_anti").unionByName(exact)


def knn_forecast(windows: DataFrame, key: str, dim: int | None = None, k: int = KNN_NEIGHBOURS, approximate: bool = False,
                 **kw) -> DataFrame:
    """M4 predictions in the long prediction layout (model ``knn_regressor``)."""
    if dim is None:
        dim = int(windows.select(F.size("x")).first()[0])
    nb = (approximate_neighbours if approximate else knn_neighbours)(windows, key, dim, k, **kw)
    zero = F.col("dist") == 0
    pred = nb.groupBy(key, "id").agg(
        F.count_if(zero).alias("n_zero"),
        F.avg(F.when(zero, F.col("y_f"))).alias("zero_mean"),
        F.sum(F.when(~zero, F.col("y_f") / F.col("dist"))).alias("num"),
        F.sum(F.when(~zero, F.lit(1.0) / F.col("dist"))).alias("den"))
    yhat = F.when(F.col("n_zero") > 0, F.col("zero_mean")).otherwise(F.col("num") / F.col("den"))
    named = scored_rows(windows).select(key, "timestamp", "split", "y", (F.col("_pos") * 2 + (F.col("split") == "test").cast("long")).alias("id"))
    return _long(named.join(pred, [key, "id"]), key, "knn_regressor", yhat)


def q_knn_forecast(spark, sf_dir):
    from ..plans.registry import event_run, finish
    run = event_run(spark, sf_dir)
    return finish(knn_forecast(run.windows, "crop_type", run.dim))


def q_knn_recall(spark, sf_dir):
    """M4: recall of the opt-in approximate neighbours against the exact ones; ``recall_ok`` asks for 0.9 per key."""
    from ..plans.registry import event_run, finish
    run = event_run(spark, sf_dir)
    exact = materialize(knn_neighbours(run.windows, "crop_type", run.dim))
    close = approximate_neighbours(run.windows, "crop_type", run.dim).select("crop_type", "id", F.col("dist").alias("dist_"), "fid")
    both = exact.join(close, ["crop_type", "id", "fid"], "left").groupBy("crop_type").agg(
        F.count(F.lit(1)).alias("neighbours"), (F.count("dist_") / F.count(F.lit(1)) >= 0.9).alias("recall_ok"))
    return finish(both)
