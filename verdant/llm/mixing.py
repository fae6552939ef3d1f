"""Mixing sources to target weights by weighted fair queueing.

Sources in code-point order (null last) weigh 5, 2, 1, repeating.  The budget is
the words of the whole input; a source's target is its share by weight, at most
``cap`` times its own size, the excess shared again by weight.

Documents of a source are shuffled by a keyed hash of id and text and queue up to ``cap``
times.  A copy's virtual finish time is (words of its source up to and with it)
/ target.  All copies are range-partitioned by finish time; totals of the ranges
show which range holds the end of the budget, which is divided again until it has
few copies; those are sorted, and the last copy that still fits is the cut.  A copy is taken if it does not come after the
cut, so each source stays within one document of its target.

A source or a range is never one task: prefix sums go over (source, hash bucket)
groups whose number follows the row count, and only bucket totals meet.  Rows of one
id (or none) spread over the buckets by their texts.

Defined cases: null or wordless text has size 0 and takes nothing; null sources
are one source; equal ids are ordered by their texts, and rows of equal id and
text are interchangeable; columns of the input cannot clash because they travel in one
struct; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, cut, read, text_key

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = "mix:"
BUCKET_ROWS = 20_000
RANGES = 4096
FINEST = RANGES ** 3  # finer ranges of a double's finish times tell nothing apart


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_key():
    """The place of a document in its source's shuffled order."""
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.md5(F.concat(F.lit(SEED), doc_id, F.lit(":"), text_key(F.col("text"))))


def source_targets(sizes: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row per source with its weight and target; ``sizes`` has one (source, source_size) row per source."""
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.row_number().over(everything) - 1) % len(weights) + 1)
    s = sizes.withColumn("weight", weight).withColumn("level", F.lit(float(cap)) * F.col("source_size") / F.col("weight"))
    whole = Window.partitionBy()
    before = Window.orderBy("level", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(whole) - cap * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    open_weight = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    s = s.withColumn("reach", left.cast("double") / open_weight)
    fill = F.min(F.when(F.col("reach") <= F.col("level"), F.struct("level", "reach"))).over(whole)
    s = s.withColumn("fill", fill)
    target = F.when(F.col("level") < F.col("fill.level"), F.lit(float(cap)) * F.col("source_size")).otherwise(
        F.least(F.lit(float(cap)) * F.col("source_size"), F.col("fill.reach") * F.col("weight")))
    return s.select("source", "source_size", target.alias("target"))


def end_of_budget(copies: DataFrame, budget: int, cap: int, range_rows: int):
    """The copies of the range of finish times that ends the budget, and the words before it; None if all copies fit."""
    scale, before = RANGES, 0
    while True:
        ranged = copies.withColumn("range", F.floor(F.least(F.col("finish"), F.lit(float(cap * 2))) * scale))
        totals = ranged.groupBy("range").agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("rows"))
        running = totals.withColumn("upto", F.sum("n").over(Window.orderBy("range")) + before)  # one row a range
        last = running.filter(F.col("upto") > budget).orderBy("range").first()
        if last is None:
            return None
        copies, before = ranged.filter(F.col("range") == last["range"]).drop("range"), last["upto"] - last["n"]
        if last["rows"] <= range_rows or scale >= FINEST:
            return copies, before
        scale *= RANGES


def mix(docs: DataFrame, weights=WEIGHTS, cap: int = CAP, keep: list[str] | None = None,
        range_rows: int = BUCKET_ROWS) -> DataFrame:
    """Rows (row, size, source_size, target, copies): ``row`` has the columns ``keep`` (all by default) of ``docs``."""
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row"), F.col("source"),
        word_count(F.col("text")).alias("size"),
        shuffle_key().alias("hash"))
    light = cut(keyed.select("source", "size", "hash"))
    rows = light.count()
    digits = max(2, math.ceil(math.log(max(rows, 1) / BUCKET_ROWS + 1, 16)))
    bucket = F.substring("hash", 1, digits).alias("bucket")

    sums = cut(light.groupBy("source", bucket).agg(F.sum("size").alias("bucket_size")))
    targets = cut(source_targets(sums.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights, cap))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut(sums.select("source", "bucket", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("offset")))

    def queued(df: DataFrame) -> DataFrame:
        inside = Window.partitionBy("source", "bucket").orderBy("hash", "size").rowsBetween(Window.unboundedPreceding, 0)
        d = df.withColumn("bucket", bucket).withColumn("upto", F.sum("size").over(inside))
        o, t = offsets.alias("o"), targets.alias("t")
        d = d.alias("d").join(o, F.col("d.source").eqNullSafe(F.col("o.source")) & (F.col("d.bucket") == F.col("o.bucket")))
        d = d.join(t, F.col("d.source").eqNullSafe(F.col("t.source")))
        return d.select("d.*", "source_size", "target", (F.col("upto") + F.col("offset")).alias("place"))

    def finish(epoch):
        return (F.col("place") + epoch * F.col("source_size")) / F.nullif(F.col("target"), F.lit(0.0))

    order = ["finish", "source", "hash", "size", "epoch"]
    copies = (queued(light).filter("size > 0").select("*", F.explode(F.sequence(F.lit(0), F.lit(cap - 1))).alias("epoch"))
              .withColumn("finish", finish(F.col("epoch"))).filter(F.col("finish").isNotNull())
              .select(*order))
    copies = cut(copies)
    budget = targets.agg(F.sum("source_size")).first()[0] or 0  # one row
    last = end_of_budget(copies, budget, cap, range_rows)
    if last is None:
        taken = F.lit(cap)
    else:
        end, before = last
        end = end.withColumn("upto", F.sum("size").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) + before)
        stop = end.filter(F.col("upto") > budget).orderBy(*order).first()
        names = ["finish", "source", "hash", "size", "epoch"]

        def comes_before(e: int):
            mine = [finish(F.lit(e)), F.col("source"), F.col("hash"), F.col("size"), F.lit(e)]
            out = F.lit(False)
            for m, name in reversed(list(zip(mine, names))):
                # nulls (a null source) sort first here, as in orderBy
                at = F.lit(stop[name])
                less = (m.isNull() & F.lit(stop[name] is not None)) | F.coalesce(m < at, F.lit(False))
                out = less | (m.eqNullSafe(at) & out)
            return out
        taken = sum((comes_before(e).cast("int") for e in range(cap)), F.lit(0))
    return queued(keyed).select("row", "size", "source_size", "target",
                                F.when((F.col("size") > 0) & (F.col("target") > 0), taken).otherwise(0).alias("copies"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(read(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select("row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS hash FROM documents),
s AS (SELECT source, sum(size) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
l AS (SELECT *, CAST(3 AS DOUBLE) * source_size / weight AS level FROM w),
r AS (SELECT *, CAST(sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER before, 0) AS DOUBLE)
               / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS reach
      FROM l WINDOW before AS (ORDER BY level, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT level AS fill_level, reach AS fill FROM r WHERE reach <= level ORDER BY level, reach LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN level < fill_level THEN CAST(3 AS DOUBLE) * source_size
             ELSE least(CAST(3 AS DOUBLE) * source_size, fill * weight) END AS target FROM r, f),
q AS (SELECT d.*, source_size, target, sum(size) OVER (PARTITION BY d.source ORDER BY hash, size
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS place
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT q.*, epoch, CAST(place + epoch * source_size AS DOUBLE) / target AS finish
      FROM q, (SELECT unnest([0, 1, 2]) AS epoch) WHERE size > 0 AND target > 0),
u AS (SELECT *, sum(size) OVER (ORDER BY finish, source NULLS FIRST, hash, size, epoch
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS used FROM c)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM q LEFT JOIN (SELECT doc_id AS id, sum(size) AS taken FROM u WHERE used <= (SELECT sum(size) FROM d) GROUP BY 1) ON id = doc_id
"""
