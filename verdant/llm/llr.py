"""Quality rules by hashed n-gram log-likelihood ratio; DataFrame functions only.

Words, word pairs and word shapes (letters and digits blanked) are hashed into
``buckets``.  Two smoothed multinomials are
counted over all documents: raw (every document) and trusted (documents whose
``labels.quality`` is 1).  A document's score is the sum of
ln(p_trusted / p_raw) over its n-grams divided by their number.  Weights are whole
millionths, so sums do not depend on order, and a document is kept exactly when
``1e6 * score >= threshold`` in integers and the base rules pass.

Base rules: fewer than 10 words, or more than 20 % of the words inside 5-word
windows that occur twice or more in the text, fail.

Defined cases: null or wordless text has no words, score 0, and fails the base
rule; with no trusted text all weights are 0; several labels of one id count
once (trusted if any is 1); null ids are untrusted; repeated rows count as often
as they stand; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, cut, let, read, words

BUCKETS = 1 << 16
THRESHOLD = -300_000  # millionths of a nat per n-gram
SMOOTHING = 1.0
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20


def shapes(text: Column) -> Column:
    """The words with every run of letters and digits written as ``a``: what surrounds them stays."""
    return words(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\p{L}\p{N}]+", "a"))


def gram_hashes(d: DataFrame) -> DataFrame:
    """``d`` with 64-bit hashes of its words ``w`` and shapes ``shape``: ``singles``, ``pairs`` and ``outlines``."""
    d = d.withColumn("singles", F.transform("w", lambda x: F.xxhash64(x)))
    neighbours = F.transform(F.slice("singles", 2, F.greatest(F.size("singles") - 1, F.lit(0))),
                             lambda x, i: F.xxhash64(F.get("singles", i), x))
    return d.withColumn("pairs", neighbours).withColumn("outlines", F.transform("shape", lambda x: F.xxhash64(F.lit(0), x)))


def bucket_of(gram: Column, buckets: int) -> Column:
    if buckets & (buckets - 1):
        raise ValueError("the number of buckets is a power of two")
    return gram.bitwiseAND(F.lit(buckets - 1).cast("long")).cast("int")


def repeated_words(singles: Column, pairs: Column, size: int = WINDOW) -> Column:
    """Words inside windows of five words that stand twice or more in the text, the first included."""
    windows = F.transform(F.slice(singles, size, F.greatest(F.size(singles) - (size - 1), F.lit(0))),
                          lambda last, i: F.xxhash64(F.get(pairs, i), F.get(pairs, i + 2), last))

    def covered(hashes: Column) -> Column:
        ranked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        starts = let(ranked, lambda s: F.transform(
            F.filter(s, lambda x, i: F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))
                     | (F.when(i > 0, F.get(s, i - 1)["h"]).eqNullSafe(x["h"]))),
            lambda x: x["at"]))
        gone = F.aggregate(F.sort_array(starts), F.struct(F.lit(-size).alias("last"), F.lit(0).alias("n")),
                           lambda a, at: F.struct(at.alias("last"), (a["n"] + F.least(F.lit(size), at - a["last"])).alias("n")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(gone["n"])

    return F.when(F.size(singles) <= size, F.lit(0)).otherwise(let(windows, covered))


def measures(docs: DataFrame, keep: list[Column], text: str = "text") -> DataFrame:
    """``keep`` and, for every whole text: gram hashes and the counts of the base rules."""
    t = F.coalesce(F.col(text), F.lit(""))
    d = gram_hashes(docs.select(*keep, t.alias("_t"), words(t).alias("w"), shapes(t).alias("shape")))
    lines = F.filter(F.split("_t", "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    return d.select(
        *[c for c in d.columns if c not in ("_t", "w", "shape")], F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("_t", "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("singles"), F.col("pairs")).cast("long").alias("n_repeat_words"))


def gram_weights(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> DataFrame:
    """(bucket, weight): millionths of ln(p_trusted / p_raw), from counts over all documents."""
    ids = trusted.filter("doc_id is not null").select("doc_id").distinct().withColumn("trusted", F.lit(1)).hint("shuffle_hash")
    d = gram_hashes(docs.select("doc_id", "text").join(ids, "doc_id", "left").select(
        words(F.col("text")).alias("w"), shapes(F.col("text")).alias("shape"), "trusted"))
    counts = d.select(F.explode(F.concat("singles", "pairs", "outlines")).alias("gram"), "trusted").groupBy(
        bucket_of(F.col("gram"), buckets).alias("bucket")).agg(
        F.count(F.lit(1)).alias("raw"), F.count("trusted").alias("trust"))
    counts = cut(counts)
    n = counts.agg(F.sum("raw").alias("raw"), F.sum("trust").alias("trust")).first()  # one row
    raw, trust = n["raw"] or 0, n["trust"] or 0
    if not trust:
        return docs.sparkSession.range(buckets).select(F.col("id").alias("bucket"), F.lit(0).cast("long").alias("weight"))

    def p(count: str, total: int) -> Column:
        return (F.coalesce(F.col(count), F.lit(0)) + smoothing) / (total + smoothing * buckets)

    return docs.sparkSession.range(buckets).withColumnRenamed("id", "bucket").join(counts, "bucket", "left").select(
        "bucket", F.round(F.log(p("trust", trust) / p("raw", raw)) * 1e6).cast("long").alias("weight"))


def judge(docs: DataFrame, weights: DataFrame, threshold: int = THRESHOLD, buckets: int = BUCKETS) -> DataFrame:
    """Counts, ``score`` and verdicts of every document."""
    table = [0] * buckets
    for bucket, weight in weights.toLocalIterator():  # ``buckets`` numbers, whatever the corpus
        table[bucket] = weight
    weight_of = F.from_json(F.lit(json.dumps(table)), "array<long>")  # folded to one literal
    kinds = ("singles", "pairs", "outlines")
    total = sum((F.aggregate(k, F.lit(0).cast("long"), lambda a, g: a + F.get(weight_of, bucket_of(g, buckets)))
                 for k in kinds), F.lit(0))
    scored = measures(docs, [F.col("doc_id")]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        sum((F.size(k).cast("long") for k in kinds), F.lit(0)).alias("n"), total.alias("total"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return scored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (F.col("total") >= F.lit(threshold) * F.col("n"))).alias("kept"),
        F.when(F.col("n") > 0, F.col("total") / F.col("n") / 1e6).otherwise(F.lit(0.0)).alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return judge(docs, gram_weights(docs, read(spark, sf_dir, "labels").filter("quality = 1")))
