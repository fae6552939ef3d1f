"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: densities of lexicon words (a short fixed list, and words
and word beginnings learned from training labels by log odds, so that inflected and
compound forms count), hits close to a second-person word, hits that appear only
after undoing digit-for-letter, masking or spacing tricks, shares of capitals,
all-capital words, punctuation and obfuscated words, and lengths.  At most ``MOST`` labelled documents a class (lowest hash of the id)
train: three quarters fit the lexicon and the trees, one quarter, weighted back to
the classes' true shares, fits the calibration.

Only the sample is bounded; labels of the held-out fold are never read.

Defined cases: null and empty texts have zero features and get the score of such
a text; without both classes among the labels every score is the share of label 1
(0 without labels); several labels of an id count as the largest; repeated rows get
equal scores; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_bytes, cut, in_fold, read
from .neighbours import sample_labels

FOLDS, HELD_OUT = 3, 1
MOST = 4000
LEARNED = 300
MIN_SHARE = 0.015
STEMS = (4, 5, 6)  # lengths of word beginnings, written with a star
MIN_ODDS = 3.5
CUTOFF = 0.7
NEAR = 5
TREES, DEPTH = 15, 4

# General insults, and words that address the reader.
INSULTS = ("idiot moron stupid loser scum trash clown worthless pathetic disgusting dumb imbecile freak pig filth vermin "
           "fool jerk bastard idiota estúpido imbécil basura payaso patético asqueroso idiot abruti crétin ordure minable "
           "pathétique dégoûtant dummkopf trottel abschaum müll erbärmlich widerlich wertlos").split()
SECOND_PERSON = ("you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine euch ihr "
                 "tú ti tus usted ustedes vosotros").split()
EDGES = "\"'`´’‘“”«»()[]{}<>.,;:!?¡¿…*_~|&%#$@-–—/\\="
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
                      "!": "i", "+": "t", "*": None, ".": None, "-": None, "_": None, "|": None, "#": None, "%": None, "&": None})
# Byte classes: 1 capital, 2 other letter (any byte of a longer character too), 3 ending punctuation, 4 other punctuation.
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[128:] = 1, 2, 2
for _c in b"!?":
    _CLASS[_c] = 3
for _c in b"\"#$%&'()*+,-./:;<=>@[\\]^_`{|}~":
    _CLASS[_c] = 4
NAMES = ("hits", "log_hits", "odds", "top_odds", "distinct_hits", "hidden_hits", "obfuscated", "second_person", "near_hits",
         "log_near", "capitals", "capital_words", "exclaims", "punctuation", "log_words", "word_length")


def features(text: str | None, lexicon: dict[str, float], stems: dict[str, float]) -> np.ndarray:
    out = np.zeros(len(NAMES))
    data = as_bytes(text)
    tokens = (text or "").split()
    n = len(tokens)
    if not n:
        return out
    hits, odds, seen, hidden, mixed, second = [], 0.0, set(), 0, 0, []
    single = ""
    for i, raw in enumerate(tokens):
        word = raw.strip(EDGES).lower()
        weight = lexicon.get(word)
        if weight is None:
            for k in STEMS:
                weight = stems.get(word[:k], weight)
        if weight is None and not word.isalpha() and word:
            core = raw.lower().strip("\"'()[]{}.,;:?")
            if not core.isdigit() and re.search(r"[^\W\d_]", core) and re.search(r"[\d@$!*_.|+#%&\-]", core):
                mixed += 1
                weight = lexicon.get(core.translate(LEET)) or lexicon.get(core.rstrip("!").translate(LEET))
                hidden += weight is not None
        if len(word) == 1:  # letters set apart
            single += word
        else:
            if len(single) > 3 and single in lexicon:
                weight, hidden = lexicon[single], hidden + 1
            single = ""
        if weight is not None:
            hits.append(i)
            odds += weight
            seen.add(word)
            out[3] = max(out[3], weight)
        elif word in _SECOND:
            second.append(i)
    near = 0
    if hits and second:
        at = np.searchsorted(second, hits)
        s = np.array([-10 * NEAR, *second, n + 10 * NEAR])
        near = int(np.count_nonzero(np.minimum(np.array(hits) - s[at], s[at + 1] - np.array(hits)) <= NEAR))
    kinds = np.bincount(_CLASS[np.frombuffer(data, dtype=np.uint8)], minlength=5)
    letters = max(1, kinds[1] + kinds[2])
    out[:3] = len(hits) / n, np.log1p(len(hits)), odds / n
    out[4:] = (len(seen), hidden / n, mixed / n, len(second) / n, near / n, np.log1p(near), kinds[1] / letters,
               sum(map(str.isupper, tokens)) / n, kinds[3] / len(data), kinds[4] / len(data), np.log1p(n), len(data) / n)
    return out


_SECOND = frozenset(SECOND_PERSON)


def learn_lexicon(train: DataFrame) -> dict[str, float]:
    """Log odds of words in (text, label) rows; at most ``LEARNED`` words besides the fixed ones.

    Copies would make any of their words look telling: texts with the same least hash of
    a five-word window count once.
    """
    spaced = F.split(F.lower(F.coalesce("text", F.lit(""))), r"\s+")
    least = F.array_min(F.transform(F.sequence(F.lit(1), F.greatest(F.size("spaced") - 4, F.lit(1))), lambda i: F.xxhash64(F.slice("spaced", i, 5))))
    train = train.withColumn("spaced", spaced).withColumn("least", least).dropDuplicates(["label", "least"])
    whole = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"\p{L}{3,}"), F.lit(0)))
    begun = F.flatten(F.transform("whole", lambda w: F.array(*[
        F.when(F.length(w) >= k, F.concat(F.substring(w, 1, k), F.lit("*"))) for k in STEMS])))
    words = train.select("label", whole.alias("whole")).select(
        "label", F.explode(F.array_distinct(F.concat("whole", F.array_compact(begun)))).alias("word"))
    n = train.agg(F.sum("label").alias("bad"), F.count(F.lit(1)).alias("all")).first()  # one row
    bad, good = n["bad"], n["all"] - n["bad"]
    odds = F.log((F.col("bad") + 0.5) / (bad - F.col("bad") + 0.5)) - F.log((F.col("good") + 0.5) / (good - F.col("good") + 0.5))
    counts = words.groupBy("word").agg(F.sum("label").alias("bad"), F.sum(1 - F.col("label")).alias("good"))
    found = counts.filter(F.col("bad") >= max(3, MIN_SHARE * bad)).select("word", F.round(odds, 6).alias("odds")).filter(
        F.col("odds") >= MIN_ODDS).orderBy(F.desc("odds"), "word").limit(LEARNED)
    return dict.fromkeys(INSULTS, MIN_ODDS) | {r["word"]: r["odds"] for r in found.toLocalIterator()}


def featurise(docs: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """``docs`` with ``_features``, a vector."""
    words = {k: v for k, v in lexicon.items() if k[-1] != "*"}
    stems = {k[:-1]: v for k, v in lexicon.items() if k[-1] == "*"}

    @F.pandas_udf("array<double>")
    def measure(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([features(t, words, stems) for t in batch])

    return docs.withColumn("_features", array_to_vector(measure(F.col("text"))))


class Scorer:
    """Lexicon, trees and calibration."""

    def __init__(self, docs: DataFrame, labels: DataFrame):
        known = labels.filter(F.col("toxic").isNotNull() & ~in_fold(F.col("doc_id"), FOLDS, HELD_OUT))
        shares = known.agg(F.avg("toxic").alias("bad")).first()["bad"]
        self.constant: float | None = float(shares or 0.0)
        chosen = sample_labels(labels, "toxic", FOLDS, HELD_OUT, {0: MOST, 1: MOST})
        train = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").withColumn(
            "part", F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(4)))
        train = cut(train)  # at most 2 * MOST documents
        sizes = {(r["fit"], r["label"]): r["n"] for r in train.groupBy((F.col("part") > 0).alias("fit"), "label").agg(
            F.count(F.lit(1)).alias("n")).collect()}  # four rows
        if not all(sizes.get((fit, label)) for fit in (True, False) for label in (0, 1)):
            return
        self.constant = None
        self.lexicon = learn_lexicon(train.filter("part > 0").select("text", "label"))
        ready = cut(featurise(train, self.lexicon).select("part", F.col("label").cast("double").alias("label"), "_features"))
        trees = GBTClassifier(featuresCol="_features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=7)
        self.trees = trees.fit(ready.filter("part > 0").repartition(4))
        held = self._margin(ready.filter("part = 0")).withColumn("weight", F.when(
            F.col("label") == 1, F.lit(shares / sizes[False, 1])).otherwise(F.lit((1 - shares) / sizes[False, 0])))
        self.calibration = IsotonicRegression(featuresCol="_margin", labelCol="label", weightCol="weight",
                                              predictionCol="score").fit(held)

    def _margin(self, df: DataFrame) -> DataFrame:
        out = self.trees.transform(df)
        return out.withColumn("_margin", F.round(vector_to_array("probability")[1], 6)).drop(
            "rawPrediction", "probability", "prediction")

    def score(self, docs: DataFrame) -> DataFrame:
        """(row, score): ``row`` has the columns of ``docs``."""
        rows = docs.select(F.struct("*").alias("row"), "text")
        if self.constant is not None:
            return rows.select("row", F.lit(self.constant).alias("score"))
        scored = self.calibration.transform(self._margin(featurise(rows, self.lexicon)))
        return scored.select("row", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "score")).alias("score"))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(row, held_out, score, predicted) of every document."""
    return Scorer(docs, labels).score(docs).select(
        "row", in_fold(F.col("row.doc_id"), FOLDS, HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= CUTOFF).cast("int").alias("predicted"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs, read(spark, sf_dir, "labels")).select("row.doc_id", "held_out", "score", "predicted")
