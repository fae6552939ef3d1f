"""Quality by nearest-neighbour voting in a latent-semantic space.

A text is a bag of hashed byte trigrams, as log term frequency, plus the shares of
its words that equal the one before or stand earlier in the text, all times inverse
document frequency.  From at most ``SAMPLE``
labelled documents (half of each class, lowest hash of the id first) the driver
takes document frequencies and the leading ``RANK`` eigenvectors of the term Gram
matrix.  The labelled documents' unit vectors in that space, at most SAMPLE x RANK
floats (0.8 MB), are broadcast.  Every document is projected; cosine products with
all labelled vectors are taken exactly, block by block, and the ``NEIGHBOURS``
nearest vote with their label, weighted by similarity to the power ``SHARPNESS``.

Only the sample is bounded.  Labels of the held-out fold are never read.

Defined cases: null, empty and other texts without words have score 0; with no
labels every score is 0.5, with one class its label; several labels of an id
count as the largest; a null id is in the fold that its empty text gives; repeated rows
get equal scores; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_bytes, cut, in_fold, read, word_hashes

FOLDS, HELD_OUT = 5, 0
SAMPLE = 4096
TRIGRAM_BITS = 10
TERMS = (1 << TRIGRAM_BITS) + 2
RANK = 48
NEIGHBOURS = 32
SHARPNESS = 8
CUTOFF = 0.3
BLOCK = 256
REPEAT_WEIGHT = (40.0, 10.0)


def term_counts(text: str | None) -> np.ndarray:
    """Term weights of one whole text; all zero for one without words."""
    data = as_bytes(text)
    out = np.zeros(TERMS, dtype=np.float32)
    w = word_hashes(data)
    if not len(w):
        return out
    b = np.frombuffer(data, dtype=np.uint8).astype(np.uint32)
    if len(b) >= 3:
        code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
        code = (code * np.uint32(2654435761)) >> np.uint32(32 - TRIGRAM_BITS)
        out[:-2] = np.log1p(np.bincount(code, minlength=1 << TRIGRAM_BITS))
    again = np.count_nonzero(w[1:] == w[:-1]), len(w) - len(np.unique(w))
    out[-2:] = np.array(again) / len(w) * REPEAT_WEIGHT
    return out


def _term_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"],
                            "terms": [term_counts(t).tobytes() for t in batch["text"]]})


class Voters:
    """Projection and labelled unit vectors."""

    def __init__(self, terms: np.ndarray, labels: np.ndarray):
        self.labels = labels.astype(np.float32)
        self.idf = (np.log((1 + len(terms)) / (1 + np.count_nonzero(terms, axis=0))) + 1).astype(np.float32)
        x = self._weighted(terms)
        values, vectors = np.linalg.eigh(x.T @ x)  # single precision: TERMS squared floats stay small on the driver
        self.axes = np.ascontiguousarray(vectors[:, np.argsort(values)[::-1][:RANK]])
        self.vectors = self._unit(x @ self.axes)

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        length = np.linalg.norm(x, axis=1, keepdims=True)
        return np.divide(x, length, out=np.zeros_like(x), where=length > 0)

    def _weighted(self, terms: np.ndarray) -> np.ndarray:
        return self._unit(terms * self.idf)

    def score(self, terms: np.ndarray) -> np.ndarray:
        """Votes for a block of documents."""
        x = self._unit(self._weighted(terms) @ self.axes)
        cosine = np.rint(x.astype(np.float64) @ self.vectors.T.astype(np.float64) * 1e9).astype(np.int64)  # nano-units
        n = cosine.shape[1]
        k = min(NEIGHBOURS, n)
        near = np.argpartition(np.arange(n) - cosine * n, k - 1, axis=1)[:, :k]  # ties to the earlier vector
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1) / 1e9, 0) ** SHARPNESS
        total = weight.sum(axis=1)
        votes = (weight * self.labels[near]).sum(axis=1)
        return np.round(np.divide(votes, total, out=np.zeros_like(votes), where=total > 0), 6)


def sample_labels(labels: DataFrame, column: str, folds: int, held_out: int, per_class: dict[int, int]) -> DataFrame:
    """(doc_id, label): a bounded training sample, never from the held-out fold."""
    known = labels.filter(F.col(column).isNotNull() & F.col("doc_id").isNotNull() & ~in_fold(F.col("doc_id"), folds, held_out))
    known = known.groupBy("doc_id").agg(F.max(column).cast("int").alias("label"))
    parts = [known.filter(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for c, n in per_class.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return cut(out)


def fit(docs: DataFrame, labels: DataFrame) -> Voters | float:
    """Voters, or the constant score where there are not two classes to learn from."""
    chosen = sample_labels(labels, "quality", FOLDS, HELD_OUT, {0: SAMPLE // 2, 1: SAMPLE // 2})
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").mapInPandas(
        _term_rows, "doc_id long, label int, terms binary")
    one = rows.groupBy("doc_id").agg(F.max("label").alias("label"), F.min("terms").alias("terms"))  # one text an id
    labels_, terms = [], bytearray()
    for r in one.orderBy("doc_id").toLocalIterator():  # at most SAMPLE rows
        labels_.append(r["label"])
        terms += r["terms"]
    if len(set(labels_)) < 2:
        return float(labels_[0]) if labels_ else 0.5
    return Voters(np.frombuffer(terms, dtype=np.float32).reshape(-1, TERMS), np.array(labels_))


def score_documents(docs: DataFrame, voters: Voters | float) -> DataFrame:
    """(row, score): ``row`` has the columns of ``docs``."""
    rows = docs.select(F.struct("*").alias("row"))
    if isinstance(voters, float):
        return rows.select("row", F.lit(voters).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(voters)

    @F.pandas_udf("double")
    def vote(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            out = [shared.value.score(np.stack([term_counts(t) for t in batch.iloc[at:at + BLOCK]]))
                   for at in range(0, len(batch), BLOCK)]
            yield pd.Series(np.concatenate(out) if out else [], dtype="float64")

    return rows.select("row", vote(F.col("row.text")).alias("score"))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(row, held_out, score, predicted) of every document."""
    return score_documents(docs, fit(docs, labels)).select(
        "row", in_fold(F.col("row.doc_id"), FOLDS, HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= CUTOFF).cast("int").alias("predicted"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs, read(spark, sf_dir, "labels")).select("row.doc_id", "held_out", "score", "predicted")
