"""Corpus pipeline over ``documents``: quality, near copies, personal data, source mix, tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows the one before kept;
all but the last return the columns of ``documents``.  ``run`` cuts lineage after
every stage in the shared checkpoint folder, so a lost executor costs one stage.

Defined cases, for every stage: an empty table gives no rows; nulls are allowed in
any column and a null text counts as empty; extra columns pass whatever their names
(the last stage returns its own).  Quality: without two classes of labels all rows
get the one known label.  Near copies: wordless rows all stay; of rows with the same
id and text the one with the least other columns stays.  Source mix: rows without
words take no part, a row taken n times stands n times.  Tokens: an empty text has none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.llm import bpe, jaccard, mixing, neighbours, pii
from verdant.llm.common import cut, read


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on ``labels``, predicts to be good."""
    return neighbours.judge(docs, read(spark, sf_dir, "labels")).filter("predicted = 1").select("row.*")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the least id."""
    return jaccard.one_of_each(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with surrogates for personal data; ``n_chars`` follows the new text."""
    changed = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return pii.replace_entities(docs).select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each copy of a document that the mix takes."""
    taken = mixing.mix(docs).filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian 32-bit), their number, and digests of ids and decoded bytes."""
    return bpe.with_digests(bpe.BytePairs(spark).encode_rows(docs))


STAGES = [
    ("quality", keep_good),
    ("near copies", keep_one_of_each),
    ("personal data", replace_personal_data),
    ("source mix", mix_sources),
    ("tokens", encode),
]

# The votes of trained vectors cannot be written in SQL; tests hold each stage against its own input.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
