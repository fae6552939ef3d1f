"""Small fixtures that several test modules use."""
import random
import re

from pyspark.sql import functions as F

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("size", "row", "score", "copies", "draws", "key", "n", "label", "found", "old", "target", "hash", "block")
LONG = " ".join(f"word{i % 977}" for i in range(30_000))


def word_list(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def documents(spark, texts, ids=None, sources=None):
    ids = ids if ids is not None else range(len(texts))
    sources = sources if sources is not None else [f"src{i % 3}" for i in range(len(texts))]
    rows = [(i, t, "en", s, len(t or "")) for i, t, s in zip(ids, texts, sources)]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def edge_documents(spark):
    """Nulls in every column, empty, wordless, very long, repeated rows."""
    rng = random.Random(5)
    p = prose(rng, 60)
    rows = [(0, p, "en", "a", 5), (0, p, "en", "a", 5), (1, None, None, None, None), (None, p, "en", None, 5),
            (None, None, None, None, None), (2, "", "en", "b", 0), (3, " \n\t ", "en", "b", 4), (4, "one", "en", "b", 3),
            (5, LONG, "en", "c", len(LONG)), (6, "x" * 5000, "en", "c", 5000), (7, prose(rng, 80), "en", "c", 1)]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def with_clashes(df):
    return df.select("*", *[F.lit(1).alias(c) for c in CLASHES if c not in df.columns])


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
