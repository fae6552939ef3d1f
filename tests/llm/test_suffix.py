import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from verdant.llm import suffix

from .helpers import documents, edge_documents, no_documents, prose, with_clashes


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        covered = np.zeros(len(d) + 1, dtype=int)
        for i in range(len(d) - length + 1):
            if count[d[i:i + length]] > 1:
                covered[i:i + length] = 1
        spans = int((np.diff(np.concatenate(([0], covered))) == 1).sum())
        kept = bytes(np.frombuffer(d, dtype=np.uint8)[covered[:-1] == 0])
        out.append((len(d), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def run(docs, **kw):
    return suffix.repeated_spans(docs, **kw).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()


def corpus():
    rng = random.Random(3)
    p = "".join(rng.choice("abcdefgh ") for _ in range(450))
    return ["a" * 1500, "ab" * 700, "x" * 399, "x" * 400, None, "", p + "tail one is here" * 3, "head " + p, "zz" + p[:420] + "yy",
            p[30:] + "q" * 10, "é" * 450, (p + "-") * 3, "shared-prefix-" + p[10:415] + "Q",
            "shared-prefix-" + p[10:412] + "R" + p[:399], prose(rng, 150), prose(rng, 150), p[:399] + "!", "?" + p[1:400]]


@pytest.mark.parametrize("hot", [8192, 1])
def test_equals_brute_force(spark, hot):
    texts = corpus()
    got = {r.doc_id: tuple(r)[1:] for r in run(documents(spark, texts), hot=hot)}
    want = brute(texts, 400)
    assert [got[i] for i in range(len(texts))] == want


def test_short_strings_of_few_letters(spark):
    rng = random.Random(6)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 300))) for _ in range(40)]
    got = {r.doc_id: tuple(r)[1:] for r in run(documents(spark, texts), length=20, gram=6)}
    assert [got[i] for i in range(40)] == brute(texts, 20)


def test_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix, "PIECE", 257)
    rng = random.Random(7)
    text = "".join(rng.choice("abcdefgh") for _ in range(3000))
    text = text[:1200] + text[100:700] + text[1200:]
    whole = suffix.anchors(np.frombuffer(text.encode(), dtype=np.uint8))
    monkeypatch.setattr(suffix, "PIECE", 1 << 19)
    again = suffix.anchors(np.frombuffer(text.encode(), dtype=np.uint8))
    assert set(zip(*map(list, whole))) == set(zip(*map(list, again)))


def test_edges(spark):
    docs = edge_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = Counter((i, *x) for (i, _), x in zip(rows, brute([t for _, t in rows], 400)))
    assert Counter(map(tuple, run(with_clashes(docs)))) == want
    assert run(no_documents(spark)) == []


def test_mergesort_orders_suffixes_and_survives_collisions():
    rng = random.Random(1)
    strings = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 12))).encode() for _ in range(300)]
    group = np.array([rng.randrange(4) for _ in strings])
    s = suffix.Suffixes(strings, group, 12)
    want = sorted(range(300), key=lambda i: (group[i], strings[i]))
    order, agree = s.neighbours()
    assert [(group[i], strings[i]) for i in order] == [(group[i], strings[i]) for i in want]
    s.prefix[:] = 0  # every hash collides
    order, same = s.neighbours()
    assert [(group[i], strings[i]) for i in order] == [(group[i], strings[i]) for i in want] and list(same) == list(agree)


def test_prefix_hashes_are_made_in_place():
    strings = [bytes([i % 251]) * 400 for i in range(2000)]
    tracemalloc.start()
    s = suffix.Suffixes(strings, np.zeros(2000, dtype=np.int64), 400)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.5 * (s.prefix.nbytes + s.bytes.nbytes)
    assert (s.prefix[:, 1:] == np.cumsum((s.bytes[:, :-1] + np.uint64(1)) * suffix.powers(suffix._MULTIPLIER, 400), axis=1)).all()


def test_long_texts_reach_python_in_small_batches(spark):
    def sizes(batches):
        for b in batches:
            yield pd.DataFrame({"size": [int(b["text"].str.len().sum())]})
    run(documents(spark, ["a b"]))
    long = spark.range(40, numPartitions=1).select(F.repeat(F.lit("x"), 1 << 20).alias("text"))
    assert long.mapInPandas(sizes, "size long").agg(F.max("size")).first()[0] <= 2 * suffix.ARROW_BYTES
