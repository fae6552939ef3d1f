"""Periodic runs against a scan of every lag."""
import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from verdant.llm import runs

from .helpers import LONG, documents, edge_documents, no_documents, prose, with_clashes, word_list


def every_lag(ws):
    ids, found = {}, {}
    w = np.array([ids.setdefault(x, len(ids)) for x in ws], dtype=np.int64)
    for q in range(1, len(w) // 3 + 1):
        differ = np.concatenate(([-1], np.flatnonzero(w[:-q] != w[q:]), [len(w) - q]))
        same = np.diff(differ) - 1
        for i in np.flatnonzero(same >= max(24, 3 * q) - q):
            found.setdefault((int(differ[i] + 1), int(same[i] + q)), q)
    return sorted((a, n, q) for (a, n), q in found.items())


def rewritten(doc_id, ws):
    if doc_id is None or not ws:
        return ws
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return ws
    g, n = h // 10, len(ws)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [ws[i] if i < a else ws[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    ws = rewritten(doc_id, word_list(text))
    found = every_lag(ws) if len(ws) >= 24 else []
    drop = {i for a, n, q in found for i in range(a + q, a + n)}
    top = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None,) * 3

    def sha(x):
        return hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(ws), len(found), *top, 1000 * top[1] // top[2] if found else None,
            sha("".join(f"{a},{n},{q}\n" for a, n, q in found)), sha(" ".join(w for i, w in enumerate(ws) if i not in drop)))


def periodic_texts(seed, count, sizes=(0, 1, 23, 24, 60, 200, 700)):
    rng = random.Random(seed)
    for _ in range(count):
        n, kinds = rng.choice(sizes), rng.choice([1, 2, 3, 60])
        ws = [f"w{rng.randrange(kinds)}" for _ in range(n)]
        for _ in range(rng.randrange(3)):
            if n > 10:
                a, p = rng.randrange(n), rng.randint(1, n // 3)
                for i in range(a, min(n, a + rng.randint(1, n))):
                    ws[i] = ws[a + (i - a) % p]
        yield " ".join(ws)


def test_all_runs_equal_a_scan_of_every_lag():
    texts = list(periodic_texts(3, 600))
    for text, (n, start, length, period, _) in zip(texts, runs.runs_of_texts([t.encode() for t in texts])):
        assert n == len(text.split())
        assert list(zip(start.tolist(), length.tolist(), period.tolist())) == every_lag(text.split())


def test_fibonacci_words_and_powers_of_one_word():
    a, b = "a", "a b"
    for _ in range(12):
        a, b = b, f"{b} {a}"
    for text in (b, "x " * 5000, "a b " * 40 + "c " + "a b " * 40):
        (_, s, n, p, _), = runs.runs_of_texts([text.encode()])
        assert list(zip(s.tolist(), n.tolist(), p.tolist())) == every_lag(text.split())


def test_runs_do_not_cross_texts():
    half = " ".join(f"k{i % 17}" for i in range(40))
    assert [len(x[1]) for x in runs.runs_of_texts([half.encode()] * 3)] == [0, 0, 0]


@pytest.mark.parametrize("batch", [1 << 22, 100])
def test_query_equals_brute_force(spark, tmp_path, monkeypatch, batch):
    monkeypatch.setattr(runs, "BATCH_BYTES", batch)
    rng = random.Random(4)
    texts = list(periodic_texts(8, 60)) + [prose(rng, 120) for _ in range(60)] + [None, "", " \t\n"]
    docs = documents(spark, texts)
    docs.unionByName(edge_documents(spark)).write.parquet(str(tmp_path / "documents.parquet"))
    rows = [tuple(r) for r in runs.query(spark, str(tmp_path)).collect()]
    want = [expected(r.doc_id, r.text) for r in docs.unionByName(edge_documents(spark)).collect()]
    assert sorted(rows, key=str) == sorted(want, key=str)


def test_long_text_nulls_and_clashing_columns(spark):
    found = {r.doc_id: r for r in runs.find_runs(with_clashes(edge_documents(spark))).filter("doc_id in (1, 4, 5)").collect()}
    assert found[1].n_words == 0 and found[1].runs == [] and found[1].collapsed == ""
    assert found[4].collapsed == "one"
    assert [tuple(r) for r in found[5].runs] == [(0, len(LONG.split()), 977)]
    assert len(found[5].collapsed.split()) == 977
    assert runs.find_runs(no_documents(spark)).count() == 0
