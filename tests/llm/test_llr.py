import math
import random
from collections import Counter

import re
import xxhash

from verdant.llm import llr

from .helpers import LONG, documents, edge_documents, labels, no_documents, prose, with_clashes, word_list


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def h64(text, seed=42):
    return xxhash.xxh64_intdigest(text.encode(), seed)


def long_hash(value, seed):
    return xxhash.xxh64_intdigest((value & (1 << 64) - 1).to_bytes(8, "little"), seed)


def grams(text, buckets):
    w = [h64(x) for x in word_list(text)]
    pairs = [long_hash(b, long_hash(a, 42)) for a, b in zip(w, w[1:])]
    zero = xxhash.xxh64_intdigest((0).to_bytes(4, "little"), 42)
    outlines = [h64(x, zero) for x in word_list(re.sub(r"[^\W_]+", "a", text or ""))]
    return [g & (buckets - 1) for g in w + pairs + outlines]


def brute(rows, trusted, buckets, threshold):
    raw, trust = Counter(), Counter()
    for i, t in rows:
        g = Counter(grams(t, buckets))
        raw += g
        if i in trusted:
            trust += g
    n, m = sum(raw.values()), sum(trust.values())
    weight = [round(1e6 * math.log(((trust[b] + 1) / (m + buckets)) / ((raw[b] + 1) / (n + buckets)))) if m else 0 for b in range(buckets)]
    out = []
    for i, t in rows:
        w, lines = word_list(t), [x for x in (t or "").split("\n") if word_list(x)]
        windows = [tuple(w[k:k + 5]) for k in range(len(w) - 4)]
        count = Counter(windows)
        covered = {k + j for k, x in enumerate(windows) if count[x] > 1 for j in range(5)}
        g = grams(t, buckets)
        failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
        out.append((i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)),
                    len(covered), failed, not failed and sum(weight[b] for b in g) >= threshold * len(g)))
    return Counter(out)


def run(spark, docs, trusted, buckets, threshold):
    lab = labels(spark, [(i, 1, 0) for i in trusted] + [(None, 1, 0)])
    got = llr.judge(docs, llr.gram_weights(docs, lab, buckets), threshold, buckets)
    return Counter(tuple(r)[:8] for r in got.collect())


def test_equals_brute_force(spark):
    rng = random.Random(1)
    texts = [prose(rng, 50) for _ in range(30)]
    texts += [" ".join(x + rng.choice(["###", "$$", "|", "!!"]) for x in prose(rng, 40).split()) for _ in range(8)]
    texts += ["a b c d e f g " * 6, "line one here\nline one here\nother\n\n line one here", "p q r s t u v w x y z p q r s t u",
              "same " * 40, prose(rng, 9), prose(rng, 10), prose(rng, 5) + " " + prose(rng, 200)]
    docs = documents(spark, texts)
    trusted = set(range(20))
    for threshold in (-300_000, 0, 100_000):
        assert run(spark, docs, trusted, 256, threshold) == brute(list(enumerate(texts)), trusted, 256, threshold)


def test_edges(spark):
    docs = edge_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows, {0, 7}, 1024, -300_000)
    assert run(spark, with_clashes(docs), {0, 7}, 1024, -300_000) == want
    assert any(k[1] == len(LONG.split()) for k in want)


def test_without_trusted_text_and_without_documents(spark):
    docs = documents(spark, [prose(random.Random(2), 20), "few words"])
    got = llr.judge(docs, llr.gram_weights(docs, labels(spark, []))).collect()
    assert [(r.score, r.kept) for r in sorted(got, key=lambda r: r.doc_id)] == [(0.0, True), (0.0, False)]
    none = no_documents(spark)
    assert llr.judge(none, llr.gram_weights(none, labels(spark, []))).count() == 0


def test_plan_runs_no_python(spark):
    docs = documents(spark, ["a b c"])
    plan = llr.judge(docs, llr.gram_weights(docs, labels(spark, [(0, 1, 0)])))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
