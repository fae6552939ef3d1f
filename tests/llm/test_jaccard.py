import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from verdant.llm import components, jaccard
from verdant.llm.common import cut
from verdant.llm.components import connected_components

from .helpers import documents, edge_documents, no_documents, prose, with_clashes, word_list


def brute(rows, threshold=0.8):
    """{row index: (class id, links)} by comparing all pairs that share a shingle."""
    words = [word_list(t) for _, t in rows]
    sets = [{tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set() for w in words]
    at = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            at[g].append(i)
    parent, links = list(range(len(rows))), Counter()

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a
    for i, s in enumerate(sets):
        for j, n in Counter(j for g in s for j in at[g] if j != i).items():
            if n / (len(s) + len(sets[j]) - n) >= threshold:
                links[i] += 1
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = d if least.get(r) is None else least[r] if d is None else min(d, least[r])
    return Counter((d, least[find(i)], links[i]) for i, (d, _) in enumerate(rows))


def run(docs, **kw):
    return Counter((r.doc_id, r.class_id, r.n_links) for r in jaccard.near_copies(docs, **kw).collect())


def edited(rng, text, n):
    w = text.split()
    for k in rng.sample(range(len(w)), n):
        w[k] = f"edit{rng.randrange(10 ** 6)}"
    return " ".join(w)


def test_banding_reaches_its_recall():
    for threshold in (0.5, 0.8, 0.95):
        bands, rows = jaccard.bands_and_rows(threshold, 0.99, 256)
        assert bands * rows <= 256 and 1 - (1 - threshold ** rows) ** bands >= 0.99
    with pytest.raises(ValueError):
        jaccard.bands_and_rows(0.01, 0.9999, 8)


@pytest.mark.parametrize("block", [256, 7])
def test_equals_brute_force(spark, block):
    rng = random.Random(11)
    base = [prose(rng, n) for n in (30, 60, 120, 300)]
    texts = base + [edited(rng, base[2], n) for n in (1, 1, 2, 2, 3, 3, 4, 5, 8)]
    texts += [edited(rng, base[3], rng.randint(1, 9)) for _ in range(40)]  # a large group of different near copies
    texts += [base[0]] * 25 + [base[1] + " " + prose(rng, n) for n in (1, 5, 12, 20)]
    texts += [prose(rng, rng.randint(1, 50)) for _ in range(40)] + ["", None, "one two", "one two", "a b c d e"]
    assert run(documents(spark, texts), block=block) == brute(list(enumerate(texts)))


def test_edges(spark):
    docs = edge_documents(spark)
    assert run(with_clashes(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert run(no_documents(spark)) == Counter()
    kept = jaccard.one_of_each(with_clashes(docs))
    assert set(docs.columns) < set(kept.columns) and "size" in kept.columns
    ids = sorted((r.doc_id, r.text or "") for r in kept.filter("doc_id is not null").collect())
    assert [i for i, _ in ids] == [0, 1, 2, 3, 4, 5, 6, 7]
    assert kept.count() == 9  # and the null id without words


def test_sparse_and_dense_sets_intersect_exactly():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 9000, rng.integers(1, 6000))).astype(np.uint64) for _ in range(12)]
    got = jaccard.intersections(sets)
    assert all(got[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(12) for j in range(12) if i != j)


def test_components_of_edges_that_fit_a_task_need_no_rounds(spark, monkeypatch):
    cuts = []
    monkeypatch.setattr(components, "cut", lambda df: cuts.append(1) or cut(df))
    edges = spark.range(4000).selectExpr("id as a", "id + 1 as b").filter("a % 1000 <> 999")
    for task_edges in (1 << 17, 700):
        monkeypatch.setattr(components, "TASK_EDGES", task_edges)
        cuts.clear()
        got = components.connected_components(edges)
        assert (len(cuts) == 2) == (task_edges > 4000)
        assert got.count() == 4000 and got.filter("root <> node - node % 1000").count() == 0
    keyed = edges.selectExpr("unhex(lpad(hex(b), 4, '0')) as a", "unhex(lpad(hex(a), 4, '0')) as b")
    assert components.connected_components(keyed).filter("hex(root) = '03E8'").count() == 1000


def test_components(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5), (None, 3)]
    parent = {}

    def find(a):
        while parent.setdefault(a, a) != a:
            a = parent[a]
        return a
    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a is not None and a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
