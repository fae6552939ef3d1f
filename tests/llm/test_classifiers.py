import random
import zlib

import numpy as np
import pytest

from verdant.llm import neighbours, toxicity

from .helpers import LONG, documents, edge_documents, labels, no_documents, prose, with_clashes


def fold(i, parts):
    return zlib.crc32(str(i).encode()) % parts


def auc(scores, truth):
    s, y = np.asarray(scores), np.asarray(truth)
    return np.mean([(a > b) + 0.5 * (a == b) for a in s[y == 1] for b in s[y == 0]])


@pytest.fixture(scope="module")
def quality(spark):
    rng = random.Random(12)
    rows = []
    for i in range(400):
        good = i % 4 > 0
        t = prose(rng, rng.randint(20, 80))
        if not good:
            t = " | ".join(t.split()) if i % 8 else " ".join(w for w in t.split()[:8] for _ in range(12))
        rows.append((i, t, int(good)))
    docs = documents(spark, [t for _, t, _ in rows])
    return docs, labels(spark, [(i, y, 0) for i, _, y in rows]), {i: y for i, _, y in rows}


@pytest.fixture(scope="module")
def toxic(spark):
    rng = random.Random(13)
    rows = []
    for i in range(500):
        bad, w = i % 5 == 0, prose(rng, rng.randint(20, 60)).split()
        if bad:
            for _ in range(rng.randint(2, 5)):
                w.insert(rng.randrange(len(w)), rng.choice(["you stupid", "grumbo" + rng.choice(["ta", "lin", "s"]), "1d10t", "IDIOT!!"]))
        rows.append((i, " ".join(w), int(bad)))
    docs = documents(spark, [t for _, t, _ in rows])
    return docs, labels(spark, [(i, 1, y) for i, _, y in rows]), {i: y for i, _, y in rows}


def test_quality_on_held_out_documents(quality):
    docs, lab, truth = quality
    got = neighbours.judge(docs, lab).select("row.doc_id", "held_out", "score", "predicted").collect()
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out]
    assert auc([r.score for r in held], [truth[r.doc_id] for r in held]) > 0.97


def test_votes_are_exact(quality):
    docs, lab, _ = quality
    voters = neighbours.fit(docs, lab)
    terms = np.stack([neighbours.term_counts(r.text) for r in docs.limit(60).collect()])
    x = voters._unit(voters._weighted(terms) @ voters.axes)
    for row, score in zip(x, voters.score(terms)):
        c = np.round([sum(float(a) * float(b) for a, b in zip(row, v)) for v in voters.vectors], 9)
        best = np.argsort(-c, kind="stable")[:neighbours.NEIGHBOURS]
        w = np.maximum(c[best], 0) ** neighbours.SHARPNESS
        assert abs((w * voters.labels[best]).sum() / w.sum() - score) < 1e-6


@pytest.mark.parametrize("module,column", [(neighbours, 1), (toxicity, 2)])
def test_held_out_labels_are_never_read(quality, toxic, spark, module, column):
    docs, lab, _ = quality if module is neighbours else toxic
    parts, held = module.FOLDS, module.HELD_OUT
    flipped = spark.createDataFrame([
        tuple(1 - v if k == column and fold(r[0], parts) == held else v for k, v in enumerate(r)) for r in lab.collect()], lab.schema)
    pick = lambda x: sorted((r.row.doc_id, r.score) for r in module.judge(docs, x).collect())
    assert pick(lab) == pick(flipped)


def test_toxicity_on_held_out_documents(toxic):
    docs, lab, truth = toxic
    got = toxicity.judge(docs, lab).select("row.doc_id", "held_out", "score", "predicted").collect()
    assert all(r.held_out == (fold(r.doc_id, 3) == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    held = [r for r in got if r.held_out]
    assert auc([r.score for r in held], [truth[r.doc_id] for r in held]) > 0.97
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95


def test_toxicity_features():
    lexicon = {"idiot": 3.0, "stupid": 2.5}
    f = lambda t: dict(zip(toxicity.NAMES, toxicity.features(t, lexicon, {"grum": 4.0})))
    plain = f("the sea is calm and wide today")
    assert plain["hits"] == plain["obfuscated"] == plain["capitals"] == 0
    near = f("You are such an IDIOT!! really grumbly")
    assert near["log_hits"] == pytest.approx(np.log1p(2)) and near["log_near"] == pytest.approx(np.log1p(1)) and near["top_odds"] == 4.0
    assert near["capital_words"] > 0 and near["exclaims"] > 0
    assert f("an 1d10t here")["hidden_hits"] > 0 and f("what an i d i o t they are")["hidden_hits"] > 0 and f("st*pid s.t.u.p.i.d")["hidden_hits"] > 0
    assert not np.any(toxicity.features(None, lexicon, {})) and not np.any(toxicity.features(" \n", lexicon, {}))
    assert np.isfinite(toxicity.features(LONG, lexicon, {})).all()


@pytest.mark.parametrize("module", [neighbours, toxicity])
def test_edges(spark, module, quality, toxic):
    docs, lab, _ = quality if module is neighbours else toxic
    edge = with_clashes(edge_documents(spark))
    joined = edge.unionByName(with_clashes(docs))
    lab = lab.unionByName(spark.createDataFrame([(None, 1, 1), (3, None, None), (7, 1, 1), (7, 0, 0)], lab.schema))
    got = module.judge(joined, lab).select("row.size", "row.text", "held_out", "score", "predicted").collect()
    assert len(got) == 11 + docs.count() and all(0 <= r.score <= 1 for r in got)
    empty = {r.score for r in got if not (r.text or "").strip()}
    assert len(empty) == 1
    assert module.judge(no_documents(spark), lab).count() == 0


@pytest.mark.parametrize("module,constant", [(neighbours, 0.5), (toxicity, 0.0)])
def test_without_two_classes(spark, module, constant):
    docs = documents(spark, ["some text here", None, "more of it"])
    none = labels(spark, [])
    assert {r.score for r in module.judge(docs, none).collect()} == {constant}
    ones = labels(spark, [(i, 1, 1) for i in range(3)])
    assert {r.score for r in module.judge(docs, ones).collect()} == {1.0}
