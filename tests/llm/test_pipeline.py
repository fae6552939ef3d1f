"""Each stage of the pipeline is held against its own input; queries against SQL at the small scale."""
import os
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as P
from verdant.llm import jaccard, mixing, neighbours
from verdant.llm.common import read

from .helpers import DOC_SCHEMA, edge_documents, no_documents, with_clashes

SF = "/root/testdata/sf0.001"
needs = pytest.mark.skipif(not os.path.exists(SF), reason="no test data")


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    docs, out = read(spark, SF, "documents"), []
    for k, (name, stage) in enumerate(P.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(k))
        stage(spark, docs, SF).write.parquet(path)
        out.append((name, docs, spark.read.parquet(path)))
        docs = out[-1][2]
    return out


@needs
def test_stages_chain(spark, staged):
    columns = read(spark, SF, "documents").columns
    assert [n for n, _, _ in staged] == [n for n, _ in P.STAGES]
    assert all(after.columns == columns for _, _, after in staged[:-1])
    for (_, _, after), (_, before, _) in zip(staged, staged[1:]):
        assert after.count() == before.count() > 0


@needs
def test_decisions_take_effect(spark, staged):
    _, docs, good = staged[0]
    kept = {r.doc_id for r in good.collect()}
    judged = neighbours.judge(docs, read(spark, SF, "labels")).select("row.doc_id", "predicted").collect()
    assert kept == {r.doc_id for r in judged if r.predicted} and len(kept) < docs.count()
    _, before, single = staged[1]
    names = {r.class_id for r in jaccard.near_copies(before).collect()}
    assert sorted(r.doc_id for r in single.collect()) == sorted(names)
    _, before, clean = staged[2]
    old = {r.doc_id: r for r in before.collect()}
    new = clean.collect()
    changed = [r for r in new if r.text != old[r.doc_id].text]
    assert changed and not any("@mail0.example.com" in r.text for r in new)
    assert all(r.n_chars == len(r.text) and r.source == old[r.doc_id].source for r in new)
    _, before, mixed = staged[3]
    copies = {r.doc_id: r.copies for r in mixing.mix(before).select("row.doc_id", "copies").collect()}
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {i: n for i, n in copies.items() if n}
    _, before, tokens = staged[4]
    assert tokens.count() == before.count() and tokens.filter("n_tokens * 4 <> octet_length(ids)").count() == 0


@pytest.mark.parametrize("name,stage", P.STAGES)
def test_stages_on_edge_rows(spark, tmp_path, name, stage):
    edge_documents(spark).select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic")).write.parquet(str(tmp_path / "labels.parquet"))
    docs = with_clashes(edge_documents(spark))
    got = stage(spark, docs, str(tmp_path)).collect()
    assert stage(spark, with_clashes(no_documents(spark)), str(tmp_path)).collect() == []
    if name == "tokens":
        assert len(got) == docs.count() and all(r.n_tokens == 0 for r in got if r.doc_id in (1, 2))
        return
    assert set(got[0].asDict()) == set(docs.columns)
    if name in ("quality", "personal data"):  # one class of labels: all are good; no entity: no text changes
        assert Counter((r.doc_id, r.text) for r in got) == Counter((r.doc_id, r.text) for r in docs.collect())
    elif name == "near copies":  # the repeated row, and the same text under a null id, go but for one
        assert Counter((r.doc_id, r.text) for r in got) == Counter(
            {(r.doc_id, r.text): 1 for r in docs.collect() if r.doc_id is not None or not (r.text or "").split()})
    else:  # wordless rows have no part in the mix
        assert all((r.text or "").split() for r in got)


def test_equal_ids_and_texts_keep_the_least_row(spark):
    for order in (1, -1):
        rows = [(7, "same words in this text", "en", s, 5) for s in ("y", "x", "z", "x")][::order]
        got = jaccard.one_of_each(spark.createDataFrame(rows, DOC_SCHEMA).withColumn("m", F.create_map(F.lit("k"), "source"))).collect()
        assert [(r.doc_id, r.source, r.m) for r in got] == [(7, "x", {"k": "x"})]


@needs
def test_run_equals_the_chain(spark, staged):
    pick = lambda df: sorted(tuple(r) for r in df.select("doc_id", "n_tokens", "ids_sha256").collect())
    assert pick(E.queries()["pipeline"](spark, SF)) == pick(staged[-1][2])


@needs
@pytest.mark.parametrize("name", sorted(k for k in E.oracle_sql() if k.startswith("op")))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(E.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    got = E.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(*columns).collect()), key=str) == sorted(want.fetchall(), key=str)
