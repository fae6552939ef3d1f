import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from verdant.llm import bpe

from .helpers import LONG, documents, edge_documents, no_documents, with_clashes

HARD = ["", "!", "!!! a", None, "it's  \n\n 日本語 テスト 　 x y é́ ١٢٣ ½ 🙂🙂 \x00 \x85 z", "a" * 5000, "hello" * 300,
        "  \t\n  end   ", "DON'T we'll <|endoftext|>", "0" * 1000, "ÿĀþ", "﻿ x ​ y", "Ǆǅ ﬀ ß", LONG]


@pytest.fixture(scope="module")
def reference():
    ranks = bpe.load_ranks(public_tokenizers.path(bpe.RANKS))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_every_token_encodes_to_itself(reference):
    ranks = bpe.load_ranks(public_tokenizers.path(bpe.RANKS))
    pairs = {t: bpe.pair_of(t, ranks) for t in ranks if len(t) > 1}
    assert len(set(pairs.values())) == len(ranks) - 256
    assert all(reference._core_bpe.encode_single_piece(t) == [r] for t, r in ranks.items())


@pytest.mark.parametrize("cached", [0, 40, 1 << 17])
def test_equals_library_and_round_trips(spark, reference, cached):
    docs = documents(spark, HARD)
    pairs = bpe.BytePairs(spark)
    if cached:
        pairs.learn(docs, cached=cached)
    tokens = docs.select("doc_id", pairs.encode(docs.text).alias("t"))
    got = {r.doc_id: r for r in tokens.select("doc_id", pairs.ids(tokens.t).alias("ids"), pairs.packed(tokens.t).alias("packed"),
                                              pairs.decode(tokens.t).alias("text")).collect()}
    for i, t in enumerate(HARD):
        want = reference.encode_ordinary(t or "")
        assert bytes(got[i].packed) == np.array(want, dtype="<u4").tobytes(), repr(t)[:60]
        assert got[i].ids == want
        assert bytes(got[i].text) == (t or "").encode()


def test_query_digests_on_edges(spark, reference):
    docs = edge_documents(spark)
    got = sorted(map(tuple, bpe.encode_documents(with_clashes(docs)).collect()), key=str)
    want = []
    for r in docs.collect():
        ids = reference.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
                     hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert bpe.encode_documents(no_documents(spark)).count() == 0


@pytest.mark.parametrize("known", [0, 3, 1 << 20])
def test_blocks_fold_distinct_units_only(spark, reference, known):
    words = [" " + "".join(chr(97 + i // 26 ** k % 26) for k in range(4)) for i in range(0, 40_000, 97)]
    texts = HARD + ["".join(words[i::7]) * 3 + "\x85 x　  y 's!'s" for i in range(7)] * 2 + ["a\x1c b\x1f  c᠎ d", "\n", " "]
    docs = documents(spark, texts).coalesce(1)
    pairs = bpe.BytePairs(spark)
    given = []
    inner = pairs._encode_each
    pairs._encode_each = lambda units: given.append(units) or inner(units)
    got = {r.doc_id: (bytes(r.ids), bytes(r.decoded)) for r in pairs.encode_rows(docs, known=known).collect()}
    assert len(given) == 2  # the folds see arrays of units, for the known ones and for the others
    assert got == {i: (np.array(reference.encode_ordinary(t or ""), dtype="<u4").tobytes(), (t or "").encode()) for i, t in enumerate(texts)}
    counts = docs.selectExpr("coalesce(text, '') AS text").mapInArrow(bpe._count_units(True), "unit string, n long").collect()
    assert sum(len(r.unit) * r.n for r in counts) == sum(len(t or "") for t in texts) and len({r.unit for r in counts}) == len(counts)
    assert pairs._often(docs.selectExpr("coalesce(text, '') AS text"), known).num_rows <= known
