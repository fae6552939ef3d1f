"""Token files against the tokenizer itself, and the files against their format."""
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from verdant.llm import tokenfile

from .helpers import LONG, documents, edge_documents, no_documents, prose, with_clashes

PATH = public_tokenizers.path("byte_bpe_50k.json")


def encoded(texts, end=0):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return [np.array(e.ids + [end], dtype="<u4") for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def stored(spark, docs, folder, **kw):
    tokenfile.write_tokens(docs, folder, PATH, **kw)
    return tokenfile.read_tokens(spark, folder, block_docs=3).collect()


def test_query_equals_the_library(spark, tmp_path):
    rng = random.Random(6)
    texts = [prose(rng, rng.randint(0, 90)) for _ in range(120)] + [None, "", "<|endoftext|> é 漢字 \U0001F600", LONG]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    documents(spark, texts, ids=ids).repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(tuple(r) for r in tokenfile.query(spark, str(tmp_path)).collect())
    start, want = 0, []
    for i, e in zip(sorted(ids), encoded([x for _, x in sorted(zip(ids, texts))])):
        want.append((i, start, len(e), zlib.crc32(e.tobytes())))
        start += len(e)
    assert got == want


@pytest.mark.parametrize("chars", [1, 1 << 20])
def test_nulls_repeated_ids_and_clashing_columns(spark, tmp_path, chars):
    docs = with_clashes(edge_documents(spark))
    got = stored(spark, docs, f"file://{tmp_path}/t", batch_chars=chars)
    rows = docs.select("doc_id", "text").collect()
    want = sorted((r.doc_id if r.doc_id is not None else -1, e.tobytes()) for r, e in zip(rows, encoded([r.text for r in rows])))
    assert sorted((r.doc_id if r.doc_id is not None else -1, bytes(r.ids)) for r in got) == want
    got.sort(key=lambda r: r.start)
    assert [r.start for r in got] == [0, *np.cumsum([len(r.ids) // 4 for r in got])[:-1]]
    order = [r.doc_id for r in got]
    assert order[:2] == [None, None] and order[2:] == sorted(order[2:])
    assert stored(spark, no_documents(spark), f"file://{tmp_path}/none") == []


def test_one_id_on_all_rows_is_spread_and_files_keep_their_format(spark, tmp_path):
    folder = f"{tmp_path}/hot"
    docs = documents(spark, ["same text here"] * 400, ids=[7] * 400).repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = stored(spark, docs, folder)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(got) == 400 and {bytes(r.ids) for r in got} == {encoded(["same text here"])[0].tobytes()}
    shards = spark.read.parquet(f"{folder}/shards").orderBy("shard").collect()
    assert len(shards) > 1
    base = 0
    for s in shards:
        off = np.fromfile(f"{folder}/{s.shard}.off", dtype="<u8")
        assert s.base == base and len(off) == s.n_docs + 1 and off[0] == 0 and off[-1] == s.n_tokens
        assert os.path.getsize(f"{folder}/{s.shard}.ids") == 2 * s.n_tokens  # the vocabulary fits 16 bits
        assert (np.fromfile(f"{folder}/{s.shard}.doc", dtype="<i8") == 7).all()
        base += s.n_tokens
    assert not [f for f in os.listdir(folder) if f.endswith(".part")]


def test_wide_ids_take_32_bits(spark, tmp_path):
    folder = f"{tmp_path}/wide"
    got = stored(spark, documents(spark, ["a b", "c"]), folder, end_id=70_000)
    assert [bytes(r.ids) for r in sorted(got, key=lambda r: r.start)] == [e.tobytes() for e in encoded(["a b", "c"], 70_000)]


def test_units_between_spaces_give_the_ids_of_whole_texts(monkeypatch):
    rng = random.Random(9)
    alphabet = ["a", "B", "é", "漢", " ", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "'s", "'", "1", "!", "-", " ", "​", "x" * 60, "'ll"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    monkeypatch.setattr(tokenfile, "KNOWN_UNITS", 50)
    with open(PATH, encoding="utf-8") as f:
        encoder = tokenfile.Encoder(f.read(), 0)
    assert encoder.by_units
    want = [e.astype("<u2").tobytes() for e in encoded(texts)]
    assert [m for i in range(0, len(texts), 100) for m in encoder.encode(texts[i:i + 100])] == want


def test_other_vocabularies_are_given_whole_texts():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        source = f.read()
    encoder = tokenfile.Encoder(source, 1)
    assert not encoder.by_units
    want = Tokenizer.from_str(source).encode("Some Words here", add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode(["Some Words here"])[0], dtype="<u2").tolist() == want + [1]


def test_new_units_go_to_the_library_joined_and_are_told_apart(monkeypatch):
    rng = random.Random(4)
    alphabet = ["a", "ß", "é", "漢", "１", "–", " ", " ", "  ", "\n", "\x85", "\xa0", "　", " ", "᠎", "'s", "'", "7", "&&&", "_", " the", "ing"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += [" ".join(f"w{rng.randrange(10**6)}" for _ in range(50)) + "***" for _ in range(40)]
    monkeypatch.setattr(tokenfile, "JOINED_BYTES", 1000)
    with open(PATH, encoding="utf-8") as f:
        encoder = tokenfile.Encoder(f.read(), 0)
    library, given = encoder.made, []

    class Counted:
        def encode_batch_fast(self, batch, **kw):
            given.extend(batch)
            return library.encode_batch_fast(batch, **kw)
    encoder.made = Counted()
    assert encoder.encode(texts) == [e.astype("<u2").tobytes() for e in encoded(texts)]
    given.clear()
    new = [prose(rng, 50) for _ in range(40)]
    assert encoder.encode(new) == [e.astype("<u2").tobytes() for e in encoded(new)]
    assert len(given) < 200  # almost 2,000 new units
    given.clear()
    assert encoder.encode(new) == [e.astype("<u2").tobytes() for e in encoded(new)] and not given
