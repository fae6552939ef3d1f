"""The prefix trie against plain dictionaries of prefixes, with copies, deep paths and small trees."""
import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from verdant.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, rebuild=True):
    own = {}
    for c, t, r, x in sorted((r for r in rows if r[0] is not None), key=lambda z: (z[1] is not None, z[1] or 0, z[2] or "", z[3] or "")):
        own.setdefault(c, []).append((r or "", x or ""))
    new = {c: tuple(s) for c, s in own.items()}
    if rebuild:
        for c, s in own.items():
            h = zlib.crc32(str(c).encode()) % 9
            new[c] = tuple(own.get(c - c % 5, [])[:h] + s[h:])
    nodes, kids, leaves, saved = {}, {}, {}, {}
    for c, s in new.items():
        for d in range(len(s) + 1):
            nodes.setdefault(s[:d], []).append(c)
    for p in sorted(nodes, key=len, reverse=True):
        if p:
            kids.setdefault(p[:-1], []).append(p)
        k = kids.get(p, [])
        leaves[p] = sum(leaves[q] for q in k) if k else 1
        saved[p] = sum(saved[q] for q in k) + ((len(nodes[p]) - 1) * len(p[-1][1].encode()) if p else 0)
    out = []
    for p, m in nodes.items():
        ends = ",".join(str(c) for c in sorted(m) if len(new[c]) == len(p))
        out.append((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(seed, n, turns=7, texts=3):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        rows += [(c, t, ("user", "assistant")[t % 2], f"é{rng.randrange(texts)}" * rng.randint(1, 2)) for t in range(rng.randint(1, turns))]
    return rows


def write(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    return str(tmp_path)


def test_query_equals_dictionaries_and_sql(spark, tmp_path):
    rows = conversations(1, 90)
    rows += [(200 + c, t, "user", "same") for c in range(60) for t in range(3)]  # copies
    rows += [(300, None, None, None), (300, 0, "user", None), (301, 5, "user", "late"), (None, 0, "user", "no id")]
    rows += [(303, 0, "user", "twice")] * 2 + [(-7, 0, "user", "negative"), (-10, 1, "user", "base")]
    path = write(spark, tmp_path, rows)
    got = sorted((tuple(r) for r in trie.query(spark, path).collect()), key=str)
    assert got == brute(rows)
    db = duckdb.connect()
    db.execute(f"create view conversations as select * from '{path}/conversations.parquet/*.parquet'")
    assert sorted(db.execute(trie.SQL).fetchall(), key=str) == got


@pytest.mark.parametrize("segment,tree_rows,hot", [(3, 1, 1), (2, 5, 2), (512, 100_000, 4096)])
def test_segments_partial_trees_and_hot_parents_change_nothing(spark, tmp_path, monkeypatch, segment, tree_rows, hot):
    monkeypatch.setattr(trie, "SEGMENT", segment)
    monkeypatch.setattr(trie, "PIECE", 2)
    rows = conversations(2, 60, turns=14, texts=2) + [(500, t, "user", f"deep{t}") for t in range(40)]
    known = trie.cut(trie.identify(spark.createDataFrame(rows, SCHEMA)))
    members = known.select("conv_id").distinct()
    got = trie.trie(known, members, tree_rows=tree_rows, hot_children=hot)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, rebuild=False)


def test_wide_nodes_grow_through_every_layout():
    root, sizes = trie.Node(b""), {}
    rng = random.Random(3)
    keys = {bytes(rng.randrange(256) for _ in range(16)) for _ in range(3000)}
    rooms = set()
    for k in keys:
        sizes[k] = 1
        trie.insert(root, k, [1, 0, 1, 0, trie.NEVER])
        rooms.add(root.room)
    assert rooms == {4, 16, 48, 256}
    rows = list(trie.emit(root, trie.ROOT, 0, sizes))
    assert len(rows) == len(keys) + 1
    top = [r for r in rows if r[2] == 0]
    assert [(r[3], r[5], r[6]) for r in top] == [(len(keys), len(keys), len(keys))]


def test_long_texts_clashing_columns_and_empty_tables(spark):
    rows = [(c, t, "user", "long " * 20000 + str(c)) for c in range(4) for t in range(2)]
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(1).alias(c) for c in ("pos", "id", "size", "node", "m", "w", "final")])
    assert sorted((tuple(r) for r in trie.prefix_trie(df).collect()), key=str) == brute(rows, rebuild=False)
    assert trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
