"""Prefix trie of conversations by adaptive radix trees over fixed-width turn ids.

A turn is known by 16 bytes: the first half of the SHA-256 of its role and text, compared
as a big-endian number, so a conversation is a byte string and a prefix of turns is a
prefix of bytes.  A node of the trie is a distinct sequence of first turns, the textless
root (depth 0) included.

1. Conversations are streamed in turn order and cut into segments of ``SEGMENT`` turns;
   a segment starts at an anchor, the chained id of all turns before it, so that no row
   and no tree path grows with the longest conversation.
2. Equal conversations become one with a weight (partial aggregates: a third of all rows
   in copies of one conversation is one row a task).
3. Segments are range-partitioned by anchor and first turns, the rest by hash, so that a
   hot first turn is spread.  A task inserts them into adaptive radix trees: nodes of 4,
   16, 48 and 256 children that grow as they fill, paths without a branch compressed into
   one node, and only byte depths that end a turn emit trie nodes.  Trees are given out
   and begun anew at a bound, for what they emit adds up: partial nodes of one id are
   merged by a partial aggregate.
4. A second pass has what needs whole nodes: which sequences are leaves, and which
   conversation owns a node (its smallest member), so that each node's bytes are counted
   once.  Both are known per sequence, so subtree sums add up over partial trees as well.
5. A node's parent is looked up by join; parents of very many children (at most 65,536 of
   them by the choice of the bound) are broadcast.  The ids of the members that end at a
   node are streamed in order into its digest, from pieces of ``PIECE`` ids.

Defined cases: null roles and texts are empty; null turns come first, equal turns are
ordered by role and text; rows without a conversation id form no conversation; extra
columns are ignored; an empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.series import join_small
from .common import cut, read

WIDTH = 16
ROOT = bytes(WIDTH)
SEGMENT = 512
PIECE = 4096
TREE_BYTES = 32 << 20
TREE_ROWS = 100_000
HOT_CHILDREN = 4096
HOT_PARENTS = 1 << 16
NEVER = (1 << 62)
EMPTY_SHA = hashlib.sha256(b"").hexdigest()

SEGMENTS = "conv_id long, seg long, anchor binary, path binary, sizes array<long>, final binary"
PARTIALS = ("node binary, parent binary, depth long, n_convs long, conv_id long, n_leaves long, saved_tokens long")


# ------------------------------------------------------- adaptive radix tree

class Node:
    """A tree node: compressed path, children in one of four layouts, and what ends here.

    ``sums`` is [weight, least conversation, leaves, saved, least owned depth] or None.
    """

    __slots__ = ("path", "room", "keys", "kids", "sums")

    def __init__(self, path: bytes):
        self.path, self.room, self.keys, self.kids, self.sums = path, 4, bytearray(), [], None

    def find(self, byte: int) -> "Node | None":
        if self.room <= 16:  # sorted bytes beside their children
            i = bisect_left(self.keys, byte)
            return self.kids[i] if i < len(self.keys) and self.keys[i] == byte else None
        if self.room == 48:  # one slot number a byte
            return self.kids[self.keys[byte] - 1] if self.keys[byte] else None
        return self.kids[byte]

    def put(self, byte: int, child: "Node") -> None:
        """Add a child, or replace the one there."""
        if self.room <= 16:
            i = bisect_left(self.keys, byte)
            if i < len(self.keys) and self.keys[i] == byte:
                self.kids[i] = child
                return
            if len(self.keys) < self.room:
                self.keys.insert(i, byte)
                self.kids.insert(i, child)
                return
            self._grow()
            self.put(byte, child)
        elif self.room == 48:
            if self.keys[byte]:
                self.kids[self.keys[byte] - 1] = child
            elif len(self.kids) < 48:
                self.kids.append(child)
                self.keys[byte] = len(self.kids)
            else:
                self._grow()
                self.put(byte, child)
        else:
            self.kids[byte] = child

    def _grow(self) -> None:
        if self.room == 4:
            self.room = 16
        elif self.room == 16:
            slots = bytearray(256)
            for i, byte in enumerate(self.keys):
                slots[byte] = i + 1
            self.room, self.keys = 48, slots
        else:
            self.room, self.keys, self.kids = 256, bytearray(), [self.kids[s - 1] if s else None for s in self.keys]

    def children(self) -> Iterator[tuple[int, "Node"]]:
        if self.room <= 16:
            yield from zip(self.keys, self.kids)
        elif self.room == 48:
            yield from ((b, self.kids[s - 1]) for b, s in enumerate(self.keys) if s)
        else:
            yield from ((b, k) for b, k in enumerate(self.kids) if k is not None)


def merge(a: list | None, b: list) -> list:
    return list(b) if a is None else [a[0] + b[0], min(a[1], b[1]), a[2] + b[2], a[3] + b[3], min(a[4], b[4])]


def _shared(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of a and b[at:]."""
    if b.startswith(a, at):
        return len(a)
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if b.startswith(a[:mid], at) else (low, mid - 1)
    return low


def insert(root: Node, key: bytes, sums: list) -> None:
    node, at, above, by = root, 0, None, 0
    while True:
        same = _shared(node.path, key, at)
        if same < len(node.path):  # split the compressed path
            upper = Node(node.path[:same])
            upper.put(node.path[same], node)
            node.path = node.path[same + 1:]
            above.put(by, upper)
            node = upper
        at += same
        if at == len(key):
            node.sums = merge(node.sums, sums)
            return
        child = node.find(key[at])
        if child is None:
            child = Node(key[at + 1:])
            child.sums = list(sums)
            node.put(key[at], child)
            return
        above, by, node, at = node, key[at], child, at + 1


def chain(before: bytes, turn: bytes) -> bytes:
    """Id of a node from its parent's and its last turn."""
    return hashlib.blake2b(before + turn, digest_size=WIDTH).digest()


def emit(root: Node, anchor: bytes, depth: int, sizes: dict) -> Iterator[tuple]:
    """Partial nodes of one tree; the tree's own root only where it is the trie's root."""
    order = [(root, -1, b"", anchor, depth)]
    turns: list[list] = []
    for number, (node, _, rest, here, d) in enumerate(order):  # grows: parents before children
        held, mine = rest + node.path, []
        for i in range(0, len(held) - WIDTH + 1, WIDTH):
            turn = held[i:i + WIDTH]
            below, d = chain(here, turn), d + 1
            mine.append((below, here, d, sizes[turn]))
            here = below
        turns.append(mine)
        left = held[len(held) // WIDTH * WIDTH:]
        order += [(k, number, left + bytes((b,)), here, d) for b, k in node.children()]
    totals = [o[0].sums for o in order]
    for number in range(len(order) - 1, -1, -1):
        s = totals[number]
        for node, parent, d, size in reversed(turns[number]):
            s[3] += size * (s[0] - (s[4] <= d))
            yield node, parent, d, s[0], s[1], s[2], s[3]
        above = order[number][1]
        if above >= 0:
            totals[above] = merge(totals[above], s)
        elif anchor == ROOT:
            yield ROOT, None, 0, s[0], s[1], s[2], s[3]


def _trees(tree_rows: int, tree_bytes: int):
    names = [f.split()[0] for f in PARTIALS.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        roots, sizes, rows, held = {}, {}, 0, 0

        def give():
            out = []
            for (anchor, seg), root in roots.items():
                for row in emit(root, anchor, seg * SEGMENT, sizes):
                    out.append(row)
                    if len(out) >= 50_000:
                        yield pd.DataFrame(out, columns=names)
                        out = []
            if out:
                yield pd.DataFrame(out, columns=names)

        for b in batches:
            for seg, anchor, path, lens, w, conv, leaves, saved, own in zip(
                    b["seg"], b["anchor"], b["path"], b["sizes"], b["w"], b["m"], b["leaves"], b["saved"], b["own"]):
                sizes.update(zip((path[i:i + WIDTH] for i in range(0, len(path), WIDTH)), map(int, lens)))
                root = roots.setdefault((anchor, int(seg)), None)
                if root is None:
                    root = roots[anchor, int(seg)] = Node(b"")
                insert(root, path, [int(w), int(conv), int(leaves), int(saved), int(own)])
                rows, held = rows + 1, held + len(path) + 512
                if rows >= tree_rows or held >= tree_bytes:
                    yield from give()
                    roots, sizes, rows, held = {}, {}, 0, 0
        yield from give()
    return run


# --------------------------------------------------------------- Spark stages

def identify(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, id, size): turns numbered from 1 in order, by their 16-byte ids and UTF-8 bytes of text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text")).filter(
        "conv_id is not null")
    pos = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    said = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    return rows.withColumn("pos", pos.cast("long")).select(
        "conv_id", "pos", F.unhex(F.substring(F.sha2(said, 256), 1, 2 * WIDTH)).alias("id"),
        F.octet_length("text").cast("long").alias("size"))


def rebuild(turns: DataFrame, members: DataFrame, group: int = 5, shares: int = 9) -> DataFrame:
    """The contract's conversations: c has the first h turns of c - c % group, then its own after its first h.

    ``h`` = crc32(decimal c) % shares; ``turns`` and the result are as ``identify`` gives them.
    """
    def h(c):
        return F.crc32(c.cast("string").cast("binary")) % shares

    def base(c):
        return c - F.pmod(c, F.lit(group).cast("long"))

    c = F.col("conv_id")
    heads = turns.filter((F.col("pos") < shares) & (c == base(c))).select(c.alias("_base"), "pos", "id", "size")
    shared = members.select("conv_id", base(c).alias("_base")).join(heads, "_base").filter(F.col("pos") <= h(c))
    own = turns.filter(F.col("pos") > h(c))
    return shared.select("conv_id", "pos", "id", "size").unionByName(own)


def _segment(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows by conversation and position -> segments; the last one of a conversation has its final node."""
    names = [f.split()[0] for f in SEGMENTS.split(", ")]
    now, seg, anchor, here, path, sizes = None, 0, ROOT, ROOT, [], []
    for b in batches:
        out = []
        for conv, turn, size in zip(b["conv_id"], b["id"], b["size"]):
            if conv != now or len(path) == SEGMENT:
                if now is not None:
                    out.append((now, seg, anchor, b"".join(path), sizes, here if conv != now else None))
                seg, anchor = (0, ROOT) if conv != now else (seg + 1, here)
                here, path, sizes, now = anchor, [], [], conv
            here = chain(here, turn)
            path.append(turn)
            sizes.append(size)
        if out:
            yield pd.DataFrame(out, columns=names)
    if now is not None:
        yield pd.DataFrame([(now, seg, anchor, b"".join(path), sizes, here)], columns=names)


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted (final, conv_id) -> pieces of comma-joined ids."""
    now, ids = None, []
    for b in batches:
        out = []
        for node, conv in zip(b["final"], b["conv_id"]):
            if ids and (node != now or len(ids) == PIECE):
                out.append((now, ids[0], ",".join(map(str, ids))))
                ids = []
            now = node
            ids.append(int(conv))
        if out:
            yield pd.DataFrame(out, columns=["node", "first", "piece"])
    if ids:
        yield pd.DataFrame([(now, ids[0], ",".join(map(str, ids)))], columns=["node", "first", "piece"])


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    now, sha = None, None
    for b in batches:
        out = []
        for node, piece in zip(b["node"], b["piece"]):
            if node != now:
                if now is not None:
                    out.append((now, sha.hexdigest()))
                now, sha = node, hashlib.sha256(piece.encode())
            else:
                sha.update(b"," + piece.encode())
        if out:
            yield pd.DataFrame(out, columns=["node", "sha"])
    if now is not None:
        yield pd.DataFrame([(now, sha.hexdigest())], columns=["node", "sha"])


def _binary(value: bytes) -> Column:
    return F.unhex(F.lit(value.hex()))


def trie(turns: DataFrame, members: DataFrame, tree_rows: int = TREE_ROWS, tree_bytes: int = TREE_BYTES,
         hot_children: int = HOT_CHILDREN) -> DataFrame:
    """Nodes of the prefix trie of the conversations ``members`` (distinct conv_id) with ``turns`` as of ``identify``."""
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "pos").select("conv_id", "id", "size")
    parts = cut(ordered.mapInPandas(_segment, SEGMENTS))
    silent = members.join(parts.select("conv_id").distinct(), "conv_id", "left_anti").select(
        "conv_id", F.lit(0).cast("long").alias("seg"), _binary(ROOT).alias("anchor"), _binary(b"").alias("path"),
        F.array().cast("array<long>").alias("sizes"), _binary(ROOT).alias("final"))
    parts = cut(parts.unionByName(silent))
    ends = parts.filter("final is not null").select("final", "conv_id")
    kinds = ends.groupBy("final").agg(F.min("conv_id").alias("m"), F.count(F.lit(1)).alias("w"))
    reps = cut(parts.select("conv_id", "seg", "anchor", "path", "sizes").join(kinds.withColumnRenamed("m", "conv_id"), "conv_id")
               .withColumnRenamed("conv_id", "m"))

    def grow(rows: DataFrame) -> DataFrame:
        order = ["anchor", "head", "tail"]
        spread = rows.withColumn("head", F.substring("path", 1, 4 * WIDTH)).withColumn("tail", F.xxhash64("path"))
        return spread.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(_trees(tree_rows, tree_bytes), PARTIALS)

    zero = F.lit(0).cast("long")
    plain = reps.select("m", "seg", "anchor", "path", "sizes", "w", zero.alias("leaves"), zero.alias("saved"),
                        F.lit(NEVER).alias("own"))
    nodes = cut(grow(plain).groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.first("parent").alias("parent"), F.first("depth").alias("depth"),
        F.sum("n_convs").alias("n_convs")))

    # per sequence: is its end a leaf, and from which depth on is its first conversation the smallest member?
    leaf = kinds.join(nodes.select(F.col("node").alias("final"), "n_convs"), "final").select(
        "m", (F.col("n_convs") == F.col("w")).cast("long").alias("leaves"))
    owned = nodes.groupBy(F.col("conv_id").alias("m")).agg(F.min("depth").alias("own"))
    facts = leaf.join(owned, "m", "left").select("m", "leaves", F.coalesce("own", F.lit(NEVER)).alias("own"))
    known = reps.join(facts, "m")
    begin = F.col("seg") * SEGMENT
    first = F.greatest(F.least(F.col("own") - begin, F.lit(SEGMENT + 1).cast("long")), F.lit(1).cast("long")).cast("int")
    total = F.aggregate("sizes", zero, lambda a, x: a + x)
    mine = F.aggregate(F.slice("sizes", first, F.lit(SEGMENT)), zero, lambda a, x: a + x)
    deeper = Window.partitionBy("m").orderBy(F.desc("seg")).rowsBetween(Window.unboundedPreceding, -1)
    whole = known.withColumn("here", F.col("w") * total - mine).select(
        "m", "seg", "anchor", "path", "sizes", "w", "leaves", F.coalesce(F.sum("here").over(deeper), zero).alias("saved"), "own")

    sums = grow(whole).select("node", "n_leaves", "saved_tokens", zero.alias("n_children"), F.lit(None).cast("string").alias("sha"))
    kids = nodes.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children")).select(
        "node", zero.alias("n_leaves"), zero.alias("saved_tokens"), "n_children", F.lit(None).cast("string").alias("sha"))
    listed = ends.repartitionByRange("final", "conv_id").sortWithinPartitions("final", "conv_id").mapInPandas(
        _pieces, "node binary, first long, piece string")
    shas = listed.repartition("node").sortWithinPartitions("node", "first").select("node", "piece").mapInPandas(
        _digests, "node binary, sha string").select(
        "node", zero.alias("n_leaves"), zero.alias("saved_tokens"), zero.alias("n_children"), "sha")
    facts = sums.unionByName(kids).unionByName(shas).groupBy("node").agg(
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
        F.sum("n_children").alias("n_children"), F.max("sha").alias("sha"))
    full = cut(nodes.join(facts, "node"))

    n = full.count()
    bound = max(hot_children, n // HOT_PARENTS)
    hot = full.filter(F.col("n_children") > bound).select(F.col("node").alias("parent"), F.col("conv_id").alias("_hot"))
    named = join_small(full, hot, "parent", "left", min(n, HOT_PARENTS))
    rest = named.filter("_hot is null and parent is not null").drop("_hot").join(
        full.filter(F.col("n_children").between(1, bound)).select(F.col("node").alias("parent"), F.col("conv_id").alias("_hot")), "parent")
    named = named.filter("_hot is not null or parent is null").unionByName(rest)
    return named.select("conv_id", "depth", F.col("_hot").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                        "saved_tokens", F.coalesce("sha", F.lit(EMPTY_SHA)).alias("ends_sha256"))


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The trie of (conv_id, turn, role, text) rows."""
    known = cut(identify(turns))
    return trie(known, known.select("conv_id").distinct())


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = cut(identify(read(spark, sf_dir, "conversations")))
    members = known.select("conv_id").distinct()
    return trie(rebuild(known, members), members)


# Group by whole prefixes; the CRC32 of the decimal id is folded bit by bit.
SQL = """
WITH RECURSIVE t AS (
  SELECT conv_id, coalesce(text, '') AS body, strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS said,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT DISTINCT conv_id, conv_id - ((conv_id % 5) + 5) % 5 AS base FROM t),
crc AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR) AS s, 0 AS i, CAST(4294967295 AS BIGINT) AS v FROM c
  UNION ALL
  SELECT conv_id, s, i + 1, xor(y >> 1, (y & 1) * 3988292384)
  FROM (SELECT conv_id, s, i, CASE WHEN i % 8 = 0 THEN xor(v, CAST(ascii(substr(s, i // 8 + 1, 1)) AS BIGINT)) ELSE v END AS y
        FROM crc WHERE i < 8 * length(s))),
h AS (SELECT conv_id, xor(v, 4294967295) % 9 AS h FROM crc WHERE i = 8 * length(s)),
rebuilt AS (
  SELECT c.conv_id, t.pos, t.said, t.body FROM c JOIN h USING (conv_id) JOIN t ON t.conv_id = c.base AND t.pos <= h.h
  UNION ALL SELECT t.conv_id, t.pos, t.said, t.body FROM t JOIN h USING (conv_id) WHERE t.pos > h.h),
seqs AS (
  SELECT c.conv_id, coalesce(list(sha256(said) ORDER BY pos) FILTER (pos IS NOT NULL), []) AS ids,
         coalesce(list(strlen(body) ORDER BY pos) FILTER (pos IS NOT NULL), []) AS sizes
  FROM c LEFT JOIN rebuilt USING (conv_id) GROUP BY c.conv_id),
pre AS (
  SELECT conv_id, d AS depth, sha256(array_to_string(ids[1:d], ',')) AS node, len(ids) = d AS ends,
         CASE WHEN d > 0 THEN sha256(array_to_string(ids[1:d - 1], ',')) END AS parent,
         CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS size
  FROM (SELECT *, unnest(range(0, len(ids) + 1)) AS d FROM seqs)),
nodes AS (
  SELECT node, min(conv_id) AS conv_id, any_value(depth) AS depth, any_value(parent) AS parent, count(*) AS n_convs,
         any_value(size) AS size, sha256(coalesce(string_agg(CASE WHEN ends THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM pre GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
above AS (SELECT DISTINCT a.node AS top, b.node FROM pre a JOIN pre b ON a.conv_id = b.conv_id AND a.depth <= b.depth),
sums AS (
  SELECT top AS node, sum((n_convs - 1) * size) AS saved_tokens, count(*) FILTER (kids.node IS NULL) AS n_leaves
  FROM above JOIN nodes USING (node) LEFT JOIN kids USING (node) GROUP BY top)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums USING (node) LEFT JOIN kids USING (node) LEFT JOIN nodes p ON p.node = n.parent
"""
