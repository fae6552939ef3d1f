"""Near copies: n-gram Jaccard join by MinHash banding.

1. Every whole text becomes its set of hashed five-word shingles; equal sets are
   one class (128-bit digest), counted with partial aggregates, so a text with
   any number of copies goes on as one row.
2. MinHash signatures are cut into bands; the number of rows a band is the largest
   whose bands reach the target recall at the threshold within ``MAX_HASHES``.
   A shuffle on band hashes links each class to the least class of its bucket (a
   star, not all pairs); connected components of the stars are candidate groups.
3. The shingle sets of a candidate group meet in blocks of about ``BLOCK``
   classes, one task per pair of blocks, so no task grows with a group.  There
   every pair is verified on the full sets; only link counts and a spanning
   forest leave the task.
4. Components of the forests are the classes of near copies.

Defined cases: null text is empty; a text without words has no shingles, links to
nothing and is a class of its own; a text of one to four words is one shingle;
repeated rows are copies; null ids count as documents but never name a class
unless all its ids are null; an empty table gives no rows; extra columns pass.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from .common import as_bytes, cut, mix, read, shingle_hashes, text_key
from .components import connected_components

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.9999
MAX_HASHES = 128
BLOCK = 256
DENSE = 1 << 22  # occurrences squared beyond which intersections are counted by matrix products


def bands_and_rows(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows) with the most rows a band, for the fewest chance candidates, that reach the recall."""
    found = None
    for rows in range(1, most + 1):
        bands = math.ceil(math.log1p(-recall) / math.log1p(-threshold ** rows))
        if bands * rows <= most:
            found = bands, rows
    if not found:
        raise ValueError("no banding reaches this recall with so few hashes")
    return found


def signature(shingles: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash per band."""
    rng = np.random.default_rng(7)
    a = rng.integers(0, 1 << 32, (bands * rows, 1), dtype=np.uint32) | np.uint32(1)
    b = rng.integers(0, 1 << 32, (bands * rows, 1), dtype=np.uint32)
    h = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(bands * rows, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(h), 4096):
        np.minimum(least, ((h[at:at + 4096] ^ b) * a).min(axis=1), out=least)
    out = np.arange(1, bands + 1, dtype=np.uint64)
    for column in least.reshape(bands, rows).T:
        out = mix(out + column.astype(np.uint64))
    return out.view(np.int64)


def _describe(size: int, bands: int, rows: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets, hashes = [], []
            for text in batch["text"]:
                s = shingle_hashes(as_bytes(text), size)
                sets.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                hashes.append(signature(s, bands, rows) if len(s) else None)
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "text_key": batch["text_key"],
                                "set_key": sets, "bands": hashes})
    return run


def _sets(size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set = set()  # of this partition; copies of a text need no second row
        for batch in batches:
            batch = batch[[k not in seen and not seen.add(k) for k in batch["set_key"]]]
            if len(batch):
                shingles = [shingle_hashes(as_bytes(t), size).tobytes() for t in batch["text"]]
                yield batch.drop(columns="text").assign(shingles=shingles)
    return run


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections within one pair of blocks."""
    n = len(sets)
    member = np.repeat(np.arange(n), [len(s) for s in sets])
    values, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[place] > 1
    member, place = member[shared], np.unique(place[shared], return_inverse=True)[1]
    out = np.zeros((n, n), dtype=np.int64)
    if not len(member):
        return out
    width = int(place.max()) + 1
    for at in range(0, width, 4096):
        here = (place >= at) & (place < at + 4096)
        x = np.zeros((n, min(4096, width - at)), dtype=np.float32)
        x[member[here], place[here] - at] = 1
        out += np.rint(x @ x.T).astype(np.int64)
    return out


def _verify(threshold: float):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates("set_key").sort_values("set_key").reset_index(drop=True)
        n = len(group)
        empty = pd.DataFrame({"a": [], "b": [], "links": []}).astype({"links": "int64"})
        if n < 2:
            return empty
        sets = [np.frombuffer(s, dtype=np.uint64) for s in group["shingles"]]
        size = np.array([len(s) for s in sets])
        inter = intersections(sets)
        linked = inter / (size[:, None] + size[None, :] - inter) >= threshold
        block = group["block"].to_numpy()
        # a pair of two blocks counts links across; the block with itself counts those inside
        linked &= (block[:, None] != block[None, :]) if group["i"][0] != group["j"][0] else ~np.eye(n, dtype=bool)
        links = linked @ group["copies"].to_numpy()
        least = np.where(linked, np.arange(n)[None, :], n).min(axis=1)
        root = np.minimum(least, np.arange(n))
        while True:  # least member of each component
            via = np.where(linked, root[None, :], n).min(axis=1)
            new = np.minimum(root, via)
            new = new[new]
            if (new == root).all():
                break
            root = new
        has = links > 0
        key = group["set_key"].to_numpy()
        return pd.DataFrame({"a": key[has], "b": key[root[has]], "links": links[has]})
    return run


def near_copies(docs: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE, recall: float = RECALL,
                block: int = BLOCK) -> DataFrame:
    """(doc_id, text_key, class_id, n_links): one row per document.

    ``class_id`` is the least doc_id of the group; ``n_links`` counts the other
    documents, copies included, at or above the threshold.
    """
    bands, rows = bands_and_rows(threshold, recall)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"), "text")
    described = cut(source.mapInPandas(_describe(shingle, bands, rows),
                                       "doc_id long, text_key string, set_key binary, bands array<long>"))
    classes = cut(described.filter("set_key is not null").groupBy("set_key").agg(
        F.min("text_key").alias("text_key"), F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("copies"),
        F.first("bands").alias("bands")))

    short = F.xxhash64("set_key").alias("node")
    buckets = classes.select(short, F.explode("bands").alias("bucket"))
    # cut, so that the join below reads two plain shuffles and a hot bucket can be split
    hubs = cut(buckets.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("top")).filter("hub <> top"))
    stars = buckets.join(hubs, "bucket").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    groups = cut(connected_components(stars))
    # cut, so that the join below reads plain shuffles and a hot group can be split
    sizes = cut(groups.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")))
    members = classes.select("set_key", "text_key", "copies", short).join(groups, "node").join(sizes, "root").select(
        "text_key", "set_key", "copies", F.col("root").alias("group"), "blocks",
        F.pmod(F.hash("set_key"), "blocks").alias("block"))

    texts = source.select("text_key", "text").join(members.hint("shuffle_hash"), "text_key").drop("text_key").mapInPandas(
        _sets(shingle), "set_key binary, copies long, group long, blocks int, block int, shingles binary")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = texts.withColumn("other", other).select(
        "group", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "set_key",
        "copies", "shingles")
    verified = cut(paired.groupBy("group", "i", "j").applyInPandas(_verify(threshold), "a binary, b binary, links long"))

    linked = verified.groupBy(F.col("a").alias("set_key")).agg(F.sum("links").alias("links"))
    roots = connected_components(verified.select("a", "b")).select(F.col("node").alias("set_key"), "root")
    known = classes.select("set_key", "least_id", "copies").join(roots, "set_key", "left").join(linked, "set_key", "left").select(
        "set_key", "least_id", F.coalesce("root", "set_key").alias("root"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    names = known.groupBy("root").agg(F.min("least_id").alias("class_id"))
    known = known.join(names, "root").select("set_key", "class_id", "n_links")
    return described.select("doc_id", "text_key", "set_key").join(known, "set_key", "left").select(
        "doc_id", "text_key", F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"))


def _unordered(kind: DataType) -> bool:
    """Maps and variants, which rows cannot be sorted by, anywhere in a type."""
    return any(name in kind.simpleString() for name in ("map<", "variant"))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without near copies: the document that names its class stays, once; texts without words all stay.

    Of rows with the same id and text the one with the least other columns stays, nulls first.
    """
    decided = near_copies(docs, **options)
    keep = decided.filter(F.col("doc_id").eqNullSafe(F.col("class_id"))).select(
        F.col("text_key").alias("_key"), F.col("doc_id").alias("_id")).distinct().hint("shuffle_hash")
    rows = docs.select(F.struct("*").alias("_row"), text_key(F.col("text")).alias("_text"))
    kept = rows.join(keep, (F.col("_text") == F.col("_key")) & F.col("_row.doc_id").eqNullSafe(F.col("_id")))
    others = [(F.col(f"_row.`{f.name}`"), f.dataType) for f in docs.schema.fields if f.name not in ("doc_id", "text")]
    order = [F.to_json(F.struct(c)) if _unordered(kind) else c for c, kind in others]
    first = Window.partitionBy("_text", "_row.doc_id").orderBy(*order or [F.lit(0)])
    wordless = ~F.coalesce(F.col("_row.text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    return kept.withColumn("_n", F.row_number().over(first)).filter((F.col("_n") == 1) | wordless).select("_row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(read(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")
