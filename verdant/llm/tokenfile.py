"""Token ids as flat unsigned integer files with 64-bit document offsets, memory-mapped on reading.

A folder holds shards, each written by one task over a contiguous range of documents in
ascending id order:

* ``<shard>.ids``: the token ids, flat, unsigned 16-bit little-endian where every id of the
  vocabulary fits, else 32-bit; each document ends with ``end_id``.
* ``<shard>.off``: unsigned 64-bit offsets into the shard, one more than it has documents.
* ``<shard>.doc``: signed 64-bit document ids (documents without an id come first, as 0).

The table ``shards`` in the folder names the shards with their sizes and ``base``, the ids
before the shard: the prefix sum of the sizes of the shards before it.  Global offset =
base + shard offset, so that no shard is written twice.

Execution: documents are range-partitioned by id (ties by content, equal rows by a salt, so
that an id on a third of all rows is spread), sorted within tasks and streamed: a task holds
one encoding batch, never a shard.  Files are written under a name of the attempt and moved
into place, so a repeated task replaces its shard by the same bytes.  A worker encodes a distinct
unit (a word with the white space before it, or a run of signs) once as long as it remembers it (where the
vocabulary's splitting allows that; a bounded number).  New units go to the library joined to longer texts, and
the ids are told apart by the bytes that each token stands for; texts are cut, units looked up and
ids put together as Arrow columns.  Readers take blocks of documents and map the files (other file systems: ranged reads).

``docs`` should be a stored table: the salt follows the order of its rows, which a repeated
task must find again.

Defined cases: null text is empty (just ``end_id``); null ids come first; repeated ids and
rows keep a document each; other columns are ignored; an empty table gives no shards and no
rows; strings of special tokens in a text are ordinary text.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from ..sources.sinks import shared_path
from .common import ends_space, parts, read, strings, unit_starts

BATCH_CHARS = 1 << 23
BLOCK_DOCS = 1 << 13
SALTS = 1 << 10
KNOWN_UNITS = 1 << 21  # units that a worker remembers, about 25 bytes each
UNIT_CHARS = 48  # bytes; longer ones are not worth remembering
JOINED_BYTES = 1 << 18  # of new units that the library is given as one text
SHARDS = "shard int, n_docs long, n_nulls long, n_tokens long"


def file_system(folder: str):
    """(pyarrow file system, path) of a folder; local and shared mounts are memory-mapped."""
    from pyarrow import fs
    parts = urlparse(folder)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(use_mmap=True), unquote(parts.path)
    return fs.FileSystem.from_uri(folder)


def splits_at_spaces(tokenizer: str) -> bool:
    """Whether the ids of a text are those of its units, cut where ``unit_starts`` says.

    True of plain byte-level splitting without normalisation: no piece goes on from other
    characters into white space or from one class of characters into another (but after an
    apostrophe or a space), and nothing but white space looks at what follows it.
    """
    made = json.loads(tokenizer)
    pre = made.get("pre_tokenizer") or {}
    plain = made.get("normalizer") is None and all(t["special"] for t in made.get("added_tokens") or [])
    level = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
    return bool(plain and level and made["model"].get("type") == "BPE" and not made["model"].get("ignore_merges"))


class Encoder:
    """Texts to id bytes by the tokenizers library, each distinct unit encoded once as long as it is remembered."""

    def __init__(self, tokenizer: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
        from tokenizers import Tokenizer
        self.made = Tokenizer.from_str(tokenizer)
        self.made.no_truncation()
        self.made.no_padding()
        self.made.encode_special_tokens = True
        size = max(self.made.get_vocab_size(), end_id + 1)
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.end_id = end_id
        self.by_units = splits_at_spaces(tokenizer)
        self.known = self.ids = pa.array([], pa.large_binary())
        # A byte-level token has one character for each byte of text that it stands for.
        self.bytes_of = np.zeros(max(self.made.get_vocab().values(), default=0) + 1, dtype=np.int64)
        for token, i in self.made.get_vocab().items():
            self.bytes_of[i] = len(token)

    def _library(self, texts: list[str]) -> pa.Array:
        """The ids of each text as bytes."""
        ids = [np.array(e.ids, dtype=self.kind) for e in self.made.encode_batch_fast(texts, add_special_tokens=False)]
        ends = np.cumsum([0, *map(len, ids)]) * self.kind.itemsize
        return strings(ends, np.concatenate(ids) if ids else b"")

    def _joined(self, units: pa.Array) -> list[pa.Array]:
        """The same for units that may stand after one another in one text, told apart by the bytes of their tokens."""
        at, data = parts(units)
        out, begin = [], 0
        while begin < len(units):
            end = max(begin + 1, int(np.searchsorted(at, at[begin] + JOINED_BYTES)) - 1)
            text = data[at[begin]:at[end]].tobytes().decode()
            ids = np.array(self.made.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=self.kind)
            covered = np.cumsum(self.bytes_of[ids])
            ends = at[begin + 1:end + 1] - at[begin]
            last = np.searchsorted(covered, ends)
            if len(covered) and last[-1] == len(covered) - 1 and (covered[last] == ends).all():
                out.append(strings(np.concatenate(([0], last + 1)) * self.kind.itemsize, ids))
            else:  # the vocabulary drops or changes something: each unit for itself
                out.append(self._library(units.slice(begin, end - begin).cast(pa.large_string()).to_pylist()))
            begin = end
        return out

    def _new(self, units: pa.Array) -> pa.Array:
        """The ids of units that are not remembered."""
        at, data = parts(units)
        free = (data[at[:-1]] == 32) & ~ends_space(data)[at[1:] - 1]  # from a space to something else
        order = np.concatenate((np.flatnonzero(free), np.flatnonzero(~free)))
        made = self._joined(units.filter(pa.array(free)))
        made.append(self._library(units.filter(pa.array(~free)).cast(pa.large_string()).to_pylist()))
        back = np.empty(len(order), dtype=np.int64)
        back[order] = np.arange(len(order))
        return pa.concat_arrays(made).take(pa.array(back))

    def _units(self, units: pa.Array) -> pa.Array:
        """The ids of distinct units."""
        found = pc.index_in(units, value_set=self.known).fill_null(-1).to_numpy().astype(np.int64)
        new = found < 0
        if new.any():
            fresh = units.filter(pa.array(new))
            known, ids = pa.concat_arrays([self.known, fresh]), pa.concat_arrays([self.ids, self._new(fresh)])
            found[new] = len(self.known) + np.arange(len(fresh))
            made = ids.take(pa.array(found))
            if len(known) > KNOWN_UNITS:  # goes on with the units of this batch
                known, ids = units, made
            short = pc.less_equal(pc.binary_length(known), UNIT_CHARS)
            self.known, self.ids = known.filter(short), ids.filter(short)
            return made
        return self.ids.take(pa.array(found))

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, an end id after each, and how many each text has."""
        texts = texts.cast(pa.large_string())
        if self.by_units:
            at, data = parts(texts)
            starts = unit_starts(data, at)
            units = strings(starts, data).dictionary_encode()
            ends, ids = parts(self._units(units.dictionary).take(units.indices))
            ends = ends[np.searchsorted(starts, at)]
        else:
            ends, ids = parts(self._library(texts.to_pylist()))
        ends //= self.kind.itemsize
        return np.insert(ids.view(self.kind), ends[1:], self.end_id), np.diff(ends) + 1

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text and the end id."""
        ids, counts = self.flat(pa.array(texts, pa.large_string()))
        return [part.tobytes() for part in np.split(ids, np.cumsum(counts)[:-1])] if texts else []


_encoders: dict = {}  # a Python worker serves many tasks: its units serve them all


def encoder_of(tokenizer: str, end_id: int) -> Encoder:
    key = (hash(tokenizer), len(tokenizer), end_id)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(tokenizer, end_id)
    return _encoders[key]


def _writer(folder: str, tokenizer, end_id: int, batch_chars: int):
    """Encode and write the documents of one partition as one shard; yields its sizes."""
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, size = [], 0
        for batch in batches:
            ends = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False).astype(np.int64))
            begin = 0
            while begin < len(ends):
                done = int(ends[begin - 1]) if begin else 0
                end = min(len(ends), int(np.searchsorted(ends, done + batch_chars - size)) + 1)
                held.append(batch.slice(begin, end - begin))
                size += int(ends[end - 1]) - done
                begin = end
                if size >= batch_chars:
                    yield pa.Table.from_batches(held)
                    held, size = [], 0
        if held:
            yield pa.Table.from_batches(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        store, path = file_system(folder)
        task = TaskContext.get()
        shard, files, encoder = task.partitionId(), {}, None
        n_docs = n_nulls = n_tokens = 0
        for rows in chunks(batches):
            if not files:
                encoder = encoder_of(tokenizer.value, end_id)
                store.create_dir(path, recursive=True)
                files = {k: store.open_output_stream(f"{path}/{shard}.{task.taskAttemptId()}.{k}.part") for k in ("ids", "off", "doc")}
                files["off"].write(np.zeros(1, dtype="<u8").tobytes())
            ids, counts = encoder.flat(pa.concat_arrays([c.cast(pa.large_string()) for c in rows["text"].chunks]))
            files["ids"].write(ids.tobytes())
            ends = np.cumsum(counts) + n_tokens
            files["off"].write(ends.astype("<u8").tobytes())
            files["doc"].write(rows["doc_id"].fill_null(0).to_numpy().astype("<i8").tobytes())
            n_docs, n_nulls, n_tokens = n_docs + len(rows), n_nulls + rows["doc_id"].null_count, int(ends[-1])
        for name, f in files.items():
            f.close()
            store.move(f"{path}/{shard}.{task.taskAttemptId()}.{name}.part", f"{path}/{shard}.{name}")
        if files:
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), *(pa.array([n], pa.int64()) for n in (n_docs, n_nulls, n_tokens))],
                                             names=["shard", "n_docs", "n_nulls", "n_tokens"])
    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 0, batch_chars: int = BATCH_CHARS) -> DataFrame:
    """Write (doc_id, text) rows as shards under ``folder``; returns the table ``shards`` with bases, as stored.

    ``tokenizer_path`` is a file of the tokenizers library (a few MB), read by the driver and broadcast.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = spark.sparkContext.broadcast(f.read())
    text = F.coalesce("text", F.lit(""))
    salt = F.pmod(F.hash(F.monotonically_increasing_id()), F.lit(SALTS))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("h1"), F.hash("text").alias("h2"), salt.alias("salt"))
    order = ["doc_id", "h1", "h2", "salt"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    sizes = ranged.mapInArrow(_writer(folder, tokenizer, end_id, batch_chars), SHARDS)
    sizes.write.mode("overwrite").parquet(f"{folder}/sizes")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    based = spark.read.schema(SHARDS).parquet(f"{folder}/sizes").withColumn(
        "base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    based.write.mode("overwrite").parquet(f"{folder}/shards")
    return spark.read.schema(SHARDS + ", base long").parquet(f"{folder}/shards")


def _reader(folder: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = file_system(folder)

        def piece(name, kind, begin, n):
            width = np.dtype(kind).itemsize
            with store.open_input_file(f"{path}/{name}") as f:
                return np.frombuffer(f.read_at(n * width, begin * width), dtype=kind)  # a view of the mapped file

        for batch in batches:
            for b in batch.itertuples(index=False):
                n = b.last - b.first
                with store.open_input_file(f"{path}/{b.shard}.ids") as f:
                    kind = "<u2" if f.size() == 2 * b.n_tokens else "<u4"
                off = piece(f"{b.shard}.off", "<u8", b.first, n + 1).astype(np.int64)
                doc = pd.Series(piece(f"{b.shard}.doc", "<i8", b.first, n)).astype("Int64")
                doc[np.arange(b.first, b.last) < b.n_nulls] = pd.NA
                for i in range(0, n, 512):
                    j = min(n, i + 512)
                    ids = piece(f"{b.shard}.ids", kind, int(off[i]), int(off[j] - off[i]))
                    yield pd.DataFrame({
                        "doc_id": doc[i:j].reset_index(drop=True), "start": b.base + off[i:j],
                        "ids": [ids[x:y].astype("<u4").tobytes() for x, y in zip(off[i:j] - off[i], off[i + 1:j + 1] - off[i])]})
    return run


def read_tokens(spark: SparkSession, folder: str, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(doc_id, start, ids) of every document from the files; ids as little-endian unsigned 32-bit integers."""
    shards = spark.read.schema(SHARDS + ", base long").parquet(f"{folder}/shards")
    first = F.explode(F.expr(f"sequence(0L, n_docs - 1, {int(block_docs)}L)"))
    blocks = shards.select("shard", "base", "n_docs", "n_nulls", "n_tokens", first.alias("first"))
    blocks = blocks.select("shard", "base", "n_nulls", "n_tokens", "first", F.least(F.col("first") + block_docs, "n_docs").alias("last"))
    # a stated number: these rows are tiny, but what they stand for is not
    return blocks.repartition(shuffle_partitions(spark), "shard", "first").mapInPandas(_reader(folder), "doc_id long, start long, ids binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    folder = shared_path(spark, "tokens")
    write_tokens(read(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return read_tokens(spark, folder).select(
        "doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
