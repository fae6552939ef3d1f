"""Byte-level BPE encoding and decoding with Spark higher-order functions.

A sequence of token ids is kept as a string with one character per id (code
point = id; id 0 stands as the first free id until the end, for ``translate``
and ``replace`` treat U+0000 apart).  Merging a pair everywhere is then
``replace(tokens, left || right, merged)``, which goes from left to right
without overlap, and a word is encoded by folding such merges, lowest rank
first, over its bytes.  A vocabulary of n ids makes n - 256 ranked pairs: the
one split of each token that lower ranks leave.  Merging all places of the
lowest pair at once equals merging the leftmost one, because every token of the
vocabulary encodes to itself (checked when the ranks are read).

The rank map is a literal: an array of short strings of a few pairs each, indexed by
a hash, so that a lookup does not scan it.  Literals are bound once, at the top of an
expression: each expression around a literal prints all of it when a plan is printed.  Distinct words are counted over all documents; the
``CACHED`` most frequent ones of at most ``CACHED_CHARS`` characters are folded
once and become a second literal map, of bounded size.  Every other word is
folded where it stands, so the result does not depend on these two numbers.

Tables (``encode_rows``) fold no text twice in a block of documents: texts are cut
where a word surely ends (``unit_starts``), the distinct units of a block are encoded by
the same folds, and their ids are put together and decoded as Arrow columns.  Units that
stand often in the whole table, ``KNOWN`` at most, are folded once for all blocks and broadcast.

Decoding looks up the bytes of each id and concatenates them.

Defined cases: null text is empty and has no tokens; very long words are folded
by as many passes as they have distinct merges; repeated rows give equal rows;
an empty table gives no rows; columns beside ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, let, parts, read, strings, unit_starts

RANKS = "byte_bpe_50k.tiktoken"
CACHED = 1 << 17
CACHED_CHARS = 48
PLAN_CHARS = 1 << 16
KNOWN = 1 << 20  # units that all tasks know, about 35 bytes each
BLOCK_BYTES = 8 << 20  # of texts that are cut together
JOINED = 256  # documents of a block that are put together at once
MANY = 1 << 16  # occurrences of a unit; more count as equally many
START, END = "\ue000", "\ue001"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def pair_of(token: bytes, ranks: dict[bytes, int]) -> tuple[int, int]:
    """The two ids that merge into ``token`` last, using lower ranks only."""
    parts, limit = [token[i:i + 1] for i in range(len(token))], ranks[token]
    while len(parts) > 2:
        best = min((ranks.get(a + b, limit), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if best[0] >= limit:
            raise ValueError(f"token {limit} does not encode to itself")
        i = best[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return ranks[parts[0]], ranks[parts[1]]


def slot(key: Column, slots: int) -> Column:
    return F.hash(key).bitwiseAND(F.lit(slots - 1))


class LiteralMap:
    """A bounded number of (k, v) string rows as a literal array of short strings, indexed by a hash of the key.

    A slot is ``START k END v`` for each of its entries.  Neither keys nor values
    hold START or END; a START in a key that is looked up becomes END END, which no
    slot holds.
    """

    def __init__(self, entries: DataFrame, slots: int):
        table = [""] * slots
        for i, k, v in entries.select(slot(F.col("k"), slots), "k", "v").toLocalIterator():
            table[i] += START + k + END + v
        self.slots, self.table = slots, F.from_json(F.lit(json.dumps(table, ensure_ascii=False)), "array<string>")

    def get(self, table: Column, key: Column) -> Column:
        """The value of the key, or null; ``table`` is this map's, as the caller bound it."""
        want = F.concat(F.lit(START), F.replace(key, F.lit(START), F.lit(END + END)), F.lit(END))
        return let(F.get(table, slot(key, self.slots)), lambda held: let(
            F.instr(held, want), lambda at: F.when(at > 0, F.substring_index(
                F.substr(held, at + F.length(want)), START, 1))))

    def get_short(self, table: Column, key: Column, key_chars: int, value_chars: int) -> Column:
        """The same for keys and values of fixed lengths, the keys free of START."""
        return let(F.get(table, slot(key, self.slots)), lambda held: let(
            F.instr(held, F.concat(F.lit(START), key)), lambda at: F.when(
                at > 0, F.substr(held, at + (key_chars + 2), F.lit(value_chars)))))


def _cut(texts: pa.Array, by_units: bool) -> tuple[np.ndarray, pa.DictionaryArray]:
    """How many units each text has, and all units (whole texts, if the splitting pattern is another one)."""
    at, data = parts(texts.cast(pa.large_string()).fill_null(""))
    starts = unit_starts(data, at) if by_units else np.unique(at)
    return np.diff(np.searchsorted(starts, at)).astype("<i4"), strings(starts, data).dictionary_encode()


def _count_units(by_units: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = _cut(batch["text"], by_units)[1]
            names = units.dictionary.cast(pa.large_string()).cast(pa.string())
            counts = np.bincount(units.indices.to_numpy(), minlength=len(names)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([names, pa.array(counts)], names=["unit", "n"])
    return run


def _number_units(by_units: bool, known):
    """A row a block: ids, numbers of units, units as places among the known or (from -1 down) the new ones, new units."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            counts, units = _cut(batch["text"], by_units)
            place = pc.index_in(units.dictionary, value_set=known.value).fill_null(-1).to_numpy().astype("<i4")
            new = place < 0
            place[new] = -1 - np.arange(new.sum())
            fresh = units.dictionary.filter(pa.array(new)).cast(pa.large_string()).cast(pa.string())
            ids = batch["doc_id"]
            yield pa.RecordBatch.from_arrays([
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                pa.array([counts.tobytes()], pa.binary()), pa.array([place[units.indices.to_numpy()].tobytes()], pa.binary()),
                pa.ListArray.from_arrays(pa.array([0, len(fresh)], pa.int32()), fresh)], names=["doc_id", "counts", "places", "units"])
    return run


def _ids_of(tokens: pa.Array) -> pa.Array:
    """Ids as little-endian unsigned 32-bit integers from strings of one character an id."""
    at, data = parts(tokens.cast(pa.large_string()))
    lengths = pc.utf8_length(tokens).to_numpy(zero_copy_only=False).astype(np.int64)
    return strings(4 * np.concatenate(([0], np.cumsum(lengths))), data.tobytes().decode().encode("utf-32-le"))


def _join_units(known, pieces):
    """Ids and decoded bytes of each document of a block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                doc_id, fresh = (batch[c].slice(i, 1).flatten() for c in ("doc_id", "tokens"))
                all_units = pa.concat_arrays([known.value, _ids_of(fresh)])
                place = np.frombuffer(batch["places"][i].as_py(), dtype="<i4")
                place = np.where(place < 0, len(known.value) - 1 - place, place)
                first = np.concatenate(([0], np.cumsum(np.frombuffer(batch["counts"][i].as_py(), dtype="<i4"))))
                for begin in range(0, len(doc_id), JOINED):
                    at = first[begin:begin + JOINED + 1]
                    ends, ids = parts(all_units.take(pa.array(place[at[0]:at[-1]])))
                    ends = ends[at - at[0]]
                    spelt, text = parts(pieces.value.take(pa.array(ids.view("<u4"))))
                    yield pa.RecordBatch.from_arrays([
                        doc_id.slice(begin, JOINED), strings(ends, ids).cast(pa.binary()),
                        strings(spelt[ends // 4], text).cast(pa.binary())], names=["doc_id", "ids", "decoded"])
    return run


class BytePairs:
    """Encoder and decoder for one rank file."""

    def __init__(self, spark: SparkSession, path: str | None = None, pattern: str = public_tokenizers.PATTERN):
        ranks = load_ranks(path or public_tokenizers.path(RANKS))
        if sorted(ranks.values()) != list(range(len(ranks))) or len(ranks) >= 0xD800:
            raise ValueError("ranks must be 0 .. n-1, fewer than 55296")
        self.spark, self.pattern, self.by_units = spark, "(?U)" + pattern, pattern == public_tokenizers.PATTERN
        # Plans print their literals, and the driver keeps what plans print: keep that short.
        spark.conf.set("spark.sql.maxPlanStringLength", str(PLAN_CHARS))
        self.zero = chr(len(ranks))
        char = lambda i: chr(i) if i else self.zero
        self.bytes_from = "".join(map(chr, range(256)))
        self.bytes_to = "".join(char(ranks[bytes([b])]) for b in range(256))
        pairs = [("".join(map(char, pair_of(t, ranks))), r) for t, r in ranks.items() if len(t) > 1]
        # the value is the merged token and the pair again, so that the least value tells all of a merge
        self.merges = LiteralMap(spark.createDataFrame([(p, chr(r) + p) for p, r in pairs], "k string, v string"), 1 << 16)
        by_id = sorted(ranks, key=ranks.get)
        self.spelt = pa.array(by_id, pa.large_binary())
        self.pieces = F.from_json(F.lit(json.dumps([t.decode("latin-1") for t in by_id])), "array<string>")
        self.cache: LiteralMap | None = None

    def words(self, text: Column) -> Column:
        """The matches of the splitting pattern, in order."""
        return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(self.pattern), F.lit(0))

    def fold(self, word: Column) -> Column:
        """Token characters of one word, by ranked merges over its bytes."""
        return let(self.merges.table, lambda merges: self._fold(word, merges))

    def _fold(self, word: Column, merges: Column) -> Column:
        start = F.translate(F.decode(F.encode(word, "UTF-8"), "ISO-8859-1"), self.bytes_from, self.bytes_to)

        def step(state: Column, _) -> Column:
            def lowest(chars: Column) -> Column:  # ranks are code points, so the least string is the lowest rank
                return F.array_min(F.transform(F.slice(chars, 2, F.greatest(F.size(chars) - 1, F.lit(0))),
                                               lambda right, i: self.merges.get_short(merges, F.concat(F.get(chars, i), right), 2, 3)))
            return F.when(state["done"], state).otherwise(
                let(let(F.split(state["s"], ""), lowest), lambda best: F.struct(
                    F.when(best.isNull(), state["s"]).otherwise(
                        F.replace(state["s"], F.substring(best, 2, 2), F.substring(best, 1, 1))).alias("s"),
                    best.isNull().alias("done"))))

        rounds = F.when(F.octet_length(word) > 1, F.sequence(F.lit(2), F.octet_length(word))).otherwise(
            F.array().cast("array<int>"))
        return F.aggregate(rounds, F.struct(start.alias("s"), F.lit(False).alias("done")), step, lambda state: state["s"])

    def learn(self, docs: DataFrame, text: str = "text", cached: int = CACHED) -> "BytePairs":
        """Fold the most frequent distinct words of all documents once, for ``encode`` to look up."""
        counts = (docs.select(F.explode(self.words(F.col(text))).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
                  .filter((F.length("k") <= CACHED_CHARS) & ~F.col("k").rlike(f"[{START}{END}]")).orderBy(F.desc("n"), "k").limit(cached))
        # Cut, so that the plans of the count do not print the rank map again at each of their stages.
        self.cache = LiteralMap(cut(counts.select("k")).select("k", self.fold(F.col("k")).alias("v")), 1 << 17)
        return self

    def encode(self, text: Column) -> Column:
        """Token characters of a whole text; ``ids``, ``packed`` and ``decode`` read them."""
        def joined(one) -> Column:
            return F.replace(F.array_join(F.transform(self.words(text), one), ""), F.lit(self.zero), F.lit("\0"))

        def folded(merges: Column) -> Column:
            if self.cache is None:
                return joined(lambda w: self._fold(w, merges))
            return let(self.cache.table, lambda cache: joined(
                lambda w: F.coalesce(self.cache.get(cache, w), self._fold(w, merges))))
        return let(self.merges.table, folded)

    def _encode_each(self, units: Column) -> Column:
        """Token characters of each of an array of texts, every word folded."""
        return let(self.merges.table, lambda merges: F.transform(units, lambda u: F.replace(F.array_join(F.transform(
            self.words(u), lambda w: self._fold(w, merges)), ""), F.lit(self.zero), F.lit("\0"))))

    def _often(self, texts: DataFrame, most: int) -> pa.Table:
        """At most ``most`` units of least counts above some count, with their tokens."""
        counts = texts.mapInArrow(_count_units(self.by_units), "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))
        counts = cut(counts.filter((F.col("n") > 1) & (F.length("unit") <= CACHED_CHARS)))
        least, total = MANY + 1, 0
        for n, units in counts.groupBy(F.least("n", F.lit(MANY)).alias("n")).agg(F.count(F.lit(1)).alias("units")).orderBy(F.desc("n")).collect():
            total += units
            if total > most:
                break
            least = n
        often = counts.filter(F.col("n") >= least).select("unit")
        return often.select("unit", F.element_at(self._encode_each(F.array("unit")), 1).alias("tokens")).toArrow()

    def encode_rows(self, docs: DataFrame, known: int = KNOWN) -> DataFrame:
        """doc_id, ids (little-endian unsigned 32-bit integers) and the bytes decoded from them, of each (doc_id, text) row."""
        sc = self.spark.sparkContext
        self.spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BLOCK_BYTES))
        texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        often = self._often(texts.select("text"), known)
        units, tokens = (often[c].cast(pa.large_string()).combine_chunks() for c in ("unit", "tokens"))
        units = sc.broadcast(units.cast(pa.large_binary()))
        kind = docs.schema["doc_id"].dataType.simpleString()
        blocks = texts.mapInArrow(_number_units(self.by_units, units), f"doc_id array<{kind}>, counts binary, places binary, units array<string>")
        blocks = blocks.select("doc_id", "counts", "places", self._encode_each(F.col("units")).alias("tokens"))
        return blocks.mapInArrow(_join_units(sc.broadcast(_ids_of(tokens)), sc.broadcast(self.spelt)), f"doc_id {kind}, ids binary, decoded binary")

    @staticmethod
    def ids(tokens: Column) -> Column:
        return F.transform(F.filter(F.split(tokens, ""), lambda c: c != ""), lambda c: F.ascii(c))

    @staticmethod
    def _packed(chars: Column) -> Column:
        spread = F.concat(F.array_join(chars, "\0"), F.lit("\0"))
        return F.encode(F.when(F.get(chars, F.lit(0)) == "", F.lit("")).otherwise(spread), "UTF-16LE")

    @staticmethod
    def _decoded(chars: Column, pieces: Column) -> Column:
        found = F.transform(chars, lambda c: F.get(pieces, F.ascii(c)))
        return F.encode(F.when(F.get(chars, F.lit(0)) == "", F.lit("")).otherwise(F.array_join(found, "")), "ISO-8859-1")

    def packed(self, tokens: Column) -> Column:
        """The ids as little-endian unsigned 32-bit integers: UTF-16 units with a zero unit after each."""
        return let(F.split(tokens, ""), self._packed)

    def decode(self, tokens: Column) -> Column:
        """The bytes that the ids stand for."""
        return let(self.pieces, lambda pieces: let(F.split(tokens, ""), lambda chars: self._decoded(chars, pieces)))

    def digests(self, tokens: Column) -> Column:
        """SHA-256 of the packed ids and of the decoded bytes, from one splitting of the tokens."""
        return let(self.pieces, lambda pieces: let(F.split(tokens, ""), lambda chars: F.struct(
            F.sha2(self._packed(chars), 256).alias("ids_sha256"),
            F.sha2(self._decoded(chars, pieces), 256).alias("decoded_sha256"))))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(read(spark, sf_dir, "documents").select("doc_id", "text"))


def encode_documents(docs: DataFrame) -> DataFrame:
    return with_digests(BytePairs(docs.sparkSession).encode_rows(docs)).drop("ids")


def with_digests(rows: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids, and SHA-256 of the ids and of the decoded bytes."""
    return rows.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
