"""Exact removal of repeated 400-byte strings by hash-compared suffix sorting.

A byte goes if a 400-byte string that covers it starts anywhere else too.

1. Anchors: each window of ``LENGTH`` bytes elects its 64-byte gram of least hash
   (the leftmost of equals), so equal windows elect the same gram at the same
   offset.  Neighbouring windows mostly elect the same one: about one anchor in
   170 bytes.  An anchor goes on with a hash of its context, the bytes of every
   window that can hold it.  Grams that stand once cannot be in a repeat.
2. Anchors of equal context, twice or more: the whole context is repeated.
3. Anchors of equal gram and different contexts: one of each distinct context is
   read.  The suffixes that start at the anchor, and those that run leftwards from
   it, are sorted by a mergesort whose comparison finds the common extension by
   binary search over prefix polynomial hashes; neighbours' common extensions are
   then verified byte by byte.  A window that starts ``o`` bytes before its anchor
   is repeated iff two contexts agree on ``o`` bytes to the left and on the rest
   to the right, that is, share both classes that these extensions cut.
4. A gram with over ``HOT`` distinct contexts is not gathered.  Its window offsets
   are cut into runs of ``RUN``; the bytes that all windows of a run share are hashed
   and counted with partial aggregates, which rules most runs out; those that they
   span, which settles whole runs; and the windows of the rest (the same answer).

Texts are matched by a 96-bit content key; a text that stands twice is repeated
as a whole.  Matches never cross documents; windows are judged on the input.

Defined cases: null text is empty; texts under 400 bytes keep everything; long
texts are read in pieces with margins; repeated rows are repeats of each other;
an empty table gives no rows; ids are only passed on.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _MULTIPLIER, PrefixHash, as_bytes, cut, mix, powers, read

LENGTH = 400
GRAM = 64
HOT = 8192
RUN = 16
PIECE = 1 << 19
BATCH = 4096
ARROW_BYTES = 4 << 20  # of rows that a task hands to Python at once; by rows alone, long texts would add up
KEY = ["t1", "t2"]


def content_key(text) -> list:
    t = F.coalesce(text, F.lit(""))
    return [F.xxhash64(t).alias("t1"), F.hash(F.lit(1), t).alias("t2")]


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values, from block prefixes and suffixes."""
    n = len(v)
    a = np.concatenate((v, np.full(-n % width, np.iinfo(v.dtype).max, dtype=v.dtype))).reshape(-1, width)
    ahead = np.minimum.accumulate(a, axis=1).ravel()
    back = np.minimum.accumulate(a[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions, gram hashes, context hashes) of the anchors of one text."""
    found = []
    width = length - gram + 1
    for begin in range(0, len(data) - length + 1, PIECE):
        shift = max(0, begin - length)
        piece = data[shift:begin + PIECE + 2 * length]
        sums = PrefixHash(piece)
        at = np.arange(len(piece) - gram + 1)
        h = mix(sums.of(at, at + gram))
        low = np.uint64((1 << 20) - 1)
        first, last = begin - shift, min(begin + PIECE, len(data) - length + 1) - shift  # window starts
        ranked = ((h & ~low) | at.astype(np.uint64))[first:last + width - 1]
        pos = (sliding_min(ranked, width) & low).astype(np.int64)
        pos = pos[np.concatenate(([True], pos[1:] != pos[:-1]))]
        start, end = np.maximum(pos - (length - gram), 0), np.minimum(pos + length, len(piece))
        context = mix(sums.of(start, end) + mix(((pos - start) * 4096 + (end - pos)).astype(np.uint64)))
        found.append((pos + shift, h[pos], context))
    if not found:
        return (np.zeros(0, np.int64),) + (np.zeros(0, np.uint64),) * 2
    return tuple(np.concatenate(x) for x in zip(*found))


def _find(length: int, gram: int):
    """Anchors of whole texts; ``place`` packs t2 (high half) and the position."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, size = [], 0
            for t1, t2, text in zip(batch["t1"], batch["t2"], batch["text"]):
                pos, key, context = anchors(np.frombuffer(as_bytes(text), dtype=np.uint8), length, gram)
                out.append((np.full(len(pos), t1, dtype=np.int64), (np.int64(t2) << 32) + pos, key.view(np.int64),
                            context.view(np.int64)))
                size += len(pos)
                if size > 100_000:
                    yield pd.DataFrame(dict(zip(("t1", "place", "gram", "context"), map(np.concatenate, zip(*out)))))
                    out, size = [], 0
            if size:
                yield pd.DataFrame(dict(zip(("t1", "place", "gram", "context"), map(np.concatenate, zip(*out)))))
    return run


def _contexts(length: int, gram: int):
    """The bytes to the right of each wanted anchor, itself included, and those to the left of it."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set = set()  # texts of this partition; copies need no second reading
        names = ["gram", "context", "crowded", "before", "after"]
        for batch in batches:
            rows = []
            for t1, t2, text, wanted in zip(batch["t1"], batch["t2"], batch["text"], batch["wanted"]):
                if (t1, t2) in seen:
                    continue
                seen.add((t1, t2))
                data = as_bytes(text)
                for w in wanted:
                    p = w["pos"]
                    rows.append((w["gram"], w["context"], w["crowded"], data[max(0, p - (length - gram)):p], data[p:p + length]))
                    if len(rows) >= BATCH:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
            if rows:
                yield pd.DataFrame(rows, columns=names)
    return run


class Suffixes:
    """Byte strings in groups, sorted within each group by hash-compared mergesort."""

    def __init__(self, strings: list[bytes], group: np.ndarray, longest: int):
        n = len(strings)
        self.strings, self.group = strings, group
        self.size = np.array([len(s) for s in strings], dtype=np.int64)
        self.bytes = np.zeros((n, longest + 1), dtype=np.uint8)
        for row, s in zip(self.bytes, strings):
            row[:len(s)] = np.frombuffer(s, dtype=np.uint8)
        self.prefix = np.zeros((n, longest + 1), dtype=np.uint64)
        sums = self.prefix[:, 1:]  # in place: the table is eight times the strings, and further copies of it would add up
        sums[:] = self.bytes[:, :-1]
        sums += np.uint64(1)
        sums *= powers(_MULTIPLIER, longest)
        for i in range(0, n, 256):
            np.cumsum(sums[i:i + 256], axis=1, out=sums[i:i + 256])

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Lengths of common extensions, by binary search over prefix hashes."""
        low, high = np.zeros(len(i), dtype=np.int64), np.minimum(self.size[i], self.size[j])
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = self.prefix[i, middle] == self.prefix[j, middle]
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def before(self, i: np.ndarray, j: np.ndarray, ties: bool) -> np.ndarray:
        """Whether suffix i sorts before j; equal ones do if ``ties``."""
        out = self.group[i] < self.group[j]
        k = np.flatnonzero(self.group[i] == self.group[j])
        if len(k):
            a, b = i[k], j[k]
            n = self.common(a, b)
            a_ends, b_ends = n == self.size[a], n == self.size[b]
            out[k] = np.where(a_ends | b_ends, np.where(a_ends & b_ends, ties, a_ends),
                              self.bytes[a, n] < self.bytes[b, n])
        return out

    def _places(self, order, item, run_start, run_end, ties):
        """How many suffixes of a sorted run come before each item (``ties``: or equal it)."""
        low, high = run_start.copy(), run_end.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low - run_start
            middle = (low[open_] + high[open_]) // 2
            if ties:
                less = ~self.before(item[open_], order[middle], False)
            else:
                less = self.before(order[middle], item[open_], False)
            low[open_] = np.where(less, middle + 1, low[open_])
            high[open_] = np.where(less, high[open_], middle)

    def sort(self) -> np.ndarray:
        """Stable bottom-up mergesort; all merges of a level go together."""
        n = len(self.strings)
        order = np.arange(n)
        place = np.arange(n)
        width = 1
        while width < n:
            start = place // (2 * width) * (2 * width)
            middle, end = np.minimum(start + width, n), np.minimum(start + 2 * width, n)
            left = place < middle
            rank = np.empty(n, dtype=np.int64)
            # runs that meet at a boundary between groups, or are in order already, stay as they are
            rank[left] = self._places(order, order[left], middle[left], end[left], False)
            rank[~left] = self._places(order, order[~left], start[~left], middle[~left], True)
            to = np.where(left, place + rank, place - (middle - start) + rank)
            new = np.empty(n, dtype=np.int64)
            new[to] = order
            order, width = new, width * 2
        return order

    def neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """(order, common extension with the one before, -1 at the start of a group), verified on the bytes."""
        order = self.sort()
        a, b = order[:-1], order[1:]
        n = np.where(self.group[a] == self.group[b], self.common(a, b), -1)
        for i, j, k in zip(a, b, n):
            if k > 0 and self.strings[i][:k] != self.strings[j][:k]:  # two strings with one hash: compare bytes
                order = np.array(sorted(range(len(self.strings)), key=lambda x: (self.group[x], self.strings[x])))
                a, b = order[:-1], order[1:]
                n = np.array([len(os.path.commonprefix([self.strings[x], self.strings[y]])) if self.group[x] == self.group[y]
                              else -1 for x, y in zip(a, b)], dtype=np.int64)
                break
        return order, np.concatenate(([-1], n))


def repeated_windows(group: np.ndarray, before: list[bytes], after: list[bytes], length: int, gram: int) -> np.ndarray:
    """[context, o]: whether the window that starts o bytes before the anchor stands in another context of the group."""
    n, width = len(group), length - gram + 1
    by_right, agree_right = Suffixes(after, group, length).neighbours()  # one table of prefix hashes at a time
    by_left, agree_left = Suffixes([s[::-1] for s in before], group, length - gram).neighbours()
    out = np.zeros((n, width), dtype=bool)
    here, there = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    for o in range(width):
        here[by_right] = np.cumsum(agree_right < length - o)
        there[by_left] = np.cumsum(agree_left < o)
        both = here * (n + 1) + there
        order = np.argsort(both, kind="stable")
        same = both[order][1:] == both[order][:-1]
        out[order[1:], o] |= same
        out[order[:-1], o] |= same
    return out


def _compare(length: int, gram: int):
    def spans(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates(["gram", "context"])
        group = np.unique(rows["gram"].to_numpy(), return_inverse=True)[1]
        flags = repeated_windows(group, list(rows["before"]), list(rows["after"]), length, gram)
        edge = np.diff(np.pad(flags, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, first = np.nonzero(edge == 1)
        last = np.nonzero(edge == -1)[1] - 1  # offsets first..last: bytes from -last up to length - first
        return pd.DataFrame({"gram": rows["gram"].to_numpy()[row], "context": rows["context"].to_numpy()[row],
                             "begin": (-last).astype(np.int32), "end": (length - first).astype(np.int32)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size >= BATCH:
                rows = pd.concat(held, ignore_index=True)
                grams = rows["gram"].to_numpy()
                whole = int(np.searchsorted(grams, grams[-1]))  # the last gram may go on in the next batch
                if whole:
                    yield from (spans(part) for part in _chunks(rows.iloc[:whole]))
                held, size = [rows.iloc[whole:]], len(rows) - whole
        if size:
            rows = pd.concat(held, ignore_index=True)
            yield from (spans(part) for part in _chunks(rows))
    return run


def _chunks(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Runs of whole grams, of about BATCH rows."""
    grams = rows["gram"].to_numpy()
    edges = np.concatenate(([0], np.flatnonzero(grams[1:] != grams[:-1]) + 1, [len(rows)]))
    at = 0
    while at < len(rows):
        k = np.searchsorted(edges, at + BATCH, side="right") - 1
        end = int(edges[k]) if edges[k] > at else int(edges[k + 1])
        yield rows.iloc[at:end]
        at = end


def _cores(length: int, gram: int):
    """Per run of ``RUN`` window offsets: the bytes that all its windows share, and those that they span."""
    first = np.arange(0, length - gram + 1, RUN)
    last = np.minimum(first + RUN - 1, length - gram)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for g, c, before, after in zip(batch["gram"], batch["context"], batch["before"], batch["after"]):
                at, end = len(before), len(before) + len(after)
                sums = PrefixHash(np.frombuffer(before + after, dtype=np.uint8))
                has = (first <= at) & (at + length - last <= end)
                lo, hi = first[has], last[has]
                whole = (hi <= at) & (at + length - lo <= end)
                span = sums.of(np.maximum(at - hi, 0), np.minimum(at + length - lo, end))
                out.append((np.full(len(lo), g), np.full(len(lo), c), lo.astype(np.int32),
                            mix(sums.of(at - lo, at + length - hi)).view(np.int64), mix(span).view(np.int64), whole))
            if out:
                yield pd.DataFrame(dict(zip(("gram", "context", "lo", "core", "span", "whole"), map(np.concatenate, zip(*out)))))
    return run


def _hash_windows(length: int, gram: int):
    """Hashes of the windows in the wanted runs of offsets."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for g, c, before, after, runs in zip(batch["gram"], batch["context"], batch["before"], batch["after"], batch["runs"]):
                at, end = len(before), len(before) + len(after)
                sums = PrefixHash(np.frombuffer(before + after, dtype=np.uint8))
                o = np.concatenate([np.arange(lo, min(lo + RUN, length - gram + 1)) for lo in runs])
                o = o[(o <= at) & (at + length - o <= end)]
                out.append((np.full(len(o), g), np.full(len(o), c), o.astype(np.int32),
                            mix(sums.of(at - o, at - o + length)).view(np.int64)))
            if out:
                yield pd.DataFrame(dict(zip(("gram", "context", "o", "window"), map(np.concatenate, zip(*out)))))
    return run


def _crowded_spans(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """Repeated windows of grams with very many contexts, from counts of hashes only."""
    width = length - gram + 1
    runs = cut(contexts.mapInPandas(_cores(length, gram), "gram long, context long, lo int, core long, span long, whole boolean"))

    def twice(df: DataFrame, *keys: str) -> DataFrame:  # cut, so that a join with it can be split
        return cut(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("context").alias("least")).filter("n > 1").drop("n"))
    cores = twice(runs, "gram", "lo", "core").drop("least")  # else no window of the run stands twice
    spans = twice(runs.filter("whole"), "gram", "lo", "span")  # all its windows do
    open_ = cut(runs.join(cores, ["gram", "lo", "core"]).join(spans, ["gram", "lo", "span"], "left").select(
        "gram", "context", "lo", (F.col("whole") & F.col("least").isNotNull()).alias("all"),
        F.col("least").eqNullSafe(F.col("context")).alias("stands_in")))
    last = F.least(F.col("lo") + (RUN - 1), F.lit(width - 1))
    resolved = open_.filter("all").select("gram", "context", (-last).alias("begin"), (length - F.col("lo")).alias("end"))
    # One context of each settled span shows its windows to those that are not settled.
    wanted = open_.filter("not all or stands_in").groupBy("gram", "context").agg(F.collect_list("lo").alias("runs"))
    windows = cut(contexts.join(wanted, ["gram", "context"]).mapInPandas(
        _hash_windows(length, gram), "gram long, context long, o int, window long"))
    single = windows.join(twice(windows, "gram", "o", "window").drop("least"), ["gram", "o", "window"]).select(
        "gram", "context", (-F.col("o")).alias("begin"), (length - F.col("o")).alias("end"))
    return resolved.unionByName(single)


def _remove(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, spans, copies in zip(batch["text"], batch["spans"], batch["copies"]):
                data = as_bytes(text)
                n = len(data)
                if copies > 1 and n >= length:
                    merged = [(0, n)]
                else:
                    merged = []
                    for b, e in sorted((max(0, s["begin"]), min(n, s["end"])) for s in (spans if spans is not None else ())):
                        if merged and b <= merged[-1][1]:
                            merged[-1] = merged[-1][0], max(e, merged[-1][1])
                        else:
                            merged.append((b, e))
                kept, at = hashlib.sha256(), 0
                for b, e in merged:
                    kept.update(data[at:b])
                    at = e
                kept.update(data[at:])
                out.append((n, sum(e - b for b, e in merged), len(merged), kept.hexdigest(),
                            [{"begin": b, "end": e} for b, e in merged]))
            frame = pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])
            yield pd.concat([batch[["doc_id"]].astype("Int64").reset_index(drop=True), frame], axis=1)
    return run


def _unpack(place: str) -> list:
    return [F.shiftright(place, 32).cast("int").alias("t2"), F.col(place).bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("pos")]


def _merge(spans):
    """Sorted spans with overlapping and touching ones joined."""
    def add(done, x):
        last = F.try_element_at(done, F.lit(-1))
        joined = F.struct(last["begin"].alias("begin"), F.greatest(last["end"], x["end"]).alias("end"))
        return F.when((F.size(done) > 0) & (x["begin"] <= last["end"]), F.concat(
            F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(F.concat(done, F.array(x)))
    return F.aggregate(spans, F.array().cast("array<struct<begin:int,end:int>>"), add)


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed byte spans."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *content_key(F.col("text")))
    anchored = source.select("text", *KEY).mapInPandas(_find(length, gram), "t1 long, place long, gram long, context long")
    # Eight bytes an anchor first: only grams that stand twice, copies of a text included, go on.
    often = anchored.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram")
    # Dealt anew by all columns, so that the join may be split where one gram is very common.
    found = anchored.join(cut(often).hint("shuffle_hash"), "gram", "left_semi").repartition("t1", "place", "gram", "context")
    found = cut(found.distinct())
    classes = cut(found.groupBy("gram", "context").agg(
        F.count(F.lit(1)).alias("n"), F.first("t1").alias("t1"), F.first("place").alias("place")))
    grams = cut(classes.groupBy("gram").agg(F.count(F.lit(1)).alias("contexts")).filter("contexts > 1"))
    mixed = cut(classes.join(grams, "gram").select(
        "gram", "context", "t1", *_unpack("place"), (F.col("contexts") > hot).alias("crowded")))

    wanted = mixed.groupBy(*KEY).agg(F.collect_list(F.struct("gram", "context", "pos", "crowded")).alias("wanted"))
    read_in = source.select("text", *KEY).join(wanted.hint("shuffle_hash"), KEY).mapInPandas(
        _contexts(length, gram), "gram long, context long, crowded boolean, before binary, after binary")
    crowds = not mixed.filter("crowded").isEmpty()
    if crowds:
        read_in = cut(read_in)  # two readers
    spans = read_in.filter("not crowded").repartition("gram").sortWithinPartitions("gram").mapInPandas(
        _compare(length, gram), "gram long, context long, begin int, end int")
    if crowds:
        spans = spans.unionByName(_crowded_spans(read_in.filter("crowded").dropDuplicates(["gram", "context"]), length, gram))
    equal = classes.filter("n > 1").select("gram", "context", F.lit(gram - length).alias("begin"), F.lit(length).alias("end"))
    spans = spans.unionByName(equal)

    # One row per context, its overlapping spans joined, before they meet the occurrences; cut, so that
    # the join with a context of very many occurrences may be split.
    merged = cut(spans.groupBy("gram", "context").agg(
        _merge(F.sort_array(F.collect_set(F.struct("begin", "end")))).alias("spans")))
    by_text = found.join(merged, ["gram", "context"]).select("t1", *_unpack("place"), "spans").select(*KEY, F.transform(
        "spans", lambda s: F.struct((F.col("pos") + s["begin"]).alias("begin"), (F.col("pos") + s["end"]).alias("end"))).alias("spans"))
    by_text = by_text.groupBy(*KEY).agg(F.flatten(F.collect_list("spans")).alias("spans"))
    copies = source.groupBy(*KEY).agg(F.count(F.lit(1)).alias("copies"))
    known = copies.join(by_text, KEY, "left").filter("copies > 1 or spans is not null").hint("shuffle_hash")
    return source.join(known, KEY, "left").select("doc_id", "text", "spans", F.coalesce("copies", F.lit(1)).alias("copies")).mapInPandas(
        _remove(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                         "removed array<struct<begin:long,end:long>>")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(read(spark, sf_dir, "documents")).drop("removed")
