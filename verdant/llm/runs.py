"""Periodic runs of words by multi-scale minimizers.

A run is a stretch of consecutive words with smallest period ``q`` and at least
``max(24, 3 q)`` words that no neighbouring word extends.  All runs of a text are
found exactly:

* Periods up to ``SHORT`` by direct lag scans: where do words ``q`` apart differ?
* Longer periods scale by scale.  A scale covers the periods ``lo < q <= g`` with
  grams of ``g`` words (about sqrt(2) times ``lo``) and windows of
  ``2 (lo + 1) - g + 1`` grams.  A run of such a period holds a whole window and the
  one ``q`` words later; both elect the same least gram (leftmost of equals), so its
  position and the one ``q`` further are minimizers of equal hash.  A gram of ``g >= q``
  words cannot stand in between, or ``q`` would not be the smallest period, so
  neighbours in (hash, position) order give every seed.
* A seed is extended both ways by comparing words in growing steps, so that hashes
  only propose; stretches that two periods share keep the smaller one.

The words of many texts stand in one numpy array with a unique mark after each text,
so a scan serves a whole batch and nothing crosses texts.  No shuffle: a text is
handled where it is read; memory follows the batch, or one text if that is longer.

Defined cases: null and wordless texts have no words, no runs and an empty collapsed
text; repeated rows and ties are rows of their own; null ids stay null; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_bytes, let, mix, read, words

SHORT = 16
LEAST = 24
TIMES = 3
BATCH_BYTES = 4 << 20

FOUND = "n_words long, starts array<long>, lengths array<long>, periods array<long>, collapsed string"


def _lag_scan(w: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, lengths) of the stretches of period q that are long enough."""
    differ = np.concatenate(([-1], np.flatnonzero(w[:-q] != w[q:]), [len(w) - q]))
    same = np.diff(differ) - 1
    at = np.flatnonzero(same >= max(LEAST, TIMES * q) - q)
    return differ[at] + 1, same[at] + q


def _least(ranked: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of ``width`` values, by doubling."""
    out, have = ranked, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of two neighbouring (or overlapping) grams as one."""
    return mix(a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(29))))


def _seeds(w: np.ndarray, reach) -> Iterator[tuple[int, int]]:
    """(period, position) seeds of every scale; ``reach(n)`` is the end of the texts with ``n`` words or more."""
    h, span, lo = mix(w.astype(np.uint64) + np.uint64(1)), 1, SHORT
    while True:
        m = reach(TIMES * (lo + 1))
        if m == 0:
            return
        g = max(lo + 1, int((lo + 1) * 1.4142))
        width = 2 * (lo + 1) - g + 1
        h = h[:m]
        while 2 * span <= g:
            h, span = _join(h[:-span], h[span:]), 2 * span
        grams = h if span == g else _join(h[:m - g + 1], h[g - span:m - span + 1])
        low = np.uint64((1 << int(len(grams)).bit_length()) - 1)
        least = _least((grams & ~low) | np.arange(len(grams), dtype=np.uint64), width)
        pos = (least & low).astype(np.int64)
        pos = pos[np.concatenate(([True], pos[1:] != pos[:-1]))]
        pos = pos[np.argsort(grams[pos], kind="stable")]
        far = np.diff(pos)
        at = np.flatnonzero((grams[pos[1:]] == grams[pos[:-1]]) & (far > lo) & (far <= g))
        order = np.lexsort((pos[at], far[at]))
        yield from zip(far[at][order].tolist(), pos[at][order].tolist())
        lo = g


def _stretch(w: np.ndarray, p: int, q: int) -> tuple[int, int]:
    """First and last + 1 position k around p with w[k] == w[k + q]."""
    right, step = p, 64
    while True:
        a, b = w[right:right + step], w[right + q:right + q + step]
        differ = a[:len(b)] != b
        if differ.any():
            right += int(differ.argmax())
            break
        right += len(b)
        if len(b) < step:
            break
        step *= 2
    left, step = p, 64
    while left:
        step = min(step, left)
        differ = (w[left - step:left] != w[left - step + q:left + q])[::-1]
        if differ.any():
            left -= int(differ.argmax())
            break
        left -= step
        step *= 2
    return left, right


def all_runs(w: np.ndarray, reach) -> np.ndarray:
    """Rows (start, length, period) of all runs of an array of texts, by start and period."""
    found = []
    for q in range(1, SHORT + 1):
        m = reach(max(LEAST, TIMES * q))
        if m:
            start, length = _lag_scan(w[:m], q)
            found.append(np.column_stack((start, length, np.full(len(start), q))))
    late, last, end = [], 0, -1
    for q, p in _seeds(w, reach):
        if q == last and p < end:
            continue
        left, end = _stretch(w, p, q)
        last = q
        if end - left + q >= TIMES * q:
            late.append((left, end - left + q, q))
    found.append(np.array(late, dtype=np.int64).reshape(-1, 3))
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), dtype=bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[first]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def runs_of_texts(texts: list[bytes]) -> list[tuple]:
    """(n_words, starts, lengths, periods, collapsed text) of each text."""
    split = [t.split() for t in texts]  # bytes split at exactly \x20 and \x09-\x0D
    sizes = np.array([len(s) for s in split], dtype=np.int64)
    order = np.argsort(-sizes, kind="stable")  # longest first: a scale needs the first texts only
    number = defaultdict(count().__next__)
    ends = np.cumsum(sizes[order] + 1)
    w = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.int64)
    for place, (i, end) in enumerate(zip(order, ends)):
        w[end - 1 - sizes[i]:end - 1] = np.fromiter(map(number.__getitem__, split[i]), np.int64, sizes[i])
        w[end - 1] = -2 - place  # a mark that equals nothing else
    falling = -sizes[order]

    def reach(n):
        k = int(np.searchsorted(falling, -n, side="right"))
        return int(ends[k - 1]) if k else 0

    runs = all_runs(w, reach)
    later = np.zeros(len(w) + 1, dtype=np.int64)
    np.add.at(later, runs[:, 0] + runs[:, 2], 1)
    np.add.at(later, runs[:, 0] + runs[:, 1], -1)
    keep = np.cumsum(later[:-1]) == 0
    cut = np.searchsorted(runs[:, 0], np.concatenate(([0], ends)))
    out: list = [None] * len(texts)
    for place, i in enumerate(order):
        begin = int(ends[place] - 1 - sizes[i])
        mine = runs[cut[place]:cut[place + 1]]
        kept = split[i] if not len(mine) else [x for x, k in zip(split[i], keep[begin:begin + sizes[i]]) if k]
        out[i] = (int(sizes[i]), mine[:, 0] - begin, mine[:, 1], mine[:, 2], b" ".join(kept).decode("utf-8", "surrogatepass"))
    return out


def _find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [f.split()[0] for f in FOUND.split(", ")]
    for batch in batches:
        held, begin, size = [], 0, 0
        for i, text in enumerate(batch["text"]):
            held.append(as_bytes(text))
            size += len(held[-1])
            if size > BATCH_BYTES or i == len(batch) - 1:
                ids = batch["doc_id"].iloc[begin:i + 1].astype("Int64").reset_index(drop=True)
                yield pd.concat([ids, pd.DataFrame(runs_of_texts(held), columns=names)], axis=1)
                held, begin, size = [], i + 1, 0


def find_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of each document; runs (start, length, period) by start, then period.

    ``collapsed`` has the words that no run holds after its first period, joined by one space.
    """
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(_find, f"doc_id long, {FOUND}")
    runs = F.zip_with(F.arrays_zip(F.col("starts").alias("start"), F.col("lengths").alias("length")), "periods", lambda a, q: F.struct(
        a["start"].alias("start"), a["length"].alias("length"), q.alias("period")))
    return found.select("doc_id", "n_words", runs.alias("runs"), "collapsed")


def planted(doc_id: Column, text: Column) -> Column:
    """The contract's texts: one in ten becomes periodic from some word on (a null id: unchanged)."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def periodic(ws):
        n = F.size(ws).cast("long")
        return let(F.struct(F.pmod(g, n).alias("a"), n.alias("n")), lambda s: let(
            F.struct(s["a"].alias("a"), s["n"].alias("n"), (1 + F.floor((s["n"] - s["a"]) / (3 + F.pmod(g, F.lit(8))))).alias("p")),
            lambda v: F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), v["n"] - 1), lambda i: F.get(ws, F.when(
                i >= v["a"], v["a"] + F.pmod(i - v["a"], v["p"])).otherwise(i).cast("int"))), " ")))

    changed = let(words(text), lambda ws: F.when(F.size(ws) > 0, periodic(ws)).otherwise(F.lit("")))
    return F.when(h % 10 == 0, changed).otherwise(text)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    runs = F.col("runs")
    best = F.array_max(F.transform(runs, lambda r: F.struct(
        (r["length"] / r["period"]).alias("times"), (-r["start"]).alias("start"), (-r["period"]).alias("period"), r["length"].alias("length"))))
    listed = F.array_join(F.transform(runs, lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])), "")
    found = find_runs(docs.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text")))
    return found.select("*", best.alias("best"), listed.alias("listed")).select(
        "doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
