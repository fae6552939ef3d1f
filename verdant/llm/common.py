"""Helpers that several training-data operators share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# The white space that separates words, as a Java/Python class body.
SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"

_MULTIPLIER = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder."""
    if not ensure_checkpoint_dir(df.sparkSession):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return df.checkpoint(eager=True)


def words(text: Column) -> Column:
    """The words of a text, in order; null gives an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), "")


def text_key(text: Column) -> Column:
    """128-bit content key, so that rows are matched by what they say and not by an id that may repeat or be null."""
    return F.md5(F.coalesce(text, F.lit("")))


def in_fold(doc_id: Column, parts: int, remainder: int) -> Column:
    """crc32 of the id's decimal text, modulo ``parts``, equals ``remainder``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts == remainder


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it several times in ``body`` (no repeated evaluation)."""
    return F.element_at(F.transform(F.array(value), body), 1)


# ------------------------------------------------------------------ numpy parts

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept and grown by doubling."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        _powers[base] = have = np.multiply.accumulate(have)
    return have[:n]


class PrefixHash:
    """Polynomial hashes of all substrings of one byte string from one prefix pass."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.prefix = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_MULTIPLIER, n), out=self.prefix[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of data[start:end], the same wherever the content stands."""
        inverse = powers(_INVERSE, len(self.prefix))
        return (self.prefix[end] - self.prefix[start]) * inverse[start]


def mix(h: np.ndarray) -> np.ndarray:
    """Final avalanche of 64-bit hashes."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def as_bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def word_hashes(data: bytes) -> np.ndarray:
    """One 64-bit hash per word of a UTF-8 text."""
    b = np.frombuffer(data, dtype=np.uint8)
    if not len(b):
        return np.zeros(0, dtype=np.uint64)
    inside = ~((b == 32) | ((b >= 9) & (b <= 13)))
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    return mix(PrefixHash(b).of(edge[0::2], edge[1::2]))


def shingle_hashes(data: bytes, n: int) -> np.ndarray:
    """Sorted distinct hashes of all n-word shingles; a text of fewer words is one shingle, an empty one none."""
    w = word_hashes(data)
    if not len(w):
        return w
    n = min(n, len(w))
    h = np.full(len(w) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        h = h * np.uint64(_MULTIPLIER) + w[i:len(w) - n + 1 + i]
    return np.unique(mix(h))


# ------------------------------------------------------------------ Arrow parts

def _classes() -> np.ndarray:
    """1 letters, 2 digits, 4 other signs, 8 white space, 0 all else, by byte; characters over ASCII count as else."""
    of = np.zeros(256, dtype=np.uint8)
    for c in range(33, 127):
        of[c] = 1 if chr(c).isalpha() else 2 if chr(c).isdigit() else 4
    of[[9, 10, 11, 12, 13, 32]] = 8
    return of


CLASSES = _classes()


def ends_space(data: np.ndarray) -> np.ndarray:
    """Whether white space of any script ends at a byte of UTF-8 (of some other characters too, never less)."""
    out = CLASSES[data] == 8
    if len(data) > 1 and (data > 127).any():
        before, last = data[:-1], data[1:]
        out[1:] |= (((before == 0xC2) & ((last == 0x85) | (last == 0xA0))) | ((before == 0x9A) & (last == 0x80))
                    | ((before == 0x80) & (((last >= 0x80) & (last <= 0x8F)) | (last == 0xA8) | (last == 0xA9) | (last == 0xAF)))
                    | ((before == 0x81) & (last == 0x9F)) | ((before == 0xA0) & (last == 0x8E)))
    return out


def unit_starts(data: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where units of texts begin, and the end: places where a piece of byte-level splitting surely ends.

    These are the starts of texts (``texts``, with the end), white space after something else, and
    changes between ASCII letters, digits and signs, except after an apostrophe (``'s`` is one piece).
    """
    cut = np.ones(len(data) + 1, dtype=bool)
    kind = CLASSES[data]
    left = kind[:-1]
    cut[1:-1] = ((kind[1:] == 8) & ~ends_space(data)[:-1]) | (
        (left != kind[1:]) & (left != 0) & (left != 8) & (kind[1:] != 0) & (data[:-1] != 39))
    cut[texts] = True
    return np.flatnonzero(cut)


def strings(offsets: np.ndarray, data) -> pa.Array:
    """Byte strings that stand one after another in ``data``."""
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [
        None, pa.py_buffer(np.ascontiguousarray(offsets, dtype=np.int64)), pa.py_buffer(data)])


def parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a large binary or string array, from 0."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return at - at[0], np.frombuffer(data or b"", dtype=np.uint8)[at[0]:at[-1]]
