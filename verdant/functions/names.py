"""Name and key text functions.

Each comes in two forms: a Column expression for values inside a table and a
plain Python helper for schema-time work on ``df.columns``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DEFAULT_KEY, UNKNOWN_KEY_SLUG

_NON_ALNUM = "[^a-z0-9]+"


def normalize_name(name: str) -> str:
    """Python form of ``normalize_col`` for column names."""
    return re.sub(_NON_ALNUM, "_", str(name).strip().lower()).strip("_")


def slug(name: str, default: str = UNKNOWN_KEY_SLUG) -> str:
    return normalize_name(name) or default


def normalize_col(c: Column) -> Column:
    """trim, lower, runs of characters outside [a-z0-9] become '_', strip '_'."""
    return F.btrim(F.regexp_replace(F.lower(F.trim(c)), _NON_ALNUM, "_"), F.lit("_"))


def slug_col(c: Column, default: str = UNKNOWN_KEY_SLUG) -> Column:
    """``normalize_col`` with an empty result replaced by ``default``."""
    return F.coalesce(F.nullif(normalize_col(c), F.lit("")), F.lit(default))


def clean_key_col(c: Column, null_text: str | None = "nan") -> Column:
    """Key text cleaning: strip, lower, empty -> default key.

    A missing key becomes ``null_text`` (the text form of a missing value);
    pass ``None`` to map it to the default key instead.
    """
    text = F.lower(F.trim(c.cast("string")))
    missing = F.lit(null_text) if null_text is not None else F.lit(DEFAULT_KEY)
    return F.when(c.isNull(), missing).when(text == "", F.lit(DEFAULT_KEY)).otherwise(text)


def display_key(c: Column) -> Column:
    return F.upper(c)


def lookup_key(c: Column) -> Column:
    return F.lower(c)
