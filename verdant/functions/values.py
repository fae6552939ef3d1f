"""Value functions: lenient casts, NaN handling, ISO text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
              "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def na_to_null(c: Column) -> Column:
    """Text missing-value tokens become NULL (exact field text, as a CSV reader matches them)."""
    return F.when(c.isin(_NA_TOKENS), F.lit(None)).otherwise(c)


def nan_to_null(c: Column) -> Column:
    return F.nanvl(c, F.lit(None).cast("double"))


def lenient_double(c: Column) -> Column:
    """Unparseable or NaN -> NULL (never raises under ANSI mode)."""
    return nan_to_null(c.try_cast("double"))


# Accepted date orders, tried from top to bottom after ISO text; each also with a time.
DATE_FORMATS = ["yyyy/M/d", "M/d/yyyy", "d/M/yyyy", "M-d-yyyy", "d-M-yyyy", "d.M.yyyy", "yyyyMMdd",
                "MMM d, yyyy", "MMMM d, yyyy", "d MMM yyyy", "d MMMM yyyy"]
TIME_FORMATS = ["", " H:mm", " H:mm:ss", " H:mm:ss.SSSSSS", " h:mm a", " h:mm:ss a"]


def lenient_timestamp(c: Column) -> Column:
    """ISO text with 'T' or space, else one of the fixed date orders with an optional time; bad -> NULL.

    Month-first is tried before day-first, so only days above 12 read as day-first.
    """
    s = F.regexp_replace(F.trim(c.cast("string")), r"\s+", " ")
    iso = F.when(s.rlike(r"^\d{8}( |$)"), F.lit(None).cast("timestamp_ntz")).otherwise(s.try_cast("timestamp_ntz"))
    tries = [F.try_to_timestamp(s, F.lit(d + t)).cast("timestamp_ntz") for d in DATE_FORMATS for t in TIME_FORMATS]
    return F.coalesce(iso, *tries)


def finite_or_zero(c: Column) -> Column:
    """NaN, NULL and +-inf -> 0.0."""
    d = c.cast("double")
    bad = d.isNull() | F.isnan(d) | (F.abs(d) == F.lit(float("inf")))
    return F.when(bad, F.lit(0.0)).otherwise(d)


def json_number(c: Column) -> Column:
    """Number safe for JSON output: NaN or unparseable -> NULL."""
    return lenient_double(c)


def iso_text(ts: Column) -> Column:
    """ISO-8601 text; fractional seconds only when present."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.when(F.unix_micros(ts.cast("timestamp")) % 1000000 == 0, whole).otherwise(frac)
