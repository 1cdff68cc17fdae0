"""Casts, defaults and null tokens (built-in expressions only, so they stay in codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from macrotide.schemas import DEFAULT_GEO

# Spellings of a missing geo, compared after trimming, case-sensitive.
NULL_TOKENS = ["", "NA", "N/A", "na", "n/a", "null", "NULL"]
# Spellings of a missing observation in landed pages.
VALUE_NULL_TOKENS = ["", ".", "NaN", "nan"]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


_DAY = r"^(\d{4})([-/])(\d{1,2})\2(\d{1,2})"
_TIME = r"[ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?( ?(Z|[+-]\d{2}(:?\d{2})?|[A-Za-z]+(/[A-Za-z_]+)*))?"


def _dashed(text: Column) -> Column:
    return F.regexp_replace(text, _DAY, "$1-$3-$4")


def _stamp(text: Column) -> Column:
    """A full day with or without a time of day; a part of a day, a bare year or a year-month is NULL."""
    return F.when(text.rlike(f"{_DAY}({_TIME})?$"), _dashed(text).try_cast("timestamp"))


def to_date_or_null(c: Column | str) -> Column:
    """Day to DATE, anything else to NULL: ``YYYY-MM-DD`` or ``YYYY/MM/DD``, with one-digit months and days, alone
    or as the day of a valid stamp (of which the written day counts, whatever its zone).

    Bare years, year-months and times of day, which a plain Spark cast would accept, are no dates.
    """
    text = F.trim(_col(c).cast("string"))
    # A day as ISO writes it needs no pattern: of ten such characters the plain cast takes nothing else.
    iso = (F.length(text) == 10) & (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-") & F.substring(text, 10, 1).between("0", "9")
    return F.when(iso, text.try_cast("date")).when(_stamp(text).isNotNull(), F.substring_index(F.substring_index(_dashed(text), " ", 1), "T", 1).try_cast("date"))


def to_double_or_null(c: Column | str) -> Column:
    """Number to DOUBLE or NULL; Java's type suffixes (``1.5f``, ``2d``) do not count as numbers, single
    underscores between digits (``1_000``) do."""
    text = _col(c).cast("string")
    plain = F.when(text.contains("_"), F.when(~text.rlike(r"(^|[^0-9])_|_($|[^0-9])"), F.regexp_replace(text, "_", ""))).otherwise(text)
    # A text that ends in a digit has no suffix, whatever the pattern would cost.
    return F.when(F.substring(text, -1, 1).between("0", "9") | ~text.rlike(r"[0-9.][dDfF]\s*$"), plain.try_cast("double"))


def to_timestamp_or_null(c: Column | str) -> Column:
    """ISO stamp to TIMESTAMP or NULL; a stamp without a zone is taken in the session zone (UTC).

    A stamp has a full day; times of day would otherwise become stamps of the day of the run.
    """
    return _stamp(F.trim(_col(c).cast("string")))


def default_geo(c: Column | str, default: str = DEFAULT_GEO) -> Column:
    """Trimmed geo; blank or missing becomes the default area."""
    return F.coalesce(F.nullif(F.trim(_col(c)), F.lit("")), F.lit(default))


def null_tokens(c: Column | str) -> Column:
    """NULL for the missing-value spellings, otherwise the value as it is (not trimmed)."""
    return F.when(~F.trim(_col(c)).isin(NULL_TOKENS), _col(c))


def value_or_null(c: Column | str) -> Column:
    """Observation text to DOUBLE with the page sources' null spellings."""
    text = F.trim(_col(c))
    return F.when(~text.isin(VALUE_NULL_TOKENS), to_double_or_null(text))


def period_to_iso(c: Column | str) -> Column:
    """Year or year-month to the ISO text of its first day; other lengths stay unchanged."""
    p = _col(c)
    return (
        F.when(F.length(p) == 4, F.concat(p, F.lit("-01-01")))
        .when(F.length(p) == 7, F.concat(p, F.lit("-01")))
        .otherwise(p)
    )


def fx_series_id(quote: Column | str, base: Column | str, freq: str = "D",
                 rate_type: str = "SP00", variation: str = "A") -> Column:
    """``EXR.D.<quote>.<base>.SP00.A``"""
    return F.concat_ws(".", F.lit("EXR"), F.lit(freq), _col(quote), _col(base),
                       F.lit(rate_type), F.lit(variation))
