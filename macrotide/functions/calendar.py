"""Month arithmetic and date windows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from macrotide.functions.clean import _col

HISTORY_START = date(2000, 1, 1)


def first_of_month(c: Column | str) -> Column:
    return F.trunc(_col(c), "month")


def shift_months(c: Column | str, n: int) -> Column:
    return F.add_months(_col(c), n)


def month_of_year(c: Column | str) -> Column:
    return F.month(_col(c))


def quarter_of_year(c: Column | str) -> Column:
    return F.quarter(_col(c))


def month_spine(spark: SparkSession, start: date, cutoff: date) -> DataFrame:
    """One row per month start from ``start`` up to the cutoff's month (the time dimension)."""
    months = F.sequence(F.lit(start), F.trunc(F.lit(cutoff), "month"), F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(months).alias("month"))


def up_to_month(c: Column | str, cutoff: date) -> Column:
    """Dates whose month is not after the cutoff's month.

    Stated as a bound on the date itself (not on its month), so that it is pushed into the scan.
    """
    following = date(cutoff.year + cutoff.month // 12, cutoff.month % 12 + 1, 1)
    return _col(c) < F.lit(following)


def up_to_day(c: Column | str, cutoff: date) -> Column:
    return _col(c) <= F.lit(cutoff)


def between_days(c: Column | str, start: date, end: date) -> Column:
    """Closed date range."""
    return _col(c).between(F.lit(start), F.lit(end))


def relative_range(choice: str, as_of: date, custom: tuple[date | None, date | None] = (None, None)) -> tuple[date, date]:
    """Dashboard range choice to a closed date range; unknown or incomplete choices mean five years."""
    if choice == "custom" and custom[0] and custom[1]:
        return custom[0], custom[1]
    end = date(as_of.year, 12, 31)
    if choice == "since2000":
        return HISTORY_START, end
    years = 10 if choice == "10years" else 5
    return date(as_of.year - years, 1, 1), end


def trailing_days(c: Column | str, as_of: date, days: int = 7) -> Column:
    """Stamps from ``days`` before the reference date on; no upper bound."""
    return _col(c) >= F.date_sub(F.lit(as_of), days)


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Elapsed minutes rounded to one decimal; works for zoned and zone-less stamps."""
    return F.round(_micros(end, start) / F.lit(60_000_000.0), 1)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Difference of the two stamps' whole epoch seconds, as a shell clock would give it."""
    return _epoch_seconds(end) - _epoch_seconds(start)


def _epoch_seconds(c: Column | str) -> Column:
    return F.unix_seconds(_col(c).cast("timestamp"))


def _micros(end: Column | str, start: Column | str) -> Column:
    return F.unix_micros(_col(end).cast("timestamp")) - F.unix_micros(_col(start).cast("timestamp"))
