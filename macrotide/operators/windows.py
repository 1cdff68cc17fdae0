"""Lags, trailing statistics and fills along a series.

Input is at most one row per period and series (after last-write-wins or monthly aggregation), so a
window partition is bounded by the number of periods on the calendar, whatever the size of the data.
All windows of one call share a specification: one shuffle and one sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from macrotide.functions.numeric import ratio_change


def series_window(keys: list[str], time: str = "month"):
    return Window.partitionBy(*keys).orderBy(F.col(time).asc_nulls_last())


def add_lags(df: DataFrame, value: str, keys: list[str], lags: tuple[int, ...] = (1, 3, 6, 12),
             time: str = "month") -> DataFrame:
    """``lag_<n>m`` columns; they count rows (see :func:`add_calendar_lags` for months)."""
    w = series_window(keys, time)
    return df.select("*", *[F.lag(value, n).over(w).alias(f"lag_{n}m") for n in lags])


def earlier_value(df: DataFrame, keys: list[str], value: str, aliases: dict[str, int], time: str = "month",
                  where: Column | None = None) -> DataFrame:
    """Value the given number of calendar months earlier, as ``{alias: months}`` columns; NULL in a gap.

    A range frame of one month number replaces the self-join: one scan, one shuffle, one sort for all
    offsets. Keys and month should be unique among the rows ``where`` selects (else the highest counts).
    """
    number = F.year(time) * 12 + F.month(time)
    used = F.col(value) if where is None else F.when(where, F.col(value))
    w = Window.partitionBy(*keys).orderBy(number.asc_nulls_last())
    return df.select("*", *[F.max(used).over(w.rangeBetween(-n, -n)).alias(a) for a, n in aliases.items()])


def add_calendar_lags(df: DataFrame, value: str, keys: list[str], lags: tuple[int, ...] = (1, 3, 6, 12),
                      time: str = "month") -> DataFrame:
    """``lag_<n>m`` columns that count months on the calendar, whatever rows are missing."""
    return earlier_value(df, keys, value, {f"lag_{n}m": n for n in lags}, time)


def add_changes(df: DataFrame, value: str) -> DataFrame:
    """Month-on-month and year-on-year change from the lag columns."""
    return df.select(
        "*",
        ratio_change(value, "lag_1m").alias("hicp_mom"),
        ratio_change(value, "lag_12m").alias("hicp_yoy"),
    )


def densify(df: DataFrame, keys: list[str], time: str = "month") -> DataFrame:
    """Add the missing months between each series' first and last row, with NULL values.

    Each row expands to the months up to the next row of its series, so there is no grid to join; the
    shuffle also serves later windows over the same keys. Repeated or missing months stay as they are.
    """
    following = F.lead(time).over(series_window(keys, time))
    gap = F.sequence(F.col(time), F.add_months("_next", -1), F.expr("interval 1 month"))
    spread = df.withColumn("_next", following).withColumn(
        "_month", F.explode(F.when(F.col("_next") > F.col(time), gap).otherwise(F.array(time))))
    own = F.col("_month").eqNullSafe(F.col(time))
    return spread.select([
        F.col("_month").alias(c) if c == time else F.col(c) if c in keys else F.when(own, F.col(c)).alias(c)
        for c in df.columns])


def add_trailing_means(df: DataFrame, columns: dict[str, str], keys: list[str], time: str,
                       widths: tuple[int, ...] = (3, 12)) -> DataFrame:
    """Mean over the last n rows including the current one, as ``<label>_ma<n>``.

    ``columns`` maps a column to its label. Without keys all rows form one partition: only for input
    with one row per month.
    """
    w = series_window(keys, time)
    return df.select("*", *[
        F.avg(c).over(w.rowsBetween(1 - n, 0)).alias(f"{label}_ma{n}")
        for c, label in columns.items() for n in widths
    ])


def add_leak_free_rolling(df: DataFrame, columns: list[str], keys: list[str], time: str = "month",
                          widths: tuple[int, ...] = (3, 6, 12)) -> DataFrame:
    """Mean and sample deviation of the previous n rows, current row excluded.

    NULLs are skipped; a deviation of fewer than two values is 0.
    """
    w = series_window(keys, time)
    out: list[Column] = []
    for c in [c for c in columns if c in df.columns]:
        for n in widths:
            frame = w.rowsBetween(-n, -1)
            out.append(F.avg(c).over(frame).alias(f"{c}_ma{n}"))
            out.append(F.coalesce(F.stddev_samp(c).over(frame), F.lit(0.0)).alias(f"{c}_std{n}"))
    return df.select("*", *out)


def fill_forward_backward(df: DataFrame, columns: list[str], keys: list[str], time: str = "month") -> DataFrame:
    """Carry the last value forward; what is still missing at the start takes the first value there is.

    The back fill is a whole-partition first value: a frame that ends at the last row would be
    recomputed for every row.
    """
    w = series_window(keys, time)
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = {
        c: F.coalesce(F.last(c, ignorenulls=True).over(so_far), F.first(c, ignorenulls=True).over(whole))
        for c in columns
    }
    return df.select([filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])


def add_previous(df: DataFrame, value: str, keys: list[str], alias: str, time: str = "month") -> DataFrame:
    return df.select("*", F.lag(value, 1).over(series_window(keys, time)).alias(alias))


def add_expanding(df: DataFrame, keys: list[str], time: str, **aggregates: Column) -> DataFrame:
    """Aggregates over all earlier rows of the series (an expanding training window)."""
    frame = series_window(keys, time).rowsBetween(Window.unboundedPreceding, -1)
    return df.select("*", *[a.over(frame).alias(n) for n, a in aggregates.items()])


def winsorize(df: DataFrame, column: str, keys: list[str], lower: float = 0.05, upper: float = 0.05,
              fit_on: Column | None = None) -> DataFrame:
    """Replace the ``int(lower*n)`` lowest values of each group by the next one, likewise at the top.

    ``n`` counts present values among the rows ``fit_on`` selects (all rows by default); the bounds
    found there clip every row. For groups that are not bounded by a calendar use
    :func:`macrotide.operators.orderstats.winsorize_large`.
    """
    used = F.when(fit_on if fit_on is not None else F.lit(True), F.col(column))
    used = F.when(~F.isnan(used), used)
    group = Window.partitionBy(*keys)
    rank = F.row_number().over(group.orderBy(F.col("_used").asc_nulls_last()))
    n = F.count("_used").over(group)
    ranked = df.withColumn("_used", used).withColumn("_rank", rank).withColumn("_n", n)
    at = lambda position: F.max(F.when(F.col("_rank") == position, F.col("_used"))).over(group)
    low_rank = F.floor(F.col("_n") * lower) + 1
    high_rank = F.col("_n") - F.floor(F.col("_n") * upper)
    bounded = ranked.withColumn("_lo", at(low_rank)).withColumn("_hi", at(high_rank))
    return bounded.select([
        clip(F.col(c), F.col("_lo"), F.col("_hi")).alias(c) if c == column else F.col(c) for c in df.columns
    ])


def clip(value: Column, low: Column, high: Column) -> Column:
    """Value limited to the bounds; NULL stays NULL, NaN stays NaN, a NULL bound does not limit."""
    return F.when(F.isnan(value), value).when(value.isNotNull(), F.least(F.greatest(value, low), high))


def last_known(df: DataFrame, value: str, keys: list[str], target_month, time: str = "month") -> DataFrame:
    """Newest present value before the target month and its month, one row per key."""
    past = df.filter((F.col(time) < F.lit(target_month)) & F.col(value).isNotNull())
    return past.groupBy(*keys).agg(
        F.max(time).alias("last_known_month"), F.max_by(value, time).alias("last_known_level"))


def latest_and_trend(df: DataFrame, keys: list[str], columns: list[str], trend: str,
                     time: str = "month", n: int = 3) -> DataFrame:
    """Newest row per key, and the mean of ``trend`` over the newest n rows where there are n."""
    w = Window.partitionBy(*keys).orderBy(F.col(time).desc_nulls_last())
    top = df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n)
    newest = [F.max(F.when(F.col("_rank") == 1, F.col(c))).alias(c) for c in [time, *columns]]
    return top.groupBy(*keys).agg(
        *newest, F.when(F.count(F.lit(1)) >= n, F.avg(trend)).alias(f"{trend}_trend"))
