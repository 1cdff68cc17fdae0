"""Wide reporting views and the dashboard's key figures."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from macrotide.functions.calendar import between_days, first_of_month, shift_months
from macrotide.functions.numeric import ratio_change
from macrotide.operators.keyed import last_write_wins
from macrotide.operators.windows import add_trailing_means, earlier_value
from macrotide.schemas import DEFAULT_GEO, HEADLINE_SERIES

COMPARISON_MONTHS = {"1year": 12, "2years": 24, "5years": 60}


def year_ago(df: DataFrame, base: DataFrame, keys: list[str], value: str, alias: str,
             time: str = "month", months: int = 12) -> DataFrame:
    """Add the value another table has the given number of calendar months earlier (a plain equi-join).

    Within one table use :func:`macrotide.operators.windows.earlier_value`, which needs no join.
    """
    earlier = base.select(*keys, shift_months(time, months).alias(time), F.col(value).alias(alias))
    return df.join(earlier, [*keys, time], "left")


def actuals_and_nowcasts(index: DataFrame, nowcasts: DataFrame, all_versions: bool = False) -> DataFrame:
    """Actual and predicted levels in one long table with a ``source`` tag.

    The output table is appended to on each training run; by default only the newest prediction per
    month and geo counts, ``all_versions`` keeps every one.
    """
    if not all_versions:
        nowcasts = last_write_wins(nowcasts, ["month", "geo"], "created_at_utc", ("y_nowcast", "model_version"))
    actual = index.select("month", "geo", F.col("hicp_index").alias("index_value"), F.lit("actual").alias("source"))
    predicted = nowcasts.select("month", "geo", F.col("y_nowcast").alias("index_value"), F.lit("nowcast").alias("source"))
    return actual.unionByName(predicted)


def hicp_wide(index: DataFrame, nowcasts: DataFrame, geo: str | None = DEFAULT_GEO,
              all_versions: bool = False, series_id: str = HEADLINE_SERIES) -> DataFrame:
    """Actuals and nowcasts of the headline series with year-on-year change and trailing means.

    ``geo=None`` serves every geo at once; year-ago values and means are keyed by geo either way. One
    series per geo keeps a window to that geo's months.
    """
    index = index.filter(F.col("series_id") == series_id)
    if geo is not None:
        index, nowcasts = index.filter(F.col("geo") == geo), nowcasts.filter(F.col("geo") == geo)
    combined = actuals_and_nowcasts(index, nowcasts, all_versions)
    # Year-ago first: its geo partitioning also serves the (geo, source) windows.
    aged = earlier_value(combined, ["geo"], "index_value", {"index_12m_ago": 12}, where=F.col("source") == "actual")
    rolled = add_trailing_means(aged, {"index_value": "hicp_idx"}, ["geo", "source"], "month")
    return rolled.select(
        "month", "geo", "index_value", "source",
        ratio_change("index_value", "index_12m_ago").alias("hicp_yoy"), "hicp_idx_ma3", "hicp_idx_ma12")


def macro_monthly(macro: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Drivers per month over all geos; the highest end-of-month rate stands for the month."""
    return macro.groupBy(*(keys or []), first_of_month("month").alias("ref_month")).agg(
        F.avg("fx_usd_eur_avg").alias("fx_usd_eur_avg_m"),
        F.avg("brent_crude_usd").alias("brent_crude_m"),
        F.avg("nat_gas_eu_usd").alias("nat_gas_m"),
        F.max("policy_rate_eom").alias("policy_rate_eom_m"))


def macro_wide(macro: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Monthly drivers with trailing means.

    Without keys the window has one partition; its input is one row per calendar month.
    """
    keys = keys or []
    rolled = add_trailing_means(macro_monthly(macro, keys), {
        "fx_usd_eur_avg_m": "fx", "brent_crude_m": "brent_crude", "nat_gas_m": "nat_gas"}, keys, "ref_month")
    return rolled.select(
        *keys, "ref_month", "fx_usd_eur_avg_m", "fx_ma3", "fx_ma12", "brent_crude_m", "brent_crude_ma3",
        "brent_crude_ma12", "nat_gas_m", "nat_gas_ma3", "nat_gas_ma12", "policy_rate_eom_m")


def in_range(view: DataFrame, start: date, end: date, time: str = "month") -> DataFrame:
    return view.filter(between_days(time, start, end))


def comparison_overlay(df: DataFrame, keys: list[str], value: str, period: str = "1year",
                       time: str = "month") -> DataFrame:
    """Current value beside the one a comparison period earlier; unknown periods mean one year."""
    months = COMPARISON_MONTHS.get(period, 12)
    return earlier_value(df.select(*keys, time, value), keys, value, {f"{value}_ago": months}, time)


def key_figures(hicp: DataFrame, macro: DataFrame) -> DataFrame:
    """One row per geo: latest actual, trend, latest nowcast and its change, latest drivers.

    One pass over the view (one shuffle by geo); the drivers are a scalar subquery.
    The nowcast is compared with the actual twelve months before it, or keeps the view's change where
    that actual is missing. Without driver rows the driver columns are NULL.
    """
    aged = earlier_value(hicp, ["geo"], "index_value", {"_base": 12}, where=F.col("source") == "actual")
    newest_first = Window.partitionBy("geo", "source").orderBy(
        F.col("month").desc_nulls_last(), F.col("index_value").desc_nulls_last())
    top = aged.withColumn("_rank", F.row_number().over(newest_first)).filter(F.col("_rank") <= 3)
    actual, nowcast = F.col("source") == "actual", F.col("source") == "nowcast"

    def newest(source: Column, value: Column) -> Column:
        return F.max(F.when(source & (F.col("_rank") == 1), value))

    base_date = F.when(F.col("_base").isNotNull(), shift_months("month", -12))
    yoy = F.coalesce(ratio_change("index_value", "_base"), F.col("hicp_yoy"))
    figures = top.groupBy("geo").agg(
        newest(actual, F.col("month")).alias("latest_actual_date"),
        newest(actual, F.col("index_value")).alias("current_hicp_index"),
        newest(actual, F.col("hicp_yoy")).alias("current_hicp_yoy"),
        F.when(F.count(F.when(actual, 1)) >= 3, F.avg(F.when(actual, F.col("hicp_yoy")))).alias("recent_trend_3m"),
        newest(nowcast, F.col("month")).alias("nowcast_date"),
        newest(nowcast, F.col("index_value")).alias("nowcast_hicp_index"),
        newest(nowcast, base_date).alias("nowcast_base_date"),
        newest(nowcast, F.col("_base")).alias("nowcast_base_index"),
        newest(nowcast, yoy).alias("nowcast_hicp_yoy"))
    drivers = macro.agg(F.struct(*[F.max_by(c, "ref_month").alias(alias) for c, alias in {
        "fx_usd_eur_avg_m": "current_fx", "brent_crude_m": "current_brent",
        "nat_gas_m": "current_nat_gas", "policy_rate_eom_m": "current_policy_rate"}.items()]).alias("_m"))
    return figures.withColumn("_m", drivers.scalar()).select("*", "_m.*").drop("_m")
