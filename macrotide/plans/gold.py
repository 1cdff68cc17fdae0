"""Gold star schema: index facts, monthly macro drivers and the feature table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macrotide.functions.calendar import first_of_month, up_to_day, up_to_month
from macrotide.functions.numeric import pair_mean
from macrotide.operators.keyed import latest_by
from macrotide.operators.stats import conditional_pivot
from macrotide.operators.windows import add_calendar_lags, add_changes, add_lags
from macrotide.schemas import BRENT_SERIES, DEFAULT_GEO, GAS_SERIES, HEADLINE_SERIES


def fact_index(silver_index: DataFrame) -> DataFrame:
    """``month, geo, series_id, hicp_index``; a missing geo stays missing here."""
    return silver_index.select(
        first_of_month("ts_date").alias("month"), "geo", "series_id", F.col("value").alias("hicp_index"))


def _monthly(silver: DataFrame) -> DataFrame:
    return silver.select(
        first_of_month("ts_date").alias("month"), F.coalesce("geo", F.lit(DEFAULT_GEO)).alias("geo"),
        "ts_date", "series_id", "value")


def fx_monthly(silver_fx: DataFrame, cutoff: date, pattern: str = "%USD%") -> DataFrame:
    """Monthly mean of the matching series per geo; a month without them is kept with NULL."""
    return _monthly(silver_fx.filter(up_to_month("ts_date", cutoff))).groupBy("month", "geo").agg(
        F.avg(F.when(F.col("series_id").ilike(pattern), F.col("value"))).alias("fx_usd_eur_avg"))


def rates_monthly(silver_rates: DataFrame, cutoff: date, series_id: str | None = None) -> DataFrame:
    """Monthly mean and end-of-month value per geo, over all rate series or one.

    Rows first collapse to one per day and series (hash aggregate, combined before the shuffle), so the
    data is read once and only days reach the end-of-month pick. Its order is total: newest day, then
    last series id (``MRR`` of the three), then highest value.
    """
    rows = _monthly(silver_rates.filter(up_to_month("ts_date", cutoff)))
    if series_id is not None:
        rows = rows.filter(F.col("series_id") == series_id)
    days = rows.groupBy("month", "geo", "ts_date", "series_id").agg(
        F.sum("value").alias("_sum"), F.count("value").alias("_n"), F.max("value").alias("_value"))
    return days.groupBy("month", "geo").agg(
        F.try_divide(F.sum("_sum"), F.sum("_n")).alias("policy_rate_monthly_avg"),
        F.max(F.struct("ts_date", "series_id", "_value")).alias("_last"),
    ).select("month", "geo", "policy_rate_monthly_avg", F.col("_last._value").alias("policy_rate_eom"))


def end_of_month(silver: DataFrame, alias: str, series_id: str | None = None) -> DataFrame:
    """Value of the newest day per month and geo; same order as in :func:`rates_monthly`."""
    rows = _monthly(silver)
    if series_id is not None:
        rows = rows.filter(F.col("series_id") == series_id)
    newest = latest_by(rows, ["month", "geo"], [F.col(c).desc_nulls_last() for c in ["ts_date", "series_id", "value"]])
    return newest.select("month", "geo", F.col("value").alias(alias))


def energy_monthly(silver_energy: DataFrame, cutoff: date) -> DataFrame:
    """Brent and gas monthly means per geo, month to date at the cutoff's day."""
    rows = _monthly(silver_energy.filter(up_to_day("ts_date", cutoff)))
    return conditional_pivot(rows, ["month", "geo"], "series_id", "value",
                             {BRENT_SERIES: "brent_crude_usd", GAS_SERIES: "nat_gas_eu_usd"})


def fact_macro(spine: DataFrame, silver_fx: DataFrame, silver_rates: DataFrame, silver_energy: DataFrame,
               cutoff: date) -> DataFrame:
    """Monthly drivers on the month spine.

    FX joins by month only and its geo (or the default area) is the key of the other two, so a geo
    without FX in a month has no row for it, and several FX geos give a month several rows. FX is never
    dealt by month, of which there are few: the spine, one row per calendar month, goes to every task, and the
    months without FX are added.
    """
    fx = fx_monthly(silver_fx, cutoff).withColumnRenamed("geo", "fx_geo")
    rates = rates_monthly(silver_rates, cutoff)
    energy = energy_monthly(silver_energy, cutoff)
    months = spine.filter(up_to_month("month", cutoff))
    covered = fx.join(F.broadcast(months), "month")
    lacking = months.join(fx.select("month").distinct(), "month", "left_anti")
    base = covered.unionByName(lacking, allowMissingColumns=True).withColumn("geo", F.coalesce("fx_geo", F.lit(DEFAULT_GEO)))
    return base.join(rates, ["month", "geo"], "left").join(energy, ["month", "geo"], "left").select(
        "month", "geo", "fx_usd_eur_avg", "policy_rate_monthly_avg", "policy_rate_eom",
        "brent_crude_usd", "nat_gas_eu_usd")


def fact_cpi_features(index: DataFrame, macro: DataFrame, calendar_lags: bool = False) -> DataFrame:
    """Index facts with lags, changes and the month's drivers.

    Lags come first: drivers are unique per month and geo, so joining them afterwards gives the same
    rows and keeps their columns out of the sort. Lags count rows of the series; with
    ``calendar_lags`` they count months.
    """
    lags = add_calendar_lags if calendar_lags else add_lags
    featured = add_changes(lags(index, "hicp_index", ["geo", "series_id"]), "hicp_index")
    return featured.join(macro, ["month", "geo"], "left").select(
        "month", "geo", "series_id", "hicp_index",
        "fx_usd_eur_avg", "policy_rate_monthly_avg", "policy_rate_eom", "brent_crude_usd", "nat_gas_eu_usd",
        "lag_1m", "lag_3m", "lag_6m", "lag_12m", "hicp_mom", "hicp_yoy")


def nowcast_input(features: DataFrame, series_id: str = HEADLINE_SERIES) -> DataFrame:
    """Design table of the headline series."""
    return features.filter(F.col("series_id") == series_id).select(
        "month", "geo", F.col("hicp_index").alias("target_hicp_index"),
        "lag_1m", "lag_3m", "lag_6m", "lag_12m", "hicp_mom", "hicp_yoy",
        "fx_usd_eur_avg", "policy_rate_monthly_avg", "policy_rate_eom",
        pair_mean("brent_crude_usd", "nat_gas_eu_usd").alias("energy_price_usd"))


def dashboard_view(features: DataFrame, series_id: str = HEADLINE_SERIES) -> DataFrame:
    """Per month and geo: headline index and the drivers."""
    return features.groupBy("month", "geo").agg(
        F.max(F.when(F.col("series_id") == series_id, F.col("hicp_index"))).alias("hicp_index"),
        *[F.max(c).alias(c) for c in ["fx_usd_eur_avg", "policy_rate_eom", "brent_crude_usd", "nat_gas_eu_usd"]])
