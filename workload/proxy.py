"""Macro-like inputs derived from the driver tables, as DataFrames and as SQL.

``orders`` rows play vintages of a monthly index (newest order of a month wins) and policy rates,
``lineitem`` rows exchange rates and energy prices, ``events`` rows raw bronze text and run logs.
Divisions by primes keep monthly means off the half-way points of rounding.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from macrotide.functions import clean
from macrotide.functions.calendar import month_spine
from macrotide.plans import features as feature_plan
from macrotide.plans import gold
from macrotide.plans.silver import silver_from_staging
from macrotide.session import cut_lineage
from macrotide.sources.bronze import stage
from workload.registry import cte

START, CUTOFF = date(1995, 1, 1), date(2001, 7, 15)
TRAIN_STOP = date(1999, 12, 1)


# Known schemas save the job that reads a footer to infer one.
SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf}/{name}.parquet")


def _iso(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def _pick(c: Column, *values: str) -> Column:
    """Value number ``c`` of a constant list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (c + 1).cast("int"))


# ---- bronze -------------------------------------------------------------------------------------

def bronze_index(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    return o.select(
        F.date_format(F.trunc("o_orderdate", "month"), "yyyy-MM-dd").alias("dt"),
        F.lit("eurostat_hicp").alias("dataset"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "CP00")
        .otherwise(F.concat(F.lit("CP0"), F.substring("o_orderpriority", 1, 1))).alias("series_id"),
        F.when(key % 89 == 0, "NA").when(status == "F", F.when(key % 2 == 0, "").otherwise("  "))
        .when(key % 83 == 0, F.concat(F.lit(" "), status, F.lit(" "))).otherwise(status).alias("geo"),
        F.when(key % 101 == 0, ".").otherwise(F.col("o_totalprice").cast("string")).alias("value"),
        F.lit("orders").alias("source"),
        _iso("o_orderdate").alias("ingest_ts"),
    )


cte("bronze_index", """
SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS dt, 'eurostat_hicp' AS dataset,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'CP00' ELSE 'CP0' || substr(o_orderpriority, 1, 1) END AS series_id,
  CASE WHEN o_orderkey % 89 = 0 THEN 'NA'
       WHEN o_orderstatus = 'F' THEN CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE '  ' END
       WHEN o_orderkey % 83 = 0 THEN ' ' || o_orderstatus || ' ' ELSE o_orderstatus END AS geo,
  CASE WHEN o_orderkey % 101 = 0 THEN '.' ELSE CAST(o_totalprice AS VARCHAR) END AS value,
  'orders' AS source, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S+00:00') AS ingest_ts
FROM orders""")


def bronze_events(spark: SparkSession, sf: str, *carried: str) -> DataFrame:
    e = table(spark, sf, "events")
    n, user = F.col("event_id"), F.col("user_id") % 10
    return e.select(
        F.date_format("ts", "yyyy-MM-dd").alias("dt"),
        _pick(n % 4, "energy_prices", "ecb_rates_eu", "ecb_fx_eu", "eurostat_hicp").alias("dataset"),
        F.col("event_type").alias("series_id"),
        F.when(user == 0, "").when(user == 1, " NA ").when(user == 2, "n/a").when(user == 3, "Null")
        .when(user == 4, " DE ").when(user == 6, "N/A")
        .when(user != 5, F.concat(F.lit("G"), user.cast("string"))).alias("geo"),
        F.when(n % 50 == 0, ".").when(n % 77 == 0, "").otherwise(F.col("value").cast("string")).alias("value"),
        F.lit("events").alias("source"),
        _iso("ts").alias("ingest_ts"),
        *carried,
    )


cte("bronze_events", """
SELECT strftime(ts, '%Y-%m-%d') AS dt,
  CASE event_id % 4 WHEN 0 THEN 'energy_prices' WHEN 1 THEN 'ecb_rates_eu' WHEN 2 THEN 'ecb_fx_eu'
       ELSE 'eurostat_hicp' END AS dataset,
  event_type AS series_id,
  CASE user_id % 10 WHEN 0 THEN '' WHEN 1 THEN ' NA ' WHEN 2 THEN 'n/a' WHEN 3 THEN 'Null' WHEN 4 THEN ' DE '
       WHEN 5 THEN NULL WHEN 6 THEN 'N/A' ELSE 'G' || (user_id % 10) END AS geo,
  CASE WHEN event_id % 50 = 0 THEN '.' WHEN event_id % 77 = 0 THEN '' ELSE CAST(value AS VARCHAR) END AS value,
  'events' AS source, strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS ingest_ts
FROM events""")

_STAGE = """
SELECT try_cast(dt AS DATE) AS dt, dataset, series_id, coalesce(nullif(trim(geo), ''), 'EA20') AS geo,
  try_cast(value AS DOUBLE) AS value, source, epoch_us(try_cast(ingest_ts AS TIMESTAMPTZ)) AS ingest_us
FROM {0}"""
_LWW = """
SELECT * FROM {0}
QUALIFY row_number() OVER (PARTITION BY dataset, dt, geo, series_id
  ORDER BY ingest_us DESC NULLS LAST, value DESC NULLS LAST, source DESC NULLS LAST) = 1"""
_SILVER = """
SELECT dt AS ts_date,
  CASE WHEN trim(geo) IN ('', 'NA', 'N/A', 'na', 'n/a', 'null', 'NULL') THEN NULL ELSE geo END AS geo, series_id,
  CASE dataset WHEN 'energy_prices' THEN 'energy_price' WHEN 'ecb_rates_eu' THEN 'policy_rate'
       WHEN 'ecb_fx_eu' THEN 'exchange_rate' WHEN 'eurostat_hicp' THEN 'price_index' END AS measure,
  value,
  CASE dataset WHEN 'energy_prices' THEN 'USD' WHEN 'ecb_rates_eu' THEN 'percent'
       WHEN 'eurostat_hicp' THEN 'Index (2015=100)' END AS unit,
  CASE WHEN dataset IN ('ecb_rates_eu', 'ecb_fx_eu') THEN 'D' ELSE 'M' END AS freq, source, ingest_us AS vintage_us
FROM {0}"""
for _name in ("index", "events"):
    cte(f"staged_{_name}", _STAGE.format(f"bronze_{_name}"), (f"bronze_{_name}",))
    cte(f"lww_{_name}", _LWW.format(f"staged_{_name}"), (f"staged_{_name}",))
    cte(f"silver_raw_{_name}", _SILVER.format(f"lww_{_name}"), (f"lww_{_name}",))


# ---- silver -------------------------------------------------------------------------------------

def silver_index(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly index through the whole bronze and silver path, rebased."""
    return silver_from_staging(stage(bronze_index(spark, sf))).withColumn("value", F.col("value") / 3001.0)


def silver_fx(spark: SparkSession, sf: str) -> DataFrame:
    quote = _pick(F.col("l_linenumber") % 4, "USD", "GBP", "JPY", "CNY")
    return table(spark, sf, "lineitem").select(
        F.to_date("l_shipdate").alias("ts_date"), _line_geo().alias("geo"),
        clean.fx_series_id(quote, F.lit("EUR")).alias("series_id"),
        (F.lit(1000.0) * (1 + F.col("l_tax")) / 1009.0).alias("value"))


def silver_rates(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.to_date("o_orderdate").alias("ts_date"),
        F.nullif("o_orderstatus", F.lit("F")).alias("geo"),
        _pick(F.col("o_orderkey") % 3, "MRR", "DFR", "MLF").alias("series_id"),
        (F.col("o_totalprice") / 100003.0).alias("value"))


def silver_energy(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.to_date("l_shipdate").alias("ts_date"), _line_geo().alias("geo"),
        _pick(F.col("l_linenumber") % 2, "POILBREUSDM", "PNGASEUUSDM").alias("series_id"),
        (F.col("l_extendedprice") / F.col("l_quantity") / 101.0).alias("value"))


def _line_geo() -> Column:
    return F.when(F.col("l_linestatus") == "F", "EA20").otherwise(F.col("l_linestatus"))


cte("silver_index", "SELECT * REPLACE (value / 3001.0::DOUBLE AS value) FROM silver_raw_index", ("silver_raw_index",))
cte("silver_fx", """
SELECT l_shipdate::DATE AS ts_date, CASE WHEN l_linestatus = 'F' THEN 'EA20' ELSE l_linestatus END AS geo,
  'EXR.D.' || CASE l_linenumber % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'GBP' WHEN 2 THEN 'JPY' ELSE 'CNY' END
    || '.EUR.SP00.A' AS series_id,
  1000.0::DOUBLE * (1 + l_tax) / 1009.0::DOUBLE AS value
FROM lineitem""")
cte("silver_rates", """
SELECT o_orderdate::DATE AS ts_date, nullif(o_orderstatus, 'F') AS geo,
  CASE o_orderkey % 3 WHEN 0 THEN 'MRR' WHEN 1 THEN 'DFR' ELSE 'MLF' END AS series_id,
  o_totalprice / 100003.0::DOUBLE AS value
FROM orders""")
cte("silver_energy", """
SELECT l_shipdate::DATE AS ts_date, CASE WHEN l_linestatus = 'F' THEN 'EA20' ELSE l_linestatus END AS geo,
  CASE l_linenumber % 2 WHEN 0 THEN 'POILBREUSDM' ELSE 'PNGASEUUSDM' END AS series_id,
  l_extendedprice / l_quantity / 101.0::DOUBLE AS value
FROM lineitem""")


# ---- gold ---------------------------------------------------------------------------------------

def spine(spark: SparkSession) -> DataFrame:
    return month_spine(spark, START, CUTOFF)


def index(spark: SparkSession, sf: str) -> DataFrame:
    return gold.fact_index(silver_index(spark, sf))


def headline(spark: SparkSession, sf: str) -> DataFrame:
    """Index facts of the headline series that have a geo and a value."""
    return headline_of(index(spark, sf))


def headline_of(facts: DataFrame) -> DataFrame:
    return facts.filter((F.col("series_id") == "CP00") & F.col("geo").isNotNull() & F.col("hicp_index").isNotNull())


def macro(spark: SparkSession, sf: str) -> DataFrame:
    return gold.fact_macro(spine(spark), silver_fx(spark, sf), silver_rates(spark, sf), silver_energy(spark, sf), CUTOFF)


def features(spark: SparkSession, sf: str) -> DataFrame:
    """Feature table over stored drivers: their size is known, so few are broadcast to the index facts."""
    return gold.fact_cpi_features(index(spark, sf), cut_lineage(macro(spark, sf), "macro"))


def nowcast_input(spark: SparkSession, sf: str) -> DataFrame:
    return gold.nowcast_input(features(spark, sf)).filter(F.col("geo").isNotNull())


def matrix(spark: SparkSession, sf: str) -> DataFrame:
    return feature_plan.training_matrix(nowcast_input(spark, sf), TRAIN_STOP)


def nowcasts(head: DataFrame) -> DataFrame:
    """Two appended versions of a prediction for each late month, the second one newer."""
    late = head.filter(F.col("month") >= F.lit(date(2000, 1, 1)))
    v = F.col("v")
    return late.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("v")).select(
        "month", "geo", F.concat(F.lit("v"), v.cast("string")).alias("model_version"),
        (F.col("hicp_index") * (0.97 + v / 100.0)).alias("y_nowcast"), F.col("hicp_index").alias("y_actual"),
        (F.col("hicp_index") - F.col("hicp_index") * (0.97 + v / 100.0)).alias("residual"),
        F.date_add("month", v).cast("timestamp").alias("created_at_utc"))


def stored_gold(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Headline facts as a written table, and the nowcasts made from it.

    Views read their inputs several times; over stored gold tables the vintages are read only once.
    """
    head = cut_lineage(headline(spark, sf), "headline")
    return head, nowcasts(head)


cte("spine", f"SELECT unnest(generate_series(DATE '{START}', DATE '{CUTOFF.replace(day=1)}', INTERVAL 1 MONTH))::DATE AS month")
cte("fact_index", """
SELECT date_trunc('month', ts_date)::DATE AS month, geo, series_id, value AS hicp_index FROM silver_index""",
    ("silver_index",))
cte("headline", """
SELECT * FROM fact_index WHERE series_id = 'CP00' AND geo IS NOT NULL AND hicp_index IS NOT NULL""", ("fact_index",))
cte("fx_monthly", f"""
SELECT date_trunc('month', ts_date)::DATE AS month, coalesce(geo, 'EA20') AS geo,
  avg(CASE WHEN series_id ILIKE '%USD%' THEN value END) AS fx_usd_eur_avg
FROM silver_fx WHERE date_trunc('month', ts_date)::DATE <= DATE '{CUTOFF.replace(day=1)}' GROUP BY 1, 2""", ("silver_fx",))
cte("rates_avg", f"""
SELECT date_trunc('month', ts_date)::DATE AS month, coalesce(geo, 'EA20') AS geo, avg(value) AS policy_rate_monthly_avg
FROM silver_rates WHERE date_trunc('month', ts_date)::DATE <= DATE '{CUTOFF.replace(day=1)}' GROUP BY 1, 2""", ("silver_rates",))
cte("rates_eom", """
SELECT date_trunc('month', ts_date)::DATE AS month, coalesce(geo, 'EA20') AS geo, value AS policy_rate_eom
FROM silver_rates
QUALIFY row_number() OVER (PARTITION BY coalesce(geo, 'EA20'), date_trunc('month', ts_date)
  ORDER BY ts_date DESC, series_id DESC, value DESC) = 1""", ("silver_rates",))
cte("energy_monthly", f"""
SELECT date_trunc('month', ts_date)::DATE AS month, coalesce(geo, 'EA20') AS geo,
  avg(CASE WHEN series_id = 'POILBREUSDM' THEN value END) AS brent_crude_usd,
  avg(CASE WHEN series_id = 'PNGASEUUSDM' THEN value END) AS nat_gas_eu_usd
FROM silver_energy WHERE ts_date <= DATE '{CUTOFF}' GROUP BY 1, 2""", ("silver_energy",))
cte("fact_macro", """
SELECT month, geo, fx_usd_eur_avg, policy_rate_monthly_avg, policy_rate_eom, brent_crude_usd, nat_gas_eu_usd
FROM (SELECT spine.month, coalesce(fx_monthly.geo, 'EA20') AS geo, fx_usd_eur_avg FROM spine LEFT JOIN fx_monthly USING (month))
LEFT JOIN rates_avg USING (month, geo) LEFT JOIN rates_eom USING (month, geo) LEFT JOIN energy_monthly USING (month, geo)""",
    ("spine", "fx_monthly", "rates_avg", "rates_eom", "energy_monthly"))
cte("lagged", """
SELECT *, lag(hicp_index, 1) OVER w AS lag_1m, lag(hicp_index, 3) OVER w AS lag_3m,
  lag(hicp_index, 6) OVER w AS lag_6m, lag(hicp_index, 12) OVER w AS lag_12m
FROM fact_index WINDOW w AS (PARTITION BY geo, series_id ORDER BY month)""", ("fact_index",))
cte("features", """
SELECT h.month, h.geo, h.series_id, h.hicp_index, m.fx_usd_eur_avg, m.policy_rate_monthly_avg, m.policy_rate_eom,
  m.brent_crude_usd, m.nat_gas_eu_usd, h.lag_1m, h.lag_3m, h.lag_6m, h.lag_12m,
  h.hicp_index / nullif(h.lag_1m, 0) - 1 AS hicp_mom, h.hicp_index / nullif(h.lag_12m, 0) - 1 AS hicp_yoy
FROM lagged h LEFT JOIN fact_macro m ON m.month = h.month AND m.geo = h.geo""", ("lagged", "fact_macro"))
cte("nowcast_input", """
SELECT month, geo, hicp_index AS target_hicp_index, lag_1m, lag_3m, lag_6m, lag_12m, hicp_mom, hicp_yoy,
  fx_usd_eur_avg, policy_rate_monthly_avg, policy_rate_eom,
  (brent_crude_usd + nat_gas_eu_usd) / 2.0::DOUBLE AS energy_price_usd
FROM features WHERE series_id = 'CP00' AND geo IS NOT NULL""", ("features",))
cte("nowcasts", """
SELECT month, geo, 'v' || v AS model_version, hicp_index * (0.97::DOUBLE + v / 100.0::DOUBLE) AS y_nowcast,
  hicp_index AS y_actual, hicp_index - hicp_index * (0.97::DOUBLE + v / 100.0::DOUBLE) AS residual,
  (month + v::INTEGER)::TIMESTAMP AS created_at_utc
FROM headline, (VALUES (1), (2)) AS t(v) WHERE month >= DATE '2000-01-01'""", ("headline",))
cte("latest_nowcasts", """
SELECT * FROM nowcasts
QUALIFY row_number() OVER (PARTITION BY month, geo ORDER BY created_at_utc DESC, y_nowcast DESC) = 1""", ("nowcasts",))
cte("macro_wide", """
WITH m AS (
  SELECT month AS ref_month, avg(fx_usd_eur_avg) AS fx_usd_eur_avg_m, avg(brent_crude_usd) AS brent_crude_m,
    avg(nat_gas_eu_usd) AS nat_gas_m, max(policy_rate_eom) AS policy_rate_eom_m
  FROM fact_macro GROUP BY 1)
SELECT ref_month, fx_usd_eur_avg_m, avg(fx_usd_eur_avg_m) OVER w3 AS fx_ma3, avg(fx_usd_eur_avg_m) OVER w12 AS fx_ma12,
  brent_crude_m, avg(brent_crude_m) OVER w3 AS brent_crude_ma3, avg(brent_crude_m) OVER w12 AS brent_crude_ma12,
  nat_gas_m, avg(nat_gas_m) OVER w3 AS nat_gas_ma3, avg(nat_gas_m) OVER w12 AS nat_gas_ma12, policy_rate_eom_m
FROM m WINDOW w3 AS (ORDER BY ref_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
  w12 AS (ORDER BY ref_month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)""", ("fact_macro",))
cte("combined", """
SELECT month, geo, hicp_index AS index_value, 'actual' AS source FROM headline
UNION ALL SELECT month, geo, y_nowcast, 'nowcast' FROM latest_nowcasts""", ("headline", "latest_nowcasts"))
cte("hicp_wide", """
SELECT c.month, c.geo, c.index_value, c.source, c.index_value / nullif(a.hicp_index, 0) - 1 AS hicp_yoy,
  avg(c.index_value) OVER (PARTITION BY c.geo, c.source ORDER BY c.month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS hicp_idx_ma3,
  avg(c.index_value) OVER (PARTITION BY c.geo, c.source ORDER BY c.month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS hicp_idx_ma12
FROM combined c LEFT JOIN headline a ON a.geo = c.geo AND a.month = (c.month - INTERVAL 12 MONTH)::DATE""", ("combined", "headline"))


# ---- many series --------------------------------------------------------------------------------

def panel(spark: SparkSession, sf: str) -> DataFrame:
    """One monthly series per customer, with gaps; the number of series grows with the data."""
    o = table(spark, sf, "orders")
    return o.groupBy(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("geo"),
        F.trunc("o_orderdate", "month").alias("month"),
    ).agg(F.avg(F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") / 3001.0)).alias("value"))


cte("panel", """
SELECT 'C' || o_custkey AS geo, date_trunc('month', o_orderdate)::DATE AS month,
  avg(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice / 3001.0::DOUBLE END) AS value
FROM orders GROUP BY 1, 2""")

_ROLL_COLUMNS = ("fx_usd_eur_avg", "policy_rate_monthly_avg", "policy_rate_eom")
ROLLING_SQL = ", ".join(
    f"avg({c}) OVER w{n} AS {c}_ma{n}, coalesce(stddev_samp({c}) OVER w{n}, 0.0) AS {c}_std{n}"
    for c in _ROLL_COLUMNS for n in (3, 6, 12))
ROLLING_WINDOWS = ", ".join(
    f"w{n} AS (PARTITION BY geo ORDER BY month ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)" for n in (3, 6, 12))
FEATURE_NAMES = [
    "lag_1m", "lag_3m", "lag_6m", "lag_12m", *_ROLL_COLUMNS, "month_of_year", "quarter",
    *[f"{c}_{s}{n}" for c in _ROLL_COLUMNS for n in (3, 6, 12) for s in ("ma", "std")]]
cte("featured", f"""
SELECT *, month(month) AS month_of_year, quarter(month) AS quarter, {ROLLING_SQL}
FROM nowcast_input WINDOW {ROLLING_WINDOWS}""", ("nowcast_input",))
cte("winsor_bounds", f"""
SELECT geo, max(CASE WHEN rk = floor(n * 0.05::DOUBLE) + 1 THEN hicp_mom END) AS lo,
  max(CASE WHEN rk = n - floor(n * 0.05::DOUBLE) THEN hicp_mom END) AS hi
FROM (SELECT geo, hicp_mom, row_number() OVER (PARTITION BY geo ORDER BY hicp_mom) AS rk,
        count(*) OVER (PARTITION BY geo) AS n
      FROM nowcast_input WHERE hicp_mom IS NOT NULL AND month <= DATE '{TRAIN_STOP}')
GROUP BY 1""", ("nowcast_input",))
cte("matrix", f"""
SELECT f.geo, f.month, {', '.join('f.' + c for c in FEATURE_NAMES)},
  CASE WHEN f.hicp_mom IS NOT NULL THEN least(greatest(f.hicp_mom, b.lo), b.hi) END AS hicp_mom, f.target_hicp_index
FROM featured f LEFT JOIN winsor_bounds b USING (geo)
WHERE f.hicp_mom IS NOT NULL AND f.target_hicp_index IS NOT NULL
  AND {' AND '.join('f.' + c + ' IS NOT NULL' for c in FEATURE_NAMES)}""", ("featured", "winsor_bounds"))
