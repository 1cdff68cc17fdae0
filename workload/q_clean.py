"""Projections, casts, filters and scalar functions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from macrotide.functions import calendar as cal
from macrotide.functions import clean, ids, numeric
from macrotide.operators import quality
from macrotide.plans import features as feature_plan
from macrotide.plans import gold, views
from macrotide.plans.nowcast import MIN_TRAIN_ROWS
from macrotide.plans.silver import select_series, silver_from_staging
from macrotide.sources.bronze import coerce_bronze, stage
from workload import proxy
from workload.proxy import CUTOFF, TRAIN_STOP, table
from workload.registry import query, r, rounded


@query("p1_coerce_bronze", """
SELECT strftime(ts, '%Y-%m-%d') AS dt, NULL::VARCHAR AS dataset, event_type AS series_id,
  CASE user_id % 3 WHEN 0 THEN 'NA' WHEN 1 THEN 'NA' ELSE ' ' END AS geo, CAST(value AS VARCHAR) AS value,
  NULL::VARCHAR AS source,
  CASE WHEN event_id % 2 = 0 THEN '2024-02-01T00:00:00+00:00' ELSE strftime(ts, '%Y-%m-%d') END AS ingest_ts
FROM events""")
def p1_coerce_bronze(spark, sf):
    e = table(spark, sf, "events")
    rows = e.select(
        F.to_date("ts").alias("dt"), F.col("event_type").alias("series_id"), "value",
        F.when(F.col("user_id") % 3 == 0, "").when(F.col("user_id") % 3 == 2, " ").alias("geo"),
        F.when(F.col("event_id") % 4 == 0, "").when(F.col("event_id") % 2 == 1, F.date_format("ts", "yyyy-MM-dd")).alias("ingest_ts"))
    return coerce_bronze(rows, F.lit("2024-02-01T00:00:00+00:00"))


# Stamps in forms that one engine or the other might take for something else.
_ODD = ["2024", "2024-03", "12:30:00", "T10:00", "2024-01-05 10:00:00", "2024-01-05T00:00:00", "2024/01/05", "2024/1/5 10:00",
        "2024-01-05 junk", "2024-01-05 25:00:00", "2024-13-05", "2024-01/05", "2024-01-05T10:00:00.123456", "2024-01-05T", "1_000", "1__0"]
_ODD_SQL = "[" + ", ".join(f"'{x}'" for x in _ODD) + "]"


@query("p2_try_casts", f"""
WITH o AS (SELECT event_id, ts, value, {_ODD_SQL}[(event_id % {len(_ODD)} + 1)::INT] AS odd FROM events)
SELECT event_id, CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN ts::DATE WHEN 2 THEN try_cast(odd AS DATE) WHEN 3 THEN ts::DATE END AS d,
  CASE event_id % 4 WHEN 0 THEN value WHEN 1 THEN value WHEN 3 THEN CASE WHEN odd = '1_000' THEN 1000 WHEN odd = '2024' THEN 2024 END END AS v,
  CASE WHEN event_id % 3 <> 0 THEN epoch_us(ts::TIMESTAMP) ELSE epoch_us(try_cast(odd AS TIMESTAMP)) END AS ts_us
FROM o""")
def p2_try_casts(spark, sf):
    n = F.col("event_id")
    day = F.date_format("ts", "yyyy-MM-dd")
    text = F.col("value").cast("string")
    odd = F.element_at(F.array(*[F.lit(x) for x in _ODD]), (n % len(_ODD) + 1).cast("int"))
    raw = table(spark, sf, "events").select(
        "event_id",
        F.when(n % 5 == 0, F.date_format("ts", "yyyy")).when(n % 5 == 1, day).when(n % 5 == 2, odd)
        .when(n % 5 == 3, F.date_format("ts", "yyyy-M-d")).alias("d"),
        F.when(n % 4 == 0, text).when(n % 4 == 1, F.concat(F.lit(" "), text, F.lit(" ")))
        .when(n % 4 == 2, F.concat(text, F.lit("f"))).otherwise(odd).alias("v"),
        F.when(n % 3 == 0, odd).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")).alias("t"))
    return raw.select("event_id", clean.to_date_or_null("d").alias("d"), clean.to_double_or_null("v").alias("v"),
                      F.unix_micros(clean.to_timestamp_or_null("t")).alias("ts_us"))


@query("p3_default_geo", "SELECT dt, series_id, coalesce(nullif(trim(geo), ''), 'EA20') AS geo FROM bronze_events", ("bronze_events",))
def p3_default_geo(spark, sf):
    return proxy.bronze_events(spark, sf).select("dt", "series_id", clean.default_geo("geo").alias("geo"))


@query("p4_null_tokens", """
SELECT dt, series_id, CASE WHEN geo IS NULL OR trim(geo) IN ('', 'NA', 'N/A', 'na', 'n/a', 'null', 'NULL') THEN NULL ELSE geo END AS geo
FROM bronze_events""", ("bronze_events",))
def p4_null_tokens(spark, sf):
    return proxy.bronze_events(spark, sf).select("dt", "series_id", clean.null_tokens("geo").alias("geo"))


@query("p5_silver_projection", """
SELECT ts_date, geo, series_id, measure, value, unit, freq, source, vintage_us FROM silver_raw_events""", ("silver_raw_events",))
def p5_silver_projection(spark, sf):
    silver = silver_from_staging(stage(proxy.bronze_events(spark, sf)))
    return silver.withColumn("vintage_us", F.unix_micros("vintage_ts")).drop("vintage_ts")


@query("p6_period_to_iso", """
SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN date_trunc('year', o_orderdate)::DATE
  WHEN 1 THEN date_trunc('month', o_orderdate)::DATE ELSE o_orderdate::DATE END AS period
FROM orders""")
def p6_period_to_iso(spark, sf):
    n = F.col("o_orderkey") % 3
    text = F.when(n == 0, F.date_format("o_orderdate", "yyyy")).when(n == 1, F.date_format("o_orderdate", "yyyy-MM")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, sf, "orders").select(
        "o_orderkey", clean.to_date_or_null(clean.period_to_iso(text)).alias("period"))


@query("p7_series_id", "SELECT ts_date, series_id FROM silver_fx", ("silver_fx",))
def p7_series_id(spark, sf):
    return proxy.silver_fx(spark, sf).select("ts_date", "series_id")


@query("p8_series_and_geo_filter", f"""
SELECT month, geo, series_id, {r('hicp_index')} AS hicp_index FROM fact_index WHERE series_id = 'CP00' AND geo = 'EA20'""", ("fact_index",))
def p8_series_and_geo_filter(spark, sf):
    return rounded(proxy.index(spark, sf).filter((F.col("series_id") == "CP00") & (F.col("geo") == "EA20")))


@query("p9_month_to_date_cutoff", f"""
SELECT month, geo, {r('brent_crude_usd')} AS brent_crude_usd, {r('nat_gas_eu_usd')} AS nat_gas_eu_usd FROM energy_monthly""", ("energy_monthly",))
def p9_month_to_date_cutoff(spark, sf):
    return rounded(gold.energy_monthly(proxy.silver_energy(spark, sf), CUTOFF))


@query("p10_closed_range", f"""
SELECT ref_month, {r('fx_usd_eur_avg_m')} AS fx_usd_eur_avg_m, {r('fx_ma3')} AS fx_ma3, {r('fx_ma12')} AS fx_ma12, {r('policy_rate_eom_m')} AS policy_rate_eom_m
FROM macro_wide WHERE ref_month >= DATE '1997-03-01' AND ref_month <= DATE '1999-08-01'""", ("macro_wide",))
def p10_closed_range(spark, sf):
    wide = views.macro_wide(proxy.macro(spark, sf))
    picked = views.in_range(wide, date(1997, 3, 1), date(1999, 8, 1), "ref_month")
    return rounded(picked.select("ref_month", "fx_usd_eur_avg_m", "fx_ma3", "fx_ma12", "policy_rate_eom_m"))


@query("p11_relative_range", """
SELECT c.choice, count(*) AS n FROM orders o JOIN (VALUES ('5years', DATE '1996-01-01', DATE '2001-12-31'),
  ('10years', DATE '1991-01-01', DATE '2001-12-31'), ('since2000', DATE '2000-01-01', DATE '2001-12-31'),
  ('custom', DATE '1998-01-05', DATE '1998-02-03'), ('unknown', DATE '1996-01-01', DATE '2001-12-31')) AS c(choice, a, b)
  ON o.o_orderdate::DATE BETWEEN c.a AND c.b GROUP BY 1""")
def p11_relative_range(spark, sf):
    day = F.to_date("o_orderdate")
    one_pass = table(spark, sf, "orders").agg(*[
        F.count(F.when(cal.between_days(day, *cal.relative_range(c, date(2001, 7, 15), (date(1998, 1, 5), date(1998, 2, 3)))), 1)).alias(c)
        for c in ("5years", "10years", "since2000", "custom", "unknown")])
    return one_pass.unpivot([], one_pass.columns, "choice", "n")


@query("p12_trailing_days", """
SELECT event_id, event_type FROM events WHERE ts >= DATE '2024-01-30' - INTERVAL 7 DAY""")
def p12_trailing_days(spark, sf):
    return table(spark, sf, "events").filter(cal.trailing_days("ts", date(2024, 1, 30))).select("event_id", "event_type")


@query("p13_ilike", "SELECT series_id, count(*) AS n FROM silver_fx WHERE series_id ILIKE '%usd%' GROUP BY 1", ("silver_fx",))
def p13_ilike(spark, sf):
    return proxy.silver_fx(spark, sf).filter(F.col("series_id").ilike("%usd%")).groupBy("series_id").agg(F.count("*").alias("n"))


_CORE = ["lag_1m", "lag_3m", "lag_6m", "lag_12m", "fx_usd_eur_avg", "policy_rate_monthly_avg", "policy_rate_eom"]


@query("p14_feature_columns", f"SELECT month, geo, {', '.join(r(c) + ' AS ' + c for c in _CORE)} FROM nowcast_input", ("nowcast_input",))
def p14_feature_columns(spark, sf):
    df = proxy.nowcast_input(spark, sf)
    return rounded(df.select("month", "geo", *feature_plan.feature_columns(df)))


@query("p15_complete_cases", f"""
SELECT month, geo, {r('target_hicp_index')} AS target_hicp_index, {r('lag_12m')} AS lag_12m FROM nowcast_input
WHERE {' AND '.join(c + ' IS NOT NULL' for c in _CORE)} AND target_hicp_index IS NOT NULL""", ("nowcast_input",))
def p15_complete_cases(spark, sf):
    df = feature_plan.complete_cases(proxy.nowcast_input(spark, sf), [*_CORE, "target_hicp_index"])
    return rounded(df.select("month", "geo", "target_hicp_index", "lag_12m"))


@query("p16_split", f"""
SELECT geo, CASE WHEN month <= DATE '{TRAIN_STOP}' THEN 'train' ELSE 'test' END AS part, count(*) AS n_rows,
  min(month) AS period_start, max(month) AS period_end,
  month <= DATE '{TRAIN_STOP}' AND count(*) >= 24 AS enough FROM headline GROUP BY geo, month <= DATE '{TRAIN_STOP}', 2""", ("headline",))
def p16_split(spark, sf):
    train, test = feature_plan.split_at(proxy.stored_gold(spark, sf)[0], TRAIN_STOP)
    parts = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    sizes = parts.groupBy("geo", "part").agg(
        F.count("*").alias("n_rows"), F.min("month").alias("period_start"), F.max("month").alias("period_end"))
    return sizes.withColumn("enough", (F.col("part") == "train") & (F.col("n_rows") >= MIN_TRAIN_ROWS))


@query("p17_finite_check", """
SELECT 'finite' AS rule, column_name, failures::BIGINT AS failures FROM (
  SELECT count(*) FILTER (WHERE l_tax = 0) AS ratio, count(*) FILTER (WHERE l_discount = 0) AS root FROM lineitem)
UNPIVOT (failures FOR column_name IN (ratio, root))""")
def p17_finite_check(spark, sf):
    zero_inf, zero_nan = F.lit(float("inf")), F.lit(float("nan"))
    df = table(spark, sf, "lineitem").select(
        F.when(F.col("l_tax") == 0, zero_inf).otherwise(1 / F.when(F.col("l_tax") != 0, F.col("l_tax"))).alias("ratio"),
        F.when(F.col("l_discount") == 0, zero_nan).otherwise(F.sqrt("l_discount")).alias("root"))
    return quality.non_finite(df, ["ratio", "root"])


@query("p18_align_features", f"SELECT geo, month, {r('lag_3m')} AS lag_3m, 0.0::DOUBLE AS unseen, {r('lag_1m')} AS lag_1m FROM nowcast_input", ("nowcast_input",))
def p18_align_features(spark, sf):
    return rounded(feature_plan.align_features(proxy.nowcast_input(spark, sf), ["lag_3m", "unseen", "lag_1m"]))


@query("p19_series_selection", f"""
SELECT ts_date, geo, series_id, {r('value')} AS value FROM silver_index
WHERE geo = 'EA20' AND series_id = 'CP00' AND unit = 'Index (2015=100)' AND freq = 'M'
  AND ts_date >= DATE '1996-01-01' AND ts_date < DATE '1999-07-01'""", ("silver_index",))
def p19_series_selection(spark, sf):
    picked = select_series(proxy.silver_index(spark, sf), "EA20", "CP00", "Index (2015=100)", "M", "1996", "1999-06")
    return rounded(picked.select("ts_date", "geo", "series_id", "value"))


@query("p20_rename_and_attach", f"""
SELECT month, 'EA20' AS geo, {r('y_nowcast')} AS y_pred, {r('y_actual')} AS y_true, {r('residual')} AS residual FROM nowcasts""", ("nowcasts",))
def p20_rename_and_attach(spark, sf):
    df = proxy.nowcasts(proxy.headline(spark, sf)).withColumnsRenamed({"y_nowcast": "y_pred", "y_actual": "y_true"})
    return rounded(df.withColumn("geo", F.lit("EA20")).select("month", "geo", "y_pred", "y_true", "residual"))


@query("f1_first_of_month", "SELECT date_trunc('month', l_shipdate)::DATE AS month, count(*) AS n FROM lineitem GROUP BY 1")
def f1_first_of_month(spark, sf):
    return table(spark, sf, "lineitem").groupBy(cal.first_of_month("l_shipdate").alias("month")).agg(F.count("*").alias("n"))


@query("f2_month_spine", """
SELECT s.month, count(o.o_orderkey) AS n FROM spine s LEFT JOIN orders o ON date_trunc('month', o.o_orderdate) = s.month GROUP BY 1""", ("spine",))
def f2_month_spine(spark, sf):
    months = table(spark, sf, "orders").groupBy(cal.first_of_month("o_orderdate").alias("month")).agg(F.count("*").alias("n"))
    return proxy.spine(spark).join(months, "month", "left").select("month", F.coalesce("n", F.lit(0)).alias("n"))


@query("f3_shift_months", """
SELECT o_orderkey, (o_orderdate::DATE - INTERVAL 12 MONTH)::DATE AS year_ago, (o_orderdate::DATE + INTERVAL 1 MONTH)::DATE AS next_month FROM orders""")
def f3_shift_months(spark, sf):
    day = F.to_date("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey", cal.shift_months(day, -12).alias("year_ago"), cal.shift_months(day, 1).alias("next_month"))


@query("f4_month_and_quarter", "SELECT month(o_orderdate) AS m, quarter(o_orderdate) AS q, count(*) AS n FROM orders GROUP BY 1, 2")
def f4_month_and_quarter(spark, sf):
    return table(spark, sf, "orders").groupBy(
        cal.month_of_year("o_orderdate").alias("m"), cal.quarter_of_year("o_orderdate").alias("q")).agg(F.count("*").alias("n"))


@query("f5_minutes_between", """
SELECT user_id, (round((epoch_us(max(ts)) - epoch_us(min(ts))) / 60000000.0::DOUBLE, 1)) AS minutes FROM events GROUP BY 1""")
def f5_minutes_between(spark, sf):
    ends = table(spark, sf, "events").groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return ends.select("user_id", cal.minutes_between("a", "b").alias("minutes"))


@query("f6_seconds_between", """
SELECT user_id, floor(epoch_us(max(ts)) / 1000000.0)::BIGINT - floor(epoch_us(min(ts)) / 1000000.0)::BIGINT AS seconds FROM events GROUP BY 1""")
def f6_seconds_between(spark, sf):
    ends = table(spark, sf, "events").groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return ends.select("user_id", cal.seconds_between("a", "b").alias("seconds"))


@query("f7_ratio_change", f"SELECT l_orderkey, l_linenumber, {r('l_discount / nullif(l_tax, 0) - 1')} AS change FROM lineitem")
def f7_ratio_change(spark, sf):
    return rounded(table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", numeric.ratio_change("l_discount", "l_tax").alias("change")))


@query("f8_pair_mean", f"SELECT month, geo, {r('energy_price_usd')} AS energy_price_usd FROM nowcast_input", ("nowcast_input",))
def f8_pair_mean(spark, sf):
    return rounded(proxy.nowcast_input(spark, sf).select("month", "geo", "energy_price_usd"))


@query("f9_level_and_residual", f"""
SELECT o_orderkey, {r('o_totalprice / 3001.0::DOUBLE * (1 + (o_orderkey % 7 - 3) / 101.0::DOUBLE)')} AS level,
  {r('o_totalprice / 3001.0::DOUBLE - o_totalprice / 3001.0::DOUBLE * (1 + (o_orderkey % 7 - 3) / 101.0::DOUBLE)')} AS residual FROM orders""")
def f9_level_and_residual(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_totalprice") / 3001.0).alias("y"), ((F.col("o_orderkey") % 7 - 3) / 101.0).alias("change"))
    out = df.withColumn("level", numeric.level_from_change("y", "change"))
    return rounded(out.select("o_orderkey", "level", numeric.residual("y", "level").alias("residual")))


@query("f10_null_handling", """
SELECT event_type, CASE WHEN user_id % 10 IN (0, 5) THEN 'EA20' WHEN user_id % 10 = 1 THEN 'NA' WHEN user_id % 10 = 4 THEN 'DE'
  ELSE 'other' END AS bucket, count(*) AS n FROM events GROUP BY 1, 2""")
def f10_null_handling(spark, sf):
    geo = clean.default_geo("geo")
    return proxy.bronze_events(spark, sf).groupBy(
        F.col("series_id").alias("event_type"),
        F.when(geo.isin("EA20", "NA", "DE"), geo).otherwise("other").alias("bucket")).agg(F.count("*").alias("n"))


@query("f11_model_version", """
SELECT geo, 'gbt_20240101T000000Z_' || substr(sha1('{"cols": ["lag_1m", "lag_3m"], "params": {"depth": 3, "geo": "' || geo || '", "rows": ' || n || '}}'), 1, 8) AS model_version
FROM (SELECT geo, count(*) AS n FROM panel GROUP BY 1)""", ("panel",))
def f11_model_version(spark, sf):
    sizes = proxy.panel(spark, sf).groupBy("geo").agg(F.count("*").alias("n"))
    params = F.create_map(F.lit("rows"), F.col("n").cast("string"), F.lit("depth"), F.lit("3"),
                          F.lit("geo"), F.concat(F.lit('"'), F.col("geo"), F.lit('"')))
    payload = ids.canonical_json(F.array(F.lit("lag_1m"), F.lit("lag_3m")), params)
    return sizes.select("geo", ids.model_version(payload, F.lit("2024-01-01").cast("timestamp")).alias("model_version"))


@query("f12_run_id", "SELECT 'C' || o_custkey AS geo, 36 AS id_length FROM orders GROUP BY 1")
def f12_run_id(spark, sf):
    geos = proxy.panel(spark, sf).select("geo").distinct()
    return geos.withColumn("run_id", ids.run_id()).select("geo", F.length("run_id").alias("id_length"))


@query("f13_percent", f"SELECT month, geo, {r('hicp_yoy * 100')} AS hicp_yoy_pct FROM features WHERE series_id = 'CP00'", ("features",))
def f13_percent(spark, sf):
    df = proxy.features(spark, sf).filter(F.col("series_id") == "CP00")
    return rounded(df.select("month", "geo", numeric.percent("hicp_yoy").alias("hicp_yoy_pct")))


@query("f14_json_access", """
SELECT json_extract_string(props, '$.k')::INTEGER AS k, count(*) AS n FROM events GROUP BY 1""")
def f14_json_access(spark, sf):
    parsed = F.from_json("props", "map<string,int>")
    return table(spark, sf, "events").groupBy(F.element_at(parsed, "k").alias("k")).agg(F.count("*").alias("n"))
