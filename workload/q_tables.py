"""Joins, aggregates, windows, top-k and set operations."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macrotide.functions.numeric import ratio_change
from macrotide.operators import keyed, orderstats, quality, stats, vintages, windows
from macrotide.plans import features as feature_plan
from macrotide.plans import gold, views
from macrotide.plans.silver import all_series, dataset_labels
from macrotide.session import scratch_path
from macrotide.sources.bronze import stage
from workload import proxy
from workload.proxy import CUTOFF, FEATURE_NAMES, ROLLING_SQL, ROLLING_WINDOWS, TRAIN_STOP, table
from workload.registry import query, r, rounded


def _cols(*names: str, digits: int = 6) -> str:
    return ", ".join(f"{r(n, digits)} AS {n}" for n in names)


_MACRO = ["fx_usd_eur_avg", "policy_rate_monthly_avg", "policy_rate_eom", "brent_crude_usd", "nat_gas_eu_usd"]
_LAGS = ["lag_1m", "lag_3m", "lag_6m", "lag_12m"]


# ---- joins --------------------------------------------------------------------------------------

@query("j1_fact_cpi_features", f"SELECT month, geo, series_id, {_cols('hicp_index', *_MACRO, *_LAGS, 'hicp_mom', 'hicp_yoy')} FROM features", ("features",))
def j1_fact_cpi_features(spark, sf):
    return rounded(proxy.features(spark, sf))


@query("j2_fact_macro", f"SELECT month, geo, {_cols(*_MACRO)} FROM fact_macro", ("fact_macro",))
def j2_fact_macro(spark, sf):
    return rounded(proxy.macro(spark, sf))


@query("j3_hicp_wide", f"SELECT month, geo, source, {_cols('index_value', 'hicp_yoy', 'hicp_idx_ma3', 'hicp_idx_ma12')} FROM hicp_wide", ("hicp_wide",))
def j3_hicp_wide(spark, sf):
    return rounded(views.hicp_wide(*proxy.stored_gold(spark, sf), geo=None))


@query("j3_year_ago_panel", f"""
SELECT p.geo, p.month, {r('p.value')} AS value, {r('a.value')} AS value_ago FROM panel p
LEFT JOIN panel a ON a.geo = p.geo AND a.month = (p.month - INTERVAL 12 MONTH)::DATE""", ("panel",))
def j3_year_ago_panel(spark, sf):
    p = proxy.panel(spark, sf)
    return rounded(windows.earlier_value(p, ["geo"], "value", {"value_ago": 12}))


@query("j7_nowcast_base_lookup", f"""
SELECT n.month, n.geo, {r('n.index_value')} AS index_value, {r('a.hicp_index')} AS base_index,
  {r('coalesce(n.index_value / nullif(a.hicp_index, 0) - 1, n.hicp_yoy)')} AS yoy
FROM hicp_wide n LEFT JOIN headline a ON a.geo = n.geo AND a.month = (n.month - INTERVAL 12 MONTH)::DATE
WHERE n.source = 'nowcast'""", ("hicp_wide",))
def j7_nowcast_base_lookup(spark, sf):
    head, nowcasts = proxy.stored_gold(spark, sf)
    wide = views.hicp_wide(head, nowcasts, geo=None).filter(F.col("source") == "nowcast")
    looked = views.year_ago(wide, head, ["geo"], "hicp_index", "base_index")
    return rounded(looked.select("month", "geo", "index_value", "base_index", F.coalesce(
        ratio_change("index_value", "base_index"), F.col("hicp_yoy")).alias("yoy")))


def _overlay_sql(months: int) -> str:
    return f"""
SELECT c.geo, c.month, {r('c.hicp_index')} AS hicp_index, {r('a.hicp_index')} AS hicp_index_ago FROM headline c
LEFT JOIN headline a ON a.geo = c.geo AND (a.month + INTERVAL {months} MONTH)::DATE = c.month"""


for _period, _months in (("1year", 12), ("2years", 24), ("5years", 60)):
    @query(f"j8_overlay_{_period}", _overlay_sql(_months), ("headline",))
    def _overlay(spark, sf, period=_period):
        return rounded(views.comparison_overlay(proxy.headline(spark, sf), ["geo"], "hicp_index", period))


@query("j6_append_if_absent", f"""
SELECT geo, month, {r('value')} AS value FROM panel
UNION ALL SELECT DISTINCT geo, DATE '2001-06-01', NULL::DOUBLE FROM panel
WHERE geo NOT IN (SELECT geo FROM panel WHERE month = DATE '2001-06-01')""", ("panel",))
def j6_append_if_absent(spark, sf):
    p = proxy.panel(spark, sf)
    new = p.select("geo").distinct().withColumn("month", F.lit(date(2001, 6, 1)))
    return rounded(keyed.append_if_absent(p, new, ["geo", "month"]))


# ---- aggregates ---------------------------------------------------------------------------------

@query("a1_last_write_wins", "SELECT dt, dataset, series_id, geo, value, source, ingest_us FROM lww_events", ("lww_events",))
def a1_last_write_wins(spark, sf):
    staged = stage(proxy.bronze_events(spark, sf))
    newest = keyed.last_write_wins(staged, ["dataset", "dt", "geo", "series_id"])
    return newest.withColumn("ingest_us", F.unix_micros("ingest_ts")).drop("ingest_ts")


@query("a1_merged_batches", "SELECT dt, dataset, series_id, geo, value, source, ingest_us FROM lww_events", ("lww_events",))
def a1_merged_batches(spark, sf):
    """The vintages in three batches, each merged into the bucketed store of those before."""
    staged, keys, buckets = stage(proxy.bronze_events(spark, sf)), ["dataset", "dt", "geo", "series_id"], 8
    batch = F.pmod(F.xxhash64("ingest_ts", "value"), F.lit(3))
    first, second = scratch_path(spark, "vintages"), scratch_path(spark, "vintages")
    vintages.create(staged.filter(batch == 0), first, buckets, keys)
    vintages.merge(staged.filter(batch == 1), first, second, buckets, keys)
    newest = vintages.merged(staged.filter(batch == 2), second, buckets, keys).select(*staged.columns)
    return newest.withColumn("ingest_us", F.unix_micros("ingest_ts")).drop("ingest_ts")


@query("a1_last_write_wins_hot_keys", """
SELECT l_linestatus, l_returnflag, l_shipdate::DATE AS ts_date, l_orderkey, l_linenumber, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_linestatus, l_returnflag
  ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC) = 1""")
def a1_last_write_wins_hot_keys(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_linestatus", "l_returnflag", F.to_date("l_shipdate").alias("ts_date"), "l_orderkey", "l_linenumber", "l_extendedprice")
    return keyed.last_write_wins(rows, ["l_linestatus", "l_returnflag"], "ts_date", ("l_orderkey", "l_linenumber", "l_extendedprice"))


@query("a2_fx_monthly", f"SELECT month, geo, {_cols('fx_usd_eur_avg')} FROM fx_monthly", ("fx_monthly",))
def a2_fx_monthly(spark, sf):
    return rounded(gold.fx_monthly(proxy.silver_fx(spark, sf), CUTOFF))


@query("a3_rates_monthly", f"""
SELECT month, geo, {_cols('policy_rate_monthly_avg', 'policy_rate_eom')} FROM rates_avg JOIN rates_eom USING (month, geo)""", ("rates_avg", "rates_eom"))
def a3_rates_monthly(spark, sf):
    return rounded(gold.rates_monthly(proxy.silver_rates(spark, sf), CUTOFF))


@query("a4_conditional_mean_pivot", f"""
SELECT ts_date, {r("avg(CASE WHEN series_id = 'POILBREUSDM' THEN value END)")} AS brent,
  {r("avg(CASE WHEN series_id = 'PNGASEUUSDM' THEN value END)")} AS gas FROM silver_energy GROUP BY 1""", ("silver_energy",))
def a4_conditional_mean_pivot(spark, sf):
    return rounded(stats.conditional_pivot(proxy.silver_energy(spark, sf), ["ts_date"], "series_id", "value",
                                           {"POILBREUSDM": "brent", "PNGASEUUSDM": "gas"}))


@query("a5_dashboard_view", f"""
SELECT month, geo, {r("max(CASE WHEN series_id = 'CP00' THEN hicp_index END)")} AS hicp_index,
  {r('max(fx_usd_eur_avg)')} AS fx_usd_eur_avg, {r('max(policy_rate_eom)')} AS policy_rate_eom,
  {r('max(brent_crude_usd)')} AS brent_crude_usd, {r('max(nat_gas_eu_usd)')} AS nat_gas_eu_usd
FROM features GROUP BY 1, 2""", ("features",))
def a5_dashboard_view(spark, sf):
    return rounded(gold.dashboard_view(proxy.features(spark, sf)))


@query("a6_macro_monthly", f"SELECT ref_month, {_cols('fx_usd_eur_avg_m', 'brent_crude_m', 'nat_gas_m', 'policy_rate_eom_m')} FROM macro_wide", ("macro_wide",))
def a6_macro_monthly(spark, sf):
    return rounded(views.macro_monthly(proxy.macro(spark, sf)))


@query("a7_row_counts", "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in ("orders", "lineitem", "customer", "events")))
def a7_row_counts(spark, sf):
    return quality.row_counts({t: table(spark, sf, t) for t in ("orders", "lineitem", "customer", "events")})


_METRIC_SQL = """
  avg(abs({y} - {p})) AS mae, median(abs({y} - {p})) AS median_ae, sqrt(avg(({y} - {p}) * ({y} - {p}))) AS rmse,
  1 - sum(({y} - {p}) * ({y} - {p})) / nullif(var_pop({y}) * count(*), 0) AS r2,
  avg(CASE WHEN {y} <> 0 THEN abs(({y} - {p}) / {y}) END) * 100 AS mape,
  avg(CASE WHEN abs({y} - {p}) <= 1 THEN 0.5::DOUBLE * ({y} - {p}) * ({y} - {p}) ELSE abs({y} - {p}) - 0.5::DOUBLE END) AS huber_loss,
  max(abs({y} - {p})) AS max_error, quantile_cont(abs({y} - {p}), 0.9) AS p90_error"""


@query("a8_regression_metrics", f"""
SELECT geo, model_version, {_cols(*stats.METRICS)} FROM (
  SELECT geo, model_version, {_METRIC_SQL.format(y='y_actual', p='y_nowcast')} FROM nowcasts GROUP BY 1, 2)""", ("nowcasts",))
def a8_regression_metrics(spark, sf):
    return rounded(stats.regression_metrics(proxy.nowcasts(proxy.headline(spark, sf)), ["geo", "model_version"], "y_actual", "y_nowcast"))


@query("a8_regression_metrics_pooled", f"""
SELECT l_returnflag, {_cols(*stats.METRICS, digits=5)} FROM (
  SELECT l_returnflag, {_METRIC_SQL.format(y='y', p='p')} FROM (
    SELECT l_returnflag, l_extendedprice / 3001.0::DOUBLE AS y, l_quantity / 1.7::DOUBLE AS p FROM lineitem) GROUP BY 1)""")
def a8_regression_metrics_pooled(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_returnflag", (F.col("l_extendedprice") / 3001.0).alias("y"), (F.col("l_quantity") / 1.7).alias("p"))
    return rounded(stats.regression_metrics(rows, ["l_returnflag"], "y", "p", bounded=False), 5)


@query("a8_regression_metrics_with_nan", f"""
SELECT l_returnflag, {_cols(*stats.METRICS, digits=5)} FROM (
  SELECT l_returnflag, {_METRIC_SQL.format(y='y', p='p')} FROM (
    SELECT l_returnflag, l_extendedprice / 3001.0::DOUBLE AS y, l_quantity / 1.7::DOUBLE AS p FROM lineitem WHERE l_linenumber <> 7) GROUP BY 1)""")
def a8_regression_metrics_with_nan(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_returnflag", (F.col("l_extendedprice") / 3001.0).alias("y"),
        F.when(F.col("l_linenumber") == 7, float("nan")).otherwise(F.col("l_quantity") / 1.7).alias("p"))
    return rounded(stats.regression_metrics(rows, ["l_returnflag"], "y", "p", bounded=False), 5)


@query("a9_ensemble_mean", f"SELECT geo, month, {r('avg(y_nowcast)')} AS y_nowcast FROM nowcasts GROUP BY 1, 2", ("nowcasts",))
def a9_ensemble_mean(spark, sf):
    return rounded(stats.ensemble_mean(proxy.nowcasts(proxy.headline(spark, sf)), ["geo", "month"], "y_nowcast"))


@query("a10_latest_finish", "SELECT max(ts) AS finished_at FROM events")
def a10_latest_finish(spark, sf):
    return table(spark, sf, "events").agg(F.max("ts").alias("finished_at"))


def run_metrics(spark, sf) -> DataFrame:
    """Tall metric rows per run, a run being a customer's orders."""
    wide = table(spark, sf, "orders").groupBy(F.concat(F.lit("run-"), F.col("o_custkey").cast("string")).alias("run_id")).agg(
        F.min(F.col("o_totalprice")).alias("mae"), F.max("o_totalprice").alias("max_error"))
    return stats.tall_metrics(wide, ["run_id"], ["mae", "max_error"])


@query("a11_wide_metrics", "SELECT 'run-' || o_custkey AS run_id, min(o_totalprice) AS mae, max(o_totalprice) AS max_error FROM orders GROUP BY 1")
def a11_wide_metrics(spark, sf):
    return stats.wide_metrics(run_metrics(spark, sf), ["run_id"], ["mae", "max_error"])


@query("a12_period_bounds", "SELECT geo, min(month) AS period_start, max(month) AS period_end FROM panel GROUP BY 1", ("panel",))
def a12_period_bounds(spark, sf):
    return stats.period_bounds(proxy.panel(spark, sf), ["geo"])


# ---- windows ------------------------------------------------------------------------------------

@query("w1_lags", f"SELECT geo, series_id, month, {_cols('hicp_index', *_LAGS)} FROM lagged", ("lagged",))
def w1_lags(spark, sf):
    return rounded(windows.add_lags(proxy.index(spark, sf), "hicp_index", ["geo", "series_id"]))


_PANEL_LAGS = ", ".join(f"{r(f'lag(value, {n}) OVER w')} AS lag_{n}m" for n in (1, 3, 6, 12))


@query("w1_lags_panel", f"SELECT geo, month, {r('value')} AS value, {_PANEL_LAGS} FROM panel WINDOW w AS (PARTITION BY geo ORDER BY month)", ("panel",))
def w1_lags_panel(spark, sf):
    return rounded(windows.add_lags(proxy.panel(spark, sf), "value", ["geo"]))


@query("w1_calendar_lags_panel", f"""
SELECT p.geo, p.month, {r('p.value')} AS value, {', '.join(f"{r(f'a{n}.value')} AS lag_{n}m" for n in (1, 3, 6, 12))} FROM panel p
""" + "\n".join(f"LEFT JOIN panel a{n} ON a{n}.geo = p.geo AND a{n}.month = (p.month - INTERVAL {n} MONTH)::DATE" for n in (1, 3, 6, 12)), ("panel",))
def w1_calendar_lags_panel(spark, sf):
    return rounded(windows.add_calendar_lags(proxy.panel(spark, sf), "value", ["geo"]))


@query("w1_lags_dense_months", f"""
SELECT geo, month, {r('value')} AS value, {_PANEL_LAGS} FROM (
  SELECT b.geo, s.month, p.value FROM (SELECT geo, min(month) AS lo, max(month) AS hi FROM panel GROUP BY 1) b
  JOIN (SELECT unnest(generate_series(DATE '1990-01-01', DATE '2010-12-01', INTERVAL 1 MONTH))::DATE AS month) s
    ON s.month BETWEEN b.lo AND b.hi LEFT JOIN panel p ON p.geo = b.geo AND p.month = s.month)
WINDOW w AS (PARTITION BY geo ORDER BY month)""", ("panel",))
def w1_lags_dense_months(spark, sf):
    return rounded(windows.add_lags(windows.densify(proxy.panel(spark, sf), ["geo"]), "value", ["geo"]))


@query("w2_end_of_month", f"SELECT month, geo, {_cols('policy_rate_eom')} FROM rates_eom", ("rates_eom",))
def w2_end_of_month(spark, sf):
    return rounded(gold.end_of_month(proxy.silver_rates(spark, sf), "policy_rate_eom"))


@query("w3_trailing_means_panel", f"""
SELECT geo, month, {r('value')} AS value,
  {r('avg(value) OVER (PARTITION BY geo ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)')} AS v_ma3,
  {r('avg(value) OVER (PARTITION BY geo ORDER BY month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)')} AS v_ma12 FROM panel""", ("panel",))
def w3_trailing_means_panel(spark, sf):
    return rounded(windows.add_trailing_means(proxy.panel(spark, sf), {"value": "v"}, ["geo"], "month"))


@query("w4_macro_wide", f"""SELECT ref_month, {_cols(
    'fx_usd_eur_avg_m', 'fx_ma3', 'fx_ma12', 'brent_crude_m', 'brent_crude_ma3', 'brent_crude_ma12',
    'nat_gas_m', 'nat_gas_ma3', 'nat_gas_ma12', 'policy_rate_eom_m')} FROM macro_wide""", ("macro_wide",))
def w4_macro_wide(spark, sf):
    return rounded(views.macro_wide(proxy.macro(spark, sf)))


@query("w5_leak_free_rolling", f"""
SELECT geo, month, {_cols(*[n for n in FEATURE_NAMES if n.rsplit('_', 1)[-1].startswith(('ma', 'std'))])} FROM featured""", ("featured",))
def w5_leak_free_rolling(spark, sf):
    out = windows.add_leak_free_rolling(proxy.nowcast_input(spark, sf), feature_plan.VOLATILE, ["geo"])
    return rounded(out.select("geo", "month", *[c for c in out.columns if c.rsplit("_", 1)[-1].startswith(("ma", "std"))]))


_PANEL_ROLL = ", ".join(
    f"{r(f'avg(value) OVER w{n}')} AS value_ma{n}, {r(f'coalesce(stddev_samp(value) OVER w{n}, 0.0)')} AS value_std{n}" for n in (3, 6, 12))


@query("w5_leak_free_rolling_panel", f"SELECT geo, month, {r('value')} AS value, {_PANEL_ROLL} FROM panel WINDOW {ROLLING_WINDOWS}", ("panel",))
def w5_leak_free_rolling_panel(spark, sf):
    return rounded(windows.add_leak_free_rolling(proxy.panel(spark, sf), ["value"], ["geo"]))


@query("w6_fill_forward_backward", f"""
SELECT geo, month, {r('''coalesce(last_value(value IGNORE NULLS) OVER (PARTITION BY geo ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(value IGNORE NULLS) OVER (PARTITION BY geo ORDER BY month ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))''')} AS value FROM panel""", ("panel",))
def w6_fill_forward_backward(spark, sf):
    return rounded(windows.fill_forward_backward(proxy.panel(spark, sf), ["value"], ["geo"]))


@query("w7_last_known_level", f"""
SELECT geo, max(month) AS last_known_month, {r('arg_max(value, month)')} AS last_known_level FROM panel
WHERE month < DATE '2000-06-01' AND value IS NOT NULL GROUP BY 1""", ("panel",))
def w7_last_known_level(spark, sf):
    return rounded(windows.last_known(proxy.panel(spark, sf), "value", ["geo"], date(2000, 6, 1)))


@query("w8_latest_and_trend", f"""
SELECT geo, max(CASE WHEN rk = 1 THEN month END) AS month, {r('max(CASE WHEN rk = 1 THEN value END)')} AS value,
  {r('CASE WHEN count(*) >= 3 THEN avg(value) END')} AS value_trend
FROM (SELECT *, row_number() OVER (PARTITION BY geo ORDER BY month DESC) AS rk FROM panel) WHERE rk <= 3 GROUP BY 1""", ("panel",))
def w8_latest_and_trend(spark, sf):
    return rounded(windows.latest_and_trend(proxy.panel(spark, sf), ["geo"], ["value"], "value"))


_WINSOR = """
SELECT {keys}, {out} FROM {source} t JOIN (
  SELECT {group} AS g, max(CASE WHEN rk = floor(n * 0.05::DOUBLE) + 1 THEN v END) AS lo,
    max(CASE WHEN rk = n - floor(n * 0.05::DOUBLE) THEN v END) AS hi
  FROM (SELECT {group}, {value} AS v, row_number() OVER (PARTITION BY {group} ORDER BY {value}) AS rk,
          count(*) OVER (PARTITION BY {group}) AS n FROM {source} WHERE {value} IS NOT NULL) GROUP BY 1) b ON b.g = t.{group}"""


@query("w9_winsorize_panel", _WINSOR.format(
    keys="geo, month", out=r("CASE WHEN value IS NOT NULL THEN least(greatest(value, lo), hi) END") + " AS value",
    source="panel", group="geo", value="value").replace("t JOIN", "t LEFT JOIN"), ("panel",))
def w9_winsorize_panel(spark, sf):
    return rounded(windows.winsorize(proxy.panel(spark, sf), "value", ["geo"]))


@query("w9_winsorize_hot_groups", _WINSOR.format(
    keys="o_orderkey, o_orderstatus", out="least(greatest(o_totalprice, lo), hi) AS o_totalprice",
    source="orders", group="o_orderstatus", value="o_totalprice"))
def w9_winsorize_hot_groups(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return orderstats.winsorize_large(rows, "o_totalprice", ["o_orderstatus"]).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("w9_winsorize_with_nan", _WINSOR.format(
    keys="l_orderkey, l_linenumber", out="CASE WHEN isnan(x) THEN NULL ELSE least(greatest(x, lo), hi) END AS x, isnan(x) AS was_nan",
    source="(SELECT l_orderkey, l_linenumber, l_linestatus, CASE WHEN l_linenumber = 7 THEN 'NaN'::DOUBLE ELSE l_extendedprice END AS x FROM lineitem)",
    group="l_linestatus", value="CASE WHEN NOT isnan(x) THEN x END"))
def w9_winsorize_with_nan(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_linestatus", F.when(F.col("l_linenumber") == 7, float("nan")).otherwise(F.col("l_extendedprice")).alias("x"))
    out = orderstats.winsorize_large(rows, "x", ["l_linestatus"])
    return out.select("l_orderkey", "l_linenumber", F.when(~F.isnan("x"), F.col("x")).alias("x"), F.isnan("x").alias("was_nan"))


@query("w10_previous_level", f"SELECT geo, month, {r('lag(value, 1) OVER (PARTITION BY geo ORDER BY month)')} AS previous_level FROM panel", ("panel",))
def w10_previous_level(spark, sf):
    return rounded(windows.add_previous(proxy.panel(spark, sf), "value", ["geo"], "previous_level").select("geo", "month", "previous_level"))


@query("w11_expanding_window", f"""
SELECT geo, month, {r('avg(value) OVER w')} AS mean_before, count(value) OVER w AS n_before FROM panel
WINDOW w AS (PARTITION BY geo ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""", ("panel",))
def w11_expanding_window(spark, sf):
    out = windows.add_expanding(proxy.panel(spark, sf), ["geo"], "month", mean_before=F.avg("value"), n_before=F.count("value"))
    return rounded(out.select("geo", "month", "mean_before", "n_before"))


# ---- top-k, order and set operations ------------------------------------------------------------

@query("o1_newest_rows", "SELECT dt, dataset, series_id, geo, value, ingest_us FROM staged_events ORDER BY ingest_us DESC, series_id DESC LIMIT 5", ("staged_events",))
def o1_newest_rows(spark, sf):
    # Events are numbered as they arrive; their stamps have whole seconds here, so several can be equally new.
    staged = stage(proxy.bronze_events(spark, sf, "event_id"), "event_id").withColumn("ingest_us", F.unix_micros("ingest_ts"))
    newest = keyed.newest_rows(staged, ["ingest_us", "series_id"], 5, "event_id")
    return newest.select("dt", "dataset", "series_id", "geo", "value", "ingest_us")


@query("o2_ordered_view", f"SELECT month, geo, {_cols('fx_usd_eur_avg')} FROM fact_macro ORDER BY month, geo", ("fact_macro",))
def o2_ordered_view(spark, sf):
    # Operators leave order to the sink; a served view sorts last.
    return rounded(proxy.macro(spark, sf).select("month", "geo", "fx_usd_eur_avg")).orderBy("month", "geo")


@query("o3_top_features", """
SELECT event_type || '-' || (user_id % 10) AS feature, sum(CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END)::DOUBLE AS importance
FROM events GROUP BY 1 ORDER BY 2 DESC, 1 ASC LIMIT 10""")
def o3_top_features(spark, sf):
    importance = table(spark, sf, "events").groupBy(
        F.concat_ws("-", "event_type", (F.col("user_id") % 10).cast("string")).alias("feature")).agg(
        F.count(F.when(F.col("event_id") % 3 == 0, 1)).cast("double").alias("importance"))
    return keyed.top_features(importance, 10)


_SILVER_TABLES = {"eurostat_hicp": proxy.silver_index, "ecb_fx_eu": proxy.silver_fx,
                  "ecb_rates_eu": proxy.silver_rates, "energy_prices": proxy.silver_energy}
_UNION = "\nUNION ALL ".join(
    f"SELECT ts_date, geo, series_id, value, '{measure}' AS measure, {unit} AS unit, '{freq}' AS freq FROM {name}"
    for name, measure, unit, freq in [
        ("silver_index", "price_index", "'Index (2015=100)'", "M"), ("silver_fx", "exchange_rate", "NULL", "D"),
        ("silver_rates", "policy_rate", "'percent'", "D"), ("silver_energy", "energy_price", "'USD'", "M")])


@query("x1_all_series", f"""
SELECT date_trunc('month', ts_date)::DATE AS month, geo, series_id, measure, unit, freq, count(*) AS n, {r('max(value)')} AS highest
FROM ({_UNION}) GROUP BY ALL""", ("silver_index", "silver_fx", "silver_rates", "silver_energy"))
def x1_all_series(spark, sf):
    tables = []
    for name, read in _SILVER_TABLES.items():
        measure, unit, freq = dataset_labels(F.lit(name))
        tables.append(read(spark, sf).select(
            "ts_date", "geo", "series_id", "value", measure.alias("measure"), unit.alias("unit"), freq.alias("freq")))
    series = all_series(tables)
    return rounded(series.groupBy(F.trunc("ts_date", "month").alias("month"), "geo", "series_id", "measure", "unit", "freq").agg(
        F.count("*").alias("n"), F.max("value").alias("highest")))


@query("x2_actuals_and_nowcasts", f"SELECT month, geo, {r('index_value')} AS index_value, source FROM combined", ("combined",))
def x2_actuals_and_nowcasts(spark, sf):
    return rounded(views.actuals_and_nowcasts(*proxy.stored_gold(spark, sf)))


@query("x2_all_versions", f"""
SELECT month, geo, {r('hicp_index')} AS index_value, 'actual' AS source FROM headline
UNION ALL SELECT month, geo, {r('y_nowcast')}, 'nowcast' FROM nowcasts""", ("headline", "nowcasts"))
def x2_all_versions(spark, sf):
    return rounded(views.actuals_and_nowcasts(*proxy.stored_gold(spark, sf), all_versions=True))
