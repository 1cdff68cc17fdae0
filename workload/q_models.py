"""Feature matrix, walk-forward evaluation, pooled models and nowcasts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from macrotide.functions.numeric import ratio_change
from macrotide.operators import stats
from macrotide.operators.keyed import top_features
from macrotide.operators.windows import add_previous
from macrotide.plans import features as feature_plan
from macrotide.plans import gold, nowcast, views
from macrotide.session import cut_lineage, scratch_path
from workload import proxy
from workload.proxy import FEATURE_NAMES, TRAIN_STOP
from workload.q_tables import _METRIC_SQL, _cols
from workload.registry import cte, query, r, rounded

TREES = 300
WALK_TREES = 3  # of each fit of the walk-forward; the library default is 300, whose measured cost the README gives
TARGET_MONTH = date(2001, 12, 1)


@query("m1_feature_matrix", f"SELECT geo, month, month_of_year, quarter, {_cols(*[c for c in FEATURE_NAMES if c not in ('month_of_year', 'quarter')], 'hicp_mom', 'target_hicp_index')} FROM matrix", ("matrix",))
def m1_feature_matrix(spark, sf):
    return rounded(proxy.matrix(spark, sf))


@query("m1_inference_matrix", f"""
SELECT geo, month, {', '.join(r(f'coalesce(last_value({c} IGNORE NULLS) OVER a, first_value({c} IGNORE NULLS) OVER b)') + f' AS {c}' for c in ['lag_12m', 'fx_usd_eur_avg', 'policy_rate_eom', 'energy_price_usd'])}
FROM featured WINDOW a AS (PARTITION BY geo ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  b AS (PARTITION BY geo ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""", ("featured",))
def m1_inference_matrix(spark, sf):
    out = feature_plan.inference_matrix(proxy.nowcast_input(spark, sf))
    return rounded(out.select("geo", "month", "lag_12m", "fx_usd_eur_avg", "policy_rate_eom", "energy_price_usd"))


cte("wf_input", f"""
SELECT geo, month, hicp_mom, target_hicp_index, lag(target_hicp_index) OVER w AS previous_level, lag(hicp_mom) OVER w AS previous_mom
FROM matrix WINDOW w AS (PARTITION BY geo ORDER BY month)""", ("matrix",))
cte("baselines", f"""
WITH fitted AS (
  SELECT t.geo, t.month, t.hicp_mom, t.target_hicp_index, t.previous_level, t.previous_mom, avg(h.hicp_mom) AS mean_mom,
    regr_slope(h.hicp_mom, h.previous_mom) AS slope, regr_intercept(h.hicp_mom, h.previous_mom) AS intercept
  FROM wf_input t JOIN wf_input h ON h.geo = t.geo AND h.month < t.month
  WHERE t.month > DATE '{TRAIN_STOP}' GROUP BY ALL),
tall AS (
  SELECT *, 'expanding_mean' AS model, mean_mom AS y_pred_mom FROM fitted
  UNION ALL SELECT *, 'last_value', previous_mom FROM fitted
  UNION ALL SELECT *, 'expanding_linear', intercept + slope * previous_mom FROM fitted)
SELECT month, geo, model, target_hicp_index AS y_true_level, previous_level * (1 + y_pred_mom) AS y_pred_level,
  hicp_mom AS y_true_mom, y_pred_mom, target_hicp_index - previous_level * (1 + y_pred_mom) AS residual,
  abs(target_hicp_index - previous_level * (1 + y_pred_mom)) AS abs_error
FROM tall WHERE y_pred_mom IS NOT NULL""", ("wf_input",))


@query("m3_walk_forward_baselines", f"""
SELECT month, geo, model, {_cols('y_true_level', 'y_pred_level', 'y_true_mom', 'y_pred_mom', 'residual', 'abs_error', digits=5)} FROM baselines""", ("baselines",))
def m3_walk_forward_baselines(spark, sf):
    return rounded(nowcast.baseline_walk_forward(proxy.matrix(spark, sf), TRAIN_STOP), 5)


_PANEL_RATIO = """
SELECT geo, month, value AS target_hicp_index, value / nullif(lag(value) OVER (PARTITION BY geo ORDER BY month), 0) - 1 AS hicp_mom
FROM panel WHERE value IS NOT NULL"""


@query("m3_walk_forward_baselines_panel", f"""
SELECT month, geo, model, {_cols('y_true_level', 'y_pred_level', 'residual', digits=5)} FROM (
  SELECT month, geo, model, target_hicp_index AS y_true_level, previous_level * (1 + p) AS y_pred_level,
    target_hicp_index - previous_level * (1 + p) AS residual
  FROM (
    SELECT *, avg(hicp_mom) OVER (PARTITION BY geo ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS expanding_mean,
      lag(hicp_mom) OVER (PARTITION BY geo ORDER BY month) AS last_value,
      lag(target_hicp_index) OVER (PARTITION BY geo ORDER BY month) AS previous_level
    FROM ({_PANEL_RATIO}) WHERE hicp_mom IS NOT NULL)
  UNPIVOT (p FOR model IN (expanding_mean, last_value)) WHERE month > DATE '{TRAIN_STOP}' AND previous_level IS NOT NULL)""", ("panel",))
def m3_walk_forward_baselines_panel(spark, sf):
    levels = proxy.panel(spark, sf).filter(F.col("value").isNotNull()).withColumnRenamed("value", "target_hicp_index")
    changes = add_previous(levels, "target_hicp_index", ["geo"], "_before").withColumn(
        "hicp_mom", ratio_change("target_hicp_index", "_before")).filter(F.col("hicp_mom").isNotNull())
    rows = nowcast.baseline_walk_forward(changes, TRAIN_STOP, ("expanding_mean", "last_value"))
    return rounded(rows.select("month", "geo", "model", "y_true_level", "y_pred_level", "residual"), 5)


@query("m3_baseline_metrics", f"""
SELECT geo, model, {_cols(*stats.METRICS, digits=4)} FROM (
  SELECT geo, model, {_METRIC_SQL.format(y='y_true_level', p='y_pred_level')} FROM baselines GROUP BY 1, 2)""", ("baselines",))
def m3_baseline_metrics(spark, sf):
    rows = nowcast.baseline_walk_forward(proxy.matrix(spark, sf), TRAIN_STOP)
    return rounded(stats.regression_metrics(rows, ["geo", "model"], "y_true_level", "y_pred_level"), 4)


@query("m3_walk_forward_per_series", f"""
SELECT geo, count(*) AS n_months, {r('avg(abs_error)', 4)} AS baseline_mae, true AS model_is_better FROM baselines WHERE model = 'expanding_mean' GROUP BY 1""", ("baselines",))
def m3_walk_forward_per_series(spark, sf):
    matrix = cut_lineage(proxy.matrix(spark, sf), "matrix")
    rows = nowcast.walk_forward_pooled(matrix, FEATURE_NAMES, TRAIN_STOP, trees=WALK_TREES)
    beside = nowcast.errors_beside_baseline(rows, matrix, TRAIN_STOP)
    return rounded(beside.select("geo", "n_months", "baseline_mae", (F.col("mae") < F.col("baseline_mae")).alias("model_is_better")), 4)


@query("m3_walk_forward_keys", f"""
SELECT month, geo, {r('target_hicp_index')} AS y_true_level, {r('hicp_mom')} AS y_true_mom FROM wf_input
WHERE month > DATE '{TRAIN_STOP}' AND previous_level IS NOT NULL""", ("wf_input",))
def m3_walk_forward_keys(spark, sf):
    rows = nowcast.walk_forward_pooled(proxy.matrix(spark, sf), FEATURE_NAMES, TRAIN_STOP, seeds=(42,), trees=WALK_TREES)
    return rounded(rows.select("month", "geo", "y_true_level", "y_true_mom"))


@query("m3_walk_forward_pooled", f"""
SELECT month, geo, {r('target_hicp_index')} AS y_true_level, {r('hicp_mom')} AS y_true_mom, true AS level_follows FROM wf_input
WHERE month > DATE '{TRAIN_STOP}' AND previous_level IS NOT NULL""", ("wf_input",))
def m3_walk_forward_pooled(spark, sf):
    rows = nowcast.walk_forward_pooled(proxy.matrix(spark, sf), FEATURE_NAMES, TRAIN_STOP, trees=WALK_TREES)
    follows = F.abs(F.col("residual") - (F.col("y_true_level") - F.col("y_pred_level"))) < 1e-6
    return rounded(rows.select("month", "geo", "y_true_level", "y_true_mom", (follows & F.col("y_pred_mom").isNotNull()).alias("level_follows")))


def _fitted(spark, sf):
    """Model, training rows, test rows and the stored input they come from: the tables are read for that alone."""
    source = cut_lineage(proxy.nowcast_input(spark, sf), "input")
    matrix = cut_lineage(feature_plan.training_matrix(source, TRAIN_STOP), "matrix")
    train, test = feature_plan.split_at(matrix, TRAIN_STOP)
    return nowcast.fit_pooled(train, FEATURE_NAMES, TREES), train, test, source


@query("m2_pooled_model", f"""
WITH t AS (SELECT *, month <= DATE '{TRAIN_STOP}' AS training, avg(hicp_mom) FILTER (WHERE month <= DATE '{TRAIN_STOP}') OVER () AS mean FROM matrix)
SELECT geo, count(*) FILTER (WHERE training) AS n_train, count(*) FILTER (WHERE NOT training) AS n_test,
  {r('avg(abs(hicp_mom - mean)) FILTER (WHERE training)', 5)} AS spread_around_mean, true AS fit_takes_half_of_it, 0::BIGINT AS unscored FROM t GROUP BY geo""", ("matrix",))
def m2_pooled_model(spark, sf):
    """Rows, training error against the spread around the training mean, and test rows without a score, per geo."""
    model, train, test, _ = _fitted(spark, sf)
    mean = train.agg(F.avg("hicp_mom")).first()[0]
    scored = model.transform(train).groupBy("geo").agg(
        F.count("*").alias("n_train"), F.avg(F.abs(F.col("hicp_mom") - mean)).alias("spread_around_mean"),
        F.avg(F.abs(F.col("hicp_mom") - F.col("y_pred_mom"))).alias("error"))
    tested = model.transform(test).groupBy("geo").agg(F.count("*").alias("n_test"), F.count_if(F.col("y_pred_mom").isNull() | F.isnan("y_pred_mom")).alias("unscored"))
    return rounded(scored.join(tested, "geo").select(
        "geo", "n_train", "n_test", "spread_around_mean", (F.col("error") < 0.5 * F.col("spread_around_mean")).alias("fit_takes_half_of_it"), "unscored"), 5)


@query("m5_feature_importance", f"""
SELECT feature, count(DISTINCT round(value, 9)) AS n_values, true AS weight_needs_values, true AS rank_follows_weight FROM (
  SELECT {', '.join(f'{c}::DOUBLE AS {c}' for c in FEATURE_NAMES)} FROM matrix WHERE month <= DATE '{TRAIN_STOP}')
UNPIVOT INCLUDE NULLS (value FOR feature IN ({', '.join(FEATURE_NAMES)})) GROUP BY 1""", ("matrix",))
def m5_feature_importance(spark, sf):
    """Every feature with its number of training values; constant ones have no weight, and the ranked list is in order of weight."""
    model, train, _, _ = _fitted(spark, sf)
    weights = cut_lineage(nowcast.feature_importance(model, spark), "importance")
    ranked = top_features(weights, len(FEATURE_NAMES)).collect()  # one row per feature
    falling = all(a["importance"] >= b["importance"] for a, b in zip(ranked, ranked[1:])) and abs(sum(x["importance"] for x in ranked) - 1) < 1e-9
    values = train.select([F.round(F.col(c).cast("double"), 9).alias(c) for c in FEATURE_NAMES]).unpivot([], FEATURE_NAMES, "feature", "value").groupBy("feature").agg(
        F.countDistinct("value").alias("n_values"))
    return weights.join(values, "feature").select(
        "feature", "n_values", ((F.col("importance") == 0) | (F.col("n_values") > 1)).alias("weight_needs_values"), F.lit(falling).alias("rank_follows_weight"))


@query("m8_save_and_load", f"""
SELECT geo, month, true AS same FROM matrix WHERE month > DATE '{TRAIN_STOP}'""", ("matrix",))
def m8_save_and_load(spark, sf):
    model, _, test, _ = _fitted(spark, sf)
    loaded = nowcast.load_model(nowcast.save_model(model, scratch_path(spark, "model")))
    before = model.transform(test).select("geo", "month", F.col("y_pred_mom").alias("a"))
    after = loaded.transform(test).select("geo", "month", F.col("y_pred_mom").alias("b"))
    return before.join(after, ["geo", "month"]).select("geo", "month", (F.col("a") == F.col("b")).alias("same"))


@query("m6_nowcast_future_month", f"""
SELECT geo, DATE '{TARGET_MONTH}' AS month, max(month) AS last_known_month, {r('arg_max(target_hicp_index, month)')} AS last_known_level,
  true AS level_follows, {r('any_value(lowest)')} AS lowest_change, {r('any_value(highest)')} AS highest_change, true AS change_is_near_them
FROM nowcast_input, (SELECT min(hicp_mom) AS lowest, max(hicp_mom) AS highest FROM matrix WHERE month <= DATE '{TRAIN_STOP}')
WHERE target_hicp_index IS NOT NULL AND month < DATE '{TARGET_MONTH}' GROUP BY 1""", ("nowcast_input", "matrix"))
def m6_nowcast_future_month(spark, sf):
    """Nowcast rows; the predicted change lies within the training changes, or outside by a tenth of their range at most."""
    model, train, _, source = _fitted(spark, sf)
    out = nowcast.nowcast_month(model, source, TARGET_MONTH)
    low, high = train.agg(F.min("hicp_mom"), F.max("hicp_mom")).first()
    follows = F.abs(F.col("level_pred") - F.col("last_known_level") * (1 + F.col("mom_pred"))) < 1e-9 * F.col("last_known_level")
    near = F.col("mom_pred").between(low - 0.1 * (high - low), high + 0.1 * (high - low))
    return rounded(out.select("geo", "month", "last_known_month", "last_known_level", follows.alias("level_follows"), F.lit(low).alias("lowest_change"),
                              F.lit(high).alias("highest_change"), near.alias("change_is_near_them")))


@query("m7_key_figures", f"""
WITH act AS (SELECT *, row_number() OVER (PARTITION BY geo ORDER BY month DESC) AS rk FROM hicp_wide WHERE source = 'actual'),
cur AS (SELECT geo, max(CASE WHEN rk = 1 THEN month END) AS latest_actual_date, max(CASE WHEN rk = 1 THEN index_value END) AS current_hicp_index,
    max(CASE WHEN rk = 1 THEN hicp_yoy END) AS current_hicp_yoy, CASE WHEN count(*) >= 3 THEN avg(hicp_yoy) END AS recent_trend_3m
  FROM act WHERE rk <= 3 GROUP BY 1),
nc AS (SELECT * FROM hicp_wide WHERE source = 'nowcast' QUALIFY row_number() OVER (PARTITION BY geo ORDER BY month DESC) = 1),
mac AS (SELECT * FROM macro_wide ORDER BY ref_month DESC LIMIT 1)
SELECT cur.geo, latest_actual_date, {_cols('current_hicp_index', 'current_hicp_yoy', 'recent_trend_3m')}, nc.month AS nowcast_date,
  {r('nc.index_value')} AS nowcast_hicp_index, b.month AS nowcast_base_date, {r('b.hicp_index')} AS nowcast_base_index,
  {r('coalesce(nc.index_value / nullif(b.hicp_index, 0) - 1, nc.hicp_yoy)')} AS nowcast_hicp_yoy,
  {r('mac.fx_usd_eur_avg_m')} AS current_fx, {r('mac.brent_crude_m')} AS current_brent, {r('mac.nat_gas_m')} AS current_nat_gas,
  {r('mac.policy_rate_eom_m')} AS current_policy_rate
FROM cur LEFT JOIN nc ON nc.geo = cur.geo LEFT JOIN headline b ON b.geo = nc.geo AND b.month = (nc.month - INTERVAL 12 MONTH)::DATE
LEFT JOIN mac ON true""", ("hicp_wide", "macro_wide", "headline"))
def m7_key_figures(spark, sf):
    wide = views.hicp_wide(*proxy.stored_gold(spark, sf), geo=None)
    return rounded(views.key_figures(wide, views.macro_wide(proxy.macro(spark, sf))))
