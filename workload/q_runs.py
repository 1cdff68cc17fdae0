"""Data quality, run log, model registry and keyed changes."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macrotide.operators import keyed, profiles, quality, registry, rules, runlog, versions
from macrotide.plans import batch, gold, views
from macrotide.schemas import REQUIRED
from macrotide.session import cut_lineage, scratch_path
from macrotide.sources.bronze import stage
from workload import proxy
from workload.proxy import table
from workload.q_tables import run_metrics
from workload.registry import cte, query, r, rounded

# ---- run log ------------------------------------------------------------------------------------


def _run_id():
    return F.concat_ws("-", F.lit("run"), F.col("user_id").cast("string"), F.date_format("ts", "dd"))


def status_events(spark, sf) -> DataFrame:
    """A user's events of a day are the status rows of one run: even ones start it, odd ones end it."""
    e = table(spark, sf, "events")
    failed = F.col("event_type") == "error"
    return e.select(
        _run_id().alias("run_id"), F.col("ts").alias("started_at"),
        F.when(F.col("event_id") % 2 == 1, F.col("ts")).alias("ended_at"),
        F.when(F.col("event_id") % 2 == 0, "running").when(failed, "failed").otherwise("success").alias("status"),
        F.lit("full").alias("mode"), F.lit(None).cast("string").alias("log_file"), F.col("ts").alias("event_ts"))


def stage_events(spark, sf) -> DataFrame:
    failed = F.col("event_type") == "error"
    return table(spark, sf, "events").select(
        _run_id().alias("run_id"), F.col("event_type").alias("stage_name"),
        "ts", F.when(failed, "failed").otherwise("success").alias("status"),
        (F.col("event_id") % 1000).alias("row_count"), F.when(failed, "stage failed").alias("message"))


cte("current_runs", """
SELECT 'run-' || user_id || strftime(ts, '-%d') AS run_id, min(ts) AS started_at, arg_max(CASE WHEN event_id % 2 = 1 THEN epoch_us(ts) ELSE -1 END, ts) AS ended_us,
  arg_max(CASE WHEN event_id % 2 = 0 THEN 'running' WHEN event_type = 'error' THEN 'failed' ELSE 'success' END, ts) AS status
FROM events GROUP BY 1""")
cte("stage_metrics", """
SELECT 'run-' || user_id || strftime(ts, '-%d') AS run_id, event_type AS stage_name, min(ts) AS started_at, max(ts) AS ended_at,
  floor(epoch_us(max(ts)) / 1000000.0)::BIGINT - floor(epoch_us(min(ts)) / 1000000.0)::BIGINT AS duration_seconds,
  sum(event_id % 1000)::BIGINT AS row_count,
  CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
  CASE WHEN event_type = 'error' THEN 'stage failed' END AS error_message
FROM events GROUP BY 1, event_type""")


@query("k4_run_status", """
SELECT run_id, started_at, CASE WHEN ended_us >= 0 THEN make_timestamp(ended_us) END AS ended_at, status, 'full' AS mode FROM current_runs""", ("current_runs",))
def k4_run_status(spark, sf):
    return runlog.current_runs(status_events(spark, sf)).drop("log_file")


@query("k5_stage_metrics", "SELECT * FROM stage_metrics", ("stage_metrics",))
def k5_stage_metrics(spark, sf):
    return runlog.stage_metrics(stage_events(spark, sf))


_RECENT = """
SELECT r.run_id, r.started_at AS run_started, s.stage_name, s.duration_seconds AS stage_duration_sec, s.row_count,
  round((ended_us - epoch_us(r.started_at)) / 60000000.0::DOUBLE, 1) AS minutes, r.ended_us >= 0 AS ended,
  r.status AS run_status, s.status AS stage_status
FROM current_runs r LEFT JOIN stage_metrics s ON s.run_id = r.run_id
WHERE r.started_at >= DATE '2024-01-28' - INTERVAL 7 DAY"""


@query("q6_recent_activity", f"""
SELECT run_id, run_started, CASE WHEN ended THEN minutes END AS total_duration_min, run_status, stage_name, stage_duration_sec, row_count, stage_status
FROM ({_RECENT})""", ("current_runs", "stage_metrics"))
def q6_recent_activity(spark, sf):
    runs, stages = runlog.current_runs(status_events(spark, sf)), runlog.stage_metrics(stage_events(spark, sf))
    return runlog.recent_activity(runs, stages, date(2024, 1, 28)).drop("run_ended")


@query("j4_runs_and_stages", """
SELECT r.run_id, r.status, s.stage_name FROM current_runs r LEFT JOIN stage_metrics s
  ON s.run_id = r.run_id AND s.row_count > 900""", ("current_runs", "stage_metrics"))
def j4_runs_and_stages(spark, sf):
    runs = runlog.current_runs(status_events(spark, sf)).select("run_id", "status")
    stages = runlog.stage_metrics(stage_events(spark, sf)).filter(F.col("row_count") > 900)
    return runs.join(stages.select("run_id", "stage_name"), "run_id", "left")


# ---- registry -----------------------------------------------------------------------------------


def model_runs(spark, sf) -> DataFrame:
    key = F.col("o_custkey").cast("string")
    return table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").cast("timestamp").alias("started_at_utc"),
        F.max("o_orderdate").cast("timestamp").alias("finished_at_utc"),
        F.min(F.to_date("o_orderdate")).alias("train_start"), F.max(F.to_date("o_orderdate")).alias("train_end"),
        F.count("*").alias("n"),
    ).select(
        F.concat(F.lit("run-"), key).alias("run_id"), F.concat(F.lit("v"), key).alias("model_version"),
        F.lit("gbt_regressor").alias("model_type"), "started_at_utc", "finished_at_utc", "train_start", "train_end",
        F.lit("hicp_mom").alias("target"), F.array(F.lit("lag_1m"), F.lit("lag_3m")).alias("features"),
        F.concat(F.lit("models/"), key).alias("artifact_path"),
        F.create_map(F.lit("trees"), F.col("n").cast("string"), F.lit("depth"), F.lit("3")).alias("params"))


cte("model_runs", """
SELECT 'run-' || o_custkey AS run_id, 'v' || o_custkey AS model_version, min(o_orderdate) AS started_at, max(o_orderdate) AS finished_at, count(*) AS n
FROM orders GROUP BY o_custkey""")


@query("k1_registry_runs", """
SELECT run_id, model_version, epoch_us(started_at) AS started_us, started_at::DATE AS train_start, finished_at::DATE AS train_end,
  'lag_1m,lag_3m' AS features FROM model_runs""", ("model_runs",))
def k1_registry_runs(spark, sf):
    root = scratch_path(spark, "ml")
    registry.append(model_runs(spark, sf), root, "runs")
    return registry.read(spark, root, "runs").select(
        "run_id", "model_version", F.unix_micros("started_at_utc").alias("started_us"), "train_start", "train_end",
        registry.feature_list().alias("features"))


@query("k1_registry_params", """
SELECT run_id, 'trees' AS name, n::VARCHAR AS value FROM model_runs UNION ALL SELECT run_id, 'depth', '3' FROM model_runs""", ("model_runs",))
def k1_registry_params(spark, sf):
    root = scratch_path(spark, "ml")
    registry.append(registry.params_rows(model_runs(spark, sf)), root, "params")
    return registry.read(spark, root, "params")


@query("k1_registry_metrics", """
SELECT 'run-' || o_custkey AS run_id, 'mae' AS metric, min(o_totalprice) AS value FROM orders GROUP BY o_custkey
UNION ALL SELECT 'run-' || o_custkey, 'max_error', max(o_totalprice) FROM orders GROUP BY o_custkey""")
def k1_registry_metrics(spark, sf):
    root = scratch_path(spark, "ml")
    registry.append(run_metrics(spark, sf), root, "metrics")
    return registry.read(spark, root, "metrics")


@query("k1_registry_importance", """
SELECT 'run-' || o_custkey AS run_id, o_orderpriority AS feature, round(sum(o_totalprice), 2) AS importance FROM orders GROUP BY o_custkey, o_orderpriority""")
def k1_registry_importance(spark, sf):
    root = scratch_path(spark, "ml")
    rows = table(spark, sf, "orders").groupBy(F.concat(F.lit("run-"), F.col("o_custkey").cast("string")).alias("run_id"), F.col("o_orderpriority").alias("feature")).agg(
        F.sum("o_totalprice").alias("importance"))
    registry.append(rows, root, "feature_importance")
    return rounded(registry.read(spark, root, "feature_importance"), 2)


@query("k1_registry_predictions", f"""
SELECT model_version AS run_id, month, geo, {r('y_actual')} AS y_true, {r('y_nowcast')} AS y_pred, {r('residual')} AS residual FROM nowcasts""", ("nowcasts",))
def k1_registry_predictions(spark, sf):
    root = scratch_path(spark, "ml")
    rows = proxy.nowcasts(proxy.headline(spark, sf)).withColumnsRenamed({"model_version": "run_id", "y_actual": "y_true", "y_nowcast": "y_pred"})
    registry.append(rows, root, "predictions")
    return rounded(registry.read(spark, root, "predictions"))


@query("k2_append_nowcasts", f"""
SELECT month, geo, model_version, {r('y_nowcast')} AS y_nowcast FROM nowcasts
UNION ALL SELECT month, geo, 'walk', {r('hicp_index')} FROM headline""", ("nowcasts", "headline"))
def k2_append_nowcasts(spark, sf):
    root = scratch_path(spark, "ml")
    head, nowcasts = proxy.stored_gold(spark, sf)
    registry.append(nowcasts, root, "nowcast_output")
    walk = head.select(
        "month", "geo", F.col("hicp_index").alias("y_pred_level"), F.col("hicp_index").alias("y_true_level"), F.lit(0.0).alias("residual"))
    registry.append(registry.nowcast_rows(walk, "walk", F.lit("2024-01-01").cast("timestamp")), root, "nowcast_output")
    return rounded(registry.read(spark, root, "nowcast_output").select("month", "geo", "model_version", "y_nowcast"))


@query("k3_replace_by_key", f"""
SELECT month, geo, model_version, {r('y_nowcast')} AS y_nowcast FROM nowcasts WHERE month < DATE '2001-01-01'
UNION ALL SELECT month, geo, 'nowcast_future', {r('y_actual')} FROM nowcasts WHERE month >= DATE '2001-01-01' AND model_version = 'v1'""", ("nowcasts",))
def k3_replace_by_key(spark, sf):
    old = proxy.stored_gold(spark, sf)[1].select("month", "geo", "model_version", "y_nowcast", "y_actual")
    new = old.filter((F.col("month") >= F.lit(date(2001, 1, 1))) & (F.col("model_version") == "v1")).select(
        "month", "geo", F.lit("nowcast_future").alias("model_version"), F.col("y_actual").alias("y_nowcast"), "y_actual")
    return rounded(keyed.replace_by_key(old, new, ["month", "geo"]).drop("y_actual"))


@query("k3_replace_panel", f"""
SELECT geo, month, {r('value')} AS value FROM panel p WHERE NOT EXISTS (
  SELECT 1 FROM orders o WHERE o.o_orderstatus = 'P' AND 'C' || o.o_custkey = p.geo AND date_trunc('month', o.o_orderdate)::DATE = p.month)
UNION ALL SELECT 'C' || o_custkey, date_trunc('month', o_orderdate)::DATE, {r('max(o_totalprice) / 3001.0::DOUBLE')}
FROM orders WHERE o_orderstatus = 'P' GROUP BY 1, 2""", ("panel",))
def k3_replace_panel(spark, sf):
    o = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "P")
    new = o.groupBy(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("geo"), F.trunc("o_orderdate", "month").alias("month")).agg(
        (F.max("o_totalprice") / 3001.0).alias("value"))
    return rounded(keyed.replace_by_key(proxy.panel(spark, sf), new, ["geo", "month"]))


def _panel_changes(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "P")
    return o.groupBy(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("geo"), F.trunc("o_orderdate", "month").alias("month")).agg(
        (F.max("o_totalprice") / 3001.0).alias("value"))


def _replaced_panel(spark, sf) -> tuple[str, int]:
    """Root of a versioned panel in which the same rows were replaced twice, and its first version."""
    root = scratch_path(spark, "panel")
    first = versions.create(proxy.panel(spark, sf).select("geo", "month", "value"), root, "month")
    new = cut_lineage(_panel_changes(spark, sf), "changes")
    for _ in range(2):
        versions.replace(new, root, ["geo", "month"])
    return root, first


@query("k3_replace_versioned", f"""
SELECT geo, month, {r('value')} AS value FROM panel p WHERE NOT EXISTS (
  SELECT 1 FROM orders o WHERE o.o_orderstatus = 'P' AND 'C' || o.o_custkey = p.geo AND date_trunc('month', o.o_orderdate)::DATE = p.month)
UNION ALL SELECT 'C' || o_custkey, date_trunc('month', o_orderdate)::DATE, {r('max(o_totalprice) / 3001.0::DOUBLE')}
FROM orders WHERE o_orderstatus = 'P' GROUP BY 1, 2""", ("panel",))
def k3_replace_versioned(spark, sf):
    return rounded(versions.read(spark, _replaced_panel(spark, sf)[0]))


@query("k3_untouched_parts", """
SELECT month, month NOT IN (SELECT date_trunc('month', o_orderdate)::DATE FROM orders WHERE o_orderstatus = 'P') AS same_files FROM (
  SELECT month FROM panel UNION SELECT date_trunc('month', o_orderdate)::DATE FROM orders WHERE o_orderstatus = 'P')""", ("panel",))
def k3_untouched_parts(spark, sf):
    root, first = _replaced_panel(spark, sf)
    before, now = versions.parts(spark, root, first).withColumnRenamed("folder", "was"), versions.parts(spark, root)
    return now.join(before, "part", "left").select(F.to_date("part").alias("month"), F.coalesce(F.col("folder") == F.col("was"), F.lit(False)).alias("same_files"))


@query("k5_observed_batch", "\nUNION ALL ".join(
    f"SELECT '{stage}' AS stage_name, {count} AS row_count, 'success' AS status, true AS as_read_back FROM {source}" for stage, count, source in (
        ("gold.fact_hicp", "count(*)", "fact_index"), ("gold.headline", "count(*)", "headline"), ("gold.fact_macro", "count(*)", "fact_macro"),
        ("gold.fact_cpi_features", "count(*)", "features"), ("ml.nowcast_output", "count(*)", "nowcasts"), ("report.hicp_wide", "count(*)", "hicp_wide"),
        ("report.macro_wide", "count(*)", "macro_wide"), ("report.key_figures", "count(DISTINCT geo)", "hicp_wide"))),
    ("fact_index", "headline", "fact_macro", "features", "nowcasts", "hicp_wide", "macro_wide"))
def k5_observed_batch(spark, sf):
    """Rows of every stage of a batch from staged rows to key figures, as counted by the writes, beside the stored tables."""
    root = scratch_path(spark, "batch")
    tables = batch.Batch(spark, root, "run").run({
        "gold.fact_hicp": lambda _: proxy.index(spark, sf),
        "gold.headline": lambda t: proxy.headline_of(t["gold.fact_hicp"]),
        "gold.fact_macro": lambda _: proxy.macro(spark, sf),
        "gold.fact_cpi_features": lambda t: gold.fact_cpi_features(t["gold.fact_hicp"], t["gold.fact_macro"]),
        "ml.nowcast_output": lambda t: proxy.nowcasts(t["gold.headline"]),
        "report.hicp_wide": lambda t: views.hicp_wide(t["gold.headline"], t["ml.nowcast_output"], geo=None),
        "report.macro_wide": lambda t: views.macro_wide(t["gold.fact_macro"]),
        "report.key_figures": lambda t: views.key_figures(t["report.hicp_wide"], t["report.macro_wide"])})
    log = runlog.stage_metrics(registry.read(spark, root, "stage_events"))
    back = quality.row_counts(tables).withColumnRenamed("table_name", "stage_name")
    return log.join(back, "stage_name").select("stage_name", "row_count", "status", (F.col("row_count") == F.col("n_rows")).alias("as_read_back"))


@query("j5_latest_run_metrics", """
SELECT r.model_version, epoch_us(r.finished_at) AS finished_us, m.metric, m.value FROM model_runs r JOIN (
  SELECT 'run-' || o_custkey AS run_id, 'mae' AS metric, min(o_totalprice) AS value FROM orders GROUP BY o_custkey
  UNION ALL SELECT 'run-' || o_custkey, 'max_error', max(o_totalprice) FROM orders GROUP BY o_custkey) m USING (run_id)
WHERE r.finished_at = (SELECT max(finished_at) FROM model_runs)""", ("model_runs",))
def j5_latest_run_metrics(spark, sf):
    out = registry.latest_run_metrics(model_runs(spark, sf), run_metrics(spark, sf))
    return out.select("model_version", F.unix_micros("finished_at_utc").alias("finished_us"), "metric", "value")


# ---- data quality -------------------------------------------------------------------------------


@query("q1_not_null", """
SELECT 'not_null' AS rule, column_name, failures::BIGINT AS failures FROM (
  SELECT count(*) FILTER (WHERE month IS NULL) AS month, count(*) FILTER (WHERE geo IS NULL) AS geo,
    count(*) FILTER (WHERE hicp_index IS NULL) AS hicp_index FROM fact_index)
UNPIVOT (failures FOR column_name IN (month, geo, hicp_index))""", ("fact_index",))
def q1_not_null(spark, sf):
    return quality.not_null(proxy.index(spark, sf), ["month", "geo", "hicp_index"])


@query("q2_unique", """
SELECT 'unique' AS rule, 'l_orderkey,l_linenumber' AS column_name, count(*) AS failures FROM (
  SELECT 1 FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""")
def q2_unique(spark, sf):
    return quality.unique(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("q3_accepted_values", """
SELECT 'accepted_values' AS rule, 'event_type' AS column_name, count(*) AS failures FROM events
WHERE event_type NOT IN ('click', 'view', 'purchase')""")
def q3_accepted_values(spark, sf):
    return quality.accepted_values(table(spark, sf, "events"), "event_type", ["click", "view", "purchase"])


@query("q4_layer_reconciliation", """
SELECT dataset, left_rows, right_rows, left_rows - right_rows AS difference FROM
  (SELECT dataset, count(*) AS left_rows FROM staged_events GROUP BY 1) JOIN
  (SELECT dataset, count(*) AS right_rows FROM lww_events GROUP BY 1) USING (dataset)""", ("staged_events", "lww_events"))
def q4_layer_reconciliation(spark, sf):
    staged = stage(proxy.bronze_events(spark, sf))
    return quality.reconcile(staged, keyed.last_write_wins(staged, ["dataset", "dt", "geo", "series_id"]))


@query("q5_column_profile_exact", "\nUNION ALL ".join(
    f"SELECT 'source' AS layer, 'orders' AS table_name, '{c}' AS column_name, '{t}' AS data_type, {i} AS position, "
    f"count(*) FILTER (WHERE {c} IS NULL) AS n_null, count(DISTINCT {c}) AS n_distinct FROM orders"
    for i, (c, t) in enumerate([("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
                                ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")], start=1)))
def q5_column_profile_exact(spark, sf):
    return quality.column_profile(table(spark, sf, "orders"), "source", "orders", exact=True)


@query("q5_column_profile_approx", """
SELECT column_name, true AS within_a_tenth FROM (DESCRIBE lineitem)""")
def q5_column_profile_approx(spark, sf):
    rows = table(spark, sf, "lineitem")
    near = quality.column_profile(rows, "source", "lineitem")
    exact = quality.column_profile(rows, "source", "lineitem", exact=True).select("column_name", F.col("n_distinct").alias("n"))
    return near.join(exact, "column_name").select("column_name", (F.abs(F.col("n_distinct") - F.col("n")) <= 0.1 * F.col("n")).alias("within_a_tenth"))


@query("q5_profile_by_day", "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL) AS n_null, {low}::DOUBLE AS least, {high}::DOUBLE AS greatest, "
    f"true AS distinct_near FROM lineitem" for c, low, high in (
        ("l_orderkey", "min(l_orderkey)", "max(l_orderkey)"), ("l_extendedprice", "min(l_extendedprice)", "max(l_extendedprice)"),
        ("l_returnflag", "NULL", "NULL"))))
def q5_profile_by_day(spark, sf):
    """The profile united from stored days: half of them stored first, then the others, then some of these once more."""
    rows, names = table(spark, sf, "lineitem"), ["l_orderkey", "l_extendedprice", "l_returnflag"]
    root, year = scratch_path(spark, "profile"), F.year("l_shipdate")
    for days in (year < 1995, year >= 1995, year == 1997):
        profiles.store(rows.filter(days), root, "l_shipdate", names)
    exact = quality.column_profile(rows.select(*names), "source", "lineitem", exact=True).select("column_name", F.col("n_distinct").alias("n"))
    return profiles.profile(spark, root).join(exact, "column_name").select(
        "column_name", "n_rows", "n_null", "least", "greatest", (F.abs(F.col("n_distinct") - F.col("n")) <= 0.07 * F.col("n")).alias("distinct_near"))


@query("q7_non_empty", """
SELECT 'v_hicp_dashboard_wide' AS table_name, count(*) AS n_rows FROM hicp_wide UNION ALL
SELECT 'v_macro_monthly_wide', count(*) FROM macro_wide""", ("hicp_wide", "macro_wide"))
def q7_non_empty(spark, sf):
    return quality.row_counts({
        "v_hicp_dashboard_wide": views.hicp_wide(*proxy.stored_gold(spark, sf), geo=None),
        "v_macro_monthly_wide": views.macro_wide(proxy.macro(spark, sf))})


@query("q8_constraints", """
WITH t AS (SELECT CASE WHEN event_id % 7 <> 0 THEN date_trunc('month', ts)::DATE END AS month, CASE WHEN event_id % 11 <> 0 THEN event_type END AS geo,
    CASE WHEN event_id % 13 <> 0 THEN 'v' END AS model_version, CASE WHEN event_id % 17 <> 0 THEN value END AS y_nowcast,
    CASE WHEN event_id % 19 <> 0 THEN ts END AS created_at_utc FROM events)
SELECT 'not_null' AS rule, column_name, failures::BIGINT AS failures FROM (
  SELECT count(*) FILTER (WHERE month IS NULL) AS month, count(*) FILTER (WHERE geo IS NULL) AS geo, count(*) FILTER (WHERE model_version IS NULL) AS model_version,
    count(*) FILTER (WHERE y_nowcast IS NULL) AS y_nowcast, count(*) FILTER (WHERE created_at_utc IS NULL) AS created_at_utc FROM t)
UNPIVOT (failures FOR column_name IN (month, geo, model_version, y_nowcast, created_at_utc))
UNION ALL SELECT 'unique', 'month,geo', count(*) FROM (SELECT 1 FROM t WHERE month IS NOT NULL AND geo IS NOT NULL GROUP BY month, geo HAVING count(*) > 1)""")
def q8_constraints(spark, sf):
    n = F.col("event_id")
    rows = table(spark, sf, "events").select(
        F.when(n % 7 != 0, F.trunc("ts", "month")).alias("month"), F.when(n % 11 != 0, F.col("event_type")).alias("geo"),
        F.when(n % 13 != 0, F.lit("v")).alias("model_version"), F.when(n % 17 != 0, F.col("value")).alias("y_nowcast"),
        F.when(n % 19 != 0, F.col("ts")).alias("created_at_utc"))
    return quality.check_constraints(rows, REQUIRED["nowcast_output"], ["month", "geo"])


def _declared_sql() -> str:
    """The declared rules one by one, as a reader of the declaration would write them."""
    source = {"dim_time": "spine", "fact_hicp": "fact_index", "fact_macro": "fact_macro", "gold_nowcast_input": "nowcast_input",
              "v_hicp_dashboard_wide": "hicp_wide", "v_macro_monthly_wide": "macro_wide"}
    one = "SELECT '{0}' AS table_name, '{1}' AS rule, '{2}' AS column_name, count(*) AS failures, count(*) = 0 AS passed FROM {3}".format
    parts = [one(t, "not_null", c, f"{source[t]} WHERE {c} IS NULL") for t, declared in rules.GOLD.items() for c in declared.required]
    parts.append(one("dim_time", "unique", "month", "(SELECT month FROM spine GROUP BY month HAVING count(*) > 1)"))
    parts.append(one("v_hicp_dashboard_wide", "accepted_values", "source", "hicp_wide WHERE source NOT IN ('actual', 'nowcast')"))
    return "\nUNION ALL ".join(parts)


@query("q8_declared_gold_rules", _declared_sql(), ("spine", "fact_index", "fact_macro", "nowcast_input", "hicp_wide", "macro_wide"))
def q8_declared_gold_rules(spark, sf):
    head, nowcasts = proxy.stored_gold(spark, sf)
    macro = cut_lineage(proxy.macro(spark, sf), "macro")
    return rules.check_all({
        "dim_time": proxy.spine(spark), "fact_hicp": proxy.index(spark, sf), "fact_macro": macro,
        "gold_nowcast_input": proxy.nowcast_input(spark, sf), "v_hicp_dashboard_wide": views.hicp_wide(head, nowcasts, geo=None),
        "v_macro_monthly_wide": views.macro_wide(macro)})


@query("q8_declared_rules_one_scan", """
WITH t AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 9 <> 0 THEN l_suppkey END AS supplier, l_returnflag,
    CASE WHEN l_linenumber = 7 THEN 'nan'::DOUBLE ELSE l_extendedprice END AS price FROM lineitem)
SELECT *, failures = 0 AS passed FROM (
  SELECT 'lineitem' AS table_name, 'not_null' AS rule, 'supplier' AS column_name, count(*) FILTER (WHERE supplier IS NULL) AS failures FROM t
  UNION ALL SELECT 'lineitem', 'not_null', 'l_orderkey', count(*) FILTER (WHERE l_orderkey IS NULL) FROM t
  UNION ALL SELECT 'lineitem', 'accepted_values', 'l_returnflag', count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')) FROM t
  UNION ALL SELECT 'lineitem', 'finite', 'price', count(*) FILTER (WHERE isnan(price) OR isinf(price)) FROM t
  UNION ALL SELECT 'lineitem', 'unique', 'l_orderkey,l_linenumber', count(*) FROM (
    SELECT 1 FROM t WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
  UNION ALL SELECT 'lineitem', 'unique', 'supplier,l_orderkey', count(*) FROM (
    SELECT 1 FROM t WHERE supplier IS NOT NULL AND l_orderkey IS NOT NULL GROUP BY supplier, l_orderkey HAVING count(*) > 1)
  UNION ALL SELECT 'lineitem', 'minimum_rows', 'supplier', count(*) FROM (
    SELECT 1 FROM t WHERE supplier IS NOT NULL GROUP BY supplier HAVING count(*) < 550))""")
def q8_declared_rules_one_scan(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_orderkey") % 9 != 0, F.col("l_suppkey")).alias("supplier"), "l_returnflag",
        F.when(F.col("l_linenumber") == 7, F.lit(float("nan"))).otherwise(F.col("l_extendedprice")).alias("price"))
    return rules.check(rows, "lineitem", rules.Rules(
        required=("supplier", "l_orderkey"), accepted={"l_returnflag": ("A", "N")}, finite=("price",),
        unique=(("l_orderkey", "l_linenumber"), ("supplier", "l_orderkey")), least={("supplier",): 550}))
