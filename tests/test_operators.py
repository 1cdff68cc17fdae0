import random
from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from macrotide.operators import keyed, orderstats, quality, registry, runlog, stats, versions, windows
from macrotide.session import scratch_path

T = lambda h: datetime(2024, 1, 1, h)
M = lambda n: date(2020 + (n - 1) // 12, (n - 1) % 12 + 1, 1)


def vintages(spark, rows):
    return spark.createDataFrame(rows, "dt string, geo string, series_id string, value double, source string, ingest_ts timestamp")


def test_newest_vintage_wins(spark):
    rows = [("d", "g", "s", 1.0, "a", T(10)), ("d", "g", "s", 2.0, "a", T(11)), ("d", "g", "s", 3.0, "a", None),
            ("d", None, "s", 4.0, "a", T(1)), ("d", None, "s", 5.0, "a", T(2)), ("d", "n", "s", 6.0, "a", None), ("d", "n", "s", 7.0, "a", None)]
    out = keyed.last_write_wins(vintages(spark, rows))
    assert sorted(r.value for r in out.collect()) == [2.0, 5.0, 7.0]


def test_vintage_ties_and_order_independence(spark):
    rows = [("d", "g", "s", 1.0, "a", T(10)), ("d", "g", "s", 2.0, "a", T(10)), ("d", "g", "s", 2.0, "b", T(10))]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        once = keyed.last_write_wins(vintages(spark, rows))
        assert [(r.value, r.source) for r in once.collect()] == [(2.0, "b")]
        assert keyed.last_write_wins(once.unionByName(vintages(spark, rows))).count() == 1


def test_newest_rows_settle_ties_by_arrival(spark):
    tied = spark.range(0, 4000, 1, 8).select(F.col("id"), F.lit(T(10)).alias("ingest_ts"), (F.col("id") % 7).alias("value"))
    for parts in (1, 3, 16):
        out = keyed.newest_rows(tied.repartition(parts, F.xxhash64("id")), ["ingest_ts"], 5, "id").collect()
        assert [r.id for r in out] == [0, 1, 2, 3, 4]


def test_hot_key_sends_one_row_per_task(spark):
    df = spark.range(0, 3000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("stamp"))
    out = keyed.latest_by(df, ["k"], [F.col("stamp").desc()])
    assert out.filter("k = 'hot'").first().stamp == 2997
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.rindex("WindowGroupLimit")


def test_replace_by_key_is_idempotent(spark):
    old = spark.createDataFrame([(M(1), "g", "v1"), (M(1), "g", "v2"), (M(2), "g", "v1")], "month date, geo string, v string")
    new = spark.createDataFrame([(M(1), "g", "n")], "month date, geo string, v string")
    once = keyed.replace_by_key(old, new, ["month", "geo"])
    twice = keyed.replace_by_key(once, new, ["month", "geo"])
    expected = [(M(1), "g", "n"), (M(2), "g", "v1")]
    assert sorted(map(tuple, once.collect())) == expected == sorted(map(tuple, twice.collect()))


def test_append_if_absent(spark):
    df = spark.createDataFrame([(M(1), "g", 1.0)], "month date, geo string, x double")
    new = spark.createDataFrame([(M(1), "g"), (M(2), "g")], "month date, geo string")
    assert sorted(map(tuple, keyed.append_if_absent(df, new, ["month", "geo"]).collect())) == [(M(1), "g", 1.0), (M(2), "g", None)]


def series(spark, values, start=1, geo="g"):
    rows = [(geo, M(start + i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "geo string, month date, x double")


def test_lags_count_rows_or_months(spark):
    df = spark.createDataFrame([("g", M(1), 1.0), ("g", M(3), 3.0)], "geo string, month date, x double")
    by_row = windows.add_lags(df, "x", ["geo"], (1,)).orderBy("month").collect()
    by_month = windows.add_calendar_lags(df, "x", ["geo"], (1, 3)).orderBy("month").collect()
    assert by_row[1].lag_1m == 1.0 and by_month[1].lag_1m is None
    year = windows.earlier_value(series(spark, [float(i) for i in range(14)]), ["geo"], "x", {"ago": 12}).orderBy("month").collect()
    assert [r.ago for r in year][-3:] == [None, 0.0, 1.0]


def test_lags_agree_on_complete_months(spark):
    df = series(spark, [float(i * i) for i in range(30)])
    a = windows.add_lags(df, "x", ["geo"]).orderBy("month").collect()
    b = windows.add_calendar_lags(df, "x", ["geo"]).orderBy("month").collect()
    assert a == b


def test_densify(spark):
    df = spark.createDataFrame([("g", M(2), 1.0), ("g", M(4), 3.0), ("g", M(5), None), ("h", M(11), 1.0), ("h", M(13), 2.0),
                                ("r", M(1), 1.0), ("r", M(1), 2.0), ("r", None, 3.0)],
                               "geo string, month date, x double")
    repeated = windows.densify(df.filter("geo = 'r'"), ["geo"]).collect()
    assert sorted(r.x for r in repeated) == [1.0, 2.0, 3.0]
    df = df.filter("geo <> 'r'")
    out = windows.densify(df, ["geo"]).orderBy("geo", "month").collect()
    assert [(r.geo, r.month, r.x) for r in out] == [
        ("g", M(2), 1.0), ("g", M(3), None), ("g", M(4), 3.0), ("g", M(5), None), ("h", M(11), 1.0), ("h", M(12), None), ("h", M(13), 2.0)]


def test_leak_free_rolling(spark):
    out = windows.add_leak_free_rolling(series(spark, [10.0, None, 12.0, 13.0]), ["x", "absent"], ["geo"], widths=(3,)).orderBy("month").collect()
    assert [r.x_ma3 for r in out] == [None, 10.0, 10.0, 11.0]
    assert [round(r.x_std3, 8) for r in out] == [0.0, 0.0, 0.0, 1.41421356]


def test_rolling_matches_pandas(spark):
    rng = np.random.default_rng(0)
    values = [None if rng.random() < 0.2 else float(v) for v in rng.normal(size=60)]
    out = windows.add_leak_free_rolling(series(spark, values), ["x"], ["geo"]).orderBy("month").toPandas()
    shifted = pd.Series(values, dtype=float).shift(1)
    for w in (3, 6, 12):
        np.testing.assert_allclose(out[f"x_ma{w}"].astype(float), shifted.rolling(w, min_periods=1).mean(), atol=1e-12)
        np.testing.assert_allclose(out[f"x_std{w}"], shifted.rolling(w, min_periods=1).std().fillna(0.0), atol=1e-12)


def test_rolling_does_not_see_the_present(spark):
    values = [float(i) for i in range(24)]
    changed = values[:12] + [99.0] * 12
    a = windows.add_leak_free_rolling(series(spark, values), ["x"], ["geo"]).drop("x").orderBy("month").collect()
    b = windows.add_leak_free_rolling(series(spark, changed), ["x"], ["geo"]).drop("x").orderBy("month").collect()
    assert a[:13] == b[:13] and a[13:] != b[13:]


def test_fill(spark):
    out = windows.fill_forward_backward(series(spark, [None, 1.0, None, 3.0, None]), ["x"], ["geo"]).orderBy("month").collect()
    assert [r.x for r in out] == [1.0, 1.0, 1.0, 3.0, 3.0]


def clip_by_rank(values, low=0.05, high=0.05):
    present = sorted(v for v in values if v is not None)
    n = len(present)
    lo, hi = present[int(low * n)], present[n - int(high * n) - 1]
    return [None if v is None else min(max(v, lo), hi) for v in values]


@pytest.mark.parametrize("n", [7, 20, 59])
def test_winsorize(spark, n):
    rng = random.Random(n)
    values = [None if rng.random() < 0.1 else rng.choice([rng.gauss(0, 1), 0.5]) for _ in range(n)]
    df = series(spark, values)
    expected = clip_by_rank(values)
    assert [r.x for r in windows.winsorize(df, "x", ["geo"]).orderBy("month").collect()] == expected
    assert [r.x for r in orderstats.winsorize_large(df, "x", ["geo"]).orderBy("month").collect()] == expected


def test_missing_keys_form_a_group(spark):
    df = series(spark, [float(i) for i in range(40)], geo=None)
    small = [r.x for r in windows.winsorize(df, "x", ["geo"]).orderBy("month").collect()]
    large = [r.x for r in orderstats.winsorize_large(df, "x", ["geo"]).orderBy("month").collect()]
    assert small == large and small[0] == 2.0 and small[-1] == 37.0
    rows = df.select("geo", F.col("x").alias("y_true"), (F.col("x") + 1).alias("y_pred"))
    for bounded in (True, False):
        assert [r.mae for r in stats.regression_metrics(rows, ["geo"], bounded=bounded).collect()] == [1.0]


def test_winsorize_bounds_from_early_rows(spark):
    df = series(spark, [float(i) for i in range(40)] + [1000.0])
    out = windows.winsorize(df, "x", ["geo"], fit_on=F.col("month") <= F.lit(M(40))).orderBy("month").collect()
    assert out[0].x == 2.0 and out[-1].x == 37.0


@pytest.mark.parametrize("gathered", [10_000, 30])
@pytest.mark.parametrize("shape", ["normal", "ties", "skewed"])
def test_order_statistics_of_large_groups(spark, shape, gathered):
    """Against a plain sort; with 30 values gathered at most, intervals need several rounds."""
    rng = np.random.default_rng(3)
    draw = {"normal": lambda: rng.normal(size=60_000), "ties": lambda: rng.integers(0, 5, 60_000).astype(float),
            "skewed": lambda: np.exp(rng.normal(size=60_000) * 8)}[shape]()
    pdf = pd.DataFrame({"k": np.where(np.arange(60_000) % 3 == 0, "small", "hot"), "v": draw})
    df = spark.createDataFrame(pdf).repartition(8)
    n = F.col("n")
    out = orderstats.order_statistics(df, ["k"], "v", {
        "low": (0.05, F.floor(n * 0.05)), "mid": (0.5, F.floor((n - 1) * 0.5)), "top": (1.0, n - 1)}, gathered=gathered)
    for row in out.collect():
        ranked = np.sort(pdf.loc[pdf.k == row.k, "v"].to_numpy())
        assert row.n == len(ranked)
        assert (row.low, row.mid, row.top) == (ranked[int(len(ranked) * 0.05)], ranked[(len(ranked) - 1) // 2], ranked[-1])


def test_median_of_a_million_values_in_one_group(spark):
    """Distinct values, one frequent one at the edge of an interval, and no window over the group."""
    df = spark.range(1_000_000, numPartitions=8).select(F.lit(None).cast("string").alias("k"), F.when(F.col("id") % 2 == 0, -1.0).otherwise(
        (F.col("id") * 7919 % 1_000_003).cast("double")).alias("v"))
    values = np.sort(np.where(np.arange(1_000_000) % 2 == 0, -1.0, np.arange(1_000_000) * 7919 % 1_000_003))
    n = F.col("n")
    out = orderstats.order_statistics(df, ["k"], "v", {"last_tie": (0.5, F.lit(499_999)), "first_other": (0.5, F.lit(500_000)), "p90": (0.9, F.floor(n * 0.9))})
    assert tuple(out.first())[1:] == (1_000_000, values[499_999], values[500_000], values[900_000])
    bounds = orderstats.winsorize_large(df, "v", ["k"])
    assert "Window" not in bounds._jdf.queryExecution().executedPlan().toString()
    assert bounds.agg(F.max("v")).first()[0] == values[949_999]


def test_large_quantiles_interpolate(spark):
    values = np.random.default_rng(1).normal(size=25_001)
    df = spark.createDataFrame(pd.DataFrame({"k": 1, "v": values})).repartition(4)
    row = orderstats.quantiles(df, ["k"], "v", {"a": 0.5, "b": 0.9}).first()
    np.testing.assert_allclose([row.a, row.b], np.percentile(values, [50, 90]), rtol=1e-12)


@pytest.mark.parametrize("bounded", [True, False])
def test_metrics_fixture(spark, bounded):
    df = spark.createDataFrame([("m", 0.0, 1.0), ("m", 2.0, 2.0), ("m", 4.0, 2.0)], "model string, y_true double, y_pred double")
    row = stats.regression_metrics(df, ["model"], bounded=bounded).first().asDict()
    expected = {"mae": 1, "rmse": 1.29099445, "median_ae": 1, "max_error": 2, "p90_error": 1.8, "mape": 25, "huber_loss": 0.66666667, "r2": 0.375}
    for name, value in expected.items():
        assert row[name] == pytest.approx(value, abs=1e-8)


def test_metrics_tall_and_wide(spark):
    wide = spark.createDataFrame([("r", 1.0, None)], "run_id string, mae double, mape double")
    tall = stats.tall_metrics(wide, ["run_id"], ["mae", "mape"])
    assert [tuple(r) for r in tall.collect()] == [("r", "mae", 1.0)]
    assert [tuple(r) for r in stats.wide_metrics(tall, ["run_id"], ["mae", "mape"]).collect()] == [("r", 1.0, None)]


def test_quality_rules(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", float("nan")), (None, float("inf")), ("b", None)], "k string, v double")
    fails = lambda rules: {(r.rule, r.column_name): r.failures for r in rules.collect()}
    assert fails(quality.not_null(df, ["k", "v"])) == {("not_null", "k"): 1, ("not_null", "v"): 1}
    assert fails(quality.check_constraints(df, ["k"], ["k"])) == {("not_null", "k"): 1, ("unique", "k"): 1}
    assert fails(quality.accepted_values(df, "k", ["a"])) == {("accepted_values", "k"): 1}
    assert fails(quality.non_finite(df, ["v"])) == {("finite", "v"): 2}
    assert [tuple(r) for r in quality.minimum_rows(df.dropna(subset=["k"]), ["k"], 2).collect()] == [("b", 1)]
    exact = {r.column_name: (r.n_null, r.n_distinct, r.position) for r in quality.column_profile(df, "l", "t", exact=True).collect()}
    assert exact == {"k": (1, 2, 1), "v": (1, 3, 2)}
    rough = {r.column_name: r.n_null for r in quality.column_profile(df, "l", "t").collect()}
    assert rough == {"k": 1, "v": 1}


def test_run_log(spark):
    events = spark.createDataFrame(
        [("r", T(1), None, "running", "full", "log", T(1)), ("r", None, T(3), "success", "full", "log", T(3)),
         ("q", T(2), None, "running", "full", "log", T(2))],
        "run_id string, started_at timestamp, ended_at timestamp, status string, mode string, log_file string, event_ts timestamp")
    runs = runlog.current_runs(events)
    assert {r.run_id: (r.started_at, r.ended_at, r.status) for r in runs.collect()} == {"r": (T(1), T(3), "success"), "q": (T(2), None, "running")}
    stages = runlog.stage_metrics(spark.createDataFrame(
        [("r", "load", T(1), "running", None, None), ("r", "load", T(1) + timedelta(seconds=90), "failed", 7, "boom")],
        "run_id string, stage_name string, ts timestamp, status string, row_count int, message string"))
    row = stages.first()
    assert (row.duration_seconds, row.row_count, row.status, row.error_message) == (90, 7, "failed", "boom")
    recent = runlog.recent_activity(runs, stages, date(2024, 1, 8)).collect()
    assert {(r.run_id, r.stage_name, r.total_duration_min) for r in recent} == {("r", "load", 120.0), ("q", None, None)}
    assert runlog.recent_activity(runs, stages, date(2024, 1, 9)).count() == 0


def test_registry_appends_and_refuses_nulls(spark):
    root = scratch_path(spark, "ml")
    rows = spark.createDataFrame([("r", "mae", 1.0)], "run_id string, metric string, value double")
    registry.append(rows, root, "metrics")
    registry.append(rows, root, "metrics")
    assert registry.read(spark, root, "metrics").count() == 2
    with pytest.raises(Exception, match="metrics.value is required"):
        registry.append(rows.withColumn("value", F.lit(None).cast("double")), root, "metrics")
    assert registry.read(spark, root, "metrics").count() == 2


def test_latest_run_metrics_keeps_ties(spark):
    runs = spark.createDataFrame([("a", "v1", T(1)), ("b", "v2", T(2)), ("c", "v3", T(2))], "run_id string, model_version string, finished_at_utc timestamp")
    metrics = spark.createDataFrame([(r, "mae", 1.0) for r in "abc"], "run_id string, metric string, value double")
    assert sorted(r.model_version for r in registry.latest_run_metrics(runs, metrics).collect()) == ["v2", "v3"]


def test_runs_have_unique_ids(spark):
    root = scratch_path(spark, "unique")
    rows = spark.createDataFrame([("a", "v")], "run_id string, model_version string")
    full = rows.select("*", *[F.lit(x).alias(c) for c, x in (("model_type", "m"), ("target", "t"), ("artifact_path", "p"))],
                       F.current_timestamp().alias("started_at_utc"), F.current_timestamp().alias("finished_at_utc"), F.array(F.lit("f")).alias("features"))
    registry.append(full, root, "runs")
    with pytest.raises(ValueError, match="unique"):
        registry.append(full, root, "runs")
    with pytest.raises(ValueError, match="unique"):
        registry.append(full.withColumn("run_id", F.lit("b")).union(full.withColumn("run_id", F.lit("b"))), root, "runs")
    assert registry.read(spark, root, "runs").count() == 1


def month_rows(spark, *rows):
    return spark.createDataFrame([(M(m), g, v) for m, g, v in rows], "month date, geo string, v int")


def test_replace_rewrites_touched_parts_only(spark):
    root = scratch_path(spark, "versioned")
    assert versions.versions(spark, root) == []
    with pytest.raises(LookupError):
        versions.read(spark, root)
    versions.create(month_rows(spark, (1, "a", 1), (2, "a", 2), (2, "b", 3), (3, "a/=b", 4)), root, "month")
    before = dict(map(tuple, versions.parts(spark, root).collect()))
    new = month_rows(spark, (2, "a", 20), (4, "c", 5))
    want = [(M(1), "a", 1), (M(2), "a", 20), (M(2), "b", 3), (M(3), "a/=b", 4), (M(4), "c", 5)]
    for number in (2, 3):  # twice leaves the same rows as once
        assert versions.replace(new.select("v", "geo", "month"), root, ["month", "geo"]) == number
        assert sorted(map(tuple, versions.read(spark, root).collect())) == want
    after = dict(map(tuple, versions.parts(spark, root).collect()))
    one, two, three, four = (str(M(i)) for i in (1, 2, 3, 4))
    assert after[one] == before[one] and after[three] == before[three] and after[two] != before[two] and four in after
    assert versions.read(spark, root, version=1).count() == 4
    assert [tuple(r) for r in versions.read(spark, root, only=[four]).collect()] == [(M(4), "c", 5)]
    assert versions.replace(new.limit(0), root, ["month", "geo"]) == 3  # nothing to do, no version
    with pytest.raises(ValueError):
        versions.replace(new, root, ["geo"])
    with pytest.raises(Exception, match="is missing"):
        versions.replace(month_rows(spark, (2, None, 1)), root, ["month", "geo"])
    assert len(versions.expire(spark, root, keep=1)) == 3 and versions.versions(spark, root) == [3]
    assert sorted(map(tuple, versions.read(spark, root).collect())) == want


def test_one_of_two_writers_gets_a_version(spark):
    from concurrent.futures import ThreadPoolExecutor

    root = scratch_path(spark, "versioned")
    versions.create(month_rows(spark, (1, "a", 1)), root, "month")
    with pytest.raises(versions.Conflict):
        versions.create(month_rows(spark, (1, "a", 1)), root, "month")
    with ThreadPoolExecutor(3) as pool:  # the losers start again from the winner's version: no change is lost
        list(pool.map(lambda i: versions.replace(month_rows(spark, (i, "a", i)), root, ["month", "geo"], tries=8), (1, 2, 3)))
    assert sorted(map(tuple, versions.read(spark, root).collect())) == [(M(i), "a", i) for i in (1, 2, 3)]
    files, path = versions._files(spark, root)
    files.create(path(f"{root}/manifests/.claim-00000005"), False).close()  # a writer that died
    with pytest.raises(versions.Conflict):
        versions.replace(month_rows(spark, (9, "a", 9)), root, ["month", "geo"])
    versions.release(spark, root, 5)
    assert versions.replace(month_rows(spark, (9, "a", 9)), root, ["month", "geo"]) == 5


def test_events_of_a_run_are_recorded(spark):
    root = scratch_path(spark, "events")
    for status, second in (("running", 0), ("done", 9)):
        runlog.record(spark.sql(f"SELECT 'r' AS run_id, timestamp'2024-01-01 00:00:00' AS started_at, '{status}' AS status, "
                                f"timestamp'2024-01-01 00:00:0{second}' AS event_ts"), root, "status_events")
    assert [r["status"] for r in runlog.current_runs(registry.read(spark, root, "status_events")).collect()] == ["done"]


def test_clip_keeps_nan(spark):
    df = spark.createDataFrame([(1, float(v)) for v in range(20)] + [(1, float("nan")), (1, None)], "g int, v double")
    for out in (windows.winsorize(df, "v", ["g"]), orderstats.winsorize_large(df, "v", ["g"])):
        values = [r["v"] for r in out.collect()]
        assert sum(v is not None and v != v for v in values) == 1 and sum(v is None for v in values) == 1
        assert max(v for v in values if v is not None and v == v) == 18.0


def test_metrics_leave_out_nan_in_both_forms(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 2.0, 2.0), ("a", 3.0, float("nan"))], "k string, y_true double, y_pred double")
    rows = [stats.regression_metrics(df, ["k"], bounded=b).first().asDict() for b in (True, False)]
    assert rows[0] == rows[1] and rows[0]["mae"] == 0.5
