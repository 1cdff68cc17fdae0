from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from macrotide.functions.calendar import month_spine
from macrotide.operators import keyed, registry, runlog
from macrotide.plans import batch, features, gold, nowcast, pipeline, views
from macrotide.plans.silver import select_series, to_silver
from macrotide.schemas import NOWCAST_OUTPUT, SILVER
from macrotide.session import scratch_path

M = lambda n: date(2020 + (n - 1) // 12, (n - 1) % 12 + 1, 1)
LONG = "ts_date date, geo string, series_id string, value double"


def long(spark, rows):
    return spark.createDataFrame(rows, LONG)


def macro_inputs(spark):
    fx = long(spark, [(date(2020, 1, 5), "EA20", "EXR.D.USD.EUR.SP00.A", 1.0), (date(2020, 1, 9), None, "EXR.D.usd.EUR.SP00.A", 2.0),
                      (date(2020, 1, 9), "EA20", "EXR.D.GBP.EUR.SP00.A", 9.0), (date(2020, 3, 2), "DE", "EXR.D.GBP.EUR.SP00.A", 9.0)])
    rates = long(spark, [(date(2020, 1, 30), "EA20", "MRR", 1.0), (date(2020, 1, 31), "EA20", "DFR", 2.0), (date(2020, 1, 31), "EA20", "MRR", 3.0),
                         (date(2020, 2, 3), None, "MLF", 4.0), (date(2020, 3, 3), "EA20", "MRR", 5.0)])
    energy = long(spark, [(date(2020, 2, 1), "EA20", "POILBREUSDM", 80.0), (date(2020, 3, 20), "DE", "POILBREUSDM", 70.0), (date(2020, 3, 2), "DE", "PNGASEUUSDM", 7.0)])
    return fx, rates, energy


def test_fact_macro(spark):
    cutoff = date(2020, 3, 10)
    out = gold.fact_macro(month_spine(spark, M(1), cutoff), *macro_inputs(spark), cutoff)
    rows = {(r.month, r.geo): r for r in out.collect()}
    jan, feb, mar = rows[(M(1), "EA20")], rows[(M(2), "EA20")], rows[(M(3), "DE")]
    assert len(rows) == 3
    # USD matches in any case; the end-of-month rate is the newest day's, last series id first.
    assert (jan.fx_usd_eur_avg, jan.policy_rate_monthly_avg, jan.policy_rate_eom, jan.brent_crude_usd) == (1.5, 2.0, 3.0, None)
    # A month without FX falls back to the default area.
    assert (feb.fx_usd_eur_avg, feb.policy_rate_eom, feb.brent_crude_usd) == (None, 4.0, 80.0)
    # A month whose FX has another geo finds only that geo's rates and energy; energy stops at the cutoff day.
    assert (mar.fx_usd_eur_avg, mar.policy_rate_eom, mar.brent_crude_usd, mar.nat_gas_eu_usd) == (None, None, None, 7.0)


def test_rates_of_one_series(spark):
    _, rates, _ = macro_inputs(spark)
    row = gold.rates_monthly(rates, date(2020, 1, 31), "DFR").first()
    assert (row.month, row.policy_rate_monthly_avg, row.policy_rate_eom) == (M(1), 2.0, 2.0)
    assert {r.policy_rate_eom for r in gold.end_of_month(rates, "policy_rate_eom").collect()} == {3.0, 4.0, 5.0}


def test_features_and_views_of_gold(spark):
    cutoff = date(2021, 3, 31)
    index = spark.createDataFrame([(M(i), "EA20", s, 100.0 + i) for i in range(1, 15) if i != 2 for s in ("CP00", "CP01")],
                                  "month date, geo string, series_id string, hicp_index double")
    macro = gold.fact_macro(month_spine(spark, M(1), cutoff), *macro_inputs(spark), cutoff)
    by_row = {(r.month, r.series_id): r for r in gold.fact_cpi_features(index, macro).collect()}
    by_month = {(r.month, r.series_id): r for r in gold.fact_cpi_features(index, macro, calendar_lags=True).collect()}
    assert len(by_row) == 26
    assert by_row[(M(3), "CP00")].lag_1m == 101.0 and by_month[(M(3), "CP00")].lag_1m is None
    assert by_row[(M(13), "CP00")].lag_12m is None and by_month[(M(13), "CP00")].lag_12m == 101.0
    assert by_row[(M(4), "CP01")].hicp_mom == pytest.approx(104 / 103 - 1)
    features_ = gold.fact_cpi_features(index, macro)
    assert gold.nowcast_input(features_).count() == 13
    row = gold.nowcast_input(features_).filter(F.col("month") == F.lit(M(2 + 1))).first()
    assert row.energy_price_usd is None
    assert gold.dashboard_view(features_).filter(F.col("month") == F.lit(M(1))).first().hicp_index == 101.0


def silver_rows(spark, rows):
    return spark.createDataFrame([(d, "g", s, "m", 1.0, u, f, "x", datetime(2024, 1, 1)) for d, s, u, f in rows], SILVER)


def test_series_selection_periods(spark):
    silver = silver_rows(spark, [(date(2020, 12, 31), "CP00", "I15", "M"), (date(2021, 1, 1), "CP00", "I15", "M"), (date(2021, 6, 30), "CP00", "I15", "M"),
                                 (date(2021, 7, 1), "CP00", "I15", "M"), (date(2021, 2, 1), "CP01", "I15", "M"), (date(2021, 2, 1), "CP00", "I05", "M")])
    got = lambda **k: sorted(r.ts_date for r in select_series(silver, "g", "CP00", "I15", "M", **k).collect())
    assert got(start="2021", end="2021-06") == [date(2021, 1, 1), date(2021, 6, 30)]
    assert got(end="2020") == [date(2020, 12, 31)]
    assert got(start="2021-06-30", end="2021-07-01") == [date(2021, 6, 30), date(2021, 7, 1)]


def test_silver_labels(spark):
    df = spark.createDataFrame([(d, date(2020, 1, 1), " NA ", "s", 1.0, "x", datetime(2024, 1, 1)) for d in ("ecb_fx_eu", "eurostat_hicp")],
                               "dataset string, dt date, geo string, series_id string, value double, source string, ingest_ts timestamp")
    rows = {r.measure: r for r in to_silver(df).collect()}
    assert rows["exchange_rate"].unit is None and rows["exchange_rate"].freq == "D" and rows["exchange_rate"].geo is None
    assert rows["price_index"].unit == "Index (2015=100)"
    assert dict(to_silver(df).dtypes)["unit"] == "string"


def index_and_nowcasts(spark, geos=("EA20", "DE")):
    index = spark.createDataFrame([(M(i), g, "CP00", 100.0 + i) for i in range(1, 14) for g in geos],
                                  "month date, geo string, series_id string, hicp_index double")
    rows = [(M(14), g, v, y, None, None, datetime(2024, 1, d)) for g in geos for v, y, d in (("old", 1.0, 1), ("new", 110.0, 2))]
    return index, spark.createDataFrame(rows, NOWCAST_OUTPUT)


def test_wide_view_takes_the_newest_version(spark):
    index, nowcasts = index_and_nowcasts(spark)
    wide = views.hicp_wide(index, nowcasts)
    assert wide.count() == 14 and {r.geo for r in wide.collect()} == {"EA20"}
    row = wide.filter("source = 'nowcast'").first()
    assert row.index_value == 110.0 and row.hicp_yoy == pytest.approx(110 / 102 - 1)
    # Trailing means stay within a source.
    assert row.hicp_idx_ma3 == 110.0
    assert views.hicp_wide(index, nowcasts, all_versions=True).count() == 15
    assert views.hicp_wide(index, nowcasts, geo=None).count() == 28


def test_key_figures_without_drivers_and_without_base(spark):
    index, nowcasts = index_and_nowcasts(spark)
    gap = index.filter(~((F.col("geo") == "DE") & (F.col("month") == F.lit(M(2)))))
    empty = spark.createDataFrame([], "ref_month date, fx_usd_eur_avg_m double, brent_crude_m double, nat_gas_m double, policy_rate_eom_m double")
    rows = {r.geo: r for r in views.key_figures(views.hicp_wide(gap, nowcasts, geo=None), empty).collect()}
    assert rows["EA20"].nowcast_hicp_yoy == pytest.approx(110 / 102 - 1) and rows["EA20"].nowcast_base_date == M(2)
    assert rows["DE"].nowcast_hicp_yoy is None and rows["DE"].nowcast_base_date is None and rows["DE"].nowcast_hicp_index == 110.0
    assert rows["EA20"].current_hicp_index == 113.0 and rows["EA20"].current_fx is None
    assert rows["EA20"].current_hicp_yoy == pytest.approx(113 / 101 - 1)
    assert rows["EA20"].recent_trend_3m == pytest.approx(113 / 101 - 1)


def test_overlay(spark):
    index, _ = index_and_nowcasts(spark, ("EA20",))
    rows = {r.month: r.hicp_index_ago for r in views.comparison_overlay(index, ["geo"], "hicp_index", "?").collect()}
    assert rows[M(13)] == 101.0 and rows[M(12)] is None


def test_macro_wide_skips_nulls_but_counts_rows(spark):
    macro = spark.createDataFrame([(M(i), "g", v, None, 1.0 * i, None, None) for i, v in enumerate([1.0, None, 3.0, 5.0], start=1)],
                                  "month date, geo string, fx_usd_eur_avg double, policy_rate_monthly_avg double, policy_rate_eom double, brent_crude_usd double, nat_gas_eu_usd double")
    rows = views.macro_wide(macro).orderBy("ref_month").collect()
    assert [r.fx_ma3 for r in rows] == [1.0, 1.0, 2.0, 4.0]


# ---- features and models ------------------------------------------------------------------------

def design(spark, n=48, geos=("a", "b"), bump_from=None):
    rng = np.random.default_rng(5)
    rows = []
    for g in geos:
        level, history = 100.0, []
        for i in range(1, n + 1):
            mom = float(0.002 * np.sin(i / 2) + rng.normal() * 0.0005)
            level *= 1 + mom
            history.append(level)
            lag = lambda k: history[-1 - k] if len(history) > k else None
            fx = float(1 + 0.1 * np.cos(i / 3)) + (5.0 if bump_from and i >= bump_from else 0.0)
            rows.append((M(i), g, level, lag(1), lag(3), lag(6), lag(12), mom if i > 1 else None,
                         level / lag(12) - 1 if lag(12) else None, fx, 2.0, 2.5, 50.0))
    return spark.createDataFrame(rows, "month date, geo string, target_hicp_index double, lag_1m double, lag_3m double, lag_6m double, lag_12m double, hicp_mom double, hicp_yoy double, fx_usd_eur_avg double, policy_rate_monthly_avg double, policy_rate_eom double, energy_price_usd double")


CUT = M(36)


def test_training_matrix(spark):
    matrix = features.training_matrix(design(spark), CUT)
    assert matrix.count() == 2 * 36
    assert {"hicp_yoy", "energy_price_usd"}.isdisjoint(matrix.columns) and len(features.feature_columns(matrix)) == 27
    train, test = features.split_at(matrix, CUT)
    assert (train.count(), test.count()) == (48, 24)


def test_training_rows_do_not_change_with_the_future(spark):
    a = features.training_matrix(design(spark), CUT).filter(F.col("month") <= F.lit(CUT)).orderBy("geo", "month").collect()
    b = features.training_matrix(design(spark, bump_from=37), CUT).filter(F.col("month") <= F.lit(CUT)).orderBy("geo", "month").collect()
    assert a == b


def test_training_problems(spark):
    matrix = features.training_matrix(design(spark), CUT)
    names = features.feature_columns(matrix)
    assert nowcast.training_problems(matrix, names, CUT).count() == 0
    broken = matrix.withColumn("lag_3m", F.when(F.col("month") == F.lit(M(20)), float("inf")).otherwise(F.col("lag_3m")))
    found = {tuple(r) for r in nowcast.training_problems(broken, names, M(20)).collect()}
    assert found == {("minimum_rows", "a", 8), ("minimum_rows", "b", 8), ("finite", "lag_3m", 2)}


def test_align(spark):
    out = features.align_features(design(spark, 3, ("a",)), ["lag_3m", "new", "lag_1m"])
    assert out.columns == ["geo", "month", "lag_3m", "new", "lag_1m"] and out.first().new == 0.0


def test_baselines_by_hand(spark):
    df = spark.createDataFrame([("g", M(i), m, l) for i, m, l in [(1, 0.1, 10.0), (2, 0.3, 13.0), (3, 0.2, 15.6), (4, 0.4, 21.84)]],
                               "geo string, month date, hicp_mom double, target_hicp_index double")
    rows = {(r.month, r.model): r for r in nowcast.baseline_walk_forward(df, M(2)).collect()}
    assert rows[(M(3), "expanding_mean")].y_pred_mom == pytest.approx(0.2)
    assert rows[(M(3), "expanding_mean")].y_pred_level == pytest.approx(15.6)
    assert rows[(M(4), "last_value")].y_pred_mom == pytest.approx(0.2)
    # Pairs before month 4: (0.1 -> 0.3), (0.3 -> 0.2); line through both, at 0.2.
    assert rows[(M(4), "expanding_linear")].y_pred_mom == pytest.approx(0.25)


def test_pooled_model_walk_forward_importance_and_persistence(spark, tmp_path):
    matrix = features.training_matrix(design(spark, 40), CUT)
    names = features.feature_columns(matrix)
    out = nowcast.walk_forward_pooled(matrix, names, M(38), (42,), trees=2)
    assert sorted((r.geo, r.month) for r in out.collect()) == [(g, M(i)) for g in "ab" for i in (39, 40)]
    assert nowcast.walk_forward_pooled(matrix, names, M(50), (42,), trees=2).count() == 0
    beside = {r.geo: r for r in nowcast.errors_beside_baseline(out, matrix, M(38)).collect()}
    naive = nowcast.baseline_walk_forward(matrix, M(38), ("expanding_mean",)).collect()
    for g in "ab":
        assert beside[g].n_months == 2 and beside[g].baseline_mae == pytest.approx(np.mean([r.abs_error for r in naive if r.geo == g]))
        assert beside[g].mae == pytest.approx(np.mean([r.abs_error for r in out.collect() if r.geo == g]))
    model = nowcast.fit_pooled(matrix, names, 2)
    weights = nowcast.feature_importance(model, spark)
    ranked = keyed.top_features(weights, 3).collect()
    assert [r.importance for r in ranked] == sorted((r.importance for r in weights.collect()), reverse=True)[:3]
    assert sum(r.importance for r in nowcast.feature_importance(model, spark).collect()) == pytest.approx(1.0)
    loaded = nowcast.load_model(nowcast.save_model(model, str(tmp_path / "m")))
    predict = lambda m: [r.y_pred_mom for r in m.transform(matrix).orderBy("geo", "month").collect()]
    assert predict(model) == predict(loaded)


def test_pooled_walk_forward_trains_on_the_past_only(spark):
    a = features.training_matrix(design(spark, 41, ("a",)), CUT)
    names = features.feature_columns(a)
    b = a.withColumn("hicp_mom", F.when(F.col("month") > F.lit(M(39)), F.col("hicp_mom") + 1).otherwise(F.col("hicp_mom")))
    run = lambda m: {r.month: r.y_pred_mom for r in nowcast.walk_forward_pooled(m, names, M(38), (1,), trees=2).collect()}
    first, second = run(a), run(b)
    assert all(first[M(i)] == second[M(i)] for i in (39, 40)) and first[M(41)] != second[M(41)]


def test_batch_counts_rows_and_continues_after_a_failure(spark):
    stamps = iter(datetime(2024, 1, 1) + timedelta(seconds=i) for i in range(100))
    root, broken = scratch_path(spark, "batch"), [True]

    def third(tables):
        if broken[0]:
            raise ValueError("no source\nsecond line")
        return tables["a"].join(tables["b"], "id")

    stages = {"a": lambda _: spark.range(10), "b": lambda t: t["a"].where("id % 2 = 0"), "c": third, "d": lambda t: t["c"].limit(0)}
    first = batch.Batch(spark, root, "r1", lambda: next(stamps))
    with pytest.raises(ValueError):
        first.run(stages)
    assert first.computed == ["a", "b"]
    broken[0] = False
    again = batch.Batch(spark, root, "r1", lambda: next(stamps))
    tables = again.run(stages)
    assert again.computed == ["c", "d"] and tables["c"].count() == 5  # a and b are read, not made
    log = runlog.stage_metrics(registry.read(spark, root, "stage_events")).collect()
    assert {(r.stage_name, r.row_count, r.status) for r in log} == {("a", 10, "success"), ("b", 5, "success"), ("c", 5, "success"), ("d", 0, "success")}
    failed = registry.read(spark, root, "stage_events").where("status = 'failed'").first()
    assert (failed.stage_name, failed.message, failed.row_count) == ("c", "no source", 0)
    assert [r.status for r in runlog.current_runs(registry.read(spark, root, "status_events")).collect()] == ["success"]
    other = batch.Batch(spark, root, "r2", lambda: next(stamps))
    other.run(stages)
    assert other.computed == ["a", "b", "c", "d"]  # another run has tables of its own


def test_full_batch_reaches_the_key_figures(spark):
    months = [f"20{y:02d}-{m:02d}-01" for y in (20, 21) for m in range(1, 13)]
    rows = [(d, n, s, "EA20", str(v + i), "x", "2024-01-01T00:00:00+00:00") for i, d in enumerate(months) for n, s, v in [
        ("eurostat_hicp", "CP00", 100), ("ecb_fx_eu", "EXR.D.USD.EUR.SP00.A", 1), ("ecb_rates_eu", "MRR", 4), ("energy_prices", "POILBREUSDM", 80)]]
    raw = spark.createDataFrame(rows, "dt string, dataset string, series_id string, geo string, value string, source string, ingest_ts string")
    from macrotide.sources.bronze import stage

    staging = {d: stage(raw.filter(F.col("dataset") == d)) for d in ("eurostat_hicp", "ecb_fx_eu", "ecb_rates_eu", "energy_prices")}
    predict = lambda t: t.where(F.col("month") == F.lit(date(2021, 12, 1))).select(
        F.lit(date(2022, 1, 1)).alias("month"), "geo", F.lit("v").alias("model_version"), F.lit(125.0).alias("y_nowcast"), F.lit(None).cast("double").alias("y_actual"),
        F.lit(None).cast("double").alias("residual"), F.lit("2022-01-02").cast("timestamp").alias("created_at_utc"))
    stages = batch.full(spark, staging, date(2022, 1, 31), predict, date(2020, 1, 1))
    tables = batch.Batch(spark, scratch_path(spark, "batch"), "r").run(stages)
    row = tables["report.key_figures"].first()
    assert (row.current_hicp_index, row.nowcast_hicp_index, row.nowcast_base_index) == (123.0, 125.0, 112.0)
    assert tables["report.macro_wide"].count() == 25 and list(tables) == list(stages)


def test_future_rows_and_nowcast(spark):
    source = design(spark, 40)
    source = source.unionByName(source.filter("geo = 'a'").withColumns({
        "geo": F.lit("c"), **{c: F.lit(None).cast("double") for c in ("fx_usd_eur_avg", "policy_rate_monthly_avg", "policy_rate_eom")}}))
    extended = nowcast.future_rows(source, M(41))
    assert extended.count() == source.count() + 3
    assert nowcast.future_rows(source, M(40)).count() == source.count()
    new = extended.filter((F.col("geo") == "a") & (F.col("month") == F.lit(M(41)))).first()
    last = source.filter((F.col("geo") == "a") & (F.col("month") == F.lit(M(40)))).first()
    assert new.lag_1m == last.target_hicp_index and new.target_hicp_index is None
    plain = nowcast.future_rows(source, M(41), fill_lags=False).filter((F.col("geo") == "a") & (F.col("month") == F.lit(M(41)))).first()
    assert plain.lag_1m is None
    matrix = features.training_matrix(source.filter("geo <> 'c'"), CUT)
    model = nowcast.fit_pooled(matrix, features.feature_columns(matrix), 2)
    out = {r.geo: r for r in nowcast.nowcast_month(model, source, M(41)).collect()}
    assert set(out) == {"a", "b", "c"}  # a geo without any driver is scored too
    assert out["a"].last_known_month == M(40) and out["a"].level_pred == pytest.approx(out["a"].last_known_level * (1 + out["a"].mom_pred))
    table = spark.createDataFrame([(M(41), "a", "old", 1.0, None, None, datetime(2024, 1, 1))], NOWCAST_OUTPUT)
    predictions = nowcast.nowcast_month(model, source, M(41))
    saved = nowcast.save_nowcast(table, predictions, F.lit("2024-01-02").cast("timestamp"))
    assert {(r.geo, r.model_version) for r in saved.collect()} == {(g, "nowcast_future") for g in "abc"}


def test_pipeline_names_every_layer(spark):
    rows = [("2020-01-01", d, s, "EA20", v, "x", t) for d, s, v in [
        ("eurostat_hicp", "CP00", "100"), ("ecb_fx_eu", "EXR.D.USD.EUR.SP00.A", "1.1"), ("ecb_rates_eu", "MRR", "4"),
        ("energy_prices", "POILBREUSDM", "80")] for t in ("2024-01-01T00:00:00+00:00", "2024-01-02T00:00:00+00:00")]
    raw = spark.createDataFrame(rows, "dt string, dataset string, series_id string, geo string, value string, source string, ingest_ts string")
    from macrotide.sources.bronze import stage

    staging = {d: stage(raw.filter(F.col("dataset") == d)) for d in ("eurostat_hicp", "ecb_fx_eu", "ecb_rates_eu", "energy_prices")}
    tables = pipeline.build(spark, staging, date(2020, 2, 10), date(2020, 1, 1))
    assert tables["silver.all_series"].count() == 4 and tables["silver.all_series"].columns == SILVER.names
    assert tables["gold.dim_time"].count() == 2
    row = tables["gold.gold_dashboard_view"].first()
    assert (row.hicp_index, row.fx_usd_eur_avg, row.policy_rate_eom, row.brent_crude_usd) == (100.0, 1.1, 4.0, 80.0)


def test_model_queries_read_the_tables_once(spark, monkeypatch):
    from workload import proxy, q_models

    reads, read = [], proxy.table
    monkeypatch.setattr(proxy, "table", lambda spark, sf, name: reads.append(name) or read(spark, sf, name))
    monkeypatch.setattr(q_models, "TREES", 1)
    for run in (q_models.m5_feature_importance, q_models.m6_nowcast_future_month, q_models.m2_pooled_model, q_models.m8_save_and_load):
        reads.clear()
        run(spark, "/root/testdata/sf0.01")
        assert sorted(reads) == ["lineitem", "lineitem", "orders", "orders"]  # exchange rates and energy; index and policy rates
