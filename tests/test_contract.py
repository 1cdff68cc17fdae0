"""The registered queries: agreement with DuckDB and the shape of their plans."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as contract
import check
from workload import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = catalog.QUERIES, catalog.SQL  # the training-text queries are tested in their own folder
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for t in check.TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


def test_every_query_has_sql_or_a_reason():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@needs_data
def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


@needs_data
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    ok, message = check.compare(spark, con, name, QUERIES[name], SQL.get(name), SF)
    assert ok, message


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@needs_data
@pytest.mark.parametrize("name", ["j1_fact_cpi_features", "j2_fact_macro", "j3_hicp_wide", "a1_last_write_wins", "m1_feature_matrix",
                                  "m3_walk_forward_baselines", "m7_key_figures", "w9_winsorize_hot_groups", "a8_regression_metrics_pooled",
                                  "k3_replace_panel", "j6_append_if_absent", "j5_latest_run_metrics", "x1_all_series"])
def test_plans_have_no_product_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert not re.search(r"Python|Pandas|Arrow", plan)


@needs_data
def test_one_task_windows_only_over_months(spark):
    single = [n for n in ("j1_fact_cpi_features", "m1_feature_matrix", "w1_lags_panel", "j3_hicp_wide", "w9_winsorize_hot_groups")
              if "Exchange SinglePartition" in plan_of(QUERIES[n](spark, SF))]
    assert single == []


@needs_data
def test_cutoffs_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["a2_fx_monthly"](spark, SF))
    assert "LessThan(l_shipdate" in plan and "l_extendedprice" not in plan


@needs_data
def test_rates_are_read_once(spark):
    assert plan_of(QUERIES["a3_rates_monthly"](spark, SF)).count("FileScan parquet") == 1


@needs_data
def test_rolling_features_share_one_shuffle(spark):
    plan = plan_of(QUERIES["w5_leak_free_rolling_panel"](spark, SF))
    assert plan.count("Exchange hashpartitioning(geo") == 1  # the panel's aggregate shuffles on its own keys


@needs_data
@pytest.mark.parametrize("name", ["k4_run_status", "k5_stage_metrics"])
def test_run_log_aggregates_by_hash(spark, name):
    assert "SortAggregate" not in plan_of(QUERIES[name](spark, SF))


@needs_data
def test_fx_is_not_dealt_by_month(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(QUERIES["j2_fact_macro"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = plan.index("BroadcastHashJoin [month")
    above = plan[:join]
    assert not re.search(r"hashpartitioning\(month#\d+, \d+\)", above.rsplit("Union", 1)[1])
