from datetime import date, datetime

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from macrotide.functions import calendar as cal
from macrotide.functions import clean, ids, numeric


def values(spark, inputs, expression, type_="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {type_}")
    return [row[0] for row in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_dates_need_a_full_date(spark):
    assert values(spark, ["2024", "2024-01", "2024-1-5", "abc", None, " 2024-01-05 ", "2024-02-30"], clean.to_date_or_null) == [
        None, None, date(2024, 1, 5), None, None, date(2024, 1, 5), None]


def test_numbers(spark):
    assert values(spark, [".", " 1.5 ", "1e3", "1.5f", "2d", "", None, "-3"], clean.to_double_or_null) == [
        None, 1.5, 1000.0, None, None, None, None, -3.0]


def test_null_tokens_keep_other_values_untrimmed(spark):
    assert values(spark, ["", " NA ", "n/a", "Null", " DE ", None], clean.null_tokens) == [None, None, None, "Null", " DE ", None]


def test_default_geo(spark):
    assert values(spark, [None, "  ", " DE ", "NA"], clean.default_geo) == ["EA20", "EA20", "DE", "NA"]


def test_geo_chain_bronze_to_gold(spark):
    chain = lambda c: F.coalesce(clean.null_tokens(clean.default_geo(c)), F.lit("EA20"))
    assert values(spark, ["NA", "", "DE"], chain) == ["EA20", "EA20", "DE"]
    assert values(spark, ["NA", "", "DE"], lambda c: clean.null_tokens(clean.default_geo(c))) == [None, "EA20", "DE"]


def test_periods(spark):
    assert values(spark, ["2024", "2024-03", "2024-03-07", "2024-Q1", ""], clean.period_to_iso) == [
        "2024-01-01", "2024-03-01", "2024-03-07", "2024-Q1-01", ""]


def test_value_tokens(spark):
    assert values(spark, ["", ".", "NaN", "nan", " 2.5 ", "x"], clean.value_or_null) == [None, None, None, None, 2.5, None]


def test_series_id(spark):
    assert values(spark, ["USD"], lambda c: clean.fx_series_id(c, F.lit("EUR"))) == ["EXR.D.USD.EUR.SP00.A"]


@pytest.mark.parametrize("choice, custom, expected", [
    ("5years", (None, None), (date(2020, 1, 1), date(2025, 12, 31))),
    ("10years", (None, None), (date(2015, 1, 1), date(2025, 12, 31))),
    ("since2000", (None, None), (date(2000, 1, 1), date(2025, 12, 31))),
    ("custom", (date(2021, 2, 3), date(2022, 1, 1)), (date(2021, 2, 3), date(2022, 1, 1))),
    ("custom", (date(2021, 2, 3), None), (date(2020, 1, 1), date(2025, 12, 31))),
    ("?", (None, None), (date(2020, 1, 1), date(2025, 12, 31))),
])
def test_relative_range(choice, custom, expected):
    assert cal.relative_range(choice, date(2025, 10, 3), custom) == expected


def test_spine_ends_in_the_cutoff_month(spark):
    months = [r[0] for r in cal.month_spine(spark, date(2000, 11, 1), date(2001, 2, 15)).orderBy("month").collect()]
    assert months == [date(2000, 11, 1), date(2000, 12, 1), date(2001, 1, 1), date(2001, 2, 1)]


@pytest.mark.parametrize("cutoff, last", [(date(2001, 12, 3), date(2001, 12, 31)), (date(2001, 2, 28), date(2001, 2, 28))])
def test_month_cutoff_includes_the_whole_month(spark, cutoff, last):
    kept = values(spark, [last, date(2002, 1, 1), date(2001, 3, 1)], lambda c: cal.up_to_month(c, cutoff), "date")
    assert kept[0] is True and kept[1] is False


def test_durations(spark):
    a, b = datetime(2024, 1, 1, 0, 0, 0, 900000), datetime(2024, 1, 1, 0, 1, 33, 100000)
    df = spark.createDataFrame([(a, b)], "a timestamp, b timestamp")
    assert df.select(cal.seconds_between("a", "b"), cal.minutes_between("a", "b")).first()[:] == (93, 1.5)


def test_zero_base_gives_null(spark):
    df = spark.createDataFrame([(5.0, 0.0), (5.0, 4.0), (0.0, 0.0), (1.0, None)], "x double, b double")
    assert [r[0] for r in df.select(numeric.ratio_change("x", "b")).collect()] == [None, 0.25, None, None]


def test_pair_mean_needs_both(spark):
    df = spark.createDataFrame([(80.0, None), (80.0, 20.0)], "a double, b double")
    assert [r[0] for r in df.select(numeric.pair_mean("a", "b")).collect()] == [None, 50.0]


def test_version_hash_matches_sorted_json(spark):
    df = spark.createDataFrame([(["b", "a"], {"trees": "300", "geo": '"EA20"', "rate": "0.05"})], "c array<string>, p map<string,string>")
    payload = json.dumps({"params": {"trees": 300, "geo": "EA20", "rate": 0.05}, "cols": ["b", "a"]}, sort_keys=True)
    stamp = F.lit("2024-03-02 01:02:03").cast("timestamp")
    text, version = df.select(ids.canonical_json("c", "p"), ids.model_version(ids.canonical_json("c", "p"), stamp)).first()
    assert text == payload
    assert version == "gbt_20240302T010203Z_" + hashlib.sha1(payload.encode()).hexdigest()[:8]
