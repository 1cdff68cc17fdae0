"""Declared rules, stored newest versions and packed day files."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from macrotide.operators import keyed, profiles, rules, versions, vintages
from macrotide.schemas import BRONZE_COLUMNS
from macrotide.session import scratch_path
from macrotide.sources import bronze, compaction, payloads, quarantine


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# ---- declared rules -----------------------------------------------------------------------------

ROWS = [(1, "a", 1.0), (1, "a", None), (2, None, float("nan")), (2, "c", float("inf")), (None, "x", 5.0), (None, "x", 6.0)]
RULES = rules.Rules(required=("k", "v"), accepted={"g": ("a", "c")}, finite=("v",), unique=(("k", "g"), ("k",)), least={("g",): 2, ("g", "k"): 2})


def failures(df, declared):
    return {(r["rule"], r["column_name"]): r["failures"] for r in rules.check(df, "t", declared).collect()}


def test_declared_rules(spark):
    df = spark.createDataFrame(ROWS, "k int, g string, v double")
    assert failures(df, RULES) == {
        ("not_null", "k"): 2, ("not_null", "v"): 1, ("accepted_values", "g"): 2, ("finite", "v"): 2,
        ("unique", "k,g"): 1, ("unique", "k"): 2, ("minimum_rows", "g"): 1, ("minimum_rows", "g,k"): 1}
    assert [r["passed"] for r in rules.check(df, "t", rules.Rules(required=("g",))).collect()] == [False]
    assert failures(df, rules.Rules(accepted={"g": ()})) == {("accepted_values", "g"): 5}


def test_declared_rules_of_an_empty_table_hold(spark):
    assert set(failures(spark.createDataFrame([], "k int, g string, v double"), RULES).values()) == {0}


def test_declared_rules_refuse_nothing_to_check(spark):
    df = spark.createDataFrame(ROWS, "k int, g string, v double")
    with pytest.raises(ValueError):
        rules.check(df, "t", rules.Rules())
    with pytest.raises(ValueError):
        rules.check_all({"t": df})


def test_declared_rules_scan_once(spark):
    path = scratch_path(spark, "rules")
    spark.createDataFrame(ROWS, "k int, g string, v double").write.parquet(path)
    checked = rules.check(spark.read.parquet(path), "t", RULES)
    checked.collect()
    plan = plan_of(checked).split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and plan.count("hashpartitioning") == 1


# ---- newest versions in buckets -----------------------------------------------------------------

SCHEMA = "dt date, geo string, series_id string, value double, source string, ingest_ts timestamp"


def vintage_rows(n, seed):
    pick = random.Random(seed)
    days, stamps = [None, date(2024, 1, 1), date(2024, 2, 1)], [None, datetime(2024, 3, 1), datetime(2024, 3, 2)]
    return [(pick.choice(days), pick.choice([None, "n", "v", "EA"]), pick.choice("st"), pick.choice([None, 1.0, 2.0, float("nan")]),
             pick.choice([None, "a", "b"]), pick.choice(stamps)) for _ in range(n)]


@pytest.mark.parametrize("sizes", [(0, 60, 0), (60, 60, 60), (1, 0, 200)])
def test_merged_batches_equal_the_whole(spark, sizes):
    batches = [spark.createDataFrame(vintage_rows(n, seed), SCHEMA) for seed, n in enumerate(sizes)]
    paths = [scratch_path(spark, "vintages") for _ in range(2)]
    vintages.create(batches[0], paths[0], 4)
    vintages.merge(batches[1], *paths, 4)
    merged = vintages.merged(batches[2], paths[1], 4).select(*batches[0].columns)
    whole = keyed.last_write_wins(batches[0].unionAll(batches[1]).unionAll(batches[2]))
    assert sorted(map(str, merged.collect())) == sorted(map(str, whole.collect()))
    assert vintages.read(spark, paths[0], batches[0].schema).count() == keyed.last_write_wins(batches[0]).count()


def test_merge_twice_changes_nothing(spark):
    a, b = (spark.createDataFrame(vintage_rows(80, seed), SCHEMA) for seed in (7, 8))
    paths = [scratch_path(spark, "vintages") for _ in range(3)]
    vintages.create(a, paths[0], 4)
    vintages.merge(b, paths[0], paths[1], 4)
    vintages.merge(b, paths[1], paths[2], 4)
    once, twice = (sorted(map(str, vintages.read(spark, p, a.schema).collect())) for p in paths[1:])
    assert once == twice


def test_stored_side_of_a_merge_is_not_shuffled(spark):
    path = scratch_path(spark, "vintages")
    vintages.create(spark.createDataFrame(vintage_rows(300, 1), SCHEMA), path, 4)
    landed = scratch_path(spark, "batch")
    spark.createDataFrame(vintage_rows(50, 2), SCHEMA).write.parquet(landed)
    plan = plan_of(vintages.merged(spark.read.schema(SCHEMA).parquet(landed), path, 4))
    join = plan.index("SortMergeJoin")
    stored, batch = plan[join:].split("FileScan")[:2]  # what lies above the first scan, and between the two
    assert "SelectedBucketsCount: 4 out of 4" in plan and "Exchange" not in stored
    assert batch.count("Exchange hashpartitioning") == 2


# ---- packed day files ---------------------------------------------------------------------------


def landed(spark, days):
    rows = [(d, "x", f"s{i}", "EA", str(i), "src", "2024-03-01T00:00:00+00:00") for i, d in enumerate(days)]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in BRONZE_COLUMNS))


def content(df):
    return sorted(tuple(r) for r in df.select("dt", "series_id", "value").collect())


def test_packing_keeps_rows_and_untouched_months(spark):
    root = scratch_path(spark, "bronze")
    first, second = ["2024-01-01", "2024-01-02", "2024-02-01", "not a day"], ["2024-02-01", "2024-03-05"]
    bronze.write_bronze(landed(spark, first), root, "x")
    before = content(compaction.read_compacted(spark, root, "x"))
    assert len(before) == 4
    assert compaction.compact(spark, root, "x") == 1
    assert content(compaction.read_compacted(spark, root, "x")) == before  # day files are there still, and not read twice
    assert compaction.retire(spark, root, "x") == 4 and compaction.day_files(spark, root, "x") == []
    was = versions.manifest(spark, f"{root}/x/_packed")["parts"]
    assert set(was) == {"2024-01", "2024-02", "other"}

    bronze.write_bronze(landed(spark, second), root, "x")
    whole = content(compaction.read_compacted(spark, root, "x"))
    assert len(whole) == 6
    assert compaction.compact(spark, root, "x") == 2 and compaction.compact(spark, root, "x") == 2
    now = versions.manifest(spark, f"{root}/x/_packed")["parts"]
    assert content(compaction.read_compacted(spark, root, "x")) == whole
    assert now["2024-01"] == was["2024-01"] and now["other"] == was["other"] and now["2024-02"] != was["2024-02"]
    assert len(content(compaction.read_compacted(spark, root, "x", months=["2024-02"]))) == 2


def test_packing_that_breaks_before_its_manifest_changes_nothing(spark, monkeypatch):
    root = scratch_path(spark, "bronze")
    bronze.write_bronze(landed(spark, ["2024-01-01", "2024-02-01"]), root, "x")
    before = content(compaction.read_compacted(spark, root, "x"))

    def lost(*_):
        raise OSError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(versions, "_commit", lost)
        with pytest.raises(OSError):
            compaction.compact(spark, root, "x")
    assert content(compaction.read_compacted(spark, root, "x")) == before and compaction.retire(spark, root, "x") == 0
    assert compaction.compact(spark, root, "x") == 1
    assert content(compaction.read_compacted(spark, root, "x")) == before


def test_packing_nothing(spark):
    root = scratch_path(spark, "bronze")
    assert compaction.compact(spark, root, "x") == 0 and compaction.retire(spark, root, "x") == 0
    with pytest.raises(LookupError):
        compaction.read_compacted(spark, root, "x")


def test_files_with_a_day_column_of_their_own(spark):
    root = scratch_path(spark, "bronze")
    bronze.write_bronze(landed(spark, ["2024-01-01", "2024-01-02"]), root, "x", keep_dt_in_file=True)
    before = content(compaction.read_compacted(spark, root, "x", dt_in_file=True))
    compaction.compact(spark, root, "x", dt_in_file=True)
    back = compaction.read_compacted(spark, root, "x", dt_in_file=True)
    assert content(back) == before and back.filter(F.col("dt") != F.col("dt_in_file")).count() == 0


# ---- profiles by day ----------------------------------------------------------------------------


def profile_rows(spark, days, seed):
    pick = random.Random(seed)
    rows = [(date(2024, 1 + d // 28, 1 + d % 28), pick.choice([None, float("nan"), pick.random() * 1000]), f"t{pick.randint(0, 400)}", None)
            for d in days for _ in range(100)]
    return spark.createDataFrame(rows, "d date, v double, t string, none int"), rows


def test_profile_of_days_equals_that_of_the_whole(spark):
    root, names = scratch_path(spark, "profile"), ["v", "t", "none"]
    first, a = profile_rows(spark, range(40), 1)
    second, b = profile_rows(spark, range(30, 70), 2)  # days 30 to 39 come anew
    profiles.store(first, root, "d", names)
    was = {r["part"]: r["folder"] for r in versions.parts(spark, root).collect()}
    for _ in range(2):
        profiles.store(second, root, "d", names)
    now = {r["part"]: r["folder"] for r in versions.parts(spark, root).collect()}
    assert was["2024-01-01"] == now["2024-01-01"] and was["2024-02-01"] != now["2024-02-01"]

    rows = [r for r in a if r[0] < min(x[0] for x in b)] + b
    by = {r["column_name"]: r for r in profiles.profile(spark, root).collect()}
    numbers = sorted(r[1] for r in rows if r[1] is not None and r[1] == r[1])
    assert {r["n_rows"] for r in by.values()} == {len(rows)}
    assert by["v"]["n_null"] == sum(r[1] is None for r in rows) and by["none"]["n_null"] == len(rows)
    assert by["v"]["least"] == numbers[0]
    for p, q in zip((0.25, 0.5, 0.75), by["v"]["quantiles"]):
        assert abs(sum(x <= q for x in numbers) / len(numbers) - p) < 0.04
    assert abs(by["t"]["n_distinct"] - 401) < 30 and by["none"]["n_distinct"] == 0
    assert by["t"]["quantiles"] is None and by["none"]["quantiles"] is None


# ---- documents sorted out -----------------------------------------------------------------------


def test_accepted_and_refused_are_what_landed(spark, tmp_path):
    texts = ['{"observations":[{"date":"2024-01-01","value":"1"}]}', '{"observations":[{"date"', '{"other":1}', '{"observations":[]}']
    for i, text in enumerate(texts):
        folder = tmp_path / f"series_id=s{i}"
        folder.mkdir()
        (folder / "page.json").write_text(text)
    path = scratch_path(spark, "sorted")
    docs = payloads.read_json(spark, str(tmp_path), payloads.PAGE_JSON)
    for _ in range(2):
        assert quarantine.sort_out(docs, "pages", path) == {"accepted": 2, "refused": 2}
    good, bad = quarantine.accepted(spark, path), quarantine.refused(spark, path)
    assert {r["series_id"] for r in good.collect()} == {"s0", "s3"}
    assert {(r["series_id"], r["reason"]) for r in bad.collect()} == {("s1", "unreadable"), ("s2", "incomplete")}
    assert [r[payloads.CORRUPT] for r in bad.filter("reason = 'unreadable'").collect()] == [texts[1]]
    assert payloads.flatten_pages(good).count() == 1
