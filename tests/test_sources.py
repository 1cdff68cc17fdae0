import json
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from macrotide.functions import clean
from macrotide.session import scratch_path, shared_root
from macrotide.sources import bronze, payloads

HEADER = "dt,dataset,series_id,geo,value,source,ingest_ts\n"


def test_scan_takes_dt_from_the_folder_and_skips_exports(spark, tmp_path):
    day = tmp_path / "fx" / "dt=2024-01-02"
    day.mkdir(parents=True)
    (day / "part-1.csv").write_text(HEADER + "1999-01-01,fx,USD, DE ,1.5,ECB,2024-01-02T10:00:00+00:00\n2024-01-02,fx,GBP,,x,ECB,\n")
    other = tmp_path / "fx" / "Batch"
    other.mkdir()
    (other / "all.csv").write_text("date,rate\n2024-01-02,9\n")
    raw = bronze.read_bronze(spark, str(tmp_path), "fx")
    assert bronze.misplaced_dates(raw).count() == 1
    rows = {r.series_id: r for r in bronze.stage(raw).collect()}
    assert rows["USD"].dt == date(2024, 1, 2) and rows["USD"].value == 1.5 and rows["USD"].geo == "DE"
    assert rows["GBP"].geo == "EA20" and rows["GBP"].value is None and rows["GBP"].ingest_ts is None
    assert set(r.dataset for r in rows.values()) == {"fx"}
    assert bronze.read_bronze(spark, str(tmp_path), "fx", days="2024-01-*").count() == 2


def test_coerce_fills_the_shape(spark):
    df = spark.createDataFrame([(date(2024, 1, 2), "", None), (date(2024, 1, 3), "DE", "t")], "dt date, geo string, ingest_ts string")
    rows = bronze.coerce_bronze(df, F.lit("now")).orderBy("dt").collect()
    assert [tuple(r) for r in rows] == [
        ("2024-01-02", None, None, "NA", None, None, "now"), ("2024-01-03", None, None, "DE", None, None, "t")]
    stamp = bronze.coerce_bronze(df).orderBy("dt").first().ingest_ts
    assert len(stamp) == 25 and stamp.endswith("+00:00")


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_sink_appends(spark, fmt):
    root = scratch_path(spark, "sink")
    df = spark.createDataFrame([("2024-01-02", "a", "x, \"y\"")], "dt string, series_id string, source string")
    for _ in range(2):
        bronze.write_bronze(df, root, "d", fmt, ingest_ts=F.lit("t"))
    back = (bronze.read_bronze(spark, root, "d", dt_in_file=False) if fmt == "csv" else spark.read.parquet(f"{root}/d"))
    assert back.count() == 2 and back.first().source == 'x, "y"'


def test_sink_splits_a_hot_day(spark):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        root = scratch_path(spark, "hot")
        df = spark.range(0, 60000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, "2024-01-01").otherwise(F.date_format(F.date_add(F.lit("2024-02-01").cast("date"), (F.col("id") % 20).cast("int")), "yyyy-MM-dd")).alias("dt"),
            F.md5(F.col("id").cast("string")).alias("series_id"))
        bronze.write_bronze(df, root, "d", ingest_ts=F.lit("t"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot = list(Path(f"{root}/d/dt=2024-01-01").glob("part-*.csv"))
    assert len(hot) > 2
    assert bronze.read_bronze(spark, root, "d", dt_in_file=False).count() == 60000


def test_files_per_dataset(spark):
    root = scratch_path(spark, "files")
    df = spark.createDataFrame([("2024-01-02", "a"), ("2024-01-03", "a")], "dt string, series_id string")
    bronze.write_bronze(df, root, "one")
    bronze.write_bronze(df.limit(1), root, "two")
    bronze.export_batch(df, f"{root}/one/Batch/all", ["dt"])
    assert {r.dataset: r.n_files for r in bronze.files_per_dataset(spark, root, ["one", "two"]).collect()} == {"one": 2, "two": 1}


def test_materialise_replaces(spark):
    bronze.create_layers(spark)
    bronze.materialise(spark.range(3), "gold.t_demo")
    assert bronze.materialise(spark.range(5), "gold.t_demo").count() == 5
    assert bronze.as_view(spark.table("gold.t_demo"), "v_demo").count() == 5


def document(series=None, top=None, dims=("CURRENCY", "CURRENCY_DENOM"), codes=(("GBP", "USD"), ("EUR",)), times=("2024-01-02", "2024-01-03")):
    named = lambda name, ids: {"id": name, "values": [{"id": i} for i in ids]}
    data = {}
    if series is not None:
        data["series"] = {k: {"observations": v} for k, v in series.items()}
    if top is not None:
        data["observations"] = top
    return {"structure": {"dimensions": {"series": [named(d, c) for d, c in zip(dims, codes)], "observation": [named("TIME_PERIOD", times)]}},
            "dataSets": [data]}


def land(tmp_path, *docs, folder=""):
    target = tmp_path / folder
    target.mkdir(parents=True, exist_ok=True)
    (target / "part.json").write_text("\n".join(json.dumps(d) for d in docs))
    return str(tmp_path)


def test_fx_payload(spark, tmp_path):
    doc = document({"1:0": {"0": [1.1, None], "1": [None, 0]}, "0:0": {"1": [0.86]}})
    rows = payloads.flatten_fx(payloads.read_json(spark, land(tmp_path, doc), payloads.SDMX_JSON)).collect()
    assert sorted(map(tuple, rows)) == [("2024-01-02", "USD", "EUR", 1.1), ("2024-01-03", "GBP", "EUR", 0.86)]


def test_fx_payload_in_one_pretty_file(spark, tmp_path):
    (tmp_path / "doc.json").write_text(json.dumps(document({"0:0": {"0": [2.0]}}), indent=2))
    docs = payloads.read_json(spark, str(tmp_path), payloads.SDMX_JSON, multiline=True)
    assert [tuple(r) for r in payloads.flatten_fx(docs).collect()] == [("2024-01-02", "GBP", "EUR", 2.0)]


def test_fx_payload_without_currencies(spark, tmp_path):
    good, bad = document({"0:0": {"0": [2.0]}}), document({"0:0": {"0": [2.0]}}, dims=("FREQ", "CURRENCY"))
    docs = payloads.read_json(spark, land(tmp_path, good, bad), payloads.SDMX_JSON)
    assert payloads.invalid_fx_payloads(docs).count() == 1
    assert payloads.flatten_fx(docs, strict=False).count() == 1
    with pytest.raises(Exception, match="currency dimensions"):
        payloads.flatten_fx(docs).collect()


def test_rates_payload_both_shapes(spark, tmp_path):
    nested = document({"0:0:0": {"0": [4.0], "1": [None]}}, times=("2024", "2024-03"))
    flat = document(top={"1": [3.5]}, times=("2024", "2024-03"))
    land(tmp_path, nested, folder="label=MRR")
    root = land(tmp_path, flat, folder="label=DFR")
    rows = payloads.flatten_rates(payloads.read_json(spark, root, payloads.SDMX_JSON)).collect()
    assert sorted(map(tuple, rows)) == [("2024-01-01", "MRR", 4.0), ("2024-03-01", "DFR", 3.5)]


def test_sdmx_csv_by_header_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("unit,geo,OBS_VALUE,TIME_PERIOD,coicop\nI15,DE,101.5,2024-03,CP00\nI15,DE,,2024-04,CP00\nI15,DE,n/a,2024-05,CP00\nI15,DE,1,,CP00\n")
    assert [tuple(r) for r in payloads.read_sdmx_csv(spark, str(tmp_path)).collect()] == [("2024-03-01", "DE", "CP00", "I15", 101.5)]


def test_pages_keep_null_values(spark, tmp_path):
    page = {"observations": [{"date": " 2024-01-01 ", "value": "."}, {"date": "2024-02-01", "value": "80.5"}, {"date": " ", "value": "1"}]}
    root = land(tmp_path, page, {"observations": []}, folder="series_id=POILBREUSDM")
    rows = payloads.flatten_pages(payloads.read_json(spark, root, payloads.PAGE_JSON))
    assert sorted(map(tuple, rows.collect())) == [("2024-01-01", "POILBREUSDM", None), ("2024-02-01", "POILBREUSDM", 80.5)]
    labelled = payloads.attach_catalogue(rows, payloads.energy_catalogue(spark)).first()
    assert labelled.unit == "USD per Barrel"


def test_export_round_trip(spark):
    df = spark.createDataFrame([("b", 2.0), ("a", None)], "k string, v double")
    path = bronze.export_batch(df, scratch_path(spark, "x"), ["k"], "stamp")
    back = bronze.read_export(spark, path, "k string, v double, load_ts string")
    assert sorted(map(tuple, back.collect())) == [("a", None, "stamp"), ("b", 2.0, "stamp")]


def test_scratch_lies_in_the_shared_folder(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


RATES = '{"structure":{"dimensions":{"series":[],"observation":[{"id":"TIME_PERIOD","values":[{"id":"2024-03"}]}]}},"dataSets":[{"observations":%s}]}'


def _payloads(spark, folder, *lines):
    path = folder / "docs" / "label=MRR"
    path.mkdir(parents=True)
    (path / "a.json").write_text("\n".join(lines))
    return payloads.read_json(spark, str(folder / "docs"), payloads.SDMX_JSON)


def test_text_attributes_do_not_void_a_document(spark, tmp_path):
    docs = _payloads(spark, tmp_path, RATES % '{"0":[1.5,"x",null]}')
    assert [tuple(r) for r in payloads.flatten_rates(docs).collect()] == [("2024-03-01", "MRR", 1.5)]


@pytest.mark.parametrize("broken", ['{"structure":', RATES % '{"7":[1.5]}', '{"dataSets":[]}'])
def test_broken_documents_fail_or_are_listed(spark, tmp_path, broken):
    docs = _payloads(spark, tmp_path, RATES % '{"0":[2]}', broken)
    with pytest.raises(Exception, match="payload unreadable|beyond the time axis"):
        payloads.flatten_rates(docs).collect()
    assert [r["value"] for r in payloads.flatten_rates(docs, strict=False).collect()] == [2.0]
    assert len(payloads.refused(docs, "rates").collect()) == (0 if "7" in broken else 1)


def test_other_header_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text("TIME_PERIOD,geo,OBS_VALUE\n2024,DE,1\n")
    assert [tuple(r) for r in payloads.read_sdmx_csv(spark, str(tmp_path)).collect()] == [("2024-01-01", "DE", "", "", 1.0)]
    (tmp_path / "b.csv").write_text("geo,TIME_PERIOD,OBS_VALUE\nFR,2024,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        payloads.read_sdmx_csv(spark, str(tmp_path)).collect()


def test_stamps_need_a_full_day(spark):
    from macrotide.functions import clean

    df = spark.createDataFrame([("12:30:00",), ("T10:00",), ("2024",), ("2024-03",), ("2024/1/5 10:00",)], "t string")
    assert [r[0] is None for r in df.select(clean.to_timestamp_or_null("t")).collect()] == [True] * 4 + [False]


def test_landed_documents_repeat_their_structure_compressed(spark):
    from workload import landed

    for write, kind in ((landed.fx_payloads, "fx"), (landed.rates_payloads, "rates")):
        path = write(spark, "/root/testdata/sf0.001")
        docs = payloads.read_json(spark, path, payloads.SDMX_JSON)
        assert docs.count() > 100 and payloads.refused(docs.select("structure", "dataSets", payloads.CORRUPT), kind).isEmpty()
        text = spark.read.text(path).agg(F.sum(F.length("value"))).first()[0]
        files = spark.read.format("binaryFile").load(path).select("path", "length").collect()
        assert sum(f.length for f in files) * 3 < text and all(f.path.endswith(f".{landed.CODEC}") for f in files)


def test_plain_days_and_numbers_keep_their_meaning(spark):
    texts = ["2024-01-01", "2024-01-1T", "2024-01-1\t", "2024-02-30", "2024-1-001", " 2024-01-01 ", "1.5", "1.5f", "2d ", "1_0", "x5"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(clean.to_date_or_null("t").cast("string"), clean.to_double_or_null("t")).collect()
    assert [r[0] for r in rows] == ["2024-01-01", None, None, None, None, "2024-01-01", *[None] * 5]
    assert [r[1] for r in rows] == [None] * 6 + [1.5, None, None, 10.0, None]
