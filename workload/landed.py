"""Landed files for the source readers, written by Spark from the driver tables.

Every list or map collected here is bounded by the calendar (days of a month, months of a year) or by
the four quoted currencies. Rows are dealt once, by the key of the document they end up in: the aggregates
that build a document follow without a further exchange.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from macrotide.session import scratch_path
from workload.proxy import _pick, table

CURRENCIES = ["CNY", "GBP", "JPY", "USD"]
CODEC = "lz4"  # of landed JSON, which repeats its structure in every document


def _constant(name: str, *codes: str) -> dict:
    return {"id": name, "values": [{"id": c} for c in codes]}


def _documents(series: list[dict], periods: list[str], n: Column, start: Column, data: Column) -> Column:
    """SDMX-JSON text. The structure is the same in all documents but for its first ``n`` periods, which begin with ``start``."""
    entries = [json.dumps({"id": f"@{p}"}) for p in periods]
    width = len(entries[0]) + 1
    times = F.replace(F.substring(F.lit(",".join(entries)), F.lit(1), n * width - 1), F.lit("@"), start)
    head = f'{{"structure":{{"dimensions":{{"series":{json.dumps(series)},"observation":[{{"id":"TIME_PERIOD","values":['
    return F.concat(F.lit(head), times, F.lit(']}]}},"dataSets":['), F.to_json(data), F.lit("]}"))


def _observation(index: Column, value: Column) -> Column:
    return F.struct(index.cast("string"), F.array(value, F.lit(0.0)))


def _write_lines(documents: DataFrame, path: str, *partitions: str) -> str:
    writer = documents.select(*partitions, "value").write.option("compression", CODEC)
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.text(path)
    return path


def fx_payloads(spark: SparkSession, sf: str) -> str:
    """One SDMX-JSON document per supplier and month; observations of the 13th are null."""
    date = F.to_date("l_shipdate")
    rows = table(spark, sf, "lineitem").select(
        "l_suppkey", F.trunc(date, "month").alias("month"), F.dayofmonth(date).alias("day"),
        (F.col("l_linenumber") % 4).alias("ccy"), (1 + F.col("l_tax")).alias("rate")).repartition("l_suppkey", "month")
    daily = rows.groupBy("l_suppkey", "month", "day", "ccy").agg(F.max("rate").alias("rate"))
    value = F.when(F.col("day") != 13, F.col("rate"))
    bodies = daily.groupBy("l_suppkey", "month").agg(F.collect_list(
        F.struct("ccy", _observation(F.col("day") - 1, value).alias("one"))).alias("quoted"))

    def observed(n: int) -> Column:
        own = F.transform(F.filter("quoted", lambda q: q["ccy"] == n), lambda q: q["one"])
        return F.struct(F.lit(f"0:{n}:0:0:0").alias("key"), F.struct(F.map_from_entries(own).alias("observations")).alias("body"))

    series = F.array(*[observed(n) for n in range(len(CURRENCIES))])
    present = F.map_from_entries(F.filter(series, lambda s: F.size(s["body"]["observations"]) > 0))
    text = _documents([
        _constant("FREQ", "D"), _constant("CURRENCY", *CURRENCIES), _constant("CURRENCY_DENOM", "EUR"),
        _constant("EXR_TYPE", "SP00"), _constant("EXR_SUFFIX", "A")],
        [f"{d:02d}" for d in range(1, 32)], F.dayofmonth(F.last_day("month")), F.date_format("month", "yyyy-MM-"), F.struct(present.alias("series")))
    return _write_lines(bodies.select(text.alias("value")), scratch_path(spark, "fx"))


def rates_payloads(spark: SparkSession, sf: str) -> str:
    """One document per label, customer and year with monthly periods; odd customers have no series level."""
    o = table(spark, sf, "orders")
    date = F.to_date("o_orderdate")
    key = ["label", "o_custkey", "year"]
    rows = o.select(
        _pick(F.col("o_orderkey") % 3, "MRR", "DFR", "MLF").alias("label"), "o_custkey",
        F.year(date).alias("year"), F.month(date).alias("m"), "o_totalprice").repartition(*key)
    monthly = rows.groupBy(*key, "m").agg(F.max("o_totalprice").alias("rate"))
    bodies = monthly.groupBy(*key).agg(
        F.map_from_entries(F.collect_list(_observation(F.col("m") - 1, F.col("rate")))).alias("observations"))
    flat = F.col("o_custkey") % 2 == 1
    series = F.when(~flat, F.create_map(F.lit("0:0:0"), F.struct("observations")))
    top = F.when(flat, F.col("observations"))
    data = F.struct(series.alias("series"), top.alias("observations"))
    text = _documents([_constant("FREQ", "M")], [f"-{m:02d}" for m in range(1, 13)], F.lit(12), F.format_string("%04d", F.col("year")), data)
    return _write_lines(bodies.select("label", text.alias("value")), scratch_path(spark, "rates"), "label")


def mixed_payloads(spark: SparkSession, sf: str) -> str:
    """One rates document per supplier: broken off, with a text attribute beside the value, plain, or without data."""
    n = F.col("s_suppkey") % 4
    structure = '"structure":{"dimensions":{"series":[],"observation":[{"id":"TIME_PERIOD","values":[{"id":"2024-03"}]}]}}'
    text = lambda tail: F.format_string('{%s,"dataSets":[{"observations":{"0":[%s%s]}}]}', F.lit(structure), F.col("s_acctbal").cast("string"), F.lit(tail))
    doc = F.when(n == 0, F.substring(text(""), 1, 90)).when(n == 1, text(',"x"')).when(n == 2, text(",0")).otherwise(F.lit('{"dataSets":[]}'))
    path = scratch_path(spark, "mixed")
    table(spark, sf, "supplier").select(F.lit("MRR").alias("label"), doc.alias("value")).write.partitionBy("label").text(path)
    return path


def energy_pages(spark: SparkSession, sf: str) -> str:
    """One page per series, supplier and month; some values are null tokens, some dates are blank."""
    date = F.to_date("l_shipdate")
    key = ["series_id", "l_suppkey", "month"]
    rows = table(spark, sf, "lineitem").select(
        _pick(F.col("l_linenumber") % 2, "POILBREUSDM", "PNGASEUUSDM").alias("series_id"), "l_suppkey",
        F.trunc(date, "month").alias("month"), date.alias("day"), "l_extendedprice").repartition(*key)
    daily = rows.groupBy(*key, "day").agg(F.max("l_extendedprice").alias("price"))
    n = F.dayofmonth("day")
    item = F.struct(
        F.when(n == 7, "").otherwise(F.concat(F.lit(" "), F.date_format("day", "yyyy-MM-dd"))).alias("date"),
        F.when(n == 3, ".").when(n == 4, "NaN").when(n == 5, "n.a.").otherwise(F.col("price").cast("string")).alias("value"))
    pages = daily.groupBy(*key).agg(F.collect_list(item).alias("observations"))
    return _write_lines(pages.select("series_id", F.to_json(F.struct("observations")).alias("value")),
                        scratch_path(spark, "pages"), "series_id")


def index_csv(spark: SparkSession, sf: str) -> str:
    """SDMX-CSV with more columns than the reader uses, mixed period lengths and bad values."""
    key, date = F.col("o_orderkey"), F.to_date("o_orderdate")
    rows = table(spark, sf, "orders").select(
        F.lit("dataflow").alias("DATAFLOW"),
        F.lit("I15").alias("unit"),
        F.concat(F.lit("CP0"), F.substring("o_orderpriority", 1, 1)).alias("coicop"),
        F.when(key % 5 != 0, F.col("o_orderstatus")).alias("geo"),
        F.when(key % 4 == 0, F.date_format(date, "yyyy")).when(key % 4 == 1, F.date_format(date, "yyyy-MM"))
        .when(key % 4 == 2, F.date_format(date, "yyyy-MM-dd")).alias("TIME_PERIOD"),
        F.when(key % 7 == 0, "").when(key % 11 == 0, "abc").when(key % 13 == 0, ":")
        .otherwise(F.col("o_totalprice").cast("string")).alias("OBS_VALUE"),
        F.lit("x").alias("OBS_FLAG"))
    path = scratch_path(spark, "index")
    rows.write.option("header", True).option("compression", CODEC).csv(path)
    return path
