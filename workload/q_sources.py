"""Sources, sinks and materialisation (round trips through files Spark writes)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from macrotide.functions import clean
from macrotide.plans import ingest, views
from macrotide.plans.gold import fx_monthly
from macrotide.session import scratch_path
from macrotide.sources import bronze, compaction, payloads, quarantine
from workload import landed, proxy
from workload.registry import query, r, rounded

_STAGED = "dt, dataset, series_id, geo, value, source, ingest_us"


def _with_micros(df):
    return df.withColumn("ingest_us", F.unix_micros("ingest_ts")).drop("ingest_ts")


@query("s1_scan_bronze_csv", f"SELECT {_STAGED} FROM staged_events", ("staged_events",))
def s1_scan_bronze_csv(spark, sf):
    root = scratch_path(spark, "bronze")
    raw = proxy.bronze_events(spark, sf)
    # The file keeps its own dt column; an export folder lies beside the partitions and must not be read.
    # Missing geos are landed as blanks, which staging turns into the default area.
    stamped = raw.withColumn("geo", F.coalesce(F.nullif("geo", F.lit("")), F.lit("  ")))
    bronze.write_bronze(stamped, root, "events", keep_dt_in_file=True)
    bronze.export_batch(raw.select("dt", "series_id", "value"), f"{root}/events/Batch/all", ["dt", "series_id", "value"])
    return _with_micros(bronze.stage(bronze.read_bronze(spark, root, "events")))


@query("s2_bronze_sink_round_trip", """
SELECT dt::DATE AS dt, dataset, series_id, coalesce(nullif(geo, ''), 'NA') AS geo, nullif(value, '') AS value, source, ingest_ts
FROM bronze_events""", ("bronze_events",))
def s2_bronze_sink_round_trip(spark, sf):
    root = scratch_path(spark, "bronze")
    bronze.write_bronze(proxy.bronze_events(spark, sf), root, "events")
    back = bronze.read_bronze(spark, root, "events", dt_in_file=False)
    return back.select("dt", "dataset", "series_id", "geo", F.nullif("value", F.lit("")).alias("value"), "source", "ingest_ts")


@query("s3_flatten_fx_payload", """
SELECT l_shipdate::DATE AS obs_date, CASE l_linenumber % 4 WHEN 0 THEN 'CNY' WHEN 1 THEN 'GBP' WHEN 2 THEN 'JPY' ELSE 'USD' END AS quote_ccy,
  'EUR' AS base_ccy, max(1 + l_tax) AS rate
FROM lineitem WHERE day(l_shipdate) <> 13 GROUP BY l_suppkey, 1, 2""")
def s3_flatten_fx_payload(spark, sf):
    docs = payloads.read_json(spark, landed.fx_payloads(spark, sf), payloads.SDMX_JSON)
    return payloads.flatten_fx(docs).withColumn("obs_date", clean.to_date_or_null("obs_date"))


@query("s4_flatten_rates_payload", """
SELECT date_trunc('month', o_orderdate)::DATE AS obs_date,
  CASE o_orderkey % 3 WHEN 0 THEN 'MRR' WHEN 1 THEN 'DFR' ELSE 'MLF' END AS series_id, max(o_totalprice) AS value
FROM orders GROUP BY o_custkey, 1, 2""")
def s4_flatten_rates_payload(spark, sf):
    docs = payloads.read_json(spark, landed.rates_payloads(spark, sf), payloads.SDMX_JSON)
    return payloads.flatten_rates(docs).withColumn("obs_date", clean.to_date_or_null("obs_date"))


@query("s4_readable_of_mixed_payloads", """
SELECT DATE '2024-03-01' AS obs_date, 'MRR' AS series_id, s_acctbal AS value FROM supplier WHERE s_suppkey % 4 IN (1, 2)""")
def s4_readable_of_mixed_payloads(spark, sf):
    docs = payloads.read_json(spark, landed.mixed_payloads(spark, sf), payloads.SDMX_JSON)
    return payloads.flatten_rates(docs, strict=False).withColumn("obs_date", clean.to_date_or_null("obs_date"))


@query("s4_refused_payloads", "SELECT count(*) AS refused FROM supplier WHERE s_suppkey % 4 IN (0, 3)")
def s4_refused_payloads(spark, sf):
    docs = payloads.read_json(spark, landed.mixed_payloads(spark, sf), payloads.SDMX_JSON)
    return payloads.refused(docs.select("structure", "dataSets", payloads.CORRUPT), "rates").agg(F.count("structure").alias("_s"), F.count("*").alias("refused")).select("refused")


@query("s4_sorted_out_payloads", """
SELECT 'accepted' AS status, NULL::VARCHAR AS reason, count(*) AS documents, round(sum(s_acctbal), 6) AS value, true AS as_written FROM supplier WHERE s_suppkey % 4 IN (1, 2)
UNION ALL SELECT 'refused', 'unreadable', count(*), NULL, true FROM supplier WHERE s_suppkey % 4 = 0
UNION ALL SELECT 'refused', 'incomplete', count(*), NULL, true FROM supplier WHERE s_suppkey % 4 = 3""")
def s4_sorted_out_payloads(spark, sf):
    """Accepted and refused documents of one write; accepted ones are flattened strictly afterwards."""
    path = scratch_path(spark, "sorted")
    counts = quarantine.sort_out(payloads.read_json(spark, landed.mixed_payloads(spark, sf), payloads.SDMX_JSON), "rates", path)
    good = payloads.flatten_rates(quarantine.accepted(spark, path)).agg(F.count("*").alias("documents"), F.sum("value").alias("value")).select(
        F.lit("accepted").alias("status"), F.lit(None).cast("string").alias("reason"), "documents", F.round("value", 6).alias("value"),
        (F.col("documents") == counts["accepted"]).alias("as_written"))
    bad = quarantine.refused(spark, path).groupBy("reason").agg(F.count("*").alias("documents"))
    total = bad.agg(F.sum("documents").alias("n"))
    return good.unionByName(bad.select(
        F.lit("refused").alias("status"), "reason", "documents", F.lit(None).cast("double").alias("value"),
        (F.lit(counts["refused"]) == total.scalar()).alias("as_written")))


@query("s5_read_sdmx_csv", """
SELECT CASE o_orderkey % 4 WHEN 0 THEN date_trunc('year', o_orderdate)::DATE WHEN 1 THEN date_trunc('month', o_orderdate)::DATE
       ELSE o_orderdate::DATE END AS obs_date,
  CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus ELSE '' END AS geo,
  'CP0' || substr(o_orderpriority, 1, 1) AS coicop, 'I15' AS unit, o_totalprice AS value
FROM orders WHERE o_orderkey % 4 <> 3 AND o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0""")
def s5_read_sdmx_csv(spark, sf):
    rows = payloads.read_sdmx_csv(spark, landed.index_csv(spark, sf))
    return rows.withColumn("obs_date", clean.to_date_or_null("obs_date"))


@query("s6_flatten_pages", """
SELECT l_shipdate::DATE AS obs_date, CASE l_linenumber % 2 WHEN 0 THEN 'POILBREUSDM' ELSE 'PNGASEUUSDM' END AS series_id,
  CASE WHEN day(l_shipdate) NOT IN (3, 4, 5) THEN max(l_extendedprice) END AS value
FROM lineitem WHERE day(l_shipdate) <> 7 GROUP BY l_suppkey, l_shipdate, 2""")
def s6_flatten_pages(spark, sf):
    docs = payloads.read_json(spark, landed.energy_pages(spark, sf), payloads.PAGE_JSON)
    return payloads.flatten_pages(docs).withColumn("obs_date", clean.to_date_or_null("obs_date"))


@query("s6_payloads_to_staging", """
WITH fx AS (SELECT l_suppkey, l_shipdate::DATE AS dt, CASE l_linenumber % 4 WHEN 0 THEN 'CNY' WHEN 1 THEN 'GBP' WHEN 2 THEN 'JPY' ELSE 'USD' END AS ccy,
    max(1 + l_tax) AS value FROM lineitem WHERE day(l_shipdate) <> 13 GROUP BY 1, 2, 3),
rates AS (SELECT o_custkey, date_trunc('month', o_orderdate)::DATE AS dt,
    CASE o_orderkey % 3 WHEN 0 THEN 'MRR' WHEN 1 THEN 'DFR' ELSE 'MLF' END AS series_id, max(o_totalprice) AS value FROM orders GROUP BY 1, 2, 3),
pages AS (SELECT l_suppkey, l_shipdate::DATE AS dt, CASE l_linenumber % 2 WHEN 0 THEN 'POILBREUSDM' ELSE 'PNGASEUUSDM' END AS series_id,
    CASE WHEN day(l_shipdate) NOT IN (3, 4, 5) THEN max(l_extendedprice) END AS value
    FROM lineitem WHERE day(l_shipdate) <> 7 GROUP BY l_suppkey, l_shipdate, 3),
idx AS (SELECT CASE o_orderkey % 4 WHEN 0 THEN date_trunc('year', o_orderdate)::DATE WHEN 1 THEN date_trunc('month', o_orderdate)::DATE ELSE o_orderdate::DATE END AS dt,
    'CP0' || substr(o_orderpriority, 1, 1) AS series_id, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus ELSE 'EA20' END AS geo, o_totalprice AS value
    FROM orders WHERE o_orderkey % 4 <> 3 AND o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0)
SELECT dt, 'ecb_fx_eu' AS dataset, 'EXR.D.' || ccy || '.EUR.SP00.A' AS series_id, 'EA20' AS geo, value, 'ECB' AS source FROM fx
UNION ALL SELECT dt, 'ecb_rates_eu', series_id, 'EA20', value, 'ECB' FROM rates
UNION ALL SELECT dt, 'energy_prices', series_id, 'NA', value, 'stlouisfed_fred' FROM pages
UNION ALL SELECT dt, 'eurostat_hicp', series_id, geo, value, 'Eurostat' FROM idx""")
def s6_payloads_to_staging(spark, sf):
    stamp = F.lit("2024-02-01T00:00:00+00:00")
    sdmx = lambda path: payloads.read_json(spark, path, payloads.SDMX_JSON)
    landed_rows = {  # Bronze rows of the four datasets, typed as they would be after the files
        "ecb_fx_eu": ingest.fx_to_bronze(sdmx(landed.fx_payloads(spark, sf)), stamp),
        "ecb_rates_eu": ingest.rates_to_bronze(sdmx(landed.rates_payloads(spark, sf)), stamp),
        "energy_prices": ingest.pages_to_bronze(payloads.read_json(spark, landed.energy_pages(spark, sf), payloads.PAGE_JSON), stamp),
        "eurostat_hicp": ingest.index_to_bronze(payloads.read_sdmx_csv(spark, landed.index_csv(spark, sf)), stamp)}
    staged = None
    for rows in landed_rows.values():
        one = bronze.stage(rows).drop("ingest_ts")
        staged = one if staged is None else staged.unionByName(one)
    return staged


@query("s7_attach_catalogue", f"""
SELECT ts_date, series_id, {r('value')} AS value,
  CASE series_id WHEN 'POILBREUSDM' THEN 'USD per Barrel' ELSE 'USD per MMBtu' END AS unit,
  'Monthly' AS frequency, 'FRED/World Bank (Primary Commodity Prices)' AS source
FROM silver_energy""", ("silver_energy",))
def s7_attach_catalogue(spark, sf):
    rows = proxy.silver_energy(spark, sf).select("ts_date", "series_id", "value")
    return rounded(payloads.attach_catalogue(rows, payloads.energy_catalogue(spark)))


@query("s8_batch_export", f"""
SELECT strftime(ts_date, '%Y-%m-%d') AS date, series_id, {r('max(value)')} AS value, '20240101T000000Z' AS load_ts
FROM silver_rates GROUP BY 1, 2""", ("silver_rates",))
def s8_batch_export(spark, sf):
    daily = proxy.silver_rates(spark, sf).groupBy(F.date_format("ts_date", "yyyy-MM-dd").alias("date"), "series_id").agg(
        F.max("value").alias("value"))
    path = bronze.export_batch(daily, scratch_path(spark, "batch"), ["date", "series_id"], "20240101T000000Z")
    return rounded(bronze.read_export(spark, path, "date string, series_id string, value double, load_ts string"))


@query("s9_materialise_table", f"""
SELECT month, geo, {r('fx_usd_eur_avg')} AS fx_usd_eur_avg FROM fx_monthly""", ("fx_monthly",))
def s9_materialise_table(spark, sf):
    path = scratch_path(spark, "table")
    name = "t_" + path.rsplit("-", 1)[1]
    stored = bronze.materialise(fx_monthly(proxy.silver_fx(spark, sf), proxy.CUTOFF), name, path)
    return rounded(bronze.as_view(stored, f"v_{name}"))


@query("s11_export_filtered", f"""
SELECT month, {r('index_value')} AS index_value, source, {r('hicp_yoy')} AS hicp_yoy
FROM hicp_wide WHERE geo = 'EA20' AND month BETWEEN DATE '1997-01-01' AND DATE '2000-12-31'""", ("hicp_wide",))
def s11_export_filtered(spark, sf):
    wide = views.hicp_wide(*proxy.stored_gold(spark, sf))
    picked = views.in_range(wide, date(1997, 1, 1), date(2000, 12, 31)).select("month", "index_value", "source", "hicp_yoy")
    path = bronze.export_csv(picked, scratch_path(spark, "export"))
    return rounded(bronze.read_export(spark, path, "month date, index_value double, source string, hicp_yoy double"))


@query("q9_files_per_dataset", """
SELECT unnest(['energy_prices', 'ecb_rates_eu', 'ecb_fx_eu', 'eurostat_hicp']) AS dataset, true AS as_listed""")
def q9_files_per_dataset(spark, sf):
    root = scratch_path(spark, "bronze")
    raw = proxy.bronze_events(spark, sf)
    names = ["energy_prices", "ecb_rates_eu", "ecb_fx_eu", "eurostat_hicp"]
    for name in names:
        bronze.write_bronze(raw.filter(F.col("dataset") == name), root, name)
    counted = bronze.files_per_dataset(spark, root, names)
    listed = None
    for name in names:
        one = bronze.read_bronze(spark, root, name).select(F.lit(name).alias("dataset"), F.col("_metadata.file_path").alias("f")).distinct()
        listed = one if listed is None else listed.unionByName(one)
    listed = listed.groupBy("dataset").agg(F.count("*").alias("n"))
    return counted.join(listed, "dataset").select("dataset", (F.col("n_files") == F.col("n")).alias("as_listed"))


def _compacted(spark, raw) -> str:
    """Root of a dataset that landed in three batches: two packed as they came, and retired, the third not packed yet."""
    root = scratch_path(spark, "bronze")
    batch = F.pmod(F.xxhash64("ingest_ts", "series_id"), F.lit(3))
    for i in range(3):
        bronze.write_bronze(raw.filter(batch == i), root, "rows")
        if i < 2:
            compaction.compact(spark, root, "rows")
    compaction.retire(spark, root, "rows")
    return root


@query("s2_compacted_bronze", """
SELECT dt, dataset, series_id, coalesce(nullif(geo, ''), 'NA') AS geo, nullif(value, '') AS value, source, ingest_ts FROM bronze_events""", ("bronze_events",))
def s2_compacted_bronze(spark, sf):
    back = compaction.read_compacted(spark, _compacted(spark, proxy.bronze_events(spark, sf)), "rows")
    return back.select("dt", "dataset", "series_id", "geo", F.nullif("value", F.lit("")).alias("value"), "source", "ingest_ts")


@query("q9_files_after_compaction", """
SELECT substr(dt, 1, 7) AS month, count(*) AS n_rows, 0 AS day_files FROM bronze_index GROUP BY 1""", ("bronze_index",))
def q9_files_after_compaction(spark, sf):
    """Packed rows per month beside the day files left, once everything is packed and retired."""
    root = _compacted(spark, proxy.bronze_index(spark, sf))
    compaction.compact(spark, root, "rows")
    compaction.retire(spark, root, "rows")
    left = len(compaction.day_files(spark, root, "rows"))
    packed = compaction.read_compacted(spark, root, "rows")
    return packed.groupBy(F.substring("dt", 1, 7).alias("month")).agg(F.count("*").alias("n_rows")).withColumn("day_files", F.lit(left))
