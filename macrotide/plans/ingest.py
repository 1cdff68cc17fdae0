"""Landed payloads to Bronze rows: dataset code, series id, area and source of each of the four datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macrotide.functions import clean
from macrotide.schemas import DEFAULT_GEO, MISSING_GEO
from macrotide.sources import payloads
from macrotide.sources.bronze import coerce_bronze

# Dataset codes and source labels of the public data model.
SOURCES = {"ecb_fx_eu": "ECB", "ecb_rates_eu": "ECB", "energy_prices": "stlouisfed_fred", "eurostat_hicp": "Eurostat"}


def _rows(df: DataFrame, dataset: str, series_id: Column, geo: Column, value: str, ingest_ts: Column | None) -> DataFrame:
    return coerce_bronze(df.select(
        F.col("obs_date").alias("dt"), F.lit(dataset).alias("dataset"), series_id.alias("series_id"), geo.alias("geo"),
        F.col(value).alias("value"), F.lit(SOURCES[dataset]).alias("source")), ingest_ts)


def fx_to_bronze(documents: DataFrame, ingest_ts: Column | None = None, strict: bool = True) -> DataFrame:
    """Exchange-rate payloads; every rate belongs to the default area."""
    rows = payloads.flatten_fx(documents, strict)
    return _rows(rows, "ecb_fx_eu", clean.fx_series_id("quote_ccy", "base_ccy"), F.lit(DEFAULT_GEO), "rate", ingest_ts)


def rates_to_bronze(documents: DataFrame, ingest_ts: Column | None = None, strict: bool = True) -> DataFrame:
    """Policy-rate payloads; the label is the series id."""
    rows = payloads.flatten_rates(documents, strict=strict)
    return _rows(rows, "ecb_rates_eu", F.col("series_id"), F.lit(DEFAULT_GEO), "value", ingest_ts)


def pages_to_bronze(pages: DataFrame, ingest_ts: Column | None = None, strict: bool = True) -> DataFrame:
    """Energy price pages; prices have no area, and missing values stay as rows."""
    return _rows(payloads.flatten_pages(pages, strict), "energy_prices", F.col("series_id"), F.lit(MISSING_GEO), "value", ingest_ts)


def index_to_bronze(observations: DataFrame, ingest_ts: Column | None = None) -> DataFrame:
    """Rows of :func:`payloads.read_sdmx_csv`; the item code is the series id, a blank area the default one."""
    return _rows(observations, "eurostat_hicp", F.col("coicop"), clean.default_geo("geo"), "value", ingest_ts)
