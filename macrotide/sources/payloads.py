"""Landed API payloads: SDMX-JSON, SDMX-CSV and paged JSON observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from macrotide.functions import clean

# Observation arrays may carry text attributes after the value, so they are read as text.
_OBSERVATIONS = "map<string,array<string>>"
CORRUPT = "_corrupt_record"
_DIMENSION = "array<struct<id:string,values:array<struct<id:string>>>>"
SDMX_JSON = (
    f"structure struct<dimensions:struct<series:{_DIMENSION},observation:{_DIMENSION}>>,"
    f"dataSets array<struct<series:map<string,struct<observations:{_OBSERVATIONS}>>,"
    f"observations:{_OBSERVATIONS}>>"
)
PAGE_JSON = "observations array<struct<date:string,value:string>>"


def read_json(spark: SparkSession, path: str, schema: str, multiline: bool = False) -> DataFrame:
    """Payload files with a fixed schema (no inference pass); one document per line or per file.

    Hive folders such as ``label=MRR`` or ``series_id=...`` above the files become columns. A document that
    cannot be parsed is kept whole in ``_corrupt_record``: the flatteners fail on it, or leave it out with
    ``strict=False``, and :func:`refused` lists it.
    """
    reader = spark.read.schema(f"{schema}, {CORRUPT} string").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.option("mode", "PERMISSIVE").option("multiLine", multiline).json(path)


def _readable(payloads: DataFrame, content: Column) -> Column:
    """Parsed, and with the part that its kind of document must have."""
    parsed = F.col(CORRUPT).isNull() if CORRUPT in payloads.columns else F.lit(True)
    return parsed & F.coalesce(content, F.lit(False))


def _kept(payloads: DataFrame, valid: Column, strict: bool, message: str) -> DataFrame:
    if strict:
        valid = F.when(valid, F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean"))
    return payloads.filter(valid)


def _has_data() -> Column:
    return F.col("structure").isNotNull() & (F.size("dataSets") > 0)


def _has_currencies() -> Column:
    dims = F.col("structure.dimensions.series")
    return _has_data() & (_dimension_position(dims, "CURRENCY") > 0) & (_dimension_position(dims, "CURRENCY_DENOM") > 0)


def accepted(payloads: DataFrame, kind: str) -> Column:
    """Whether a flattener accepts a document: ``kind`` is ``fx``, ``rates`` or ``pages``."""
    content = {"fx": _has_currencies, "rates": _has_data, "pages": lambda: F.col("observations").isNotNull()}[kind]()
    return _readable(payloads, content)


def refused(payloads: DataFrame, kind: str) -> DataFrame:
    """Documents that a flattener does not accept."""
    return payloads.filter(~accepted(payloads, kind))


def _dimension_position(dims: Column, name: str) -> Column:
    """1-based position of a series dimension, 0 when it is absent."""
    return F.coalesce(F.array_position(F.transform(dims, lambda d: d["id"]), name), F.lit(0))


def _times(df_structure: Column) -> Column:
    return F.transform(F.try_element_at(df_structure, F.lit(1))["values"], lambda v: v["id"])


def _first_value(observation: Column) -> Column:
    return clean.to_double_or_null(F.try_element_at(observation, F.lit(1)))


def _time_at(times: Column, index: Column, strict: bool) -> Column:
    """Period of an observation; an index beyond the time axis fails, or is NULL without ``strict``."""
    found = _at(times, index)
    if not strict:
        return found
    return F.when(found.isNotNull(), found).otherwise(F.raise_error(F.lit("observation beyond the time axis")).cast("string"))


def _at(array: Column, zero_based: Column) -> Column:
    return F.try_element_at(array, (zero_based.cast("int") + F.lit(1)))


def invalid_fx_payloads(payloads: DataFrame) -> DataFrame:
    """Payloads that cannot be parsed or lack the quote or base currency dimension."""
    return refused(payloads, "fx")


def flatten_fx(payloads: DataFrame, strict: bool = True) -> DataFrame:
    """SDMX-JSON exchange rates to ``obs_date, quote_ccy, base_ccy, rate``; NULL observations are dropped.

    A series key such as ``0:3:0:0:0`` indexes the code list of each dimension. With ``strict`` a
    payload that cannot be parsed or has no currency dimensions fails the job, and so does an observation
    beyond the time axis; otherwise they yield no rows (list the payloads with :func:`refused`).
    """
    dims = F.col("structure.dimensions.series")
    quote, base = _dimension_position(dims, "CURRENCY"), _dimension_position(dims, "CURRENCY_DENOM")
    payloads = _kept(payloads, _readable(payloads, _has_currencies()), strict, "payload unreadable or without currency dimensions")
    series = payloads.select(
        _times(F.col("structure.dimensions.observation")).alias("times"),
        quote.alias("quote_pos"), base.alias("base_pos"),
        dims.alias("dims"),
        F.explode(F.try_element_at("dataSets", F.lit(1))["series"]).alias("series_key", "body"),
    )

    def code(position: str) -> Column:
        index = F.try_element_at(F.split("series_key", ":"), F.col(position).cast("int"))
        values = F.try_element_at(F.col("dims"), F.col(position).cast("int"))["values"]
        return _at(values, index)["id"]

    # Codes are looked up once per series, before its observations are expanded.
    coded = series.select("times", code("quote_pos").alias("quote_ccy"), code("base_pos").alias("base_ccy"),
                          F.col("body.observations").alias("observations"))
    rows = coded.select("times", "quote_ccy", "base_ccy", F.explode("observations").alias("obs_index", "obs"))
    return rows.select(
        _time_at(F.col("times"), F.col("obs_index"), strict).alias("obs_date"),
        "quote_ccy", "base_ccy", _first_value(F.col("obs")).alias("rate"),
    ).filter(F.col("rate").isNotNull() & F.col("obs_date").isNotNull())


def flatten_rates(payloads: DataFrame, label: str = "label", strict: bool = True) -> DataFrame:
    """SDMX-JSON policy rates to ``obs_date, series_id, value``; ``strict`` as for :func:`flatten_fx`.

    Observations sit below ``series`` or, when a payload has no series, at the top level; both shapes
    become one array first, so every payload is read once. ``label`` names the caller's series column.
    """
    payloads = _kept(payloads, _readable(payloads, _has_data()), strict, "payload unreadable or without data sets")
    data = F.try_element_at("dataSets", F.lit(1))
    nested = F.transform(F.map_values(data["series"]), lambda s: s["observations"])
    has_series = F.coalesce(F.size(F.map_keys(data["series"])), F.lit(0)) > 0
    groups = F.when(has_series, nested).otherwise(F.array(data["observations"]))
    bodies = payloads.select(
        F.col(label).alias("series_id"),
        _times(F.col("structure.dimensions.observation")).alias("times"),
        F.explode(groups).alias("observations"),
    )
    rows = bodies.select("series_id", "times", F.explode("observations").alias("obs_index", "obs"))
    return rows.select(
        clean.period_to_iso(_time_at(F.col("times"), F.col("obs_index"), strict)).alias("obs_date"),
        "series_id", _first_value(F.col("obs")).alias("value"),
    ).filter(F.col("value").isNotNull() & F.col("obs_date").isNotNull())


def read_sdmx_csv(spark: SparkSession, path: str) -> DataFrame:
    """SDMX-CSV index observations to ``obs_date, geo, coicop, unit, value``.

    Columns are taken by header name, since such files carry more columns in no fixed order. All files of
    one read must share a header: another one fails the job. A missing geo, coicop or unit column is blank.
    Rows without a period or a numeric value are skipped.
    """
    raw = spark.read.option("header", "true").option("enforceSchema", "false").option("escape", '"').csv(path)
    text = lambda name: F.coalesce(F.col(name), F.lit("")) if name in raw.columns else F.lit("")
    return raw.select(
        clean.period_to_iso("TIME_PERIOD").alias("obs_date"), text("geo").alias("geo"), text("coicop").alias("coicop"),
        text("unit").alias("unit"), clean.to_double_or_null("OBS_VALUE").alias("value"),
        *[F.col(c).alias(f"_{i}") for i, c in enumerate(raw.columns)],  # all columns are named, so that headers are compared whole
    ).filter((F.length("obs_date") > 0) & F.col("value").isNotNull()).select("obs_date", "geo", "coicop", "unit", "value")


def flatten_pages(pages: DataFrame, strict: bool = True) -> DataFrame:
    """Paged JSON observations to ``obs_date, series_id, value``; NULL values stay, dateless rows go.

    With ``strict`` a page that cannot be parsed or has no observations fails the job.
    """
    pages = _kept(pages, _readable(pages, F.col("observations").isNotNull()), strict, "page unreadable or without observations")
    rows = pages.select("series_id", F.explode("observations").alias("o"))
    return rows.select(
        F.trim("o.date").alias("obs_date"), "series_id", clean.value_or_null("o.value").alias("value"),
    ).filter(F.length("obs_date") > 0)


# The two energy series of the catalogue.
ENERGY_CATALOGUE = [
    ("POILBREUSDM", "Global price of Brent Crude", "USD per Barrel", "Monthly",
     "FRED/World Bank (Primary Commodity Prices)"),
    ("PNGASEUUSDM", "Global price of Natural gas, EU", "USD per MMBtu", "Monthly",
     "FRED/World Bank (Primary Commodity Prices)"),
]


def energy_catalogue(spark: SparkSession) -> DataFrame:
    """The catalogue as a literal relation, so its (constant) size is known to the join planner."""
    names = ["series_id", "name", "unit", "frequency", "source"]
    entries = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in ENERGY_CATALOGUE]
    return spark.range(1).select(F.inline(F.array(*entries)))


def attach_catalogue(df: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Add unit, frequency and source of each series; series the catalogue lacks are left out.

    No broadcast hint: Spark knows the size of a literal or file catalogue and picks the join by it.
    """
    return df.join(catalogue.select("series_id", "unit", "frequency", "source"), "series_id")
