"""Bronze to silver: newest vintage, cleaned geo, labels per dataset, one union."""

from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macrotide.functions import clean
from macrotide.operators.keyed import last_write_wins
from macrotide.schemas import DATASET_LABELS


def dataset_labels(dataset: Column | str, labels: dict = DATASET_LABELS) -> tuple[Column, Column, Column]:
    """Measure, unit and frequency of a dataset code, looked up in a constant map."""
    code = clean._col(dataset)

    def lookup(i: int) -> Column:
        pairs = chain.from_iterable((F.lit(k), F.lit(v[i]).cast("string")) for k, v in labels.items())
        return F.create_map(*pairs)[code]

    return lookup(0), lookup(1), lookup(2)


def to_silver(bronze: DataFrame) -> DataFrame:
    """Long table with labels, for one dataset or several at once."""
    measure, unit, freq = dataset_labels("dataset")
    return bronze.select(
        F.col("dt").alias("ts_date"),
        clean.null_tokens("geo").alias("geo"),
        "series_id",
        measure.alias("measure"),
        "value",
        unit.alias("unit"),
        freq.alias("freq"),
        "source",
        F.col("ingest_ts").alias("vintage_ts"),
    )


def silver_from_staging(staging: DataFrame) -> DataFrame:
    return to_silver(last_write_wins(staging, ["dataset", "dt", "geo", "series_id"]))


def all_series(tables: list[DataFrame]) -> DataFrame:
    """Every silver table in one, columns matched by name."""
    return reduce(DataFrame.unionByName, tables)


def select_series(silver: DataFrame, geo: str | None = None, series_id: str | None = None,
                  unit: str | None = None, freq: str | None = None,
                  start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows of the asked series; start and end may be a year, a month or a day and are inclusive."""
    out = silver
    for column, wanted in {"geo": geo, "series_id": series_id, "unit": unit, "freq": freq}.items():
        if wanted is not None:
            out = out.filter(F.col(column) == wanted)
    if start is not None:
        out = out.filter(F.col("ts_date") >= F.lit(_first_day(start)).cast("date"))
    if end is not None:
        step = {4: "interval 1 year", 7: "interval 1 month"}.get(len(end), "interval 1 day")
        out = out.filter(F.col("ts_date") < (F.lit(_first_day(end)).cast("date") + F.expr(step)).cast("date"))
    return out


def _first_day(period: str) -> str:
    return period + {4: "-01-01", 7: "-01"}.get(len(period), "")
