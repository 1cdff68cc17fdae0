"""Bronze files: hive folders ``<dataset>/dt=YYYY-MM-DD/part-*.csv``, exports and materialised tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from macrotide.functions import clean
from macrotide.schemas import BRONZE_COLUMNS, MISSING_GEO, strings

LAYERS = ["bronze", "silver", "gold", "ml", "observability"]

_CSV_OPTIONS = {
    "header": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "escape": '"',
}


def read_bronze(spark: SparkSession, root: str, dataset: str, dt_in_file: bool = True, days: str = "*") -> DataFrame:
    """All text rows of a dataset's partition files.

    CSV columns are matched by position, so a ``dt`` column inside the file is named ``dt_in_file``;
    ``dt`` itself comes from the folder. Only ``dt=`` folders are globbed, which keeps out ``Batch/``
    exports, and their files are listed in parallel; ``days`` (say ``2024-*``) limits the listing itself.
    """
    names = [c for c in BRONZE_COLUMNS if c != "dt"]
    schema = strings((["dt_in_file"] if dt_in_file else []) + names)
    base = f"{root}/{dataset}"
    return (
        spark.read.schema(schema).options(**_CSV_OPTIONS).option("pathGlobFilter", "part-*.csv")
        .option("basePath", base).csv(f"{base}/dt={days}")
    )


def stage(df: DataFrame, *carried: str) -> DataFrame:
    """Typed staging rows: bad values become NULL, blank geo becomes the default area; ``carried`` columns stay as they are."""
    return df.select(
        clean.to_date_or_null("dt").alias("dt"),
        "dataset",
        "series_id",
        clean.default_geo("geo").alias("geo"),
        clean.to_double_or_null("value").alias("value"),
        "source",
        clean.to_timestamp_or_null("ingest_ts").alias("ingest_ts"),
        *carried,
    )


def misplaced_dates(df: DataFrame) -> DataFrame:
    """Rows whose in-file date disagrees with their folder."""
    return df.filter(~F.col("dt_in_file").eqNullSafe(F.date_format(F.col("dt").cast("date"), "yyyy-MM-dd")))


def coerce_bronze(df: DataFrame, ingest_ts: Column | None = None) -> DataFrame:
    """Any row shape to the seven text columns of Bronze.

    Missing columns become NULL, dates ISO text, an empty geo ``NA`` and an empty ``ingest_ts`` the
    given stamp (by default the query's start in whole seconds, UTC).
    """
    if ingest_ts is None:
        ingest_ts = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()),
                                  "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    types = dict(zip(df.columns, (f.dataType for f in df.schema.fields)))

    def column(name: str) -> Column:
        if name not in types:
            return F.lit(None).cast("string")
        if isinstance(types[name], (T.DateType, T.TimestampType, T.TimestampNTZType)) and name == "dt":
            return F.date_format(name, "yyyy-MM-dd")
        return F.col(name).cast("string")

    out = {name: column(name) for name in BRONZE_COLUMNS}
    out["geo"] = F.coalesce(F.nullif(out["geo"], F.lit("")), F.lit(MISSING_GEO))
    out["ingest_ts"] = F.coalesce(F.nullif(out["ingest_ts"], F.lit("")), ingest_ts)
    return df.select([c.alias(n) for n, c in out.items()])


def write_bronze(df: DataFrame, root: str, dataset: str, fmt: str = "csv",
                 keep_dt_in_file: bool = False, ingest_ts: Column | None = None) -> str:
    """Append rows below ``<root>/<dataset>/dt=...``.

    The rebalance hint gathers each day's rows, so a run adds few files per day, and lets AQE split a
    day that holds a large share of the rows over several tasks and files.
    """
    out = coerce_bronze(df, ingest_ts)
    if keep_dt_in_file:
        out = out.select(F.col("dt").alias("dt_in_file"), *BRONZE_COLUMNS)
    path = f"{root}/{dataset}"
    writer = (
        out.hint("rebalance", "dt").sortWithinPartitions("dt", "series_id", "geo")
        .write.partitionBy("dt").mode("append")
    )
    if fmt == "csv":
        writer = writer.options(**_CSV_OPTIONS)
    writer.format(fmt).save(path)
    return path


def files_per_dataset(spark: SparkSession, root: str, datasets: list[str]) -> DataFrame:
    """Number of partition files per dataset, from file listings (no file content is read)."""
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*")
        .load([f"{root}/{d}" for d in datasets]).select("path")
    )
    name = F.regexp_extract("path", r"/([^/]+)/dt=[^/]+/[^/]+$", 1)
    return listed.groupBy(name.alias("dataset")).agg(F.count("*").alias("n_files")).filter(F.col("dataset") != "")


def export_batch(df: DataFrame, path: str, order: list[str], load_ts: str | None = None) -> str:
    """Analyst export: globally sorted flat CSV, optionally with a load stamp column."""
    out = df if load_ts is None else df.withColumn("load_ts", F.lit(load_ts))
    export_csv(out.orderBy(*order), path)
    return path


def export_csv(df: DataFrame, path: str) -> str:
    """Header CSV of a result; one file per task, so size is not bound by one machine."""
    df.write.options(**_CSV_OPTIONS).csv(path)
    return path


def read_export(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).options(**_CSV_OPTIONS).csv(path)


def create_layers(spark: SparkSession) -> None:
    """One database per layer."""
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")


def materialise(df: DataFrame, table: str, path: str | None = None,
                partition_by: list[str] | None = None) -> DataFrame:
    """CREATE OR REPLACE TABLE AS: overwrite ``table`` and return it. Do not pass a plan that reads it."""
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """CREATE OR REPLACE VIEW: lazy, expanded into whatever reads it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
