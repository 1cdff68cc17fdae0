"""Model registry: append-only tables of runs, metrics, parameters, importances and predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from macrotide.schemas import KEYS, NOWCAST_OUTPUT, REGISTRY, REQUIRED


def conform(df: DataFrame, table: str) -> DataFrame:
    """Columns of a registry table in order and type; columns the input lacks are NULL."""
    schema = NOWCAST_OUTPUT if table == "nowcast_output" else REGISTRY[table]
    have = set(df.columns)
    return df.select([
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def _taken_keys(new: DataFrame, root: str, table: str, key: list[str]) -> DataFrame:
    """Keys that occur twice in the new rows, or once there and once in the table."""
    spark = new.sparkSession
    twice = new.groupBy(*key).agg(F.count("*").alias("_n")).where("_n > 1").select(*key)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{table}")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return twice
    return twice.unionByName(read(spark, root, table).select(*key).join(new.select(*key), key, "left_semi"))


def append(df: DataFrame, root: str, table: str) -> None:
    """Append typed rows; a NULL in a required column fails the write before anything is committed, and so does a
    key of the table (``KEYS``) that is there already or comes twice."""
    typed = conform(df, table)
    key = KEYS.get(table)
    if key and not _taken_keys(typed, root, table, key).isEmpty():
        raise ValueError(f"{table}: {', '.join(key)} must be unique")
    checked = typed.select([
        F.coalesce(F.col(c), F.raise_error(F.lit(f"{table}.{c} is required")).cast(typed.schema[c].dataType)).alias(c)
        if c in REQUIRED[table] else F.col(c) for c in typed.columns])
    checked.write.mode("append").parquet(f"{root}/{table}")


def read(spark: SparkSession, root: str, table: str) -> DataFrame:
    schema = NOWCAST_OUTPUT if table == "nowcast_output" else REGISTRY[table]
    return spark.read.schema(schema).parquet(f"{root}/{table}")


def params_rows(runs: DataFrame, params: str = "params") -> DataFrame:
    """A map column of parameters to ``run_id, name, value`` rows."""
    return runs.select("run_id", F.explode(params).alias("name", "value"))


def feature_list(features: str = "features"):
    """Array of feature names as the comma-separated text of an export."""
    return F.concat_ws(",", features)


def nowcast_rows(walk_forward: DataFrame, model_version: str, created_at) -> DataFrame:
    """Walk-forward rows in the shape of the nowcast output table."""
    return walk_forward.select(
        "month", "geo", F.lit(model_version).alias("model_version"),
        F.col("y_pred_level").alias("y_nowcast"), F.col("y_true_level").alias("y_actual"), "residual",
        created_at.alias("created_at_utc"))


def latest_run_metrics(runs: DataFrame, metrics: DataFrame) -> DataFrame:
    """Metrics of the run(s) with the newest finish; the maximum is a one-row side of an equi-join."""
    newest = runs.agg(F.max("finished_at_utc").alias("finished_at_utc"))
    latest = runs.select("run_id", "model_version", "finished_at_utc").join(newest, "finished_at_utc")
    return latest.join(metrics, "run_id").select("model_version", "finished_at_utc", "metric", "value")
