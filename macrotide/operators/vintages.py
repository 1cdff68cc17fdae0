"""Newest versions kept in buckets of their key: a batch is merged without shuffling what is stored.

The store is one folder of Parquet files, bucketed and sorted by the key, with one row per key. A merge reads it bucket by bucket,
shuffles the batch alone to the same buckets, and writes the next store to a folder of its own; the old one stays as it was.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from macrotide.operators.keyed import VINTAGE_KEY, last_write_wins


def _named(keys: list[str]) -> list[str]:
    return [f"_key_{c}" for c in keys]


def _placed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Texts of the key columns that are never NULL, since a bucketed join needs plain equality: ``v`` and the value, or ``n``."""
    texts = [F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n")).alias(k) for c, k in zip(keys, _named(keys))]
    return rows.select("*", *texts)


def _written(rows: DataFrame, path: str, keys: list[str], buckets: int) -> None:
    spark, name = rows.sparkSession, f"vintages_{uuid.uuid4().hex}"
    texts = _named(keys)
    rows.write.format("parquet").bucketBy(buckets, *texts).sortBy(*texts).option("path", path).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay: the table is external


def _stored(spark: SparkSession, path: str, schema: T.StructType, keys: list[str], buckets: int) -> DataFrame:
    """The files as a table that knows its buckets; ``schema`` is that of the rows."""
    name = f"vintages_{uuid.uuid4().hex}"
    texts = ", ".join(f"`{c}`" for c in _named(keys))
    columns = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields] + [f"`{c}` string" for c in _named(keys)])
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({texts}) SORTED BY ({texts}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def create(rows: DataFrame, path: str, buckets: int, keys: list[str] = VINTAGE_KEY, stamp: str = "ingest_ts",
           tie_break: tuple[str, ...] = ("value", "source")) -> None:
    """First store: the newest version of every key. ``buckets`` is fixed for the life of a store: some hundred MB each, at its final size.

    Key columns are texts, dates, stamps or whole numbers; NULL is a value of its own, as in :func:`last_write_wins`.
    """
    newest = _placed(last_write_wins(rows, keys, stamp, tie_break), keys)
    _written(newest.repartition(buckets, *_named(keys)), path, keys, buckets)


def merged(batch: DataFrame, path: str, buckets: int, keys: list[str] = VINTAGE_KEY, stamp: str = "ingest_ts",
           tie_break: tuple[str, ...] = ("value", "source")) -> DataFrame:
    """Stored rows and those of ``batch`` as the newest version of every key, with the store's key texts.

    The batch is reduced to a row per key before it goes to the store's buckets; the stored side has no exchange and no
    sort. Of versions that agree in stamp and ties the stored one stays, so merging a batch twice changes nothing.
    """
    texts = _named(keys)
    newest = _placed(last_write_wins(batch, keys, stamp, tie_break), keys).repartition(buckets, *texts)
    stored = _stored(batch.sparkSession, path, batch.schema, keys, buckets)
    names = [*batch.columns, *texts]
    side = lambda df, name: df.select(*texts, F.struct(*names).alias(name))
    both = side(stored, "was").join(side(newest, "now"), texts, "full")
    order = lambda name: F.struct(*[F.col(f"{name}.{c}") for c in (stamp, *tie_break)])
    # In a struct NULL is less than any value, as NULLS LAST is in a descending order.
    chosen = (F.when(F.col("was").isNull(), F.col("now")).when(F.col("now").isNull(), F.col("was"))
              .when(order("now") > order("was"), F.col("now")).otherwise(F.col("was")))
    return both.select(chosen.alias("row")).select("row.*")


def merge(batch: DataFrame, path: str, into: str, buckets: int, keys: list[str] = VINTAGE_KEY, stamp: str = "ingest_ts",
          tie_break: tuple[str, ...] = ("value", "source")) -> None:
    """Write the merged rows as the store ``into``; a run that breaks leaves ``path`` whole and is repeated into a new folder."""
    _written(merged(batch, path, buckets, keys, stamp, tie_break), into, keys, buckets)


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of a store."""
    return spark.read.schema(schema).parquet(path)
