"""Latest-version selection and keyed replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


VINTAGE_KEY = ["dt", "geo", "series_id"]


def _newest_first(columns: list[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def latest_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key in a total order.

    ``row_number() = 1`` is planned with a group limit before the shuffle, so each task sends at most
    one row per key and a key that holds a large share of the rows costs no more than any other.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def last_write_wins(df: DataFrame, keys: list[str] = VINTAGE_KEY, stamp: str = "ingest_ts",
                    tie_break: tuple[str, ...] = ("value", "source")) -> DataFrame:
    """Newest version per key. Stamps have whole seconds, so ties are settled by further columns.

    Each task sends at most one row per key, however many versions a key has.
    """
    return latest_by(df, keys, _newest_first([stamp, *tie_break]))


def replace_by_key(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Delete every old row whose key occurs in ``new``, then insert ``new``.

    For a stored table use :func:`macrotide.operators.versions.replace`, which rewrites the touched parts only.
    """
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def append_if_absent(df: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Add rows whose key is not there yet; columns ``new`` lacks are NULL.

    The table is first narrowed to the new keys (a semi-join, so a small ``new`` is broadcast and the
    table is not shuffled); only that remainder meets ``new`` in the anti-join.
    """
    taken = df.select(*keys).join(new.select(*keys).distinct(), keys, "left_semi").distinct()
    return df.unionByName(new.join(taken, keys, "left_anti"), allowMissingColumns=True)


def newest_rows(df: DataFrame, order: list[str], n: int = 5, landed: str | None = None) -> DataFrame:
    """The n newest rows of a table (a distributed top-k, not a global sort).

    ``landed`` names a column that numbers rows as they arrived: of equally new rows those that came first are taken,
    whatever task reads them. Without it any of them may be.
    """
    return df.orderBy(*_newest_first(order), *[F.col(landed).asc()] * (landed is not None)).limit(n)


def top_features(importance: DataFrame, n: int = 10) -> DataFrame:
    return importance.orderBy(F.col("importance").desc_nulls_last(), F.col("feature").asc()).limit(n)
