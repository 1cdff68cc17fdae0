"""Join sides of a checked size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macrotide.session import cut_lineage

BROADCAST_ROWS = 1_000_000


def checked(keys: DataFrame, purpose: str, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Store a frame of a few numbers per row; broadcast it in joins only if it has at most ``rows`` rows.

    Beyond that bound Spark plans the join itself, by size, with a shuffle.
    """
    stored = cut_lineage(keys, purpose)
    return F.broadcast(stored) if stored.count() <= rows else stored


def sampled(rows: DataFrame, about: int, key: str) -> DataFrame:
    """All rows, or about ``about`` of them by the hash of a key where there are more; the same on every run.

    No task and no driver sorts or gathers the others.
    """
    n = rows.count()
    if n <= about:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1 << 30)) < int((1 << 30) * about / n))
