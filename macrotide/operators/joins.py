"""Join on keys that may be missing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match each other, as they do in a GROUP BY; keys come from the left."""
    if not keys:
        raise ValueError("a join needs at least one key")
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, same, how).drop(*[f"_right_{k}" for k in keys])
