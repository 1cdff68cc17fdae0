"""Run ids and model version labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from macrotide.functions.clean import _col


def canonical_json(columns: Column | str, params: Column | str) -> Column:
    """JSON text ``{"cols": [...], "params": {...}}`` with sorted keys and ``", "`` / ``": "`` separators.

    ``columns`` is an array of names, ``params`` a map from name to a value that is already JSON text.
    """
    names = F.transform(_col(columns), lambda c: F.concat(F.lit('"'), c, F.lit('"')))
    pairs = F.transform(
        F.array_sort(F.map_entries(_col(params))),
        lambda e: F.concat(F.lit('"'), e["key"], F.lit('": '), e["value"]),
    )
    return F.concat(
        F.lit('{"cols": ['), F.array_join(names, ", "),
        F.lit('], "params": {'), F.array_join(pairs, ", "), F.lit("}}"),
    )


def model_version(payload: Column | str, created_at: Column | str, prefix: str = "gbt") -> Column:
    """``<prefix>_<UTC stamp>_<first 8 hex of SHA-1>``"""
    stamp = F.date_format(_col(created_at), "yyyyMMdd'T'HHmmss'Z'")
    return F.concat_ws("_", F.lit(prefix), stamp, F.substring(F.sha1(_col(payload)), 1, 8))


def run_id() -> Column:
    """Random id. Write the rows that carry it before reusing them: it differs on every evaluation."""
    return F.expr("uuid()")
