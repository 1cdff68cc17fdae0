"""Registry of checked queries: a Spark callable and, where SQL can say it, its DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def query(name: str, sql: str | None = None, needs: tuple[str, ...] = ()):
    """Register a query; ``needs`` names the common table expressions its SQL starts from."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = with_ctes(needs, sql)
        return fn

    return register


def cte(name: str, sql: str, needs: tuple[str, ...] = ()) -> None:
    CTES[name] = (needs, sql)


def with_ctes(needs: tuple[str, ...], body: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for parent in CTES[name][0]:
                visit(parent)
            ordered.append(name)

    for name in needs:
        visit(name)
    if not ordered:
        return body
    parts = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in ordered)
    body = body.strip()
    return f"WITH {parts},\n{body[5:]}" if body.startswith("WITH ") else f"WITH {parts}\n{body}"


def r(expression: str, digits: int = 6) -> str:
    """SQL rounding; adding 0.0 turns a negative zero into zero, as Spark's round does."""
    return f"(round({expression}, {digits}) + 0.0)"


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every DOUBLE column, so that the order of additions does not show."""
    return df.select([
        (F.round(f.name, digits) + F.lit(0.0)).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields])
