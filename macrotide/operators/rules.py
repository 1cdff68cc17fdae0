"""Declared data-quality rules of a table, compiled into one pass over it."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rules:
    """What must hold for every row (``required``, ``accepted``, ``finite``) and for every key (``unique``, ``least``)."""

    required: tuple[str, ...] = ()
    accepted: Mapping[str, tuple] = field(default_factory=dict)
    finite: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    least: Mapping[tuple[str, ...], int] = field(default_factory=dict)


# The rules declared for the gold tables and the two wide views.
GOLD = {
    "dim_time": Rules(required=("month",), unique=(("month",),)),
    "fact_hicp": Rules(required=("month", "geo", "hicp_index")),
    "fact_macro": Rules(required=("month", "geo")),
    "gold_nowcast_input": Rules(required=("target_hicp_index",)),
    "v_hicp_dashboard_wide": Rules(required=("month", "index_value", "source"), accepted={"source": ("actual", "nowcast")}),
    "v_macro_monthly_wide": Rules(required=("ref_month",)),
}


def _row_rules(rules: Rules) -> list[tuple[str, str, Column]]:
    """Rule, column and the condition of a failing row."""
    out = [("not_null", c, F.col(c).isNull()) for c in rules.required]
    # NULL is the not-null rule's business; without a permitted value every value fails.
    out += [("accepted_values", c, F.col(c).isNotNull() & (~F.col(c).isin(*v) if v else F.lit(True))) for c, v in rules.accepted.items()]
    return out + [("finite", c, F.isnan(c) | (F.abs(F.col(c)) == F.lit(float("inf")))) for c in rules.finite]


def check(df: DataFrame, table: str, rules: Rules) -> DataFrame:
    """``table_name, rule, column_name, failures, passed``: one row per rule, in one scan and at most one shuffle that grows.

    Row rules count failing rows. ``unique`` counts keys that occur more than once, ``least`` keys with fewer rows than
    required; keys with a NULL belong to neither. Sets of key columns become grouping sets of one aggregate, combined
    before its shuffle, which carries the counts of the row rules along; a key with a large share of the rows costs no
    more than any other. An empty table breaks no rule.
    """
    rows = _row_rules(rules)
    if not (rows or rules.unique or rules.least):
        raise ValueError(f"{table} has no rules")
    flags = [F.coalesce(bad, F.lit(False)).cast("long").alias(f"_f{i}") for i, (_, _, bad) in enumerate(rows)]
    names = [f"_f{i}" for i in range(len(rows))]
    sets = list(dict.fromkeys(tuple(sorted(set(k))) for k in (*rules.unique, *rules.least)))
    columns = sorted({c for s in sets for c in s})
    results = [(rule, c, F.sum(f"_f{i}")) for i, (rule, c, _) in enumerate(rows)]
    if not sets:
        return _reported(df.select(*flags).agg(*_named(results)), table, results)

    keyed = df.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(columns)], *flags)
    place = {c: f"_k{i}" for i, c in enumerate(columns)}
    counted = keyed.groupingSets([[F.col(place[c]) for c in s] for s in sets], *place.values()).agg(
        F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_n"), *[F.sum(n).alias(n) for n in names])

    def of(key: tuple[str, ...]) -> Column:
        bits = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in key)
        return F.col("_set") == F.lit(bits)

    def present(key: tuple[str, ...]) -> Column:
        return reduce(lambda a, b: a & b, [F.col(place[c]).isNotNull() for c in key], of(key))

    # Every row is in every grouping set; the first one carries the row rules.
    results = [(rule, c, F.sum(F.when(of(sets[0]), F.col(f"_f{i}")))) for i, (rule, c, _) in enumerate(rows)]
    results += [("unique", ",".join(k), F.count_if(present(k) & (F.col("_n") > 1))) for k in rules.unique]
    results += [("minimum_rows", ",".join(k), F.count_if(present(k) & (F.col("_n") < n))) for k, n in rules.least.items()]
    return _reported(counted.agg(*_named(results)), table, results)


def _named(results: list[tuple[str, str, Column]]) -> list[Column]:
    return [F.coalesce(failing, F.lit(0)).cast("long").alias(f"_r{i}") for i, (_, _, failing) in enumerate(results)]


def _reported(one: DataFrame, table: str, results: list[tuple[str, str, Column]]) -> DataFrame:
    entries = [F.struct(F.lit(rule).alias("rule"), F.lit(c).alias("column_name"), F.col(f"_r{i}").alias("failures"))
               for i, (rule, c, _) in enumerate(results)]
    return one.select(F.inline(F.array(*entries))).select(
        F.lit(table).alias("table_name"), "rule", "column_name", "failures", (F.col("failures") == 0).alias("passed"))


def check_all(tables: Mapping[str, DataFrame], declared: Mapping[str, Rules] = GOLD) -> DataFrame:
    """Every declared rule of the given tables; a table without rules is left out, a run does not stop at a failure."""
    checked = [check(df, name, declared[name]) for name, df in tables.items() if name in declared]
    if not checked:
        raise ValueError("no table has rules")
    return reduce(DataFrame.unionByName, checked)
