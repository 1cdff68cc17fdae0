"""Row counts, data-quality rules and the column catalogue."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``table_name, n_rows`` for several tables in one plan."""
    counts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
              for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def reconcile(left: DataFrame, right: DataFrame, by: str = "dataset") -> DataFrame:
    """Counts per dataset of two layers beside each other; each layer is read once."""
    a = left.groupBy(by).agg(F.count(F.lit(1)).alias("left_rows"))
    b = right.groupBy(by).agg(F.count(F.lit(1)).alias("right_rows"))
    missing = F.lit(0)
    return a.join(b, by, "full").select(
        by, F.coalesce("left_rows", missing).alias("left_rows"), F.coalesce("right_rows", missing).alias("right_rows"),
    ).withColumn("difference", F.col("left_rows") - F.col("right_rows"))


def not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Failing rows per column, all columns in one pass."""
    failing = df.agg(*[_count_if(F.col(c).isNull()).alias(c) for c in columns])
    return failing.unpivot([], columns, "column_name", "failures").select(
        F.lit("not_null").alias("rule"), "column_name", "failures")


def unique(df: DataFrame, columns: list[str]) -> DataFrame:
    """Number of key values that occur more than once (NULL keys are the not-null rule's business)."""
    keyed = df.dropna(subset=columns).groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    return keyed.agg(_count_if(F.col("_n") > 1).alias("failures")).select(
        F.lit("unique").alias("rule"), F.lit(",".join(columns)).alias("column_name"), "failures")


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    bad = F.col(column).isNotNull() & ~F.col(column).isin(values)
    return df.agg(_count_if(bad).alias("failures")).select(
        F.lit("accepted_values").alias("rule"), F.lit(column).alias("column_name"), "failures")


def non_finite(df: DataFrame, columns: list[str]) -> DataFrame:
    """NaN or infinite values per column (NULL passes)."""
    inf = F.lit(float("inf"))
    failing = df.agg(*[_count_if(F.isnan(c) | (F.abs(F.col(c)) == inf)).alias(c) for c in columns])
    return failing.unpivot([], columns, "column_name", "failures").select(
        F.lit("finite").alias("rule"), "column_name", "failures")


def minimum_rows(df: DataFrame, keys: list[str], least: int) -> DataFrame:
    """Keys with fewer rows than required."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") < least)


def check_constraints(df: DataFrame, required: list[str], key: list[str] | None = None) -> DataFrame:
    """Declared NOT NULL columns and primary key of a table as rule rows."""
    rules = not_null(df, required)
    return rules if key is None else rules.unionByName(unique(df, key))


def _count_if(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def column_profile(df: DataFrame, layer: str, table: str, exact: bool = False) -> DataFrame:
    """Catalogue of a table: position, type, NULL count and distinct count per column.

    The approximate form is one aggregate over one scan. The exact form counts distinct values column
    by column over distinct (column, value) pairs, which Spark pre-aggregates before the shuffle.
    """
    fields = df.schema.fields
    entries = [F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                        F.lit(i).alias("position")) for i, f in enumerate(fields, start=1)]
    catalogue = df.sparkSession.range(1).select(F.inline(F.array(*entries)))
    if exact:
        pairs = df.select([F.col(f.name).cast("string").alias(f.name) for f in fields]).unpivot(
            [], [f.name for f in fields], "column_name", "_value")
        counted = pairs.groupBy("column_name", "_value").agg(F.count(F.lit(1)).alias("_n"))
        stats = counted.groupBy("column_name").agg(
            F.coalesce(F.sum(F.when(F.col("_value").isNull(), F.col("_n"))), F.lit(0)).alias("n_null"),
            F.count("_value").alias("n_distinct"))
    else:
        one = df.agg(*[
            F.struct(_count_if(F.col(f.name).isNull()).alias("n_null"),
                     F.approx_count_distinct(f.name).alias("n_distinct")).alias(f.name) for f in fields])
        stats = one.unpivot([], [f.name for f in fields], "column_name", "_s").select(
            "column_name", "_s.n_null", "_s.n_distinct")
    return catalogue.join(stats, "column_name", "left").select(
        F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "column_name", "data_type", "position",
        F.coalesce("n_null", F.lit(0)).alias("n_null"), F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"))
