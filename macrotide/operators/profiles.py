"""Column profiles of a growing layer: mergeable sketches are stored per day and united on read, so old days are not read again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from macrotide.operators import versions
from macrotide.session import cut_lineage

# Sizes of the sketches: about 1.6 % standard error of a distinct count, about 1.3 % of rows of a rank.
LOG_BUCKETS, RANK_SIZE = 12, 200
KEYS = ["month", "day", "column_name"]


def _entry(field: T.StructField) -> Column:
    """Counts and sketches of a column; a sketch of distinct values takes texts, one of ranks takes numbers."""
    c = F.col(field.name)
    numeric = isinstance(field.dataType, T.NumericType)
    number = c.cast("double") if numeric else F.lit(None).cast("double")
    return F.struct(
        F.lit(field.name).alias("column_name"), F.count(F.lit(1)).alias("n_rows"), F.count_if(c.isNull()).alias("n_null"),
        F.hll_sketch_agg(c.cast("string"), LOG_BUCKETS).alias("values"),
        (F.kll_sketch_agg_double(number, RANK_SIZE) if numeric else F.lit(None).cast("binary")).alias("ranks"),
        F.min(number).alias("least"), F.max(number).alias("greatest"))


def daily(df: DataFrame, day: str, columns: list[str]) -> DataFrame:
    """One row per day and column, of some kilobytes whatever the day holds: counts, sketches, least and greatest number.

    All columns share one scan and one shuffle of a sketch per day and task. Rows without a day fail the job. NaN is a
    value, the greatest one, in counts and extremes; ranks leave it out.
    """
    date = F.col(day).cast("date")
    date = F.when(date.isNotNull(), date).otherwise(F.raise_error(F.lit(f"{day} is missing")).cast("date"))
    entries = [_entry(df.schema[c]) for c in columns]
    return (df.withColumn("_day", date).groupBy("_day").agg(F.array(*entries).alias("entries"))
            .select(F.col("_day").alias("day"), F.inline("entries")).select(F.trunc("day", "month").alias("month"), "*"))


def store(df: DataFrame, root: str, day: str, columns: list[str]) -> int:
    """Keep the profile of the days in ``df``, which must hold those days whole; days profiled before are replaced, others stay.

    Storing twice leaves the same profile. Returns the version of the stored table.
    """
    rows = cut_lineage(daily(df, day, columns), "profile")  # a replace reads its rows twice
    if not versions.versions(df.sparkSession, root):
        return versions.create(rows, root, "month")
    return versions.replace(rows, root, KEYS)


def profile(spark: SparkSession, root: str, ranks: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``column_name, n_rows, n_null, n_distinct, least, greatest, quantiles`` over all stored days.

    Counts and extremes are exact, distinct counts and quantiles as good as one sketch over all rows. Columns without a number
    have no extremes and no quantiles.
    """
    united = versions.read(spark, root).groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_null").alias("n_null"), F.hll_sketch_estimate(F.hll_union_agg("values")).alias("n_distinct"),
        F.min("least").alias("least"), F.max("greatest").alias("greatest"), F.kll_merge_agg_double("ranks", RANK_SIZE).alias("_ranks"))
    has = F.coalesce(F.kll_sketch_get_n_double("_ranks"), F.lit(0)) > 0
    quantiles = F.kll_sketch_get_quantile_double("_ranks", F.array(*[F.lit(float(p)) for p in ranks]))
    return united.withColumn("quantiles", F.when(has, quantiles)).drop("_ranks")
