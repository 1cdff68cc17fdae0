"""Error metrics and small reshaping aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macrotide.operators import orderstats
from macrotide.operators.joins import join_null_safe

# Metric names of the registry.
METRICS = ["mae", "median_ae", "rmse", "r2", "mape", "huber_loss", "max_error", "p90_error"]
HUBER_DELTA = 1.0


def _moment_metrics(y: Column, p: Column) -> dict[str, Column]:
    error = y - p
    size = F.abs(error)
    delta = F.lit(HUBER_DELTA)
    huber = F.when(size <= delta, F.lit(0.5) * size * size).otherwise(delta * (size - F.lit(0.5) * delta))
    return {
        "mae": F.avg(size),
        "rmse": F.sqrt(F.avg(error * error)),
        "r2": F.lit(1.0) - F.try_divide(F.sum(error * error), F.var_pop(y) * F.count(y)),
        "mape": F.avg(F.when(y != 0, F.abs(error / F.when(y != 0, y)))) * F.lit(100.0),
        "huber_loss": F.avg(huber),
        "max_error": F.max(size),
    }


def regression_metrics(df: DataFrame, keys: list[str], actual: str = "y_true", predicted: str = "y_pred",
                       bounded: bool = True) -> DataFrame:
    """Error metrics per key over the rows that have both values; NULL and NaN count as missing in every form.

    With ``bounded`` the quantiles come from the same aggregate, which keeps a group's distinct errors
    in one buffer: right for one series and model, whose rows are months. Use ``bounded=False`` for
    pooled groups: moments stay one aggregate, quantiles are found without gathering the group.
    """
    both = df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull() & ~F.isnan(actual) & ~F.isnan(predicted))
    y, p = F.col(actual), F.col(predicted)
    parts = _moment_metrics(y, p)
    if bounded:
        parts["median_ae"] = F.percentile(F.abs(y - p), 0.5)
        parts["p90_error"] = F.percentile(F.abs(y - p), 0.9)
        return both.groupBy(*keys).agg(*[parts[m].alias(m) for m in METRICS])
    errors = both.withColumn("_abs", F.abs(y - p))
    spread = orderstats.quantiles(errors, keys, "_abs", {"median_ae": 0.5, "p90_error": 0.9})
    moments = both.groupBy(*keys).agg(*[c.alias(m) for m, c in parts.items()])
    return join_null_safe(moments, spread, keys).select(*keys, *METRICS)


def tall_metrics(wide: DataFrame, keys: list[str], metrics: list[str] = METRICS) -> DataFrame:
    """Wide metric columns to ``keys, metric, value`` rows; missing metrics give no row."""
    return wide.unpivot(keys, metrics, "metric", "value").filter(F.col("value").isNotNull())


def wide_metrics(tall: DataFrame, keys: list[str], metrics: list[str] = METRICS) -> DataFrame:
    """One row per run; the names are given, so Spark need not look for them first."""
    return tall.groupBy(*keys).pivot("metric", metrics).agg(F.first("value", ignorenulls=True))


def ensemble_mean(predictions: DataFrame, keys: list[str], value: str = "y_pred_mom") -> DataFrame:
    """Mean of the members' (seeds') predictions."""
    return predictions.groupBy(*keys).agg(F.avg(value).alias(value))


def period_bounds(df: DataFrame, keys: list[str], time: str = "month") -> DataFrame:
    return df.groupBy(*keys).agg(F.min(time).alias("period_start"), F.max(time).alias("period_end"))


def conditional_pivot(df: DataFrame, keys: list[str], by: str, value: str, names: dict[str, str],
                      how: str = "avg") -> DataFrame:
    """One column per listed series, in a single aggregate: ``names`` maps a series to its column."""
    aggregate = {"avg": F.avg, "max": F.max, "min": F.min}[how]
    return df.groupBy(*keys).agg(*[
        aggregate(F.when(F.col(by) == series, F.col(value))).alias(column) for series, column in names.items()
    ])
