"""Feature matrix for training and for inference, always keyed by geo and month."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from macrotide.functions.calendar import month_of_year, quarter_of_year
from macrotide.operators.windows import add_leak_free_rolling, fill_forward_backward, winsorize

VOLATILE = ["fx_usd_eur_avg", "policy_rate_monthly_avg", "policy_rate_eom"]
KEYS = ["geo", "month"]
TARGET, LEVEL = "hicp_mom", "target_hicp_index"
_LEAKAGE = ["hicp_yoy", "energy_price_usd"]


def feature_columns(df: DataFrame, drop: list[str] | None = None) -> list[str]:
    """Numeric columns that may be used as features: keys, target, level and leaking columns are out."""
    out = {*KEYS, TARGET, LEVEL, *(_LEAKAGE if drop is None else drop)}
    return [f.name for f in df.schema.fields
            if f.name not in out and isinstance(f.dataType, (T.NumericType, T.BooleanType))]


def with_date_and_rolling(df: DataFrame) -> DataFrame:
    dated = df.select("*", month_of_year("month").alias("month_of_year"), quarter_of_year("month").alias("quarter"))
    return add_leak_free_rolling(dated, VOLATILE, ["geo"])


def complete_cases(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in which every listed column is present and not NaN."""
    doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    tests = [f"`{c}` IS NOT NULL" + (f" AND NOT isnan(`{c}`)" if c in doubles else "") for c in columns]
    return df.filter(" AND ".join(tests))


def training_matrix(nowcast_input: DataFrame, cutoff: date | None = None, winsorized: bool = True) -> DataFrame:
    """``geo, month, <features>, hicp_mom, target_hicp_index`` with complete rows only.

    The target's winsor bounds come from rows up to the cutoff, so later months do not reach into the
    training rows; ``cutoff=None`` takes the whole sample.
    """
    featured = with_date_and_rolling(nowcast_input)
    names = feature_columns(featured)
    if winsorized:
        fit_on = None if cutoff is None else F.col("month") <= F.lit(cutoff)
        featured = winsorize(featured, TARGET, ["geo"], fit_on=fit_on)
    return complete_cases(featured.select(*KEYS, *names, TARGET, LEVEL), [*names, TARGET, LEVEL])


def inference_matrix(nowcast_input: DataFrame) -> DataFrame:
    """All rows with features filled forward, then backward; target and level stay as they are."""
    featured = with_date_and_rolling(nowcast_input)
    names = feature_columns(featured, drop=["hicp_yoy"])
    return fill_forward_backward(featured.select(*KEYS, *names, TARGET, LEVEL), names, ["geo"])


def split_at(df: DataFrame, cutoff: date) -> tuple[DataFrame, DataFrame]:
    """Rows up to the cutoff (inclusive) and rows after it."""
    early = F.col("month") <= F.lit(cutoff)
    return df.filter(early), df.filter(~early)


def align_features(df: DataFrame, expected: list[str], keep: list[str] = KEYS) -> DataFrame:
    """Features in the model's order: missing ones are 0.0, others are dropped."""
    have = set(df.columns)
    return df.select(*keep, *[
        (F.col(c).cast("double") if c in have else F.lit(0.0)).alias(c) for c in expected])
