"""The whole batch: staged bronze to every gold table, as one set of lazy frames."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from macrotide.functions.calendar import HISTORY_START, month_spine
from macrotide.plans import gold
from macrotide.plans.silver import all_series, silver_from_staging


def build(spark: SparkSession, staging: dict[str, DataFrame], cutoff: date,
          start: date = HISTORY_START) -> dict[str, DataFrame]:
    """Silver and gold frames by name; ``staging`` maps the four dataset codes to typed rows.

    Nothing runs here. Write the layers you serve (``sources.bronze.materialise``) in this order, so
    that later ones read stored tables.
    """
    silver = {name: silver_from_staging(df) for name, df in staging.items()}
    spine = month_spine(spark, start, cutoff)
    index = gold.fact_index(silver["eurostat_hicp"])
    macro = gold.fact_macro(spine, silver["ecb_fx_eu"], silver["ecb_rates_eu"], silver["energy_prices"], cutoff)
    features = gold.fact_cpi_features(index, macro)
    return {
        **{f"silver.{name}": df for name, df in silver.items()},
        "silver.all_series": all_series(list(silver.values())),
        "gold.dim_time": spine,
        "gold.fact_hicp": index,
        "gold.fact_macro": macro,
        "gold.fact_cpi_features": features,
        "gold.gold_nowcast_input": gold.nowcast_input(features),
        "gold.gold_dashboard_view": gold.dashboard_view(features),
    }
