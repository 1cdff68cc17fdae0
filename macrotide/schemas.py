"""Table shapes shared by all layers."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names, dataset codes and labels of the public data model.
BRONZE_COLUMNS = ["dt", "dataset", "series_id", "geo", "value", "source", "ingest_ts"]
SILVER_COLUMNS = [
    "ts_date", "geo", "series_id", "measure", "value", "unit", "freq", "source", "vintage_ts",
]
DEFAULT_GEO = "EA20"
MISSING_GEO = "NA"
HEADLINE_SERIES = "CP00"
BRENT_SERIES = "POILBREUSDM"
GAS_SERIES = "PNGASEUUSDM"
DATASET_LABELS = {
    "energy_prices": ("energy_price", "USD", "M"),
    "ecb_rates_eu": ("policy_rate", "percent", "D"),
    "ecb_fx_eu": ("exchange_rate", None, "D"),
    "eurostat_hicp": ("price_index", "Index (2015=100)", "M"),
}


def strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in pairs])


STAGING = _fields(
    ("dt", T.DateType()), ("dataset", T.StringType()), ("series_id", T.StringType()),
    ("geo", T.StringType()), ("value", T.DoubleType()), ("source", T.StringType()),
    ("ingest_ts", T.TimestampType()),
)

SILVER = _fields(
    ("ts_date", T.DateType()), ("geo", T.StringType()), ("series_id", T.StringType()),
    ("measure", T.StringType()), ("value", T.DoubleType()), ("unit", T.StringType()),
    ("freq", T.StringType()), ("source", T.StringType()), ("vintage_ts", T.TimestampType()),
)

NOWCAST_OUTPUT = _fields(
    ("month", T.DateType()), ("geo", T.StringType()), ("model_version", T.StringType()),
    ("y_nowcast", T.DoubleType()), ("y_actual", T.DoubleType()), ("residual", T.DoubleType()),
    ("created_at_utc", T.TimestampType()),
)

WALK_FORWARD = _fields(
    ("month", T.DateType()), ("geo", T.StringType()),
    ("y_true_level", T.DoubleType()), ("y_pred_level", T.DoubleType()),
    ("y_true_mom", T.DoubleType()), ("y_pred_mom", T.DoubleType()),
    ("residual", T.DoubleType()), ("abs_error", T.DoubleType()),
)

REGISTRY = {
    "runs": _fields(
        ("run_id", T.StringType()), ("model_version", T.StringType()), ("model_type", T.StringType()),
        ("started_at_utc", T.TimestampType()), ("finished_at_utc", T.TimestampType()),
        ("train_start", T.DateType()), ("train_end", T.DateType()),
        ("test_start", T.DateType()), ("test_end", T.DateType()),
        ("target", T.StringType()), ("features", T.ArrayType(T.StringType())),
        ("artifact_path", T.StringType()), ("notes", T.StringType()),
    ),
    "metrics": _fields(("run_id", T.StringType()), ("metric", T.StringType()), ("value", T.DoubleType())),
    "params": _fields(("run_id", T.StringType()), ("name", T.StringType()), ("value", T.StringType())),
    "feature_importance": _fields(
        ("run_id", T.StringType()), ("feature", T.StringType()), ("importance", T.DoubleType()),
    ),
    "predictions": _fields(
        ("run_id", T.StringType()), ("month", T.DateType()), ("geo", T.StringType()),
        ("y_true", T.DoubleType()), ("y_pred", T.DoubleType()), ("residual", T.DoubleType()),
    ),
    "status_events": _fields(
        ("run_id", T.StringType()), ("started_at", T.TimestampType()), ("ended_at", T.TimestampType()), ("status", T.StringType()),
        ("mode", T.StringType()), ("log_file", T.StringType()), ("event_ts", T.TimestampType()),
    ),
    "stage_events": _fields(
        ("run_id", T.StringType()), ("stage_name", T.StringType()), ("ts", T.TimestampType()), ("status", T.StringType()),
        ("row_count", T.LongType()), ("message", T.StringType()),
    ),
}

# Columns whose values must be unique in a table, and columns that must be present before an append.
KEYS = {"runs": ["run_id"]}
REQUIRED = {
    "runs": ["run_id", "model_version", "model_type", "started_at_utc", "finished_at_utc",
             "target", "features", "artifact_path"],
    "metrics": ["run_id", "metric", "value"],
    "params": ["run_id", "name", "value"],
    "feature_importance": ["run_id", "feature", "importance"],
    "predictions": ["run_id", "month"],
    "nowcast_output": ["month", "geo", "model_version", "y_nowcast", "created_at_utc"],
    "pipeline_runs": ["run_id", "started_at"],
    "stage_metrics": ["run_id", "stage_name", "started_at"],
    "status_events": ["run_id", "event_ts"],
    "stage_events": ["run_id", "stage_name", "ts"],
}
