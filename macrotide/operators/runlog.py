"""Run log: status events, stage metrics and the activity view."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macrotide.functions.calendar import minutes_between, seconds_between, trailing_days
from macrotide.operators import registry
from macrotide.operators.joins import join_null_safe
from macrotide.operators.keyed import latest_by


def record(events: DataFrame, root: str, table: str) -> None:
    """Append events to the log table ``status_events`` or ``stage_events``; nothing is ever updated in place."""
    registry.append(events, root, table)


def current_runs(status_events: DataFrame) -> DataFrame:
    """State of each run from its appended status events: the newest event wins.

    Events carry ``run_id, started_at, ended_at, status, mode, log_file, event_ts``; a row that ends a
    run need not repeat the start.
    """
    state = ["ended_at", "status", "mode", "log_file"]
    newest = latest_by(status_events, ["run_id"], [F.col(c).desc_nulls_last() for c in ["event_ts", *state]]).select("run_id", *state)
    begun = status_events.groupBy("run_id").agg(F.min("started_at").alias("started_at"))
    return join_null_safe(newest, begun, ["run_id"]).select("run_id", "started_at", *state)


def stage_metrics(stage_events: DataFrame) -> DataFrame:
    """One row per run and stage from its events ``run_id, stage_name, ts, status, row_count, message``.

    Duration is the difference of whole epoch seconds; status and message come from the newest event.
    """
    keys = ["run_id", "stage_name"]
    newest = latest_by(stage_events, keys, [F.col(c).desc_nulls_last() for c in ["ts", "status", "message"]]).select(*keys, "status", "message")
    totals = stage_events.groupBy(*keys).agg(
        F.min("ts").alias("started_at"), F.max("ts").alias("ended_at"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"))
    return join_null_safe(newest, totals, keys).select(
        *keys, "started_at", "ended_at", seconds_between("started_at", "ended_at").alias("duration_seconds"), "row_count",
        "status", F.col("message").alias("error_message"))


def recent_activity(runs: DataFrame, stages: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """Runs that started in the trailing days, each with its stages (runs without stages stay)."""
    recent = runs.filter(trailing_days("started_at", as_of, days)).select(
        "run_id", F.col("started_at").alias("run_started"), F.col("ended_at").alias("run_ended"),
        minutes_between("started_at", "ended_at").alias("total_duration_min"), F.col("status").alias("run_status"))
    parts = stages.select(
        "run_id", "stage_name", F.col("duration_seconds").alias("stage_duration_sec"), "row_count",
        F.col("status").alias("stage_status"))
    return recent.join(parts, "run_id", "left")
