"""A batch of stages with a ledger: each stage's table is stored, its rows are counted as they are written, and a broken
batch continues where it stopped."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from macrotide.functions.calendar import HISTORY_START
from macrotide.operators import registry, runlog
from macrotide.plans import gold, pipeline, views
from macrotide.schemas import REGISTRY

Stage = Callable[[Mapping[str, DataFrame]], DataFrame]


def _now() -> datetime:
    return datetime.now(timezone.utc)


class Batch:
    """One run below a shared folder: ``<root>/<run_id>/<stage>`` holds tables, the run log holds events.

    ``clock`` gives the stamps of the events; nothing else depends on the time.
    """

    def __init__(self, spark: SparkSession, root: str, run_id: str, clock: Callable[[], datetime] = _now):
        self.spark, self.root, self.run_id, self.clock = spark, root, run_id, clock
        self.tables: dict[str, DataFrame] = {}
        self.computed: list[str] = []

    def _event(self, table: str, **values) -> None:
        schema = REGISTRY[table]
        row = self.spark.createDataFrame([tuple({"run_id": self.run_id, **values}.get(f.name) for f in schema.fields)], schema)
        runlog.record(row, self.root, table)

    def _finished(self, name: str) -> bool:
        """The ledger's newest event of the stage is a success, and its table is complete."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{self.run_id}/{name}/_SUCCESS")
        log = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/stage_events")
        files = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not (files.exists(log) and files.exists(path)):
            return False
        mine = registry.read(self.spark, self.root, "stage_events").where((F.col("run_id") == self.run_id) & (F.col("stage_name") == name))
        return [r["status"] for r in runlog.stage_metrics(mine).collect()] == ["success"]

    def stage(self, name: str, make: Stage) -> DataFrame:
        """Table of a stage: read if an earlier try of this run finished it, else made, counted and stored.

        The count is a metric of the write itself, so no table is read to be counted. A failure is recorded and raised.
        """
        path = f"{self.root}/{self.run_id}/{name}"
        if not self._finished(name):
            self._event("stage_events", stage_name=name, ts=self.clock(), status="running", row_count=0)
            rows = Observation(f"{self.run_id}/{name}")
            try:
                make(self.tables).observe(rows, F.count(F.lit(1)).alias("row_count")).write.mode("overwrite").parquet(path)
            except Exception as error:
                self._event("stage_events", stage_name=name, ts=self.clock(), status="failed", row_count=0, message=str(error).splitlines()[0][:500])
                raise
            self._event("stage_events", stage_name=name, ts=self.clock(), status="success", row_count=int(rows.get["row_count"]))
            self.computed.append(name)
        self.tables[name] = self.spark.read.parquet(path)
        return self.tables[name]

    def run(self, stages: Mapping[str, Stage], mode: str = "full") -> dict[str, DataFrame]:
        """All stages in order, with status events of the run around them."""
        begun = self.clock()
        self._event("status_events", started_at=begun, status="running", mode=mode, event_ts=begun)
        try:
            for name, make in stages.items():
                self.stage(name, make)
        except Exception:
            ended = self.clock()
            self._event("status_events", started_at=begun, ended_at=ended, status="failed", mode=mode, event_ts=ended)
            raise
        ended = self.clock()
        self._event("status_events", started_at=begun, ended_at=ended, status="success", mode=mode, event_ts=ended)
        return self.tables


def full(spark: SparkSession, staging: Mapping[str, DataFrame], cutoff: date, nowcasts: Callable[[DataFrame], DataFrame],
         start: date = HISTORY_START) -> dict[str, Stage]:
    """Stages from staged rows to the report: silver, gold, nowcasts, wide views and key figures.

    ``nowcasts`` makes rows of the nowcast output from ``gold.gold_nowcast_input``. Every stage reads the stored tables of
    those before it.
    """
    def layer(name: str) -> Stage:
        return lambda _: pipeline.build(spark, dict(staging), cutoff, start)[name]

    silver = {f"silver.{name}": layer(f"silver.{name}") for name in staging}
    return {
        **silver,
        "gold.dim_time": layer("gold.dim_time"),
        "gold.fact_hicp": lambda t: gold.fact_index(t["silver.eurostat_hicp"]),
        "gold.fact_macro": lambda t: gold.fact_macro(t["gold.dim_time"], t["silver.ecb_fx_eu"], t["silver.ecb_rates_eu"], t["silver.energy_prices"], cutoff),
        "gold.fact_cpi_features": lambda t: gold.fact_cpi_features(t["gold.fact_hicp"], t["gold.fact_macro"]),
        "gold.gold_nowcast_input": lambda t: gold.nowcast_input(t["gold.fact_cpi_features"]),
        "gold.gold_dashboard_view": lambda t: gold.dashboard_view(t["gold.fact_cpi_features"]),
        "ml.nowcast_output": lambda t: nowcasts(t["gold.gold_nowcast_input"]),
        "report.hicp_wide": lambda t: views.hicp_wide(t["gold.fact_hicp"], t["ml.nowcast_output"], geo=None),
        "report.macro_wide": lambda t: views.macro_wide(t["gold.fact_macro"]),
        "report.key_figures": lambda t: views.key_figures(t["report.hicp_wide"], t["report.macro_wide"]),
    }
