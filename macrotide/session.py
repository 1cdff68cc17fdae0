"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_run_folders: list[str] = []
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def build_session(app: str = "macrotide", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators assume: UTC, AQE with skew handling, no inferred clock zone.

    ``spark.sql.shuffle.partitions`` is left to the caller or the cluster: AQE coalesces a generous
    initial number, so set it to a few times the core count for large inputs.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can see: ``spark.checkpoint.dir``, or the session's warehouse where that is unset.

    Inside :func:`run_folder` it is that run's own folder.
    """
    if _run_folders:
        return _run_folders[-1]
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_intermediate"
    return root.rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """Fresh path below the shared folder; nothing is created and nothing is overwritten."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """A folder of one run's intermediates, removed when the run ends; results must be stored or read before."""
    path = scratch_path(spark, "run")
    _run_folders.append(path)
    try:
        yield path
    finally:
        _run_folders.remove(path)
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


@contextmanager
def small_batches(spark: SparkSession, limit: int = BATCH_BYTES) -> Iterator[None]:
    """Jobs run inside hand texts to Python in Arrow batches of about ``limit`` bytes, one row at least.

    Spark's own bounds are 10,000 rows and 64 MB, and a batch is held twice: by the JVM outside its heap, and by the
    Python worker. It reaches only what is stored before the block ends.
    """
    was = spark.conf.get(_BATCH, None)
    spark.conf.set(_BATCH, str(limit))
    try:
        yield
    finally:
        spark.conf.unset(_BATCH) if was is None else spark.conf.set(_BATCH, was)


def cut_lineage(df, purpose: str = "stage"):
    """Write a DataFrame to the shared folder and read it back, so later jobs do not recompute it."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
