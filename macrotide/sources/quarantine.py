"""Landed documents sorted out in one pass: accepted ones go on, refused ones are kept with the reason."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from macrotide.sources import payloads

STATUS, REASON = "status", "reason"
ACCEPTED, REFUSED = "accepted", "refused"


def sort_out(documents: DataFrame, kind: str, path: str) -> dict[str, int]:
    """Write every document below ``path/status=accepted`` or ``path/status=refused``, and return how many went where.

    ``kind`` is ``fx``, ``rates`` or ``pages``, as for :func:`macrotide.sources.payloads.refused`. A refused document has a
    ``reason``: ``unreadable`` (then its whole text is in the corrupt-record column) or ``incomplete``. Documents are parsed
    once, here; the counts are metrics of the write. An earlier result at ``path`` is replaced, so a broken run is repeated.
    """
    good = payloads.accepted(documents, kind)
    unreadable = F.col(payloads.CORRUPT).isNotNull() if payloads.CORRUPT in documents.columns else F.lit(False)
    tagged = documents.select(
        "*", F.when(good, ACCEPTED).otherwise(REFUSED).alias(STATUS),
        F.when(~good, F.when(unreadable, "unreadable").otherwise("incomplete")).alias(REASON))
    seen = Observation()
    tagged.observe(seen, F.count_if(F.col(STATUS) == ACCEPTED).alias(ACCEPTED), F.count_if(F.col(STATUS) == REFUSED).alias(REFUSED)).write.mode(
        "overwrite").partitionBy(STATUS).parquet(path)
    return dict(seen.get)


def _of(spark: SparkSession, path: str, status: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col(STATUS) == status).drop(STATUS)


def accepted(spark: SparkSession, path: str) -> DataFrame:
    """Documents for the flatteners, which find no fault in them; refused ones are not listed or read."""
    return _of(spark, path, ACCEPTED).drop(REASON)


def refused(spark: SparkSession, path: str) -> DataFrame:
    """Refused documents with their ``reason``."""
    return _of(spark, path, REFUSED)
