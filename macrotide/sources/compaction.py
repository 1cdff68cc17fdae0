"""Bronze day files packed into month files, switched by one manifest.

Day folders stay the place where rows land. ``compact`` copies what has landed into one folder per month below
``<root>/<dataset>/_packed`` and commits a manifest that names those folders and the day files they hold; readers take the packed
months and the day files that the manifest does not name. ``retire`` deletes the named ones afterwards. Nothing is read twice and nothing
is missed, whenever a writer, a reader or this job breaks off.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from macrotide.operators import versions
from macrotide.schemas import BRONZE_COLUMNS, strings
from macrotide.sources.bronze import _CSV_OPTIONS

MONTH, COVERED, OTHER = "month", "covered", "other"
_ISO_MONTH = r"^\d{4}-\d{2}-"


def _packed(root: str, dataset: str) -> str:
    return f"{root}/{dataset}/_packed"


def day_files(spark: SparkSession, root: str, dataset: str) -> list[str]:
    """Paths of the landed files below the dataset, ``dt=.../part-...``, from a listing."""
    files, path = versions._files(spark, root)
    found = files.globStatus(path(f"{root}/{dataset}/dt=*/part-*.csv")) or []
    return sorted("/".join((f.getPath().getParent().getName(), f.getPath().getName())) for f in found)


def _manifest(spark: SparkSession, root: str, dataset: str) -> dict:
    base = _packed(root, dataset)
    known = versions.versions(spark, base)
    return versions.manifest(spark, base) if known else {"version": 0, "parts": {}, COVERED: []}


def _landed(spark: SparkSession, root: str, dataset: str, names: list[str], dt_in_file: bool) -> DataFrame:
    """Text rows of day files with their month; ``dt`` comes from the folder, as text."""
    base = f"{root}/{dataset}"
    schema = strings((["dt_in_file"] if dt_in_file else []) + [c for c in BRONZE_COLUMNS if c != "dt"] + ["dt"])
    rows = spark.read.schema(schema).options(**_CSV_OPTIONS).option("basePath", base).csv([f"{base}/{n}" for n in names])
    is_date = F.col("dt").rlike(_ISO_MONTH)
    return rows.withColumn(MONTH, F.when(is_date, F.substring("dt", 1, 7)).otherwise(F.lit(OTHER)))


def _month_of(name: str) -> str:
    """Month of a day file by its folder, as the rows have it; a folder that is no date goes to a part of its own."""
    day = name[len("dt="):]
    return day[:7] if re.match(_ISO_MONTH, day) else OTHER


def compact(spark: SparkSession, root: str, dataset: str, dt_in_file: bool = False) -> int:
    """Pack the day files that no manifest names yet, and return the number of the manifest that holds.

    Months with new files are rewritten, with their packed rows of before; all others are linked. Without new files nothing is
    written. If two jobs pack at once, one gets :class:`macrotide.operators.versions.Conflict` and leaves no trace
    but an unlisted folder. The driver holds the names of day files, as Spark's own listing does, and no rows.
    """
    names, was, base = day_files(spark, root, dataset), _manifest(spark, root, dataset), _packed(root, dataset)
    present = set(names)
    fresh = sorted(present - set(was[COVERED]))
    if not fresh:
        return was["version"]
    touched = sorted({_month_of(n) for n in fresh})
    rows = _landed(spark, root, dataset, fresh, dt_in_file)
    if was["version"]:
        rows = rows.unionByName(versions.read(spark, base, was["version"], only=touched))
    written = versions._written(rows, base, MONTH)
    kept = {p: f for p, f in was["parts"].items() if p not in touched}
    versions._commit(spark, base, was["version"] + 1, {
        "schema": versions._schema(rows), "part": MONTH, "parts": kept | written,
        # Names of retired files are not needed any more: nothing lists them.
        COVERED: sorted((set(was[COVERED]) & present) | set(fresh))})
    return was["version"] + 1


def read_compacted(spark: SparkSession, root: str, dataset: str, dt_in_file: bool = False, months: list[str] | None = None) -> DataFrame:
    """All text rows of a dataset, packed or not; ``months`` (``2024-01``) limits what is listed and read.

    Day files are listed before the manifest is read: what is packed in between is then left out of the listing, not missed.
    A file retired in between fails the job, which is repeated.
    """
    names = day_files(spark, root, dataset)
    was = _manifest(spark, root, dataset)
    loose = sorted(set(names) - set(was[COVERED]))
    if months is not None:
        loose = [n for n in loose if _month_of(n) in months]
    parts = []
    if was["version"]:
        parts.append(versions.read(spark, _packed(root, dataset), was["version"], only=months))
    if loose:
        parts.append(_landed(spark, root, dataset, loose, dt_in_file))
    if not parts:
        raise LookupError(f"{root}/{dataset} has no files")
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return both.drop(MONTH)


def retire(spark: SparkSession, root: str, dataset: str, keep: int = 1) -> int:
    """Delete the day files that the newest manifest names, and versions before the ``keep`` newest; returns the number of files."""
    files, path = versions._files(spark, root)
    was, present = _manifest(spark, root, dataset), set(day_files(spark, root, dataset))
    gone = [n for n in was[COVERED] if n in present]
    for name in gone:
        files.delete(path(f"{root}/{dataset}/{name}"), False)
    if was["version"]:
        versions.expire(spark, _packed(root, dataset), keep)
    return len(gone)
