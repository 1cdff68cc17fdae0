"""Versioned tables of partition folders: each version is a manifest, and a change rewrites only the parts it touches.

Below a table's root, ``data/<commit>/_part=<value>`` holds rows and ``manifests/<number>`` lists, for one version, the folder of
every part. Files are never changed. A manifest is one small JSON file that names folders, not files, so its size follows the
number of parts (months of a calendar), not the data.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from macrotide.operators.keyed import replace_by_key

PART = "_part"


class Conflict(RuntimeError):
    """Another writer committed the version that this one was about to write."""


def _files(spark: SparkSession, root: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the committed versions, oldest first; a table that does not exist has none."""
    files, path = _files(spark, root)
    found = files.globStatus(path(f"{root}/manifests/*")) or []
    return sorted(int(name) for name in (f.getPath().getName() for f in found) if name.isdigit())


def manifest(spark: SparkSession, root: str, version: int | None = None) -> dict:
    """``version``, ``schema``, ``part`` and ``parts`` (value to folder) of a version, the newest by default."""
    known = versions(spark, root)
    if not known or version is not None and version not in known:
        raise LookupError(f"{root} has no version {'' if version is None else version}".rstrip())
    number = known[-1] if version is None else version
    return {"version": number, **json.loads(spark.read.text(f"{root}/manifests/{number:08d}", wholetext=True).first()[0])}


def parts(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """``part``, ``folder`` of a version; as many rows as the table has parts."""
    listed = manifest(spark, root, version)["parts"]
    return spark.createDataFrame(sorted(listed.items(), key=str), "part string, folder string")


def _commit(spark: SparkSession, root: str, number: int, content: dict) -> None:
    """Create the manifest of a version, if no other writer has its number.

    A writer claims the number by creating a file that must not be there yet, which the file system has to do
    exclusively, as HDFS and local ones do; then it writes the manifest under another name and renames it, so that no
    reader meets half of one. A claim is given back on failure; see :func:`release` for a writer that died.
    """
    files, path = _files(spark, root)
    draft, target = path(f"{root}/manifests/.{uuid.uuid4().hex}"), path(f"{root}/manifests/{number:08d}")
    claim = path(f"{root}/manifests/.claim-{number:08d}")
    try:
        files.create(claim, False).close()
    except Exception as error:
        if files.exists(claim):
            raise Conflict(f"{root}: version {number} is taken") from error
        raise
    try:
        out = files.create(draft, False)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        if not files.rename(draft, target):
            raise OSError(f"{root}: version {number} could not be named")
    except BaseException:
        files.delete(claim, False)
        raise


def release(spark: SparkSession, root: str, version: int) -> None:
    """Give back the number that a writer claimed before it died; a committed version stays taken."""
    files, path = _files(spark, root)
    if files.exists(path(f"{root}/manifests/{version:08d}")):
        raise Conflict(f"{root}: version {version} is committed")
    files.delete(path(f"{root}/manifests/.claim-{version:08d}"), False)


def _written(rows: DataFrame, root: str, part: str) -> dict[str, str]:
    """Write rows by part and list the folders; AQE splits a part with a large share of the rows over several files."""
    spark, folder = rows.sparkSession, f"data/{uuid.uuid4().hex}"
    value = F.coalesce(F.col(part).cast("string"), F.raise_error(F.lit(f"{part} is missing")).cast("string"))
    rows.withColumn(PART, value).hint("rebalance", PART).write.partitionBy(PART).parquet(f"{root}/{folder}")
    files, path = _files(spark, root)
    found = [s.getPath().getName() for s in files.listStatus(path(f"{root}/{folder}"))]
    unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    return {unescape(name.split("=", 1)[1]): f"{folder}/{name}" for name in found if name.startswith(f"{PART}=")}


def _schema(df: DataFrame) -> dict:
    return json.loads(T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields]).json())


def create(rows: DataFrame, root: str, part: str) -> int:
    """First version of a table, cut by a column that the calendar bounds; an existing table is a Conflict."""
    if versions(rows.sparkSession, root):
        raise Conflict(f"{root} exists")
    _commit(rows.sparkSession, root, 1, {"schema": _schema(rows), "part": part, "parts": _written(rows, root, part)})
    return 1


def read(spark: SparkSession, root: str, version: int | None = None, only: list[str] | None = None) -> DataFrame:
    """A version of a table, the newest by default; ``only`` names the parts to read (others are not listed)."""
    return _rows(spark, root, manifest(spark, root, version), only)


def _rows(spark: SparkSession, root: str, listed: dict, only: list[str] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(listed["schema"])
    folders = [f"{root}/{f}" for p, f in listed["parts"].items() if only is None or p in only]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def replace(new: DataFrame, root: str, keys: list[str], tries: int = 3) -> int:
    """Replace rows by key and return the version that has them; doing it twice leaves the same rows as doing it once.

    ``keys`` must hold the part column, so a row's key says where its old versions lie. Only parts that ``new`` touches are
    read and written; the manifest links the others as they are. Rows without a value in a key fail the job; without
    rows no version is written. A writer that loses its version number to another starts again from the newest
    version, ``tries`` times. Columns must be those of the table, in any order.
    """
    spark = new.sparkSession
    for attempt in range(tries):
        was = manifest(spark, root)
        part, names = was["part"], [f["name"] for f in was["schema"]["fields"]]
        if part not in keys:
            raise ValueError(f"keys must hold {part}, by which the table is cut")
        if sorted(new.columns) != sorted(names):
            raise ValueError(f"columns {new.columns} are not {names}")
        kinds = T.StructType.fromJson(was["schema"])
        sure = new.select([
            F.coalesce(F.col(f.name).cast(f.dataType), F.raise_error(F.lit(f"key {f.name} is missing")).cast(f.dataType)).alias(f.name)
            if f.name in keys else F.col(f.name).cast(f.dataType).alias(f.name) for f in kinds.fields])
        touched = [r[0] for r in sure.select(F.col(part).cast("string")).distinct().collect()]
        if not touched:
            return was["version"]
        fresh = _written(replace_by_key(_rows(spark, root, was, touched), sure, keys), root, part)
        kept = {p: f for p, f in was["parts"].items() if p not in touched}
        try:
            _commit(spark, root, was["version"] + 1, {**{k: was[k] for k in ("schema", "part")}, "parts": kept | fresh})
            return was["version"] + 1
        except Conflict:
            time.sleep(0.1 * (attempt + 1))  # the winner is about to name its manifest
            if attempt == tries - 1:
                raise
    raise Conflict(root)


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove all but the newest versions, and the folders that no kept version lists; returns those folders."""
    if keep < 1:
        raise ValueError("keep at least one version")
    files, path = _files(spark, root)
    known = versions(spark, root)
    listed = {n: set(manifest(spark, root, n)["parts"].values()) for n in known}
    used = set().union(*(listed[n] for n in known[-keep:]))
    gone = sorted(set().union(*listed.values()) - used)
    for number in known[:-keep]:
        files.delete(path(f"{root}/manifests/{number:08d}"), False)
    for folder in gone:
        files.delete(path(f"{root}/{folder}"), True)
    return gone
