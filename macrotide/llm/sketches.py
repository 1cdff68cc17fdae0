"""Document fingerprints: all shingle hashes below a fixed fraction of their range, comparable and mergeable."""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macrotide.llm.text import Texts, shingles, slices

WIDTH, FRACTION, LEAST = 5, 8, 16  # words of a shingle, one hash in so many is kept, and never fewer than so many
BUCKET_ROWS, BUCKETS = 2_000, 1 << 16
COMPLETE = (1 << 64) - 1
Sketch = tuple[int, np.ndarray]  # the largest hash that was kept for sure, COMPLETE where none was left out, and the hashes


def sketches(texts: Texts, width: int = WIDTH, fraction: int = FRACTION, least: int = LEAST) -> list[Sketch]:
    """Per text: the limit, and in order the hashes up to it."""
    h, first, _ = shingles(texts, width)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        found = np.unique(h[a:b])
        kept = int(np.searchsorted(found, np.uint64(COMPLETE // fraction), "right"))
        if kept >= least:
            out.append((COMPLETE // fraction, found[:kept]))
        elif len(found) > least:
            out.append((int(found[least - 1]), found[:least]))
        else:
            out.append((COMPLETE, found))
    return out


def written(sketch: Sketch) -> str:
    """Hexadecimal: the limit, then the hashes in order, 16 digits each."""
    return f"{sketch[0]:016x}{sketch[1].astype('>u8').tobytes().hex()}"


def likeness(a: Sketch, b: Sketch) -> float:
    """Estimate of the Jaccard similarity of two shingle sets; 1 for two empty ones."""
    limit = np.uint64(min(a[0], b[0]))
    left, right = (x[: np.searchsorted(x, limit, "right")] for x in (a[1], b[1]))
    common = len(np.intersect1d(left, right, assume_unique=True))
    union = len(left) + len(right) - common
    return common / union if union else 1.0


# ---- fingerprints as columns -----------------------------------------------------------------------------------------


def _parts(fingerprint: Column) -> Column:
    return F.regexp_extract_all(fingerprint, F.lit("[0-9a-f]{16}"), F.lit(0))


def _below(a: Column, b: Column) -> tuple[Column, Column]:
    """Hashes of two fingerprints up to the smaller limit; hexadecimal digits are in the order of the numbers."""
    limit = F.least(F.substring(a, 1, 16), F.substring(b, 1, 16))
    return tuple(F.filter(F.slice(_parts(x), 2, F.length(x)), lambda h: h <= limit) for x in (a, b))


def alike(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the texts behind two fingerprint columns; 1 for two without shingles."""
    left, right = _below(a, b)
    union = F.size(F.array_union(left, right))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(left, right)) / union)


def contained(a: Column, b: Column) -> Column:
    """Estimated share of the first text's shingles that the second has too; NULL where the first has none to compare."""
    left, right = _below(a, b)
    return F.when(F.size(left) > 0, F.size(F.array_intersect(left, right)) / F.size(left))


def merged(a: Column, b: Column, fraction: int = FRACTION, least: int = LEAST) -> Column:
    """Fingerprint of the union of two shingle sets, the same as if both had been read as one."""
    fixed, whole = F.lit(f"{COMPLETE // fraction:016x}"), F.lit(f"{COMPLETE:016x}")
    limit = F.least(F.substring(a, 1, 16), F.substring(b, 1, 16))
    left, right = _below(a, b)
    every = F.array_sort(F.array_union(left, right))
    low = F.filter(every, lambda h: h <= fixed)
    first = F.slice(every, 1, least)
    return (F.when(F.size(low) >= least, F.concat(fixed, F.array_join(low, "")))
            .when((F.size(every) > least) | (limit < whole), F.concat(F.element_at(first, -1), F.array_join(first, "")))
            .otherwise(F.concat(whole, F.array_join(every, ""))))


# ---- documents and their successors ----------------------------------------------------------------------------------


def _bounds(docs: DataFrame) -> list[dict]:
    """Smallest key of each bucket of neighbouring documents, in order; at most BUCKETS of them reach the driver."""
    keys = docs.select("doc_id", "mark")
    buckets = min(max(1, -(-keys.count() // BUCKET_ROWS)), BUCKETS)
    least = (keys.repartitionByRange(buckets, "doc_id", "mark").groupBy(F.spark_partition_id().alias("p"))
             .agg(F.min(F.struct("doc_id", "mark")).alias("key")).orderBy("p"))
    return [row["key"].asDict() for row in least.collect()]


def _bucketed(docs: DataFrame) -> DataFrame:
    """Documents with ``bucket``, in order of their keys; the first of a bucket also comes last in the bucket before.

    ``tail`` marks that copy. The bucket is found by halving: a step is taken where the bound it leads to is not larger.
    """
    bounds = _bounds(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    table = F.from_json(F.lit(json.dumps(bounds, default=str)), f"array<struct<doc_id:{kind},mark:bigint>>")
    key = F.struct("doc_id", "mark")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(max(1, len(bounds)).bit_length()))])
    place = F.aggregate(steps, F.lit(-1), lambda at, step: F.when(F.get(table, at + step) <= key, at + step).otherwise(at))
    rows = docs.withColumn("bucket", place)
    before = F.pmod(F.col("bucket") - 1, F.lit(max(1, len(bounds))))
    one = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("tail"))
    two = F.struct(before.alias("bucket"), F.lit(True).alias("tail"))
    return rows.withColumn("at", F.explode(F.when(F.get(table, F.col("bucket")) == key, F.array(one, two)).otherwise(F.array(one)))).select(
        "at.bucket", "at.tail", "doc_id", "mark", "text")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, fraction: int = FRACTION, least: int = LEAST) -> DataFrame:
    """Fingerprint of every text and of its edited text, compared with each other and with the next document's.

    Returns ``doc_id``, ``n_chars`` (code points), ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``,
    ``near_next``. A fingerprint keeps every hash of a shingle of ``width`` words (A-Z lower-cased; all words of a shorter
    text) below one part in ``fraction`` of the hash range. A text with fewer than ``least`` of those keeps its ``least``
    smallest, so short texts can be compared too; both rules survive a union, so fingerprints can be merged
    (``merged``), and compared as far as both reach (``alike``, ``contained``).

    The edited text has the last quarter of the code points replaced by the first as many of the next document in
    ascending order of ids, the first document's after the last. Texts move once, dealt to buckets of neighbours.

    A NULL text is empty; texts without words have an empty fingerprint, alike to other empty ones only. Rows without an
    id come first; rows that share an id follow each other in order of a hash of their texts; a single row is its own
    successor. An empty input gives an empty result; other columns are not read. Buckets are found by a job that
    runs when this is called; up to BUCKETS ids come to the driver.
    """
    docs = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("mark", F.xxhash64("text"))

    def run(batches):
        waiting = None  # bucket, id, text and sketch of the document whose successor comes next
        for batch, part in slices(batches):
            bucket, tail = (batch.column(k).to_pylist() for k in (0, 1))
            ids = batch.column(2)
            of = sketches(part, width, fraction, least)
            rows, ends = [], []
            for i, sketch in enumerate(of):
                text = part.one(i).decode("utf-8", "surrogateescape")
                if waiting is not None and waiting[0] == bucket[i]:
                    quarter = len(waiting[2]) // 4
                    rows.append((*waiting[1:], sketch))
                    ends.append((waiting[2][: len(waiting[2]) - quarter] + text[:quarter]).encode("utf-8", "surrogateescape"))
                waiting = None if tail[i] else (bucket[i], ids[i].as_py(), text, sketch)
            if not rows:
                continue
            border = np.cumsum([0, *map(len, ends)])
            other = sketches(Texts(np.frombuffer(b"".join(ends), np.uint8), border[:-1], border[1:]), width, fraction, least)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], ids.type), pa.array([len(r[1]) for r in rows], pa.int64()), pa.array([hashlib.sha256(e).hexdigest() for e in ends]),
                 pa.array([written(r[2]) for r in rows]), pa.array([written(o) for o in other]),
                 pa.array([likeness(r[2], o) for r, o in zip(rows, other)]), pa.array([likeness(r[2], r[3]) for r in rows])],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    order = ["bucket", "tail", "doc_id", "mark"]
    return _bucketed(docs).repartition("bucket").sortWithinPartitions(*order).select("bucket", "tail", "doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
