"""Exact duplicates by progressive refinement: length, then prefix hash, then the hash of the whole text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macrotide.llm.sides import checked
from macrotide.session import cut_lineage

SPACES = r"[\x20\x09-\x0D]+"
PREFIX = 64


def normalised(text: Column) -> Column:
    """Text with every run of ASCII white space as one space; NULL counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def _sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = PREFIX,
                     every_hash: bool = False) -> DataFrame:
    """One row per document: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when they are after white-space runs became single spaces (NULL is an empty text). The
    row with the smallest id of a group stays. If several equal rows carry that id, one of them stays; rows
    without an id come last, and stay only where no row has one. An empty input gives an empty result;
    other columns are not read.

    Only lengths that occur twice are compared by the hash of their first ``prefix`` characters, and only
    pairs of length and prefix that occur twice by the SHA-256 of the whole text. ``text_sha256`` of all
    other rows is NULL, unless ``every_hash`` asks for it. Texts are never shuffled: the refinement runs over
    rows of three numbers, and whole texts are hashed in the scan that meets the surviving keys.
    """
    docs = df.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("_t"))
    docs = docs.select("doc_id", "_t", F.length("_t").alias("_len"), F.xxhash64(F.substring("_t", 1, prefix)).alias("_start"))
    if every_hash:
        rows = cut_lineage(docs.select("doc_id", "_len", "_start", _sha(F.col("_t")).alias("text_sha256")), "hashes")
    else:
        rows = cut_lineage(docs.select("doc_id", "_len", "_start"), "lengths")
    lengths = rows.groupBy("_len").agg(F.count("*").alias("_n")).where("_n > 1").select("_len")
    starts = (rows.join(lengths, "_len", "left_semi").groupBy("_len", "_start").agg(F.count("*").alias("_n")).where("_n > 1")
              .select("_len", "_start"))
    starts = checked(starts, "starts")

    lone = rows.join(starts, ["_len", "_start"], "left_anti")
    if every_hash:
        again = rows.join(starts, ["_len", "_start"], "left_semi").select("doc_id", "text_sha256")
    else:
        lone = lone.withColumn("text_sha256", F.lit(None).cast("string"))
        again = cut_lineage(docs.join(starts, ["_len", "_start"], "left_semi").select("doc_id", _sha(F.col("_t")).alias("text_sha256")), "again")
    counted = again.groupBy("text_sha256", "doc_id").agg(F.count("*").alias("_copies"))
    groups = counted.groupBy("text_sha256").agg(F.min("doc_id").alias("keep_id"), F.sum("_copies").alias("group_size"))
    grouped = (counted.join(groups, "text_sha256")
               .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
               .withColumn("kept", (F.col("_copy") == 1) & F.col("doc_id").eqNullSafe(F.col("keep_id"))))
    return lone.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                       F.lit(True).alias("kept"), "text_sha256").unionByName(
        grouped.select("doc_id", "keep_id", "group_size", "kept", "text_sha256"))


def without_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of the input that stay, with all their columns.

    Of equal texts under one id, and of equal texts without an id, one row stays (any of them).
    """
    decided = exact_duplicates(df, id_col, text_col)
    twice = checked(df.groupBy(F.col(id_col).alias("_id")).agg(F.count("*").alias("_n")).where("_n > 1 or _id is null").select("_id"), "twice")
    gone = checked(decided.where("not kept and doc_id is not null").select(F.col("doc_id").alias("_id")).distinct()
                   .join(twice, "_id", "left_anti"), "gone")
    same_id = F.col(id_col).eqNullSafe(F.col("_id"))
    plain = df.join(twice, same_id, "left_anti").join(gone, F.col(id_col) == F.col("_id"), "left_anti")
    some = df.join(twice, same_id, "left_semi").withColumn("_sha", _sha(normalised(F.col(text_col))))
    lost = decided.where("doc_id is null or not kept").groupBy(F.col("doc_id").alias("_id"), "text_sha256").agg(
        F.max(F.when(F.col("doc_id").eqNullSafe(F.col("keep_id")), 1).otherwise(0)).alias("_first")).where("_first = 0")
    some = some.join(lost, same_id & (F.col("_sha") == F.col("text_sha256")), "left_anti").dropDuplicates([id_col, "_sha"])
    return plain.unionByName(some.select(*df.columns))
