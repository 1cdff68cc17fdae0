"""The corpus pipeline: documents pass the stages in order, each written and read again by the next.

Each stage takes ``(spark, docs, sf_dir)``. All but the last return the columns of ``documents``; the last returns the
packed pieces. Rows with NULL in any column, empty texts and empty tables pass as the stage's operator defines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from macrotide.llm import exact, mixing, neardup, packing, perplexity
from macrotide.llm.sides import checked
from macrotide.session import cut_lineage


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose perplexity is above their language's limit, and empty ones."""
    judged = perplexity.quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    gone = checked(judged.where("not kept").select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).distinct(), "rejected")
    mark = F.xxhash64(F.coalesce("text", F.lit("")))
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (mark == F.col("_mark")), "left_anti")


def one_of_equal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of every group of texts that are equal but for white space."""
    return exact.without_duplicates(docs)


def one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of every component of near-duplicates: five words, similarity 0.8."""
    found = neardup.near_duplicates(docs, width=5, percent=80)
    gone = checked(found.where("not kept").select(F.col("doc_id").alias("_id")).distinct(), "near")
    return docs.join(gone, F.col("doc_id") == F.col("_id"), "left_anti")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, whole: a last part of a document counts as one time.

    Rows of one source that share id and size are taken equally often.
    """
    return mixing.repeated(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of permitted lengths."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", good_quality),
    ("exact_dedup", one_of_equal),
    ("minhash_neardup", one_of_near),
    ("source_mix", mixed),
    ("best_fit_packing", packed),
]
ORACLE_SQL = None  # a language model and signatures have no SQL form; the tests use brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = cut_lineage(docs, name)
    return docs
