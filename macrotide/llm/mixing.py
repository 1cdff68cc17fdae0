"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from macrotide.llm.sides import checked
from macrotide.llm.text import WORD
from macrotide.session import cut_lineage

BUCKET_ROWS = 4096


def word_count(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=(3, 1, 2), share: float = 1.5, epochs: int = 2) -> DataFrame:
    """``target`` for every row of ``source``, ``source_size``.

    Sources in code-point order (NULL last) weigh ``weights`` in turn and share ``share`` of all sizes.
    A target stops at ``epochs`` times its source's size; the excess goes to the others by weight until no
    target is above: with sources in order of the level at which they are full, that level is settled by
    running sums. The table has one row per source of the mix, so its windows take one task.
    """
    order = Window.orderBy(F.col("source").cast("binary").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    full = (sizes.withColumn("_w", weight).withColumn("_cap", F.col("source_size").cast("double") * epochs)
            .withColumn("_full", F.col("_cap") / F.col("_w")))
    by = Window.orderBy("_full", F.col("source").cast("binary").asc_nulls_last())
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
             / (F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))))
    # The level of the first source that is not full holds for all later ones.
    open_level = F.min(F.when(F.col("_level") < F.col("_full"), F.struct("_full", "_level"))).over(whole)["_level"]
    return (full.withColumn("_level", level).withColumn("_open", open_level)
            .select("source", "source_size",
                    F.least("_cap", F.coalesce(F.col("_open") * F.col("_w"), F.col("_cap"))).alias("target")))


def _running(rows: DataFrame, group: list[str], place: str, order: list[str], value: str, name: str) -> DataFrame:
    """Sum of ``value`` over the rows before, within ``group``, in order of ``place`` (0 to 1) and ``order``.

    Rows are cut into buckets of equal width in ``place``, about BUCKET_ROWS rows each; only the bucket sums
    meet in a window per group, and rows are ranked within one bucket. No group is gathered anywhere.
    """
    stored = cut_lineage(rows, name.strip("_"))
    sizes = stored.groupBy(*group).agg(F.greatest(F.lit(1), F.ceil(F.count("*") / BUCKET_ROWS)).cast("double").alias("_buckets"))
    cut = _attached(stored, sizes, group).withColumn(
        "_bucket", F.least(F.floor(F.col(place) * F.col("_buckets")), F.col("_buckets") - 1).cast("long")).drop("_buckets")
    keys = [*group, "_bucket"]
    sums = cut.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*keys, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    within = Window.partitionBy(*keys).orderBy(place, *order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = cut.withColumn("_inside", F.coalesce(F.sum(value).over(within), F.lit(0)))
    return _attached(ranked, sums, keys).withColumn(name, F.col("_base") + F.col("_inside")).drop("_base", "_inside", "_bucket")


def _attached(rows: DataFrame, side: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on keys that may be NULL; the side has one row per key."""
    other = side.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[c for c in side.columns if c not in keys])
    condition = F.col(keys[0]).eqNullSafe(F.col("_k0"))
    for i, k in enumerate(keys[1:], 1):
        condition &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return rows.join(other, condition, "left").drop(*[f"_k{i}" for i in range(len(keys))])


def queued(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           weights=(3, 1, 2), share: float = 1.5, epochs: int = 2) -> DataFrame:
    """Documents with their place in their source's queue: ``doc_id``, ``source``, ``size``, ``source_size``,
    ``target``, ``start`` (words of the source before it). The shuffle is the MD5 of the id; rows that share an id
    follow each other by size. Reruns agree.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    rows = rows.withColumn("_shuffle", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")))
    rows = rows.withColumn("_place", F.conv(F.substring("_shuffle", 1, 8), 16, 10).cast("double") / F.lit(4294967296.0))
    started = _running(rows, ["source"], "_place", ["_shuffle", "doc_id", "size"], "size", "start")
    sizes = started.groupBy("source").agg(F.sum("size").alias("source_size"))
    return _attached(started, source_targets(sizes, weights, share, epochs), ["source"]).select(
        "doc_id", "source", "size", "source_size", "target", "start")


def mix(queue: DataFrame, share: float = 1.5, epochs: int = 2) -> DataFrame:
    """The mix, one row per copy of a document that it takes, in the order of virtual finish times.

    A source is served at a rate of its target, so its copy finishes at (words before it + its own words) /
    target, where a further pass starts at the source's size. All sources reach their targets, and the mix its
    budget, at time 1: copies are sorted by finish time over range partitions, and the copy each source
    has in service at time 1 is cut to the words that are left. Adds ``epoch``, ``finish``, ``taken`` (words),
    ``position`` (words of the mix before the copy); rows past the budget are dropped.
    """
    copies = (queue.where("size > 0 and target > 0")
              .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
              .withColumn("_from", F.col("start") + F.col("epoch") * F.col("source_size"))
              .withColumn("taken", F.least(F.col("size"), F.floor(F.col("target") - F.col("_from"))))
              .where("taken > 0")
              .withColumn("finish", F.least(F.lit(1.0), (F.col("_from") + F.col("size")) / F.col("target")))
              .withColumn("_all", F.lit(1)))
    placed = _running(copies, ["_all"], "finish", ["source", "_from"], "taken", "position")
    budget = queue.agg(F.sum("size").cast("double").alias("_words")).select((F.col("_words") * F.lit(float(share))).alias("_budget"), F.lit(1).alias("_all"))
    return _attached(placed, budget, ["_all"]).where("position < _budget").drop("_all", "_from", "_budget")


def _place(doc_id, size) -> F.Column:
    """Place of a document in its source's queue, as a value to compare."""
    return F.struct(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")).alias("shuffle"), doc_id.alias("id"), size.alias("size"))


def repeated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights=(3, 1, 2), share: float = 1.5, epochs: int = 2) -> DataFrame:
    """The rows of the input, each as often as the mix takes it, whole: a last part of a document counts as one time.

    Every pass takes a source's queue from the front, so the last document it takes settles all others: texts are
    held against one such place per source and pass, and never moved. Rows of one source that share id and size are taken
    equally often. Texts without words are not taken; an empty input gives an empty result.
    """
    queue = cut_lineage(queued(df, id_col, text_col, source_col, weights, share, epochs), "queue")
    left = [F.floor(F.col("target") - (F.col("start") + e * F.col("source_size"))) for e in range(epochs)]
    ends = checked(queue.where("size > 0 and target > 0").groupBy(F.col("source").alias("_source")).agg(
        *[F.max(F.when(left[e] > 0, _place(F.col("doc_id"), F.col("size")))).alias(f"_end{e}") for e in range(epochs)]), "ends")
    rows = df.withColumn("_size", word_count(F.col(text_col))).where("_size > 0")
    rows = rows.join(ends, F.col(source_col).eqNullSafe(F.col("_source")))
    place = _place(F.col(id_col), F.col("_size"))
    times = reduce(add, [F.coalesce((place <= F.col(f"_end{e}")).cast("int"), F.lit(0)) for e in range(epochs)])
    return (rows.withColumn("_times", times).where("_times > 0")
            .withColumn("_time", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*df.columns))


def in_order(copies: DataFrame) -> DataFrame:
    """Copies range-sorted by their place in the mix."""
    return copies.repartitionByRange("position").sortWithinPartitions("position")


def mixture(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
            weights=(3, 1, 2), share: float = 1.5, epochs: int = 2) -> DataFrame:
    """How much of every document the mix takes.

    One row per input row: ``doc_id``, ``size`` (words, NULL text: 0), ``source_size``, ``target`` (of its source),
    ``taken`` (words, copies counted; at most ``epochs`` times the size), ``position`` (words of the mix before its
    first copy, NULL if it takes none). Every source's taken words are its target, less than one word per copy in
    service at the end. A NULL source is a source of its own, the last. Texts without words are never
    taken. An empty input gives an empty result; other columns are not read. Runs jobs that keep rows of a few
    numbers in the shared folder.
    """
    queue = cut_lineage(queued(df, id_col, text_col, source_col, weights, share, epochs), "queue")
    taken = mix(queue, share, epochs).groupBy("source", "start").agg(
        F.sum("taken").alias("taken"), F.min("position").alias("position"))
    blank = queue.where("size = 0").withColumns({"taken": F.lit(0).cast("long"), "position": F.lit(None).cast("long")})
    some = _attached(queue.where("size > 0"), taken, ["source", "start"])
    names = ["doc_id", "size", "source_size", "target", "taken", "position"]
    return some.withColumn("taken", F.coalesce("taken", F.lit(0).cast("long"))).select(names).unionByName(blank.select(names))
