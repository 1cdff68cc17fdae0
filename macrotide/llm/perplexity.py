"""Quality by the perplexity of an interpolated modified Kneser-Ney model of byte n-grams, learned from trusted text."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macrotide.llm.sides import checked
from macrotide.llm.text import Texts, slices
from macrotide.session import cut_lineage, scratch_path, small_batches

ORDER, CHUNK_BYTES, QUANTILE, WINDOW, LEAST_CALIBRATION = 4, 32 << 20, 0.995, 64, 50
PART_BYTES = 1 << 20  # of text that a Python worker counts or scores at once


def _grams(texts: Texts, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at every byte, as one integer, and the borders of the texts; texts start with zero bytes."""
    size = texts.end - texts.start
    first = np.concatenate([[0], np.cumsum(size)])
    pad = order - 1
    padded = np.zeros(len(texts.data) + pad * (len(size) + 1), np.int64)
    place = np.arange(len(texts.data)) + pad * (np.repeat(np.arange(len(size)), size) + 1)
    padded[place] = texts.data
    out = np.zeros(len(texts.data), np.int64)
    for back in range(order):
        out |= padded[place - back] << (8 * back)
    return out, first


def _parts(texts: Texts, limit: int = PART_BYTES):
    """Runs of texts of about ``limit`` bytes."""
    row = 0
    while row < len(texts.start):
        until = max(row + 1, int(np.searchsorted(texts.end, texts.start[row] + limit, "right")))
        base = texts.start[row]
        yield Texts(texts.data[base:texts.end[until - 1]], texts.start[row:until] - base, texts.end[row:until] - base)
        row = until


def _distinct(texts: Texts, order: int) -> np.ndarray:
    return np.unique(np.concatenate([np.unique(_grams(part, order)[0]) for part in _parts(texts)]))


def _counts(docs: DataFrame, order: int) -> DataFrame:
    """Counts of n-grams: ``gram``, ``n``; counted by slice before the shuffle."""
    def run(batches):
        for _, texts in slices(batches, limit=PART_BYTES):
            found, n = np.unique(_grams(texts, order)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], ["gram", "n"])

    return docs.mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _unpacked(row: pa.RecordBatch, i: int) -> Texts:
    """Texts of a stored chunk."""
    end = np.cumsum(row.column(row.schema.get_field_index("size"))[i].values.to_numpy())
    data = pa.decompress(row.column(row.schema.get_field_index("blob"))[i].as_py(), int(end[-1]), codec="zstd", asbytes=True)
    return Texts(np.frombuffer(data, np.uint8), np.append(0, end[:-1]), end)


def _asked(chunks: DataFrame, order: int) -> DataFrame:
    """Distinct n-grams of every chunk: ``chunk``, ``gram``."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                gram = _distinct(_unpacked(batch, i), order)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(gram), batch.column(0)[i].as_py())), pa.array(gram)], ["chunk", "gram"])

    return chunks.select("chunk", "size", "blob").mapInArrow(run, "chunk long, gram long")


def _chunks(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """One stored row per chunk: its documents' ids, marks, languages, lengths, and their texts as one compressed block.

    Stored in buckets of ``chunk``, so that bringing answers to a chunk moves the answers only. A chunk gathers the rows
    of as many batches as it has room for, and holds their texts compressed only.
    """
    kind = docs.schema["doc_id"].dataType

    def chunk(rows, sink, blob):
        blob.close()
        columns = [pa.concat_arrays(c) for c in zip(*rows)]
        border = pa.array([0, len(columns[0])], pa.int32())
        return pa.RecordBatch.from_arrays(
            [*(pa.ListArray.from_arrays(border, c) for c in columns), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
            ["doc_id", "mark", "lang", "size", "blob"])

    def run(batches):
        rows, held = [], 0
        for batch, texts in slices(batches, limit=min(PART_BYTES, chunk_bytes)):
            if rows and held + len(texts.data) > chunk_bytes:
                yield chunk(rows, sink, blob)
                rows, held = [], 0
            if not rows:
                sink = pa.BufferOutputStream()
                blob = pa.CompressedOutputStream(sink, "zstd")
            own = pa.array(np.arange(batch.num_rows))  # copies: slices would hold the whole batch, texts too
            rows.append([*(batch.column(batch.schema.get_field_index(name)).take(own) for name in ("doc_id", "mark", "lang")), pa.array(texts.end - texts.start)])
            held += len(texts.data)
            blob.write(texts.data)
        if rows:
            yield chunk(rows, sink, blob)

    rows = docs.select("doc_id", "mark", "lang", "text").mapInArrow(
        run, f"doc_id array<{kind.simpleString()}>, mark array<long>, lang array<string>, size array<long>, blob binary")
    spark, name = docs.sparkSession, f"chunks_{uuid.uuid4().hex}"
    rows.select(F.monotonically_increasing_id().alias("chunk"), "*").write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "chunk").option(
        "path", scratch_path(spark, "chunks")).saveAsTable(name)
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only: the files stay in the shared folder
    return stored


def _discounts(table: DataFrame) -> list[float]:
    """Discounts of n-grams seen once, twice and more often, from how many there are of each count."""
    n = [0] + list(table.agg(*[F.count_if(F.col("a") == k) for k in (1, 2, 3, 4)]).first())
    y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
    out = []
    for k in (1, 2, 3):
        d = k - (k + 1) * y * n[k + 1] / n[k] if n[k] else 0.5 * k
        out.append(min(max(d, 0.05), k - 0.05))
    return out


def _discount(a: Column, d: list[float]) -> Column:
    return F.when(a == 1, d[0]).when(a == 2, d[1]).otherwise(d[2])


def model(counts: DataFrame, order: int = ORDER) -> list[tuple[DataFrame, DataFrame]]:
    """Tables of orders 1 to ``order``: (``g``, ``direct``) of n-grams, (``h``, ``back``) of contexts.

    The highest order uses counts, each lower one the number of different bytes before an n-gram. ``direct`` is
    the discounted share of an n-gram in its context, ``back`` the weight that the context leaves to the order below.
    """
    tables = []
    now = counts.select(F.col("gram").alias("g"), F.col("n").alias("a"))
    for k in range(order, 0, -1):
        d = _discounts(now)
        a = F.col("a")
        shift = F.shiftright("g", 8)
        contexts = cut_lineage(now.groupBy(shift.alias("h")).agg(
            F.sum("a").alias("total"), F.sum(F.least(a, _discount(a, d))).alias("taken")), f"contexts-{k}")
        share = now.withColumn("h", shift).join(contexts, "h").select("g", (F.greatest(a - _discount(a, d), F.lit(0.0)) / F.col("total")).alias("direct"))
        tables.insert(0, (cut_lineage(share, f"grams-{k}"), contexts.select("h", (F.col("taken") / F.col("total")).alias("back"))))
        if k > 1:
            now = cut_lineage(now.groupBy(F.col("g").bitwiseAND((1 << 8 * (k - 1)) - 1).alias("g")).agg(F.count("*").alias("a")), f"types-{k - 1}")
    return tables


def probabilities(wanted: DataFrame, tables: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """``gram``, ``logp`` of distinct n-grams, joined order by order with tables sharded by n-gram and by context."""
    rows, p = wanted.select("gram"), F.lit(1 / 256)
    for k, (grams, contexts) in enumerate(tables, 1):
        tail = F.col("gram").bitwiseAND((1 << 8 * k) - 1)
        rows = (rows.withColumn("_g", tail).withColumn("_h", F.shiftright(tail, 8))
                .join(grams.select(F.col("g").alias("_g"), "direct"), "_g", "left")
                .join(contexts.select(F.col("h").alias("_h"), "back"), "_h", "left"))
        rows = rows.select("gram", (F.coalesce("direct", F.lit(0.0)) + F.coalesce("back", F.lit(1.0)) * p).alias("p"))
        p = F.col("p")
    return rows.select("gram", F.log("p").alias("logp"))


def scored(docs: DataFrame, trusted: DataFrame, order: int = ORDER, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Bytes and log-probability of every text: ``doc_id``, ``mark`` (hash of the text), ``lang``, ``n_bytes``, ``logp``,
    ``spread`` (standard deviation of the log-probability a byte over all windows of 64 bytes).

    ``docs`` has ``doc_id``, ``text``, ``lang``; ``trusted`` the ids to learn from. Runs of rows of about ``chunk_bytes``
    are stored as chunks, in whatever order the rows come. A chunk asks for the n-grams it holds, once each, and is
    brought together with their probabilities: what moves are each chunk's distinct n-grams.
    """
    docs = docs.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("mark", F.xxhash64("text"))
    known = docs.join(checked(trusted.select("doc_id"), "trusted"), "doc_id", "left_semi").select("text")
    tables = model(cut_lineage(_counts(known, order), "counts"), order)
    chunks = _chunks(docs, chunk_bytes)
    asked = cut_lineage(_asked(chunks, order), "asked")
    answers = asked.join(probabilities(asked.select("gram").distinct(), tables), "gram").select("chunk", F.col("gram"), F.col("logp").cast("float").alias("logp"))

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        grams = right["gram"].to_numpy()
        by = np.argsort(grams)
        grams, logp = grams[by], right["logp"].to_numpy()[by].astype(float)
        out = []
        for row in left.to_batches():
            for i in range(row.num_rows):
                one = lambda name: row.column(row.schema.get_field_index(name))[i].values
                found = [_sums(part, grams, logp, order) for part in _parts(_unpacked(row, i))]
                out.append(pa.RecordBatch.from_arrays(
                    [one("doc_id"), one("mark"), one("lang"), one("size"), *(pa.array(np.concatenate(x)) for x in zip(*found))],
                    ["doc_id", "mark", "lang", "n_bytes", "logp", "spread"]))
        return pa.Table.from_batches(out, out[0].schema) if out else pa.table(
            {n: pa.array([], t) for n, t in (("doc_id", left["doc_id"].type.value_type), ("mark", pa.int64()), ("lang", pa.string()), ("n_bytes", pa.int64()), ("logp", pa.float64()), ("spread", pa.float64()))})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        score, f"doc_id {kind}, mark long, lang string, n_bytes long, logp double, spread double")


def _sums(texts: Texts, grams: np.ndarray, logp: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Log-probability of every text, and its spread over windows."""
    gram, first = _grams(texts, order)
    if not len(gram):
        return np.zeros(len(texts.start)), np.zeros(len(texts.start))
    sums = np.concatenate([[0.0], np.cumsum(logp[np.searchsorted(grams, gram)])])
    return sums[first[1:]] - sums[first[:-1]], _spread(sums, first)


def _spread(sums: np.ndarray, first: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """Standard deviation over all windows of ``width`` bytes of each text; 0 for a text without two of them."""
    many = np.maximum(np.diff(first) - width + 1, 0)
    row = np.repeat(np.arange(len(many)), many)
    start = first[row] + np.arange(len(row)) - (np.cumsum(many) - many)[row]
    mean = (sums[start + width] - sums[start]) / width
    least = np.maximum(many, 1)
    centre = np.bincount(row, mean, len(many)) / least
    return np.sqrt(np.bincount(row, (mean - centre[row]) ** 2, len(many)) / least)


def _calibration(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % 8 == 0


def quality(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            quantile: float = QUANTILE, order: int = ORDER) -> DataFrame:
    """Perplexity of every text, its spread over windows, and whether both are within their language's limits.

    Returns ``doc_id``, ``mark`` (hash of the text, to tell rows that share an id), ``n_bytes``, ``perplexity``, ``limit``,
    ``spread``, ``spread_limit``, ``kept``. Trusted texts are those labelled good (``quality`` 1 in every label); seven
    eighths of them train the model, the rest set the limits: the ``quantile`` of their log-perplexity in a language, and
    that of their spread. Words said over and over are each likely or unlikely for whole windows: the mean may be usual,
    the spread is not. A language with under 50 of them, or none (NULL), takes the limits over all.

    NULL and empty texts have no perplexity and are not kept. Without trusted text nothing is learned: perplexity, spread
    and limits are NULL and every other text is kept. Rows are judged each by their own text; an empty input
    gives an empty result; other columns are not read.
    """
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    trusted = cut_lineage(labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("q"))
                          .where("q = 1").select("doc_id"), "trusted")
    with small_batches(df.sparkSession):
        rows = cut_lineage(scored(docs, trusted.where(~_calibration(F.col("doc_id"))), order).withColumn(
            "loss", F.when(F.col("n_bytes") > 0, -F.col("logp") / F.col("n_bytes"))), "scored")
    tried = rows.where("n_bytes > 0").join(checked(trusted.where(_calibration(F.col("doc_id"))), "calibration"), "doc_id", "left_semi")
    limits = [F.percentile_approx(c, quantile, 10_000) for c in ("loss", "spread")]
    own = tried.where("lang is not null").groupBy("lang").agg(
        limits[0].alias("own"), limits[1].alias("own_spread"), F.count("*").alias("n")).where(F.col("n") >= LEAST_CALIBRATION).drop("n")
    pooled, pooled_spread = tried.agg(*limits).first()
    learned = pooled is not None
    judged = (rows.join(own, "lang", "left").withColumn("limit", F.coalesce("own", F.lit(pooled).cast("double")))
              .withColumn("spread_limit", F.coalesce("own_spread", F.lit(pooled_spread).cast("double"))))
    good = ((F.col("loss") <= F.col("limit")) & (F.col("spread") <= F.col("spread_limit"))) if learned else F.lit(True)
    return judged.select(
        "doc_id", "mark", "n_bytes", F.when(F.lit(learned), F.exp("loss")).alias("perplexity"), F.exp("limit").alias("limit"),
        F.when(F.lit(learned) & (F.col("n_bytes") > 0), F.col("spread")).alias("spread"), "spread_limit",
        ((F.col("n_bytes") > 0) & F.coalesce(good, F.lit(False))).alias("kept"))
