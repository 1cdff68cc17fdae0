"""The pipeline's stages, each against brute force over what the stage before kept."""

import re
from collections import Counter

import pyarrow as pa
import pytest

import __spark_entry__ as contract
import check
import corpus_pipeline
from macrotide.llm import mixing, neardup, perplexity, queries
from macrotide.session import cut_lineage
from tests.llm.data import LABELS, SCHEMA, documents, labels
from tests.llm.test_operators import brute_near, brute_targets, words

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(documents(), SCHEMA).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels(), LABELS).write.parquet(f"{root}/labels.parquet")
    return root


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        kept[name] = [tuple(r) for r in docs.collect()]
    names = [n for n, _ in corpus_pipeline.STAGES]
    good, equal, near, mixed, packed = (kept[n] for n in names)
    assert {t[0] for t in documents()} - {t[0] for t in good} == {70, 71, 73, 92} or 92 not in {t[0] for t in good}

    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    assert Counter(norm(t[1]) for t in equal) == Counter({norm(t[1]): 1 for t in good})
    gone = {i for i, _, _, stays in brute_near(equal, 5) if not stays}
    assert sorted(near, key=str) == sorted((t for t in equal if t[0] not in gone), key=str)

    sizes = Counter()
    for t in near:
        sizes[t[3]] += len(words(t[1]))
    target = brute_targets(dict(sizes))
    for source, size in sizes.items():
        have = [t for t in mixed if t[3] == source]
        longest = max(len(words(t[1])) for t in near if t[3] == source)
        assert target[source] - 1 <= sum(len(words(t[1])) for t in have) <= target[source] + longest
        assert all(n <= 2 for n in Counter(have).values())
    assert sum(t[3] for t in packed) == sum(len(words(t[1])) for t in mixed)


def test_run_is_registered(spark, folder):
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.run(spark, folder).count() > 0


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in check.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    ok, message = check.compare(spark, con, name, queries.QUERIES[name], queries.SQL[name], SF)
    assert ok, message


def test_native_queries_have_no_python(spark):
    for name in ("op1_source_mix", "op5_licence_scan"):
        plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_texts_go_to_python_in_small_batches(spark, folder, monkeypatch):
    seen = {}
    for module in (neardup, perplexity):
        monkeypatch.setattr(module, "cut_lineage", lambda df, name: seen.update({name: int(spark.conf.get(LIMIT).strip("b"))}) or cut_lineage(df, name))
    was = spark.conf.get(LIMIT)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    corpus_pipeline.good_quality(spark, docs, folder)
    corpus_pipeline.one_of_near(spark, docs, folder)
    assert all(seen[name] <= 8 << 20 for name in ("counts", "scored", "signatures", "sets"))
    assert spark.conf.get(LIMIT) == was


def test_chunks_gather_batches(spark):
    rows = [(i, i, None, "" if i % 7 == 0 else f"text {i} ä " * 20) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, mark long, lang string, text string").coalesce(1)
    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(limit, "10")
    try:
        chunks = perplexity._chunks(docs, 40_000).collect()
    finally:
        spark.conf.unset(limit)
    sizes = [sum(c["size"]) for c in chunks]
    assert max(sizes) <= 40_000 and sum(sizes) == sum(len(r[3].encode()) for r in rows) and len(chunks) == 2
    got = {}
    for c in chunks:
        data = pa.decompress(bytes(c["blob"]), sum(c["size"]), codec="zstd", asbytes=True)
        for i, size in zip(c["doc_id"], c["size"]):
            got[i], data = data[:size].decode(), data[size:]
    assert got == {r[0]: r[3] for r in rows}


def test_mix_takes_what_the_operator_takes_and_moves_no_text(spark, folder):
    rows = [t for t in documents() if t[0] not in (90, 91, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    want = Counter()
    for r in mixing.mixture(docs).collect():
        if r["taken"]:
            want[r["doc_id"]] += -(-r["taken"] // r["size"])
    limit = "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(limit)
    spark.conf.set(limit, "-1")  # as where the sides are large
    try:
        out = corpus_pipeline.mixed(spark, docs, folder)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert Counter(r["doc_id"] for r in out.collect()) == want and len(want) < len(rows) and max(want.values()) == 2
    finally:
        spark.conf.set(limit, was)
    assert not re.search(r"Exchange hashpartitioning|SortMergeJoin", plan)
