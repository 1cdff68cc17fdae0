"""One query per operator, over its whole table, with the digest columns that can be compared."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from macrotide.llm import anomaly, exact, langid, licences, mixing, neardup, packing, periodic, perplexity, sketches, spelling, suffixes, toxicity
from macrotide.llm.text import WORD

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op9_minhash_neardup")
def near_duplicate_documents(spark: SparkSession, sf: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf, "documents"), width=4, percent=80)


WORDS = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)"


@query("op1_source_mix", f"""
WITH d AS (SELECT doc_id, source, {WORDS}::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
q AS (SELECT *, (coalesce(sum(size) OVER (PARTITION BY source ORDER BY h, doc_id, size
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS start FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w,
        source_size::DOUBLE * 2 AS cap FROM s),
f AS (SELECT *, cap / w AS full_at FROM w),
l AS (SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - coalesce(sum(cap) OVER b, 0)) / ((sum(w) OVER ()) - coalesce(sum(w) OVER b, 0)) AS level
        FROM f WINDOW b AS (ORDER BY full_at, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
o AS (SELECT arg_min(level, full_at) FILTER (WHERE level < full_at) AS level FROM l),
t AS (SELECT l.source, l.source_size, least(cap, coalesce(o.level * w, cap)) AS target FROM l, o),
c AS (SELECT q.doc_id, q.size, q.source, q.start, t.source_size, t.target, e.epoch, q.start + e.epoch * t.source_size AS begun,
        least(q.size, floor(t.target - (q.start + e.epoch * t.source_size))::BIGINT) AS part
      FROM q JOIN t ON q.source IS NOT DISTINCT FROM t.source, (VALUES (0), (1)) e(epoch)),
p AS (SELECT *, coalesce(sum(part) OVER (ORDER BY least(1.0::DOUBLE, (begun + size)::DOUBLE / target), encode(source) NULLS FIRST, begun
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS position FROM c WHERE size > 0 AND part > 0),
g AS (SELECT source, start, sum(part)::BIGINT AS taken, min(position) AS position FROM p GROUP BY source, start)
SELECT q.doc_id, q.size, t.source_size, t.target, CASE WHEN q.size > 0 THEN coalesce(g.taken, 0) ELSE 0 END AS taken,
       CASE WHEN q.size > 0 THEN g.position END AS position
FROM q JOIN t ON q.source IS NOT DISTINCT FROM t.source
LEFT JOIN g ON q.source IS NOT DISTINCT FROM g.source AND q.start = g.start""")
def source_mix(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mixture(table(spark, sf, "documents"), weights=(3, 1, 2), share=1.5, epochs=2)


@query("op2_exact_dedup", r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[ 	-
]+', ' ', 'g') AS t FROM documents),
h AS (SELECT doc_id, sha256(t) AS text_sha256 FROM d)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM h WINDOW g AS (PARTITION BY text_sha256)""")
def exact_duplicate_documents(spark: SparkSession, sf: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf, "documents"), every_hash=True)


@query("op6_isolation_forest_rules")
def rule_verdicts(spark: SparkSession, sf: str) -> DataFrame:
    return anomaly.quality_rules(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op8_toxicity_lexicon")
def toxic_documents(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


def _licence_sql() -> str:
    quoted = ", ".join("({}, '{}', '{}')".format(i, name, text.replace("'", "''")) for i, (name, text) in enumerate(licences.TEMPLATES))
    return f"""
WITH tpl(template, licence, text) AS (VALUES {quoted}),
tw AS (SELECT template, licence, string_split(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM tpl),
tb AS (SELECT template, licence, len(w) - 1 AS t, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS bigram FROM tw),
tc AS (SELECT template, licence, t, bigram, count(*) AS tn FROM tb GROUP BY ALL),
l AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines, text FROM documents),
u AS (SELECT doc_id, unnest(CASE WHEN len(lines) > 1 THEN list_append(lines, text) ELSE lines END) AS part FROM l),
n AS (SELECT doc_id, string_split(trim(regexp_replace(lower(part), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM u),
m AS (SELECT DISTINCT w FROM n WHERE len(w) BETWEEN 2 AND 1 + (SELECT max(t) FROM tc) * 3),
b AS (SELECT w, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS bigram FROM m),
c AS (SELECT w, bigram, count(*) AS n FROM b GROUP BY ALL),
s AS (SELECT w, template, licence, 2 * sum(least(n, tn)) / (len(w) - 1 + t) AS dice FROM c JOIN tc USING (bigram) GROUP BY w, template, licence, t),
best AS (SELECT w, max(dice) AS dice, arg_min(licence, (-dice, licence)) AS licence FROM s WHERE dice >= {licences.THRESHOLD} GROUP BY w),
f AS (SELECT doc_id, max(dice) AS dice, arg_min(licence, (-dice, licence)) AS licence, count(*) AS n_units FROM n JOIN best USING (w) GROUP BY doc_id)
SELECT d.doc_id, f.licence, coalesce(f.dice, 0.0)::DOUBLE AS dice, coalesce(f.n_units, 0) AS n_units
FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN f USING (doc_id)"""


@query("op5_licence_scan", _licence_sql())
def licence_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licences.licences(table(spark, sf, "documents"))


@query("op10_best_fit_packing")
def packed_documents(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"))


@query("op3_language_pieces")
def document_languages(spark: SparkSession, sf: str) -> DataFrame:
    return langid.languages(table(spark, sf, "documents"))


@query("op4_quality_perplexity")
def document_quality(spark: SparkSession, sf: str) -> DataFrame:
    return perplexity.quality(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op7_suffix_dedup")
def texts_without_repeats(spark: SparkSession, sf: str) -> DataFrame:
    found = suffixes.without_repeats(table(spark, sf, "documents"), length=200)
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


CRC_SQL = """(SELECT list_transform(range(256), lambda n: list_reduce([n] || range(8), lambda c, i:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps)"""


def crc32_sql(octets: str, steps: str) -> str:
    """CRC-32 of a list of byte values, with the table of 256 steps that CRC_SQL derives."""
    return (f"xor(list_reduce([4294967295::BIGINT] || {octets}, lambda c, b: xor(c >> 8, {steps}[xor(c & 255, b) + 1])), 4294967295)")


@query("op11_spelling_variants", f"""
WITH t AS {CRC_SQL},
r AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{spelling.UPPER}', '{spelling.LOWER}'), '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents),
k AS (SELECT doc_id, run, count(*) AS k FROM r GROUP BY ALL),
o AS (SELECT run, k, list_transform(string_split(doc_id || ':' || run, ''), lambda c: ord(c)::BIGINT) AS points FROM k),
e AS (SELECT run, k, len(run) AS m, {crc32_sql("flatten(list_transform(points, lambda p: CASE WHEN p < 128 THEN [p] ELSE [192 + (p >> 6), 128 + (p & 63)] END))", "steps")} AS h FROM o, t),
w AS (SELECT CASE WHEN h % 199 = 0 THEN left(run, h % m) || substr(run, h % m + 2) ELSE run END AS word, k FROM e),
v AS (SELECT word, sum(k)::BIGINT AS n FROM w GROUP BY word HAVING len(word) >= 6 AND sum(k) >= 5),
a AS (SELECT word, n, unnest(range(1, len(word) + 1)) AS i FROM v),
x AS (SELECT word, n, left(word, i - 1) || '*' || substr(word, i + 1) AS one, left(word, i - 1) || substr(word, i + 1) AS less FROM a),
p AS (SELECT DISTINCT * FROM (
  SELECT l.word, l.n, r.word AS near, r.n AS near_n FROM x l JOIN x r ON l.one = r.one AND l.word <> r.word
  UNION ALL SELECT x.word, x.n, v.word, v.n FROM x JOIN v ON x.less = v.word
  UNION ALL SELECT v.word, v.n, x.word, x.n FROM x JOIN v ON x.less = v.word)),
b AS (SELECT word, count(*) AS n_near, max(near_n) AS near_n, arg_min(near, (-near_n, encode(near))) AS near FROM p GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * v.n THEN near END AS form,
             CASE WHEN near_n >= 5 * v.n THEN near_n END AS form_n FROM v LEFT JOIN b USING (word)),
c AS (WITH RECURSIVE c(word, root, depth) AS (SELECT word, word, 0 FROM f UNION ALL SELECT c.word, f.form, depth + 1 FROM c JOIN f ON c.root = f.word WHERE f.form IS NOT NULL)
      SELECT word, arg_max(root, depth) AS root FROM c GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM f JOIN c USING (word)""")
def spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    runs = spelling.runs(table(spark, sf, "documents"))
    h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run")))
    at = (h % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return spelling.variants(spelling.vocabulary(runs, F.when(h % 199 == 0, cut).otherwise(F.col("run")))).select("word", "form", "root", "n", "n_near", "form_n")


@query("op12_document_fingerprints")
def document_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return sketches.fingerprints(table(spark, sf, "documents"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """Documents of which every tenth repeats a stretch of its words up to its end: ``doc_id``, ``text``."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    n = F.size(words)
    g = F.floor(h / 10)
    some = docs.select("doc_id", "text", n.alias("n"), g.alias("g"), h.alias("h")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    rest = F.col("n") - F.col("a")
    some = some.withColumn("p", F.floor(1 + rest / (3 + F.col("g") % 8)).cast("int"))
    again = F.slice(F.flatten(F.array_repeat(F.slice(words, F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int"))), F.lit(1), rest)
    edited = F.array_join(F.concat(F.slice(words, F.lit(1), F.col("a")), again), " ")
    return some.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), edited).otherwise(F.col("text")).alias("text"))


@query("op13_periodic_runs", rf"""
WITH t AS {CRC_SQL},
d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^ 	-
]+'), []) AS w,
             {crc32_sql("list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)", "steps")} AS h FROM documents, t),
g AS (SELECT doc_id, w, len(w) AS n, h, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
q AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM g),
e AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: w[CASE WHEN i >= a THEN a + (i - a) % p ELSE i END + 1]) ELSE w END AS w FROM q),
o AS (SELECT doc_id, n, unnest(w) AS word, unnest(range(n)) AS i FROM e),
m AS (SELECT l.doc_id, r.i - l.i AS lag, l.i AS i FROM o l JOIN o r ON l.doc_id = r.doc_id AND l.word = r.word AND r.i > l.i AND 2 * (r.i - l.i) <= l.n),
s AS (SELECT doc_id, lag, min(i) AS start, count(*) AS m FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, lag ORDER BY i) AS island FROM m) GROUP BY doc_id, lag, island),
u AS (SELECT doc_id, start, m + lag AS length, min(lag) AS period FROM s WHERE m >= lag AND m + lag >= 12 GROUP BY ALL),
x AS (SELECT doc_id, count(*) AS n_runs, arg_max(struct_pack(start := start, length := length, period := period), (length, -start, -period)) AS best,
             string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed FROM u GROUP BY doc_id),
z AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM u),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM o ANTI JOIN z USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length, best.period AS period,
       1000 * best.length // best.period AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM e LEFT JOIN x USING (doc_id) LEFT JOIN k USING (doc_id)""")
def periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    found = periodic.periodic_runs(with_planted_periods(table(spark, sf, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], F.concat(r["period"], F.lit("\n")))), "")
    length, period = best["length"], -best["period"]
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-best["start"]).alias("start"), length.alias("length"), period.alias("period"),
                        F.floor(1000 * length / period).alias("exponent_milli"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
