"""Spelling variants, fingerprints and periodic runs against brute force, on odd and on adversarial inputs."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from macrotide.llm import periodic, queries, sketches, spelling
from tests.llm.data import SCHEMA, documents, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
ROWS = documents()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The odd documents with ids of their own: the contract's edits depend on them."""
    root = str(tmp_path_factory.mktemp("tables"))
    rows = [(None if r[0] is None and i % 2 else i, *r[1:]) for i, r in enumerate(ROWS)]
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{root}/documents.parquet")
    return root, rows


def words(text):
    return WORD.findall(text or "")


# ---- spelling --------------------------------------------------------------------------------------------------------


def edits(word, letters):
    for i in range(len(word) + 1):
        for c in letters:
            yield word[:i] + c + word[i:]
        if i < len(word):
            yield word[:i] + word[i + 1:]
            for c in letters:
                yield word[:i] + c + word[i + 1:]


def brute_variants(n):
    letters = {c for w in n for c in w}
    form, out = {}, {}
    for w in n:
        near = {x for x in edits(w, letters) if x in n and x != w}
        best = min(near, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
        out[w] = len(near)
    def root(w):
        return w if form[w] is None else root(form[w])
    return {(w, n[w], out[w], form[w], n[form[w]] if form[w] else None, root(w)) for w in n}


@pytest.mark.parametrize("cell_words", [16_384, 7])
def test_variants(spark, cell_words):
    rng = random.Random(4)
    n = {}
    for _ in range(900):
        w = "".join(rng.choices("abcß", k=rng.randint(2, 7)))
        n[w] = rng.choice([5, 6, 30, 31, 160, 900, 900, 5000])
    n |= {"a": 9, "b": 9, "ab": 9, "x" * 300: 5, "x" * 299: 25, "x" * 298 + "y": 125, "𝒳abcde": 7, "abcde": 70}
    df = spark.createDataFrame(list(n.items()), "word string, n int")
    got = {(r["word"], r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in spelling.variants(df, cell_words=cell_words).collect()}
    want = brute_variants({w: k for w, k in n.items() if len(w) > 1}) | {(w, 9, 0, None, None, w) for w in "ab"}
    assert got == want


def test_one_common_half(spark):
    """All words share their first letters: one shard holds them all, cut into cells."""
    rng = random.Random(2)
    n = {"common" + "".join(rng.choices("abcd", k=rng.randint(4, 7))): rng.choice([5, 50, 500]) for _ in range(1500)}
    df = spark.createDataFrame(list(n.items()), "word string, n int")
    got = {tuple(r) for r in spelling.variants(df, cell_words=100).select("word", "n", "n_near", "form", "form_n", "root").collect()}
    assert got == brute_variants(n)


def test_spelling_query(spark, folder):
    root, rows = folder
    n = Counter()
    for r in rows:
        for run in LETTERS.findall(r[1] or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{r[0]}:{run}".encode())
            n[run if r[0] is None or h % 199 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}
    got = queries.spelling_variants(spark, root)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {(r["word"], r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in got.collect()} == brute_variants(n)


# ---- fingerprints ----------------------------------------------------------------------------------------------------


def shingle_set(text):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words(text)]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def jaccard(a, b):
    a, b = shingle_set(a), shingle_set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def successors(rows, marks):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, marks[r[1] or ""]))
    return [(a, b[1] or "") for a, b in zip(order, order[1:] + order[:1])]


@pytest.mark.parametrize("bucket_rows", [2_000, 7])
def test_fingerprints(spark, docs, bucket_rows, monkeypatch):
    monkeypatch.setattr(sketches, "BUCKET_ROWS", bucket_rows)
    marks = {r["t"]: r["m"] for r in docs.select(F.coalesce("text", F.lit("")).alias("t"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("m")).collect()}
    want, exact = Counter(), defaultdict(list)
    for r, following in successors(ROWS, marks):
        text = r[1] or ""
        q = len(text) // 4
        edited = text[:len(text) - q] + following[:q]
        sha = hashlib.sha256(edited.encode()).hexdigest()
        want[(r[0], len(text), sha)] += 1
        exact[(r[0], sha)].append((text, jaccard(text, edited), jaccard(text, following), len(shingle_set(text)), len(shingle_set(following))))
    out = sketches.fingerprints(docs).collect()
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in out) == want
    prints = defaultdict(set)
    for r in out:
        text, edited, following, n, m = exact[(r["doc_id"], r["edited_sha256"])][0]
        prints[text].add(r["fingerprint"])
        small = n <= sketches.LEAST
        assert r["near_edited"] == pytest.approx(edited, abs=0.35)
        if small and m <= sketches.LEAST:
            assert r["near_next"] == following
    assert all(len(p) == 1 for p in prints.values())
    assert np.mean([abs(r["near_edited"] - exact[(r["doc_id"], r["edited_sha256"])][0][1]) for r in out]) < 0.08


def test_fingerprint_columns(spark):
    rng = random.Random(3)
    base = prose(rng, 3000).split(" ")
    parts = [base[:2000], base[1000:], base[1500:1700], base[:9], base[4:12], ["one"], []]
    texts = [" ".join(p) for p in parts]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    own = sketches.fingerprints(rows).select("doc_id", "fingerprint").cache()
    right = own.select(F.col("doc_id").alias("other"), F.col("fingerprint").alias("b"))
    out = own.crossJoin(right).select("doc_id", "other", sketches.alike(F.col("fingerprint"), F.col("b")).alias("alike"),
                                      sketches.contained(F.col("fingerprint"), F.col("b")).alias("contained"),
                                      sketches.merged(F.col("fingerprint"), F.col("b")).alias("merged")).collect()

    def arrays(print_):
        return int(print_[:16], 16), np.array([int(print_[i:i + 16], 16) for i in range(16, len(print_), 16)], np.uint64)

    of = {r["doc_id"]: arrays(r["fingerprint"]) for r in own.collect()}
    for r in out:
        a, b = r["doc_id"], r["other"]
        assert r["alike"] == pytest.approx(sketches.likeness(of[a], of[b]))
        left, both = shingle_set(texts[a]), shingle_set(texts[a]) & shingle_set(texts[b])
        if left and r["contained"] is not None:
            assert r["contained"] == pytest.approx(len(both) / len(left), abs=0.3)
        every = np.union1d(of[a][1], of[b][1])
        limit, kept = arrays(r["merged"])
        low = every[every <= sketches.COMPLETE // sketches.FRACTION]
        assert kept.tolist() == (low if len(low) >= sketches.LEAST else every[:sketches.LEAST]).tolist()
        assert (every <= np.uint64(limit)).sum() == len(kept)
    long = next(r for r in out if (r["doc_id"], r["other"]) == (2, 0))
    assert long["contained"] > 0.9 and long["alike"] < 0.3  # a short text within a long one


# ---- runs ------------------------------------------------------------------------------------------------------------


def brute_runs(w, least=12):
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i >= q and j - i + q >= least:
                found.setdefault((i, j + q), q)
            i = j
    return sorted((a, b - a, q) for (a, b), q in found.items())


def brute_collapsed(w, runs):
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def found_in(w, least=12):
    values = np.array([zlib.crc32(x.encode()) for x in w], np.uint64)
    return list(zip(*(x.tolist() for x in periodic.find_runs(values, np.array([0, len(w)]), least))))


@pytest.mark.parametrize("least", [12, 5, 2, 13])
def test_runs_of_small_alphabets(least):
    rng = random.Random(least)
    for letters in ("a", "ab", "abc", "abcdefgh"):
        for n in (0, 1, 11, 12, 13, 40, 150):
            for _ in range(6):
                w = rng.choices(letters, k=n)
                assert found_in(w, least) == brute_runs(w, least)
    for _ in range(40):
        w = []
        for _ in range(rng.randint(1, 5)):
            p = rng.choices("abcdefgh", k=rng.randint(1, 30))
            w += (p * 6)[:rng.randint(1, 5 * len(p))]
        assert found_in(w, least) == brute_runs(w, least)


def test_runs_of_structured_words():
    fib, other = ["a", "b"], ["a"]
    while len(fib) < 600:
        fib, other = fib + other, fib
    thue = [str(bin(i).count("1") % 2) for i in range(1024)]  # equal sums of powers: hashes of it collide
    for w in (fib, thue, thue + thue, ["a"] * 200 + ["b"] + ["a"] * 200 + ["c"] + ["a"] * 200, (["a"] * 50 + ["b"]) * 8):
        assert found_in(w) == brute_runs(w)


def test_many_texts_at_once():
    rng = random.Random(9)
    texts = [rng.choices("ab", k=rng.randint(0, 60)) for _ in range(60)]
    first = np.cumsum([0, *map(len, texts)])
    values = np.array([ord(x) for t in texts for x in t], np.uint64)
    got = list(zip(*(x.tolist() for x in periodic.find_runs(values, first))))
    assert got == [(a + f, n, q) for f, t in zip(first.tolist(), texts) for a, n, q in brute_runs(t)]


@pytest.mark.parametrize("hits", [1 << 21, 50])
def test_lags_in_parts(hits, monkeypatch):
    monkeypatch.setattr(periodic, "HITS", hits)
    w = (list("abcabd") * 12 + list("x" * 40)) * 3
    assert found_in(w) == brute_runs(w)


@pytest.mark.parametrize("text", [["a"] * 400_000, (["a"] * 130_000 + ["b"]) * 3, list("ab") * 100_000 + list("abc") * 60_000])
def test_long_texts_take_no_square_time(text):
    start = time.time()
    found = found_in(text)
    assert time.time() - start < 20 and found


def test_periodic_runs(docs):
    got = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic.periodic_runs(docs).collect()]
    want = []
    for r in ROWS:
        w = words(r[1])
        runs = brute_runs(w) if len(w) < 2000 else []
        want.append((r[0], len(w), runs, brute_collapsed(w, runs)))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_periodic_query(spark, folder):
    root, rows = folder
    want = []
    for r in rows:
        w = words(r[1])
        n = len(w)
        if r[0] is not None and n and (h := zlib.crc32(str(r[0]).encode())) % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i if i < a else a + (i - a) % p] for i in range(n)]
        runs = brute_runs(w) if n < 2000 else []
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        want.append((r[0], len(runs), *best, 1000 * best[1] // best[2] if runs else None,
                     hashlib.sha256("".join(f"{a},{n},{q}\n" for a, n, q in runs).encode()).hexdigest(), hashlib.sha256(brute_collapsed(w, runs).encode()).hexdigest()))
    got = queries.periodic_runs(spark, root)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str) and any(t[1] for t in want)


# ---- empty tables ----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("run", [
    lambda d: spelling.variants(spelling.vocabulary(spelling.runs(d), F.col("run"))), sketches.fingerprints, periodic.periodic_runs])
def test_empty(spark, run):
    assert run(spark.createDataFrame([], SCHEMA)).collect() == []
