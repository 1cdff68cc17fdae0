"""Language identification by unigram pieces, summed over all segmentations of a word."""

from __future__ import annotations

import base64
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from macrotide.llm.text import Rolling, Texts, find_words, slices
from macrotide.session import cut_lineage

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
ROWS_PER_LANGUAGE, STEPS = 2_000, 3
_SMOOTHING, _SLICE = 0.5, 4 << 20


def read_vocabulary(spark: SparkSession, path: str = VOCABULARY) -> list[bytes]:
    """Pieces of a public byte-level vocabulary (lines of base64 and rank), whatever their length, and all single bytes.

    The file belongs to the installation of the driver; its size is fixed whatever the input.
    """
    with open(path, "rb") as file:
        pieces = {base64.b64decode(line.split()[0]) for line in file if line.strip()}
    return sorted(pieces | {bytes([b]) for b in range(256)})


@dataclass
class Model:
    """For every length the prefixes of pieces (hashes in order, and the row of the piece that ends there or -1), the
    languages, and the pieces' probabilities (pieces x languages)."""

    prefixes: list[tuple[np.ndarray, np.ndarray]]
    languages: list[str]
    probability: np.ndarray

    @classmethod
    def of(cls, pieces: list[bytes], languages: list[str], longest: int | None = None) -> Model:
        """A model of equal probabilities over pieces of at most ``longest`` bytes (None: all)."""
        size = np.array([len(p) for p in pieces])
        start = np.cumsum(size) - size
        rolling = Rolling(np.frombuffer(b"".join(pieces), np.uint8))
        prefixes = []
        for length in range(1, min(longest or size.max(), size.max()) + 1):
            rows = np.flatnonzero(size >= length)
            h = rolling.between(start[rows], start[rows] + length)
            rows = np.where(size[rows] == length, rows, -1)
            order = np.lexsort((-rows, h))
            h, rows = h[order], rows[order]
            first = np.append(True, h[1:] != h[:-1])
            prefixes.append((h[first], rows[first]))
        return cls(prefixes, languages, np.ones((len(pieces), len(languages))) / len(pieces))


def _log_sums(x: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Logarithms of the sums of exp(x) over runs of rows that begin at ``heads``."""
    top = np.maximum.reduceat(x, heads)
    part = np.exp(x - np.repeat(top, np.diff(np.append(heads, len(x))), axis=0))
    return top + np.log(np.add.reduceat(part, heads))


class Lattice:
    """All pieces inside distinct words, as edges between nodes, one node before, between and after their bytes.

    Nodes are numbered by their distance from the word's begin, then by word, the longest word first: a sweep takes one
    distance of all words at a time, and costs the same per byte whatever the words' lengths. Every byte has to be a
    piece. Sums are kept as logarithms, so that a word of any length has a score.
    """

    def __init__(self, model: Model, data: np.ndarray, start: np.ndarray, end: np.ndarray, blank: np.ndarray):
        size = end - start + blank
        self.order = np.argsort(-size, kind="stable")
        start, end, blank, self.size = start[self.order], end[self.order], blank[self.order], size[self.order]
        first = np.cumsum(self.size) - self.size
        buffer = np.full(int(size.sum()), 32, np.uint8)
        owner = np.repeat(np.arange(len(size)), end - start)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(end - start) - (end - start), end - start)
        buffer[first[owner] + blank[owner] + inside] = data[start[owner] + inside]
        rolling = Rolling(buffer, lower=True)
        self.longest = int(self.size[0]) if len(size) else 0
        self.width = np.searchsorted(-self.size, -np.arange(self.longest + 1), "right")  # words of that many bytes or more
        self.layer = np.concatenate([[0], np.cumsum(self.width)])  # first node of each distance
        self.last = self.layer[self.size] + np.arange(len(size))

        at = np.repeat(np.arange(self.longest), self.width[1:])
        word = np.arange(len(at)) - np.repeat(np.cumsum(self.width[1:]) - self.width[1:], self.width[1:])
        kind = np.int32 if self.layer[-1] < 1 << 31 else np.int64
        edges = [[np.zeros(0, kind)] for _ in range(4)]
        for length, (hashes, rows) in enumerate(model.prefixes, 1):
            fits = at + length <= self.size[word]
            at, word = at[fits], word[fits]
            place = first[word] + at
            h = rolling.between(place, place + length)
            k = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            known = hashes[k] == h
            at, word, row = at[known], word[known], rows[k[known]]
            whole = row >= 0
            for one, values in zip(edges, (self.layer[at] + word, self.layer[at + length] + word, row, word)):
                one.append(values[whole].astype(kind))
        target = np.concatenate(edges[1])
        by_target = np.argsort(target, kind="stable")
        self.target = target[by_target]
        self.source, self.row, self.word = (np.concatenate(edges[i])[by_target] for i in (0, 2, 3))

    def forward(self, p: np.ndarray) -> np.ndarray:
        """Logarithm of the probability of all ways to reach every node, one column per language."""
        log_p = np.log(p)
        alpha = np.zeros((self.layer[-1], p.shape[1]))
        bounds = np.searchsorted(self.target, self.layer)
        heads = np.flatnonzero(np.append(True, self.target[1:] != self.target[:-1]))  # of all nodes but the words' first
        nodes = self.layer - len(self.size)
        for j in range(1, self.longest + 1):
            a, b = bounds[j], bounds[j + 1]
            alpha[self.layer[j]:self.layer[j + 1]] = _log_sums(
                alpha[self.source[a:b]] + log_p[self.row[a:b]], heads[nodes[j]:nodes[j + 1]] - a)
        return alpha

    def _backward(self, log_p: np.ndarray) -> np.ndarray:
        """Logarithm of the probability of all ways from every node to the end of its word."""
        beta = np.zeros(self.layer[-1])
        by_source = np.argsort(self.source, kind="stable")
        source, target, row = self.source[by_source], self.target[by_source], self.row[by_source]
        bounds = np.searchsorted(source, self.layer)
        for j in range(self.longest - 1, -1, -1):
            a, b = bounds[j], bounds[j + 1]
            heads = np.flatnonzero(np.append(True, source[a + 1:b] != source[a:b - 1]))
            beta[self.layer[j]:self.layer[j] + self.width[j + 1]] = _log_sums(beta[target[a:b]] + log_p[row[a:b]], heads)
        return beta

    def occurrences(self, counts: np.ndarray, pieces: int) -> np.ndarray:
        """How often every piece occurs as a substring in words that occur ``counts`` times."""
        return np.bincount(self.row, counts[self.order][self.word], pieces)

    def expected(self, p: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of every piece in words that occur ``counts`` times, for one language."""
        log_p = np.log(p)
        alpha, beta = self.forward(p[:, None])[:, 0], self._backward(log_p)
        use = np.exp(alpha[self.source] + log_p[self.row] + beta[self.target] - alpha[self.last][self.word])
        return np.bincount(self.row, use * counts[self.order][self.word], len(p))

    def scores(self, p: np.ndarray) -> np.ndarray:
        """Log probability of every word in its original order."""
        out = np.empty((len(self.size), p.shape[1]))
        out[self.order] = self.forward(p)[self.last]
        return out


def _distinct(texts: Texts):
    """Distinct words of a slice, whole: start, end, blank before, and for every occurrence its number and its text."""
    words = find_words(texts)
    _, pick, which = np.unique(Rolling(texts.data, lower=True).between(words.start, words.end), return_index=True, return_inverse=True)
    return words.start[pick], words.end[pick], np.ones(len(pick), np.int64), which, words.text


def _counted(sample: DataFrame, model: Model, first: bool) -> np.ndarray:
    """Expected uses of all pieces per language over the sample; the first time all occurrences count alike."""
    sent = sample.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = sent.value
        total = np.zeros(model.probability.shape)
        for batch, texts in slices(batches, limit=_SLICE):
            spoken = batch.column(batch.schema.get_field_index("language")).to_numpy()
            start, end, blank, which, text = _distinct(texts)
            for k in np.unique(spoken):
                counts = np.bincount(which[spoken[text] == k], minlength=len(start)).astype(float)
                own = np.flatnonzero(counts)
                if not len(own):
                    continue
                lattice = Lattice(model, texts.data, start[own], end[own], blank[own])
                if first:
                    total[:, k] += lattice.occurrences(counts[own], len(total))
                else:
                    total[:, k] += lattice.expected(model.probability[:, k], counts[own])
        piece, k = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(k), pa.array(total[piece, k])], ["piece", "language", "n"])

    found = sample.mapInArrow(run, "piece long, language long, n double").groupBy("piece", "language").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(model.probability.shape)
    out[found["piece"], found["language"]] = found["n"]
    return out


def learn(rows: DataFrame, pieces: list[bytes], per_language: int = ROWS_PER_LANGUAGE, steps: int = STEPS) -> Model | None:
    """Piece probabilities per language from rows of ``doc_id``, ``text``, ``lang``: about ``per_language`` of each language.

    Starts from how often a piece occurs as a substring; ``steps`` rounds of expectation over all segmentations
    follow. What reaches the driver are sums per piece and language.
    """
    sizes = {r["lang"]: r["n"] for r in rows.where("lang is not null").groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    model = Model.of(pieces, sorted(sizes))
    spark = rows.sparkSession
    plan = F.broadcast(spark.createDataFrame([(k, i, per_language / sizes[k]) for i, k in enumerate(model.languages)], "lang string, language long, share double"))
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    sample = cut_lineage(rows.join(plan, "lang").where(draw < F.col("share")).select("text", "language"), "languages")
    for step in range(steps + 1):
        n = _counted(sample, model, step == 0) + _SMOOTHING / len(pieces)
        model.probability = n / n.sum(axis=0)
    return model


def _with_letters(texts: Texts) -> np.ndarray:
    low = (texts.data | 32) - 97 < 26
    total = np.concatenate([[0], np.cumsum(low)])
    found = total[texts.end] > total[texts.start]
    for i in np.flatnonzero(~found & (texts.end > texts.start)):
        found[i] = any(c.isalpha() for c in texts.one(i).decode())
    return found


def held_out(id_col) -> F.Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def languages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", vocabulary: str = VOCABULARY,
              per_language: int = ROWS_PER_LANGUAGE) -> DataFrame:
    """Predicted language of every text: ``doc_id``, ``held_out``, ``lang_pred``, ``score`` (its posterior, 0 to 1).

    Learns from text and language of rows that are not held out (crc32 of the id modulo 4 is 2), a bounded number of
    each language; rows without an id count as not held out. A text's probability in a language is the product over
    its words (A-Z in lower case) of the sum over all ways to cut the word, with its leading blank, into pieces of the
    vocabulary; words and pieces have any length. NULL and empty texts, texts without a letter, and all texts if
    there is nothing to learn from, are ``und`` with score 0. Repeated rows are predicted each for itself; an empty
    input gives an empty result; other columns are not read.

    The model is broadcast: pieces x languages, whatever the input.
    """
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    model = learn(docs.where(~held_out(F.col("doc_id"))), read_vocabulary(df.sparkSession, vocabulary), per_language)
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = sent.value
        for batch, texts in slices(batches, limit=_SLICE):
            size = len(texts.start)
            predicted, score = np.full(size, "und", object), np.zeros(size)
            lettered = _with_letters(texts) if model else np.zeros(size, bool)
            if lettered.any():
                start, end, blank, which, text = _distinct(texts)
                each = Lattice(model, texts.data, start, end, blank).scores(model.probability)
                total = np.column_stack([np.bincount(text, each[which, k], size) for k in range(len(model.languages))])
                best = total.argmax(axis=1)
                share = 1 / np.exp(np.maximum(total - total.max(axis=1, keepdims=True), -700)).sum(axis=1)
                predicted[lettered] = np.array(model.languages, object)[best[lettered]]
                score[lettered] = share[lettered]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(predicted, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    found = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
