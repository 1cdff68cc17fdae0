"""Quality rules by an isolation forest over rule statistics, with a threshold from labelled rows."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macrotide.llm.sides import sampled
from macrotide.llm.text import Rolling, find_words, mix, seeds, slices
from macrotide.operators.orderstats import quantiles
from macrotide.session import cut_lineage

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_bytes", "n_upper", "n_digits", "n_distinct_words", "n_lines", "n_repeated_next"]
TREES, SAMPLE = 200, 256
TAIL = 0.002  # share of good rows beyond either end of a rule's range
STEPS = 1 << 16  # of a score, from 0 to 1: so many counts at most tell how labelled rows are spread
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_MIN_WORDS, _MAX_REPEATED = 50, 50  # fixed values of the base rules: words, per cent


def _per_text(flags: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[end] - total[start]


def _statistics(texts) -> dict[str, np.ndarray]:
    words = find_words(texts)
    size, counts = len(texts.start), words.counts()
    h = Rolling(texts.data).between(words.start, words.end)
    out = {"n_words": counts, "n_bytes": texts.end - texts.start}
    letters = (texts.data & 0xC0) != 0x80  # first bytes of code points
    inked = np.zeros(len(texts.data) + 1, np.int64)
    np.cumsum(letters, out=inked[1:])
    chars = np.concatenate([[0], np.cumsum(inked[words.end] - inked[words.start])])
    out["word_chars"] = chars[words.first[1:]] - chars[words.first[:-1]]
    data = texts.data
    out["n_symbols"] = _per_text(_SYMBOL[data], texts.start, texts.end)
    out["n_upper"] = _per_text((data >= 65) & (data <= 90), texts.start, texts.end)
    out["n_digits"] = _per_text((data >= 48) & (data <= 57), texts.start, texts.end)
    out["n_lines"] = _per_text(data == 10, texts.start, texts.end) + (out["n_bytes"] > 0)
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (words.text[1:] == words.text[:-1])
    out["n_repeated_next"] = _per_text(again, words.first[:-1], words.first[1:])

    repeated, distinct = np.zeros(size, np.int64), np.zeros(size, np.int64)
    factors = seeds(3, 21)
    n = len(h)
    three = np.zeros(n, np.uint64)
    if n > 2:
        three[: n - 2] = mix(h[:-2] * factors[0]) + mix(h[1:-1] * factors[1]) + mix(h[2:] * factors[2])
    for i in range(size):
        a, b = words.first[i], words.first[i + 1]
        if b == a:
            continue
        distinct[i] = len(np.unique(h[a:b]))
        if b - a >= 4:
            found, place, count = np.unique(three[a: b - 2], return_inverse=True, return_counts=True)
            if len(found) < b - 2 - a:
                hit = np.flatnonzero(count[place] > 1)
                covered = np.zeros(b - a, bool)
                covered[hit] = covered[hit + 1] = covered[hit + 2] = True
                repeated[i] = covered.sum()
    out["n_repeat_words"], out["n_distinct_words"] = repeated, distinct
    out["n_dup_lines"] = _duplicate_lines(texts, words)
    return {k: v.astype(np.int64) for k, v in out.items()}


def _duplicate_lines(texts, words) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text, bytes for bytes."""
    data, size = texts.data, len(texts.start)
    out = np.zeros(size, np.int64)
    if not len(data):
        return out
    breaks = np.flatnonzero(data == 10)
    some = texts.end > texts.start
    start = np.sort(np.concatenate([texts.start[some], breaks + 1]))
    start = start[start <= len(data)]
    owner = np.searchsorted(texts.start, start, "right") - 1
    # A break at the very end of a text opens an empty last line, which has no word either way.
    end = np.minimum(np.append(start[1:], len(data) + 1) - 1, texts.end[owner])
    last = np.append(owner[1:] != owner[:-1], True)
    end[last] = texts.end[owner[last]]
    full = (end > start) & (np.searchsorted(words.start, end) > np.searchsorted(words.start, start))
    start, end, owner = start[full], end[full], owner[full]
    h = Rolling(data).between(start, end)
    border = np.searchsorted(owner, np.arange(size + 1))
    for i in np.flatnonzero(np.diff(border) > 1):
        a, b = border[i], border[i + 1]
        out[i] = b - a - len(np.unique(h[a:b]))
    return out


def rule_statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts that the rules speak of, one row per document (NULL text: all zero)."""
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    names = [*BASE, *MORE]

    def run(batches):
        for batch, texts in slices(batches):
            found = _statistics(texts)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(found[n]) for n in names]], ["doc_id", *names])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"{n} long" for n in names))


def features(found: dict[str, np.ndarray]) -> np.ndarray:
    """Rule statistics of any number of rows as ratios, one column per rule."""
    words = np.maximum(found["n_words"], 1).astype(float)
    size = np.maximum(found["n_bytes"], 1).astype(float)
    # A short text repeats fewer words by chance; the expected share of distinct ones falls as a power of length.
    return np.column_stack([
        found["word_chars"] / words, found["n_symbols"] / size, found["n_dup_lines"] / np.maximum(found["n_lines"], 1),
        found["n_repeat_words"] / words, found["n_upper"] / size, found["n_digits"] / size,
        found["n_distinct_words"] / words ** 0.9, found["n_repeated_next"] / words, found["n_lines"] / words])


@dataclass
class Limits:
    """Range of every rule among good rows; a row is described by how far it lies outside, in widths of the range."""

    low: np.ndarray
    high: np.ndarray

    @classmethod
    def of(cls, good: DataFrame, columns: list[str], tail: float = TAIL) -> Limits | None:
        """Exact quantiles over all rows; None without rows."""
        found = {r["_rule"]: r for r in quantiles(good.unpivot([], columns, "_rule", "_x"), ["_rule"], "_x", {"low": tail, "high": 1 - tail}).collect()}
        return cls(*[np.array([found[c][end] for c in columns]) for end in ("low", "high")]) if found else None

    def excess(self, x: np.ndarray) -> np.ndarray:
        width = np.maximum(self.high - self.low, 1e-3)
        return np.maximum(np.maximum(x - self.high, self.low - x), 0) / width


@dataclass
class Forest:
    """Isolation trees as flat arrays: split column (-1 at a leaf), split value, right child, depth with the leaf's remainder."""

    column: np.ndarray
    value: np.ndarray
    right: np.ndarray
    depth: np.ndarray
    normal: float
    cut: float = 1.0

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** -(mean path length / expected length), in steps: near 1 for isolated rows, below 0.5 for ordinary ones."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for t in range(len(self.column)):
            at = np.zeros(len(x), np.int64)
            while True:
                column = self.column[t][at]
                inner = column >= 0
                if not inner.any():
                    break
                right = x[rows, np.maximum(column, 0)] >= self.value[t][at]
                at = np.where(inner, np.where(right, self.right[t][at], at + 1), at)
            total += self.depth[t][at]
        return np.round(2.0 ** (-total / (max(len(self.column), 1) * self.normal)) * STEPS) / STEPS


def _expected(n: int) -> float:
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def grow(x: np.ndarray, trees: int = TREES, sample: int = SAMPLE, seed: int = 7) -> Forest:
    """Random splits of random samples, down to single rows or the depth of a balanced tree.

    Samples do not overlap where there are rows enough for all trees.
    """
    rng = np.random.default_rng(seed)
    size = min(sample, len(x))
    dealt = rng.permutation(len(x)) if len(x) >= trees * size else None
    limit = int(np.ceil(np.log2(max(size, 2)))) + 2
    made = []
    for tree in range(trees):
        nodes: list[list] = []

        def split(rows: np.ndarray, depth: int) -> None:
            me = len(nodes)
            nodes.append([-1, 0.0, 0, depth + _expected(len(rows))])
            part = x[rows]
            low, high = part.min(0), part.max(0)
            usable = np.flatnonzero(high > low)
            if depth >= limit or len(rows) < 2 or not len(usable):
                return
            c = int(rng.choice(usable))
            v = rng.uniform(low[c], high[c])
            v = v if v > low[c] else np.nextafter(low[c], np.inf)
            split(rows[part[:, c] < v], depth + 1)
            nodes[me] = [c, v, len(nodes), 0.0]
            split(rows[part[:, c] >= v], depth + 1)

        split(rng.choice(len(x), size, replace=False) if dealt is None else dealt[tree * size:(tree + 1) * size], 0)
        made.append(nodes)
    width = max(len(n) for n in made)
    arrays = [np.array([[row[k] for row in n] + [(-1, 0.0, 0, 0.0)[k]] * (width - len(n)) for n in made]) for k in range(4)]
    return Forest(arrays[0].astype(np.int64), arrays[1], arrays[2].astype(np.int64), arrays[3], max(_expected(size), 1.0))


def best_cut(score: np.ndarray, n_good: np.ndarray, n_bad: np.ndarray, lose: float = 0.01) -> float:
    """The score that separates rows best, but never one that loses more than ``lose`` of the good.

    ``score`` is ascending without repeats; the others count the good and bad rows that have it.
    """
    good, bad = n_good.sum(), n_bad.sum()
    if not good:
        return 1.0
    upto = np.cumsum(n_good)
    at = (good - 1) * (1 - lose)
    below, floor = (score[np.searchsorted(upto, f(at), "right")] for f in (np.floor, np.ceil))
    if not bad:
        return float(below + (floor - below) * (at - np.floor(at))) + 1e-9
    first = np.searchsorted(score, floor)
    lost, found = 1 - upto[first:] / good, 1 - np.cumsum(n_bad)[first:] / bad
    best = first + int(np.argmax(found - 10 * lost))
    return float((score[best] + score[best + 1]) / 2) if best + 1 < len(score) else float(score[best]) + 1e-9


def calibrated(forest: Forest, x: np.ndarray, good: np.ndarray, lose: float = 0.01) -> Forest:
    """Set the cut by rows at hand."""
    score, place = np.unique(forest.score(x), return_inverse=True)
    forest.cut = best_cut(score, np.bincount(place[good], minlength=len(score)), np.bincount(place[~good], minlength=len(score)), lose)
    return forest


def _ratios(rows: DataFrame) -> DataFrame:
    """Labelled rows as ``_good``, ``_h`` (hashed id) and one column per rule."""
    columns = [f"_x{i}" for i in range(len(features({n: np.zeros(0) for n in [*BASE, *MORE]}).T))]

    def run(batches):
        for batch in batches:
            x = features({n: batch.column(batch.schema.get_field_index(n)).to_numpy() for n in [*BASE, *MORE]})
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(c) for c in x.T]], ["_good", "_h", *columns])

    return rows.select("_good", F.xxhash64("doc_id").alias("_h"), *BASE, *MORE).mapInArrow(
        run, f"_good {rows.schema['_good'].dataType.simpleString()}, _h long, " + ", ".join(f"{c} double" for c in columns))


def quality_rules(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rule statistics of every document and the verdict of an isolation forest on them.

    Returns ``doc_id``, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``base_failed``, ``kept``, ``anomaly`` (0 to 1). A row that fails a base rule (under 50 words, or over half
    of them in repeated 3-word windows) is not kept; any other is kept if its anomaly is within the threshold.

    Every rule is measured by how far it lies outside the range of good rows, so ordinary rows coincide and rare ones
    stand apart. Labelled rows that pass the base rules teach it, all of them: the ranges are exact quantiles over the good
    ones, and the threshold is set by counts of good and bad rows per score, of which there are STEPS at most. Each tree
    is grown on 256 rows of its own, as an isolation forest is, drawn by hashed id from all labelled ones; the rows of all trees,
    the counts and the ranges are what reaches the driver, whatever the input. ``labels`` has ``doc_id`` and
    ``quality`` (1 is good; NULL is no label). Without labelled good rows only the base rules decide. NULL and
    empty texts fail; rows that share an id are judged each by their own text; an empty input gives an empty
    result; other columns are not read.
    """
    names = [*BASE, *MORE]
    marks = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("_good"))
    found = cut_lineage(rule_statistics(df, id_col, text_col).withColumn(
        "base_failed", (F.col("n_words") < _MIN_WORDS) | (100 * F.col("n_repeat_words") > _MAX_REPEATED * F.col("n_words"))
    ).join(marks, "doc_id", "left"), "rules")
    teaching = "not base_failed and _good is not null"
    known = cut_lineage(_ratios(found.where(teaching)), "labelled")
    columns = known.columns[2:]
    limits, forest = Limits.of(known.where("_good = 1"), columns), None
    if limits:
        # About a quarter more rows than the trees take, since the draw gives about as many as it is asked for.
        drawn = sampled(known, TREES * SAMPLE * 5 // 4, "_h").orderBy("_h", *columns).select(columns).toPandas()
        forest = grow(limits.excess(drawn.to_numpy()), TREES, SAMPLE)
    sent = df.sparkSession.sparkContext.broadcast((forest, limits))  # trees x 2 x sample nodes, whatever the input

    def run(batches):
        for batch in batches:
            model, limits = sent.value
            take = lambda n: batch.column(batch.schema.get_field_index(n))
            x = features({n: take(n).to_numpy() for n in names})
            score = model.score(limits.excess(x)) if model else np.zeros(len(x))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[take(n) for n in BASE], take("base_failed"), pa.array(score), take("_good")],
                ["doc_id", *BASE, "base_failed", "anomaly", "_good"])

    good = found.schema["_good"].dataType.simpleString()
    scored = cut_lineage(found.mapInArrow(run, f"doc_id {found.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"{n} long" for n in BASE)
                                          + f", base_failed boolean, anomaly double, _good {good}"), "scored")
    cut = 1.0
    if forest:
        spread = scored.where(teaching).groupBy("anomaly").agg(
            F.count_if(F.col("_good") == 1).alias("good"), F.count_if(F.col("_good") != 1).alias("bad")).toPandas().sort_values("anomaly")
        cut = best_cut(*[spread[c].to_numpy() for c in ("anomaly", "good", "bad")])
    return scored.select("doc_id", *BASE, "base_failed", (~F.col("base_failed") & (F.col("anomaly") <= cut)).alias("kept"), "anomaly")
