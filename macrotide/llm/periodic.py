"""Runs of words that repeat with a period, by seeds on diagonals of each document, and their collapse to one period."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macrotide.llm.text import Rolling, Texts, Words, _powers, find_words, mix, slices

LEAST = 12
HITS = 1 << 21  # pairs of equal seeds held at a time
Found = tuple[np.ndarray, np.ndarray, np.ndarray]


class Sequences(Rolling):
    """Hashes of any range of words, from one 64-bit value for each."""

    def __init__(self, values: np.ndarray):
        forward, self.back = _powers(1 << max(20, len(values).bit_length()))
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(mix(values) * forward[: len(values)], out=self.sums[1:])


def _seeds(hashed: Sequences, first: np.ndarray, size: np.ndarray, gram: int, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The index of grams that occur twice in a document: places in order of gram and place, number of the gram, which are seeds.

    Seeds are the grams at multiples of ``stride``; ``first`` and ``size`` are the documents' first words and numbers of words.
    """
    many = np.maximum(size - gram + 1, 0)
    owner = np.repeat(np.arange(len(size)), many)
    at = first[owner] + np.arange(len(owner)) - (np.cumsum(many) - many)[owner]
    h = mix(hashed.between(at, at + gram) + mix(owner.astype(np.uint64)))
    by = np.argsort(h, kind="stable")
    h, at = h[by], at[by]
    same = h[1:] == h[:-1]
    twice = np.append(same, False) | np.append(False, same)
    h, at = h[twice], at[twice]
    number = np.cumsum(np.append(True, h[1:] != h[:-1])) - 1 if len(h) else np.zeros(0, np.int64)
    return at, number, at % stride == 0


def _chains(index: tuple[np.ndarray, np.ndarray, np.ndarray], doc: np.ndarray, stride: int, least: int, most: int) -> Iterator[Found]:
    """Lag, first and last seed of every stretch of seeds that recur ``least`` to ``most`` words later.

    Hits of one lag on neighbouring seeds overlap, so each but the first is covered already: the end of its chain is how
    far the lag has come. Lags are halved until a part has a bounded number of hits.
    """
    at, number, seed = index
    room = int(doc.size) + most + 1
    key = number * room + at
    mine = key[seed]
    todo = [(least, most)]
    while todo:
        low, high = todo.pop()
        left, right = np.searchsorted(key, mine + low), np.searchsorted(key, mine + high, "right")
        n = right - left
        total = int(n.sum())
        if not total:
            continue
        if total > HITS and low < high:
            todo += [((low + high) // 2 + 1, high), (low, (low + high) // 2)]
            continue
        i = np.repeat(at[seed], n)
        j = at[np.repeat(left, n) + np.arange(total) - np.repeat(np.cumsum(n) - n, n)]
        by = np.lexsort((i, j - i))
        i, lag = i[by], (j - i)[by]
        on = (lag[1:] == lag[:-1]) & (i[1:] == i[:-1] + stride) & (doc[i[1:]] == doc[i[:-1]])
        head = np.flatnonzero(np.append(True, ~on))
        tail = np.append(head[1:], len(i)) - 1
        yield lag[head], i[head], i[tail]


def _reach(hashed: Sequences, at: np.ndarray, lag: np.ndarray, room: np.ndarray, step: int) -> np.ndarray:
    """How many words, at most ``room``, agree with those ``lag`` later from a place on (step 1) or before it (step -1)."""
    low, high = np.zeros(len(at), np.int64), room + 1  # ``low`` agree, ``high`` do not
    while len(at) and (high - low > 1).any():
        half = (low + high) // 2
        a, b = (at, at + half) if step > 0 else (at - half, at)
        same = hashed.between(a, b) == hashed.between(a + lag, b + lag)
        low, high = np.where(same, half, low), np.where(same, high, half)
    return low


def _exact(values: np.ndarray, begin: int, end: int, at: int, lag: int) -> tuple[int, int]:
    """The stretch around ``at`` whose words agree with those ``lag`` later, within a document, word by word."""
    equal = values[begin:end - lag] == values[begin + lag:end]
    apart = np.flatnonzero(~equal) + begin
    k = np.searchsorted(apart, at)
    return (int(apart[k - 1]) + 1 if k else begin), (int(apart[k]) if k < len(apart) else end - lag)


def _is_power(values: np.ndarray, start: int, period: int) -> bool:
    return any(period % p == 0 and (values[start:start + period - p] == values[start + p:start + period]).all() for p in range(1, period // 2 + 1))


class Known:
    """Runs found so far, to skip the multiples of their periods."""

    def __init__(self, start: np.ndarray, end: np.ndarray, period: np.ndarray):
        by = np.argsort(start, kind="stable")
        self.start, end, period = start[by], end[by], period[by]
        self.end = np.maximum.accumulate(end) if len(end) else end
        self.period = period[np.maximum.accumulate(np.where(end == self.end, np.arange(len(end)), 0))] if len(end) else period

    def cover(self, at: np.ndarray, until: np.ndarray, lag: np.ndarray) -> np.ndarray:
        """A run whose period divides the lag covers the place up to ``until``: two runs of smaller period cannot both."""
        if not len(self.start):
            return np.zeros(len(at), bool)
        k = np.searchsorted(self.start, at, "right") - 1
        inside = (k >= 0) & (self.end[k] >= until)
        return inside & (lag % self.period[k] == 0)


def find_runs(values: np.ndarray, first: np.ndarray, least: int = LEAST) -> Found:
    """Maximal runs in sequences of words: start, length, smallest period, in order of start and period.

    ``first`` are the borders of the sequences. A run with period q and at least ``least`` and 2 q words has max(least - q, q)
    words that agree with those q later. Lags are taken in classes from k to 2 k; the guaranteed overlap of a class is k
    words, so it holds a seed: a gram of k / 2 + 1 words at a multiple of k / 2. Each seed is looked up in the index of all grams
    of its length among the places one lag away, and each chain of seeds is extended once. A seed has at most k such
    places, so a class costs no more than twice the words, whatever repeats in them. Hashes only find; runs are compared word by word.
    """
    size = np.diff(first)
    doc = np.repeat(np.arange(len(size)), size)
    hashed = Sequences(values)
    k = (least + 1) // 2
    low, runs = 1, [np.zeros((3, 0), np.int64)]
    while len(size) and max(2 * low, least) <= size.max():
        some = size >= max(2 * low, least)
        stride = k - k // 2
        gram = k - stride + 1
        index = _seeds(hashed, first[:-1][some], size[some], gram, stride)
        known = Known(*np.concatenate(runs, 1))
        for lag, head, tail in _chains(index, doc, stride, low, 2 * k - 1):
            new = ~known.cover(head, head + lag + gram, lag) if low > 1 else np.ones(len(lag), bool)
            lag, head, tail = lag[new], head[new], tail[new]
            begin, end = first[doc[head]], first[doc[head] + 1]
            start = head - _reach(hashed, head, lag, np.minimum(head - begin, stride), -1)
            stop = tail + gram + _reach(hashed, tail + gram, lag, np.minimum(end - lag - tail - gram, stride), 1)
            enough = (stop - start >= lag) & (stop - start + lag >= least)
            runs.append(_checked(values, *(x[enough] for x in (start, stop, lag, head, begin, end)), least))
        low, k = 2 * k, 2 * k
    start, end, period = np.concatenate(runs, 1)
    by = np.lexsort((period, start))
    return start[by], (end - start)[by], period[by]


def _checked(values, start, stop, lag, head, begin, end, least) -> np.ndarray:
    """Start, end and period of stretches that are runs, compared word by word; powers of a smaller period are none."""
    out = []
    for a, b, q, at, low, high in zip(*(x.tolist() for x in (start, stop, lag, head, begin, end))):
        sure = (values[a:b] == values[a + q:b + q]).all() and (a == low or values[a - 1] != values[a - 1 + q]) and (b + q == high or values[b] != values[b + q])
        if not sure:
            a, b = _exact(values, low, high, at, q)
        if b - a >= q and b - a + q >= least and not (q <= least and _is_power(values, a, q)):
            out.append((a, b + q, q))
    return np.array(out, np.int64).reshape(-1, 3).T


def _joined(texts: Texts, words: Words, keep: np.ndarray) -> pa.Array:
    """Texts of the kept words, joined by one space."""
    kept = np.flatnonzero(keep)
    text = words.text[kept]
    last = np.append(text[1:] != text[:-1], True) if len(kept) else np.zeros(0, bool)
    size = words.end[kept] - words.start[kept]
    full = size + ~last
    border = np.concatenate([[0], np.cumsum(full)])
    source = np.arange(border[-1]) + np.repeat(words.start[kept] - border[:-1], full)
    data = texts.data[np.minimum(source, max(len(texts.data) - 1, 0))]
    data[border[1:][~last] - 1] = 32
    count = np.bincount(text, minlength=len(texts.start)) if len(kept) else np.zeros(len(texts.start), np.int64)
    offsets = border[np.concatenate([[0], np.cumsum(count)])]
    return pa.Array.from_buffers(pa.large_string(), len(texts.start), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """Runs of repeating words of every text, and the text without the repetitions.

    Returns ``doc_id``, ``n_words``, ``runs`` (array of ``start``, ``length``, ``period``, numbers of words, by start and period),
    ``collapsed`` (words outside the runs and in the first period of every run that contains them, joined by one
    space). A run is a stretch of at least ``least`` and two periods of words, with that smallest period, which no
    neighbouring word continues; runs may overlap. Words are split at ASCII white space and equal if their bytes are (by a
    64-bit hash of each).

    NULL, empty and blank texts have no words, no runs and an empty ``collapsed``. Every row stands for itself, whatever
    its id; an empty input gives an empty result; other columns are not read. Rows are independent, so nothing is shuffled.
    """
    def run(batches):
        for batch, texts in slices(batches):
            words = find_words(texts)
            values = Rolling(texts.data).between(words.start, words.end)
            start, length, period = find_runs(values, words.first, least)
            change = np.zeros(len(values) + 1, np.int64)
            np.add.at(change, start + period, 1)
            np.add.at(change, start + length, -1)
            border = np.searchsorted(start, words.first).astype(np.int32)
            inner = pa.StructArray.from_arrays(
                [pa.array(x) for x in (start - words.first[words.text[start]], length, period)], ["start", "length", "period"])
            collapsed = _joined(texts, words, np.cumsum(change[:-1]) == 0).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words.counts()), pa.ListArray.from_arrays(border, inner), collapsed], ["doc_id", "n_words", "runs", "collapsed"])

    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
