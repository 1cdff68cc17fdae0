"""Spelling variants: words one edit apart, found with bit-sliced position indexes over shards of the vocabulary."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macrotide.session import cut_lineage

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
CELL_WORDS = 16_384  # words of one side of a shard that meet in one task
BLOCK = 1 << 20  # 64-bit words of a query block's bitsets


def runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every maximal run of letters, A-Z lower-cased: ``doc_id``, ``run``; a NULL text has none."""
    found = F.regexp_extract_all(F.translate(F.col(text_col), UPPER, LOWER), F.lit(RUN), F.lit(0))
    return df.select(F.col(id_col).alias("doc_id"), F.explode(found).alias("run"))


def vocabulary(words: DataFrame, word: Column, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """Distinct words of enough code points and occurrences: ``word``, ``n``; counted by task before the shuffle."""
    return (words.select(word.alias("word")).where(F.length("word") >= least_length)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count))


# ---- one shard -------------------------------------------------------------------------------------------------------


class PositionIndex:
    """For every position and letter the set of words with that letter there, 64 words to a machine word."""

    def __init__(self, letters: np.ndarray, size: np.ndarray):
        self.count, self.width = letters.shape
        self.known = np.unique(letters)
        codes = np.searchsorted(self.known, letters)
        self.sets = np.zeros((self.width + 2, len(self.known) + 1, -(-self.count // 64)), np.uint64)
        for position in range(self.width):
            held = np.zeros((len(self.known), self.sets.shape[2] * 64), bool)
            held[codes[:, position], np.arange(self.count)] = True
            held[:, : self.count][:, size <= position] = False
            self.sets[position, :-1] = self.packed(held)
        self.all = self.of(np.ones(self.count, bool))

    @staticmethod
    def packed(flags: np.ndarray) -> np.ndarray:
        return np.packbits(flags, axis=-1, bitorder="little").view(np.uint64)

    def of(self, flags: np.ndarray) -> np.ndarray:
        return self.packed(np.append(flags, np.zeros(-len(flags) % 64, bool)))

    def code(self, letters: np.ndarray) -> np.ndarray:
        """Codes of letters; one that no word has gets the code of an empty set."""
        at = np.minimum(np.searchsorted(self.known, letters), len(self.known) - 1)
        return np.where(self.known[at] == letters, at, len(self.known))

    def one_error(self, letters: np.ndarray, head: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Words one error away from each of several queries of equal length, and those with the same first ``head`` letters.

        All queries advance letter by letter. ``exact`` holds the words that match so far, ``other`` those with one letter
        replaced, ``less`` those that lack one of the query's letters (their positions lag by one), ``more`` those with
        an additional one (their positions lead by one).
        """
        codes = self.code(letters)
        exact = np.repeat(self.all[None], len(letters), 0)
        other, less, more = np.zeros_like(exact), np.zeros_like(exact), exact.copy()
        same_head = exact
        for i in range(letters.shape[1]):
            code = codes[:, i]
            here = self.sets[i, code]
            other = (other & here) | (exact & ~here)
            less = (less & self.sets[i - 1, code] if i else less) | exact
            exact = exact & here
            more = (more & self.sets[i + 1, code]) | exact
            if i + 1 == head:
                same_head = exact
        return other, less, more, same_head


def _letters(words: list[str], width: int) -> np.ndarray:
    """Code points by word and position, padded with zeros."""
    return np.array(words, f"U{width}").view(np.uint32).reshape(len(words), width)


def _near(rows: dict, short: int, tail: bool) -> pa.RecordBatch | None:
    """Of each query word of a cell: how many of its index words are near, and the one of largest count."""
    size = np.array([len(w) for w in rows["word"]])
    n = np.array(rows["n"], np.int64)
    index = [i for i in range(len(size)) if rows["indexed"][i]]
    index.sort(key=lambda i: (-rows["n"][i], rows["word"][i]))  # the first bit set is the form
    asked = np.flatnonzero(np.array(rows["asked"], bool))
    if not index or not len(asked):
        return None
    letters = _letters(rows["word"], short + 1)
    index = np.array(index)
    table = PositionIndex(letters[index], size[index])
    is_short = table.of(size[index] == short)
    words, best, counts = [], [], []
    block = max(1, BLOCK // table.all.size)
    for length in (short, short + 1):
        of_length = asked[size[asked] == length]
        for at in range(0, len(of_length), block):
            part = of_length[at:at + block]
            other, less, more, same_head = table.one_error(letters[part, :length], short // 2)
            near = (other & is_short) | (more & ~is_short & table.all) if length == short else less & is_short
            if tail:
                near &= ~same_head  # found where words share their head
            bits = np.unpackbits(near.view(np.uint8), axis=1, bitorder="little")[:, : table.count]
            found = bits.sum(1, dtype=np.int64)
            some = np.flatnonzero(found)
            words.append(part[some])
            best.append(index[bits[some].argmax(1)])
            counts.append(found[some])
    words, best, counts = (np.concatenate(x) for x in (words, best, counts))
    return pa.RecordBatch.from_arrays(
        [pa.array([rows["word"][i] for i in words], pa.string()), pa.array(counts), pa.array([rows["word"][i] for i in best], pa.string()), pa.array(n[best])],
        ["word", "n_near", "form", "form_n"])


# ---- the vocabulary --------------------------------------------------------------------------------------------------


def _posts(vocab: DataFrame) -> DataFrame:
    """Shards of every word: words of ``short`` letters, and of one more, that share their first or last short / 2 letters.

    One edit leaves the first or the last half of the shorter word as it is, so near words meet in a shard.
    """
    length = F.length("word")
    shards = []
    for more in (0, 1):
        short = length - more
        half = F.floor(short / 2).cast("int")
        shards += [F.struct(short.alias("short"), F.lit(False).alias("tail"), F.substring("word", F.lit(1), half).alias("part")),
                   F.struct(short.alias("short"), F.lit(True).alias("tail"), F.substring("word", length - half + 1, half).alias("part"))]
    return vocab.select("word", "n", F.explode(F.array(*shards)).alias("shard")).select("word", "n", "shard.*")


def _cells(vocab: DataFrame, cell_words: int) -> DataFrame:
    """Words dealt to cells of shards: every shard is cut into parts, and every part is asked against every part."""
    key = ["short", "tail", "part"]
    posts = _posts(vocab)
    shards = posts.groupBy(*key).agg(F.count("*").alias("m"), F.count_if(F.length("word") == F.col("short")).alias("k")).where(
        "m > 1 and k > 0").select(*key, F.ceil(F.col("m") / cell_words).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("word"), F.col("parts").cast("long")).cast("int")
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    cells = F.when(F.col("parts") == 1, F.array(F.struct(F.lit(0).alias("row"), F.lit(0).alias("col"), F.lit(True).alias("indexed"), F.lit(True).alias("asked")))).otherwise(
        F.concat(F.transform(every, lambda j: F.struct(own.alias("row"), j.alias("col"), F.lit(True).alias("indexed"), F.lit(False).alias("asked"))),
                 F.transform(every, lambda i: F.struct(i.alias("row"), own.alias("col"), F.lit(False).alias("indexed"), F.lit(True).alias("asked")))))
    return posts.join(shards, key).select("word", "n", *key, F.explode(cells).alias("cell")).select("word", "n", *key, "cell.*")


def near_words(vocab: DataFrame, cell_words: int = CELL_WORDS) -> DataFrame:
    """Of every word with a near one: ``word``, ``n_near``, and ``form``, ``form_n``, the near word of largest count."""
    key = ["short", "tail", "part", "row", "col"]

    def run(batches):
        held: list[pa.RecordBatch] = []

        def done():
            rows = pa.Table.from_batches(held).to_pydict()
            return _near(rows, rows["short"][0], rows["tail"][0])

        for batch in batches:
            if not batch.num_rows:
                continue
            names = list(zip(*(batch[k].to_pylist() for k in key)))
            start = 0
            for i in range(len(names)):
                if i and names[i] != names[i - 1] or not i and held and names[0] != last:
                    if i > start:
                        held.append(batch.slice(start, i - start))
                    if (out := done()) is not None:
                        yield out
                    held, start = [], i
            held.append(batch.slice(start))
            last = names[-1]
        if held and (out := done()) is not None:
            yield out

    found = _cells(vocab, cell_words).repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "word string, n_near long, form string, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", "best.form", (-F.col("best.less")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """Last form that is reached from each word: ``word``, ``root``, from ``word``, ``form``; each round doubles the steps.

    A form is more frequent than its word, so there are no circles, and rounds are as few as the logarithm of the depth.
    """
    now = cut_lineage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = cut_lineage(now.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        now = moved.select("word", "root")


def variants(vocab: DataFrame, ratio: int = RATIO, cell_words: int = CELL_WORDS) -> DataFrame:
    """Near words, form and root of every word of a vocabulary: ``word``, ``n``, ``n_near``, ``form``, ``form_n``, ``root``.

    ``vocab`` has one row per ``word`` with its count ``n``. Words are near if one inserted, deleted or replaced code
    point makes them equal. The form is the near word of largest count (ties: first in code-point order) if that is
    at least ``ratio`` times the word's, else NULL, as is ``form_n``; the root is where following forms ends, the word
    itself without a form. Words are compared in shards that share half their letters, cut into cells of bounded
    size; near words always share a shard. Words of under two letters are near to nothing. An empty
    vocabulary gives an empty result; other columns are not read. Building the result runs jobs that keep
    intermediates in the shared folder.
    """
    words = cut_lineage(vocab.select("word", F.col("n").cast("long").alias("n")), "vocabulary")
    formed = F.col("form_n") >= ratio * F.col("n")
    near = cut_lineage(words.join(near_words(words.where(F.length("word") > 1), cell_words), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(formed, F.col("form")).alias("form"), F.when(formed, F.col("form_n")).alias("form_n")), "near")
    last = roots(near.where("form is not null"))
    return near.join(last, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
