"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text and normalised by length."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macrotide.llm.sides import checked, sampled
from macrotide.llm.text import slices
from macrotide.session import cut_lineage

LABELLED_ROWS, ENTRIES, LEAST_DOCUMENTS = 40_000, 20_000, 3
SIGNIFICANT, FLUSH = 25.0, 400_000
# Words that count as toxic where labels say nothing, and phrases in which they don't.
SEED = ("idiot", "moron", "stupid", "loser", "scum", "trash", "pathetic", "worthless", "disgusting", "clown")
EXCEPTIONS = ("circus clown", "clown fish", "trash can", "trash bin", "trash bag", "loser bracket")
# Letters of other scripts and signs that stand for a Latin letter.
HOMOGLYPHS = {
    "а": "a", "ɑ": "a", "α": "a", "в": "b", "с": "c", "ϲ": "c", "ԁ": "d", "е": "e", "ε": "e", "ɡ": "g",
    "һ": "h", "н": "h", "і": "i", "ι": "i", "ı": "i", "ј": "j", "к": "k", "κ": "k", "ⅼ": "l", "ӏ": "l", "м": "m",
    "ո": "n", "п": "n", "о": "o", "ο": "o", "σ": "o", "р": "p", "ρ": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "τ": "t",
    "υ": "u", "ս": "u", "ν": "v", "ѵ": "v", "ԝ": "w", "ω": "w", "х": "x", "χ": "x", "у": "y", "ү": "y", "ᴢ": "z",
}
# Digits and signs written for letters; i, l, 1 and ! all become one letter.
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i"}


def _fold_table() -> dict[int, str | None]:
    """Homoglyphs and full-width forms to Latin letters, invisible signs out, punctuation and white space to blanks."""
    table: dict[int, str | None] = {ord(k): v for k, v in HOMOGLYPHS.items()}
    table |= {0xFF01 + i: chr(0x21 + i).lower() for i in range(94)}
    table |= {c: None for c in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)}
    table |= {c: " " for c in range(33) }
    table |= {c: " " for c in range(33, 128) if not chr(c).isalnum() and chr(c) not in SIGNS}
    table |= {ord(c): " " for c in "…«»“”’‘–—¡¿"}
    return table | {ord("l"): "i"}


_FOLD, _SIGNS = _fold_table(), str.maketrans(SIGNS)
_MIXED = re.compile(r"[\w@$!]*[0134578@$!9][\w@$!]*")


def _plain(found: re.Match) -> str:
    """Digits and signs become letters in words that have letters too; signs at the end are punctuation."""
    word = found[0].rstrip("!$@")
    return word.translate(_SIGNS) if any(c.isalpha() for c in word) else " "


def fold(text: str) -> str:
    """One form for a word however it is disguised: case, script, invisible signs, digits and signs inside words."""
    low = text.lower().translate(_FOLD)
    return f" {_MIXED.sub(_plain, low)} "


@dataclass
class Lexicon:
    """Weights of entries (whole words end with a blank, stems don't), exceptions, and the score's coefficients."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    coefficients: tuple[float, float, float] = (-4.0, 1.5, 0.5)

    def automaton(self):
        import ahocorasick

        machine = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            machine.add_word(f" {entry}", (len(entry) + 1, weight))
        for phrase in self.exceptions:
            folded = fold(phrase)
            machine.add_word(folded, (len(folded), None))
        machine.make_automaton()
        return machine

    def score(self, total: np.ndarray, words: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_terms(total, words) @ np.array(self.coefficients), -30, 30)))


def _terms(total: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Constant, evidence, and evidence per hundred words."""
    return np.column_stack([np.ones(len(total)), np.log1p(total), np.log1p(100 * total / np.maximum(words, 1))])


def evidence(machine, text: str) -> tuple[float, int]:
    """Sum over words of the heaviest entry that matches there, outside exception phrases; and the number of words."""
    line = fold(text)
    best: dict[int, float] = {}
    free = []
    for end, (size, weight) in machine.iter(line):
        start = end - size + 1
        if weight is None:
            free.append((start, end))
        elif weight > best.get(start, 0.0):
            best[start] = weight
    begin, until = _joined(free)
    total = sum(w for at, w in best.items() if not (k := bisect_right(begin, at)) or at >= until[k - 1])
    return total, len(line.split())


def _joined(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the union of spans, in order, so that a place is looked up and not held against every span."""
    begin: list[int] = []
    until: list[int] = []
    for a, b in sorted(spans):
        if until and a <= until[-1]:
            until[-1] = max(until[-1], b)
        else:
            begin.append(a)
            until.append(b)
    return begin, until


def _entries(words: set[str]) -> set[str]:
    """What may become an entry: whole words, and stems of four to six letters that a longer word begins with."""
    out = {f"{w} " for w in words if len(w) < 40}
    for k in (4, 5, 6):
        out.update([w[:k] for w in words if len(w) > k])
    return out


def _counts(rows: DataFrame) -> DataFrame:
    """Documents with and without label that hold each possible entry; counted per task before the shuffle."""
    def run(batches):
        seen: tuple[Counter, Counter] = (Counter(), Counter())

        def flush():
            names = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), *[pa.array([c[n] for n in names], pa.int64()) for c in seen]], ["entry", "clean", "toxic"])
            for c in seen:
                c.clear()

        for batch, texts in slices(batches):
            marks = batch.column(batch.schema.get_field_index("toxic")).to_pylist()
            for i, mark in enumerate(marks):
                seen[mark].update(_entries(set(fold(texts.one(i).decode()).split())))
                if len(seen[0]) + len(seen[1]) > FLUSH:
                    yield from flush()
        yield from flush()

    return rows.mapInArrow(run, "entry string, clean long, toxic long").groupBy("entry").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def learn(rows: DataFrame, entries: int = ENTRIES) -> Lexicon:
    """Lexicon from rows of ``text``, ``toxic`` (0 or 1), of a bounded number.

    The weight of an entry is its log-odds between the two classes, of entries that occur in some toxic rows
    and whose split is beyond chance (likelihood ratio); at most ``entries`` of them, the heaviest. How evidence
    becomes a score is a logistic fit on the same rows.
    """
    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    clean, toxic = totals.get(0, 0), totals.get(1, 0)
    seed = {fold(w)[1:]: 4.0 for w in SEED}
    if not clean or not toxic:
        return Lexicon(seed)
    a, b, share = F.col("toxic").cast("double"), F.col("clean").cast("double"), toxic / (clean + toxic)
    n = a + b
    part = lambda x, p: F.when(x > 0, x * F.log(x / (n * F.lit(p)))).otherwise(0.0)
    ratio = 2 * (part(a, share) + part(b, 1 - share))
    weight = F.log((a + 0.5) / (toxic + 1)) - F.log((b + 0.5) / (clean + 1))
    found = (_counts(rows).where((F.col("toxic") >= LEAST_DOCUMENTS) & (ratio > SIGNIFICANT)).withColumn("weight", weight)
             .where("weight > 2").orderBy(F.desc("weight"), "entry").limit(entries).toPandas())
    lexicon = Lexicon(seed | dict(zip(found["entry"], found["weight"])))
    known = _evidence(rows, lexicon, ["toxic"]).toPandas()
    lexicon.coefficients = _fit(_terms(known["total"].to_numpy(), known["words"].to_numpy()), known["toxic"].to_numpy())
    return lexicon


def _fit(x: np.ndarray, y: np.ndarray, penalty: float = 0.05) -> tuple[float, float, float]:
    """Logistic regression with non-negative slopes, by Newton steps."""
    use = [0, 1, 2]
    while True:
        z, w = x[:, use], np.zeros(len(use))
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            hessian = (z * (p * (1 - p))[:, None]).T @ z + penalty * np.eye(len(use))
            w = w + np.linalg.solve(hessian, z.T @ (y - p) - penalty * w)
        worst = min(range(1, len(use)), key=lambda k: w[k], default=0)
        if len(use) == 1 or w[worst] >= 0:
            out = np.zeros(3)
            out[use] = w
            return tuple(out)
        use.pop(worst)


def _evidence(docs: DataFrame, lexicon: Lexicon, extra: list[str]) -> DataFrame:
    """Evidence and words of every text, with the columns ``extra``; the lexicon has a bounded number of entries."""
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)
    types = {f.name: f.dataType.simpleString() for f in docs.schema.fields}

    def run(batches):
        machine = sent.value.automaton()
        for batch, texts in slices(batches):
            found = [evidence(machine, texts.one(i).decode()) for i in range(len(texts.start))]
            total, words = (np.array([f[k] for f in found], float) for k in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(batch.schema.get_field_index(c)) for c in extra], pa.array(total),
                 pa.array(words.astype(np.int64)), pa.array(sent.value.score(total, words))], [*extra, "total", "words", "score"])

    return docs.mapInArrow(run, ", ".join(f"{c} {types[c]}" for c in extra) + ", total double, words long, score double")


def held_out(id_col) -> F.Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def toxicity(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             rows: int = LABELLED_ROWS, threshold: float = 0.3) -> DataFrame:
    """Toxicity of every document: ``doc_id``, ``held_out``, ``score`` (0 to 1), ``predicted``, ``words``.

    The lexicon is learned from about ``rows`` labelled rows (all, if there are fewer; drawn by hashed id), none of
    them held out (crc32 of the id modulo 4 is 2). ``labels`` has ``doc_id`` and ``toxic``; NULL is no label, and of several labels the highest counts. Without labels a short list of
    plain words is used. NULL and empty texts score as texts without evidence. Rows that share an id are scored
    each by their own text, a row without an id is never held out; an empty input gives an empty result; other
    columns are not read.
    """
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    marks = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    chosen = checked(sampled(cut_lineage(marks, "labels"), rows, "doc_id"), "chosen")
    known = cut_lineage(docs.join(chosen, "doc_id").select("text", "toxic"), "labelled")
    scored = _evidence(docs, learn(known), ["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"), "words")
