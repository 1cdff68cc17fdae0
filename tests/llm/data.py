"""Small documents with every odd case: NULLs, blanks, long texts, copies, repeated rows, ids on several rows."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use inside
    *[T.StructField(n, T.StringType()) for n in ("key", "size", "token", "_n", "unit", "gram", "label", "bin_id", "chunk", "u")]])
LABELS = "doc_id long, quality int, toxic int, score double"


def prose(rng, n, lang="en"):
    parts = {"en": ["the", "er", "on", "and", "ing", "ou", "th", "st", "ea", "ly"], "de": ["und", "sch", "ein", "ü", "keit", "ver", "ä", "ung", "ich", "be"]}[lang]
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(n))


def documents():
    rng = random.Random(5)
    rows = []

    def add(doc_id, text, lang="en", source="a"):
        rows.append((doc_id, text, lang, source, None if text is None else len(text), *["x"] * 10))

    for i in range(40):
        lang = "de" if i % 4 == 0 else "en"
        add(i, prose(rng, rng.randint(5, 160), lang), lang, f"s{i % 3}")
    base = prose(rng, 120)
    add(50, base)
    add(51, base.replace(" ", "\n ", 3), source="b")  # equal but for white space
    words = base.split(" ")
    for i in range(4):  # near copies
        changed = list(words)
        changed[10 + 20 * i] = f"edit{i}"
        add(60 + i, " ".join(changed), source=None)
    add(70, None)
    add(71, "")
    add(72, " \t\n ")
    add(73, None, None, None)
    add(None, prose(rng, 60))
    add(None, base)
    add(74, "one two")
    add(75, "one two")
    add(76, "12345 !!! 678")
    add(77, "the idiot said m0r0n and ѕcum, you c1own", source="b")
    add(78, "Released under the MIT License.\n" + prose(rng, 30))
    add(79, prose(rng, 6000), source="long")
    add(80, "w" * 5000 + " " + "=" * 3000)
    add(81, ("same line here\n" * 4) + prose(rng, 60))
    for _ in range(3):  # one row three times
        add(90, base + " tail", "en", "b")
    add(91, prose(rng, 30))
    add(91, prose(rng, 30))  # one id, two texts
    add(92, "the&&& er### on$$$ and%%% " * 30)
    add(93, "\n".join([prose(rng, 70), base[:300]]))
    return rows


def labels():
    return [(i, 0 if i == 92 else 1, 1 if i in (77,) else 0, 0.5) for i in [*range(40), 50, 60, 77, 79, 92]] + [(None, 1, 1, 0.0), (70, None, None, 0.0)]
