"""Licence notices by the Dice coefficient over word bigrams, with native column functions only."""

from __future__ import annotations

import re
from collections import Counter
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from macrotide.session import cut_lineage

# Short public notices of common licences.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
            "permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
# Whole licences, by the name of their file; windows only are compared to them.
FULL_TEXTS = tuple((p.stem, p.read_text()) for p in sorted((Path(__file__).parent / "licence_texts").glob("*.txt")))
THRESHOLD = 0.8
_BREAKS = r"[^a-z0-9]+"


def _words(text: str) -> list[str]:
    return re.sub(_BREAKS, " ", text.lower()).split()


def normalised(text: Column) -> Column:
    """Lower case, with one space for every run of anything but ASCII letters and digits."""
    return F.trim(F.regexp_replace(F.lower(text), _BREAKS, " "))


def _bounds(size: int, threshold: float) -> tuple[int, int]:
    """Sizes of bigram bags that can reach the threshold against a bag of ``size``."""
    return -int((1e-9 - size * threshold / (2 - threshold)) // 1), int(size * (2 - threshold) / threshold + 1e-9)


def _bigrams(words: Column) -> Column:
    count = F.size(words) - 1
    return F.zip_with(F.slice(words, F.lit(1), count), F.slice(words, F.lit(2), count), lambda a, b: F.concat_ws(" ", a, b))


def _units(docs: DataFrame) -> DataFrame:
    """Normalised lines of every text, and the whole of a text with several lines: ``doc_id``, ``unit``, ``bigrams``."""
    text = F.coalesce("text", F.lit(""))
    parts = F.concat(F.split(text, "\n"), F.when(text.contains("\n"), F.array(text)).otherwise(F.array().cast("array<string>")))
    # Normalised below the explode, so that no later condition repeats that work.
    unit = docs.select("doc_id", F.explode(F.transform(parts, normalised)).alias("unit"))
    return unit.select("doc_id", "unit", (F.length("unit") - F.length(F.translate("unit", " ", ""))).alias("bigrams"))


def _joined(windows: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges of whole numbers as few disjoint ones."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(windows):
        if out and low <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def _in(name: str, bigrams) -> str:
    return f"{name} in ({', '.join(repr(b) for b in sorted(bigrams))})"


def _windows(docs: DataFrame, templates, threshold: float) -> DataFrame:
    """Best window of the normalised text for every template that one reaches: ``doc_id``, ``licence``, ``dice``.

    The best window begins and ends at a bigram of the template, holds at least ``low`` of them and spans at most
    ``high`` bigrams. Only documents and templates with such a run of positions leave the row; equal runs are scored once.
    An occurrence counts in every window that begins after the same bigram ``tn`` occurrences earlier.
    """
    spark = docs.sparkSession
    rows, kinds = [], []
    for number, (name, text) in enumerate(templates):
        words = _words(text)
        bag = Counter(f"{a} {b}" for a, b in zip(words, words[1:]))
        if not bag:
            continue
        low, high = _bounds(len(words) - 1, threshold)
        kinds.append((number, name, len(words) - 1, low, high, bag))
        rows += [(number, bigram, n) for bigram, n in bag.items()]
    known = {bigram for _, bigram, _ in rows}
    grams = F.broadcast(spark.createDataFrame(rows, "template int, bigram string, tn int"))
    sizes = F.broadcast(spark.createDataFrame([k[:5] for k in kinds], "template int, licence string, t int, low int, high int"))

    # Each explode of one array holds what lambdas below it read again.
    words = docs.select("doc_id", F.explode(F.array(F.split(normalised(F.coalesce("text", F.lit(""))), " "))).alias("words")).where(F.size("words") > 1)
    pair = "concat_ws(' ', words[i], words[i + 1])"
    firsts = {bigram.split(" ")[0] for bigram in known}
    hits = words.select("doc_id", F.explode(F.array(F.expr(
        f"transform(filter(sequence(0, size(words) - 2), i -> {_in('words[i]', firsts)} and {_in(pair, known)}), "
        f"i -> struct(i as pos, {pair} as bigram))"))).alias("hits")).where(F.size("hits") >= min(k[3] for k in kinds))
    own = hits.select("doc_id", F.explode(F.expr("array(" + ", ".join(
        f"struct({number} as template, {low} as low, {high} as high, filter(hits, x -> {_in('x.bigram', bag)}) as hits)"
        for number, _, _, low, high, bag in kinds) + ")")).alias("own")).select("doc_id", "own.*")
    begins = "filter({0}, (x, i) -> get({0}, i + low - 1).pos - x.pos < high)"
    runs = own.where(F.expr(f"size(hits) >= low and size({begins.format('hits')}) > 0")).select(
        "doc_id", "template", F.expr("transform(hits, x -> struct(x.pos - hits[0].pos as pos, x.bigram as bigram))").alias("hits"))
    runs = cut_lineage(runs.withColumn("run", F.sha2(F.to_json("hits"), 256)), "runs")

    each = runs.groupBy("template", "run").agg(F.first("hits").alias("hits")).select("template", "run", F.inline("hits"))
    at = each.join(grams, ["template", "bigram"]).groupBy("template", "run", "bigram", "tn").agg(F.sort_array(F.collect_list("pos")).alias("at"))
    placed = at.select("template", "run", F.inline(F.expr(
        "transform(at, (p, k) -> struct(p as pos, coalesce(get(at, k - tn), -1) as before))"))).join(sizes, "template")
    # A hit counts in the widest window of every start from behind `before`, at most high - 1 ahead of it, up to its own place.
    steps = placed.selectExpr("template", "run", """stack(3, pos, 0, pos, before, greatest(before, pos - high) + 1, 1, null, null,
        pos + 1, -1, null, null) as (place, step, pos, before)""")
    most = F.sum("step").over(Window.partitionBy("template", "run").orderBy("place")).cast("int")
    marked = (steps.withColumn("most", most).where("pos is not null").groupBy("template", "run")
              .agg(F.sort_array(F.collect_list(F.struct("pos", "before", "most"))).alias("hits"), F.max("most").alias("most"))
              .join(sizes, "template").where("most >= low"))
    # No window of a start is better than one that holds nothing but its most hits; starts that cannot exceed the best so far are passed over.
    best = """aggregate(filter(transform(hits, (x, i) -> struct(i, x.pos as pos, x.most as most)), y -> y.most >= low), 0D, (top, y) -> if(
        2 * y.most / (y.most + t) <= top, top, greatest(top, aggregate(slice(hits, y.i + 1, high), struct(0 as n, 0D as best), (a, x) -> struct(
            a.n + if(x.before < y.pos, 1, 0) as n,
            if(x.pos - y.pos < high, greatest(a.best, 2 * (a.n + if(x.before < y.pos, 1, 0)) / (x.pos - y.pos + 1 + t)), a.best) as best), a -> a.best))))"""
    scored = marked.select("template", "run", "licence", F.expr(best).alias("dice")).where(F.col("dice") >= threshold)
    return runs.select("doc_id", "template", "run").join(scored, ["template", "run"]).select("doc_id", "licence", "dice")


def licences(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, threshold: float = THRESHOLD,
             full_texts=FULL_TEXTS) -> DataFrame:
    """Best licence of every document: ``doc_id``, ``licence``, ``dice``, ``n_units`` (lines or whole texts that match a notice).

    Every line, and the whole of a text with several lines, is compared to every template whose size allows the
    threshold: a bag of a bigrams reaches it only against t with a between t * threshold / (2 - threshold) and
    t * (2 - threshold) / threshold. Dice is twice the common bigrams, repeats counted, over all bigrams.
    Besides, every run of words of the whole text, over line breaks too, is compared to every template and every one of
    ``full_texts``; such a window counts for ``licence`` and ``dice``, not for ``n_units``.
    Equal units are scored once. Of equal scores the first licence by name counts. Documents without a match
    (NULL and empty texts too) have a NULL licence, 0.0 and 0. Rows that share an id are one document, rows
    without an id too; an empty input gives an empty result; other columns are not read.

    The templates are the only broadcast: a parameter of some ten thousand bigrams.
    """
    spark = df.sparkSession
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows, bounds = [], []
    for number, (name, text) in enumerate(templates):
        words = _words(text)
        bag = Counter(f"{a} {b}" for a, b in zip(words, words[1:]))
        low, high = _bounds(len(words) - 1, threshold)
        bounds.append((low, high))
        rows += [(number, name, len(words) - 1, low, high, bigram, n) for bigram, n in bag.items()]
    grams = F.broadcast(spark.createDataFrame(rows, "template int, licence string, t long, low long, high long, bigram string, tn long"))

    fits = F.lit(False)
    for low, high in _joined(bounds):
        fits |= F.col("bigrams").between(low, high)
    # A unit that reaches the threshold against some template of a fitting size has at least this share of its bigrams in it.
    known = sorted({bigram for *_, bigram, _ in rows})
    hits = F.size(F.filter(_bigrams(F.split("unit", " ")), lambda x: x.isin(known)))
    near = cut_lineage(_units(docs).where(fits).where(hits * (2 - threshold) >= F.col("bigrams") * threshold - 1e-9), "units")
    pairs = near.select("unit", "bigrams").distinct().select("unit", "bigrams", F.explode(_bigrams(F.split("unit", " "))).alias("bigram"))
    common = (pairs.join(grams, (pairs["bigram"] == grams["bigram"]) & F.col("bigrams").between(F.col("low"), F.col("high")))
              .groupBy("unit", "bigrams", "template", "licence", "t", grams["bigram"], "tn").agg(F.count("*").alias("n"))
              .groupBy("unit", "bigrams", "template", "licence", "t").agg(F.sum(F.least("n", "tn")).alias("both")))
    scored = (common.withColumn("dice", 2 * F.col("both") / (F.col("bigrams") + F.col("t"))).where(F.col("dice") >= threshold)
              .groupBy("unit").agg(F.min(F.struct((-F.col("dice")).alias("less"), "licence")).alias("best"))
              .select("unit", (-F.col("best.less")).alias("dice"), "best.licence"))
    windows = _windows(docs, (*templates, *full_texts), threshold).withColumn("units", F.lit(0))
    found = (near.join(scored, "unit").select("doc_id", "licence", "dice", F.lit(1).alias("units")).unionByName(windows).groupBy("doc_id").agg(
        F.min(F.struct((-F.col("dice")).alias("less"), "licence")).alias("best"), F.sum("units").alias("n_units"))
        .select(F.col("doc_id").alias("_id"), F.col("best.licence").alias("licence"), (-F.col("best.less")).alias("dice"), "n_units"))
    everyone = docs.select("doc_id").distinct()
    return everyone.join(found, F.col("doc_id").eqNullSafe(F.col("_id")), "left").select(
        "doc_id", "licence", F.coalesce("dice", F.lit(0.0)).alias("dice"), F.coalesce("n_units", F.lit(0).cast("long")).alias("n_units"))
