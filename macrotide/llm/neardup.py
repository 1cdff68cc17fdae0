"""Near-duplicate documents by an inverted join of MinHash signature coordinates, confirmed on whole sets."""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macrotide.llm.graph import components
from macrotide.llm.sides import checked
from macrotide.llm.text import mix, seeds, shingles, slices
from macrotide.session import cut_lineage, small_batches

COORDINATES = 48
MISSED = 1e-6  # share of pairs at the similarity itself that may have too few equal coordinates
HEADS, ROUNDS = 4, 6
CLASSES, CAP = 256, 8  # of shingles by hash, and how many of a class a set's bound tells apart: one bit each
WORDS = CLASSES * CAP // 64
PART_BYTES = 1 << 20  # of text that a Python worker hashes at once


def _sets(table, width):
    """Distinct shingle hashes of every text of a slice, as one flat array and its borders."""
    for batch, texts in table:
        h, first, _ = shingles(texts, width)
        for a, b in zip(first[:-1], first[1:]):
            h[a:b].sort()
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        new[first[:-1][np.diff(first) > 0]] = True
        yield batch, h[new], np.diff(np.concatenate([[0], np.cumsum(new)])[first])


def matches_for(percent: int, coordinates: int = COORDINATES) -> int:
    """Equal coordinates to ask for, so that a pair at ``percent`` is missed less than once in a million; too low a similarity is refused."""
    p, below = percent / 100, 0.0
    for k in range(coordinates + 1):
        below += comb(coordinates, k) * p ** k * (1 - p) ** (coordinates - k)
        if below > MISSED:
            if k < 2:
                raise ValueError(f"{coordinates} coordinates cannot tell pairs at {percent} per cent")
            return k
    return coordinates


def signatures(docs: DataFrame, width: int, coordinates: int = COORDINATES) -> DataFrame:
    """``doc_id``, ``mark`` (of the text), set size, a 128-bit key of the set, and the smallest value under each hash function.

    The smallest of 64 bits is spread over 32 bits after it is found. Smallest values lie close together, the closer the
    larger the sets: cut to 32 bits as they are, those of millions of sets would be equal by chance.
    """
    times, plus = seeds(coordinates, 11), seeds(coordinates, 12)

    def run(batches):
        for batch, flat, n in _sets(slices(batches, limit=PART_BYTES), width):
            some = n > 0
            at = (np.cumsum(n) - n)[some]
            sig = np.zeros((len(n), coordinates), np.uint32)
            key = np.zeros((2, len(n)), np.uint64)
            if len(at):
                value = np.empty_like(flat)
                for k in range(coordinates):
                    np.multiply(np.bitwise_xor(flat, plus[k], out=value), times[k], out=value)
                    sig[some, k] = mix(np.minimum.reduceat(value, at)) >> np.uint64(32)
                key[0, some] = np.add.reduceat(mix(flat), at)
                key[1, some] = np.add.reduceat(mix(flat ^ times[0]), at)
            lists = pa.ListArray.from_arrays(
                np.arange(0, (len(n) + 1) * coordinates, coordinates, dtype=np.int32), pa.array(sig.ravel().view(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n), pa.array(key[0].view(np.int64)), pa.array(key[1].view(np.int64)), lists],
                ["doc_id", "mark", "n_shingles", "key_a", "key_b", "sig"])

    return docs.select("doc_id", "mark", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, mark long, n_shingles long, "
                                "key_a long, key_b long, sig array<int>")


def _classes(flat: np.ndarray, n: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Columns ``over`` and ``bits`` of sets with ``n`` shingles each, which bound what two sets have in common.

    Shingles are counted by class of their hash: two sets have at most the sum of the classes' smaller counts in common.
    A count is so many bits of ``bits``, ``CAP`` at most, and what exceeds that is summed in ``over``: the sum is no more
    than the number of bits that both sets have plus the smaller ``over``.
    """
    at = np.repeat(np.arange(len(n)) * CLASSES, n) + (flat % np.uint64(CLASSES)).astype(np.int64)
    counts = np.bincount(at, minlength=len(n) * CLASSES).reshape(len(n), CLASSES)
    low = np.minimum(counts, CAP)
    words = ((1 << low) - 1).astype(np.uint8).view(np.int64)
    return pa.array(n - low.sum(1)), pa.ListArray.from_arrays(np.arange(len(n) + 1, dtype=np.int32) * WORDS, pa.array(words.ravel()))


def _whole_sets(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id``, the set's shingles ``items``, their number ``n``, and ``over`` and ``bits`` of :func:`_classes`."""
    def run(batches):
        for batch, flat, n in _sets(slices(batches, limit=PART_BYTES), width):
            border = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(border, pa.array(flat.view(np.int64))), pa.array(n), *_classes(flat, n)],
                ["doc_id", "items", "n", "over", "bits"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, items array<long>, n long, over long, bits array<long>")


def posted(sigs: DataFrame, matches: int) -> DataFrame:
    """The part of the inverted lists that has to be merged: ``doc_id``, ``token``.

    A token is a coordinate with its value. A pair with ``matches`` common tokens meets in the rarest
    tokens of either side, all but ``matches - 1``. Tokens of one document come first in that order and
    lead nowhere, so only the shared rest of the prefix is posted: frequent values stay unposted unless a
    document has hardly any others, and a document with fewer than ``matches`` shared tokens posts nothing.
    """
    each = sigs.select("doc_id", F.posexplode("sig")).select(
        "doc_id", F.shiftleft(F.col("col").cast("long"), 8).bitwiseOR(F.col("pos").cast("long")).alias("token"))
    often = each.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    shared = (each.join(often, "token").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("t"))
              .where(F.size("t") >= matches))
    return shared.select("doc_id", F.explode(F.slice("t", F.lit(1), F.size("t") - (matches - 1))).alias("x")).select("doc_id", "x.token")


def _agreeing(pairs: DataFrame, near: DataFrame, matches: int, percent: int) -> DataFrame:
    """Pairs with so many equal coordinates whose classes allow the similarity; ``near`` has both of every set."""
    both = pairs
    for one in ("u", "v"):
        both = both.join(near.select(F.col("doc_id").alias(one), *[F.col(c).alias(c + one) for c in ("sig", "n", "over", "bits")]), one)
    same = F.aggregate(F.zip_with("sigu", "sigv", lambda a, b: (a == b).cast("int")), F.lit(0), lambda a, b: a + b)
    common = F.aggregate(F.zip_with("bitsu", "bitsv", lambda a, b: F.bit_count(a.bitwiseAND(b))), F.least("overu", "overv"), lambda a, b: a + b)
    return both.where((same >= matches) & ((100 + percent) * common >= percent * (F.col("nu") + F.col("nv")))).select(pairs.columns)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    both = (pairs.join(sets.select(F.col("doc_id").alias("u"), F.col("items").alias("a")), "u")
            .join(sets.select(F.col("doc_id").alias("v"), F.col("items").alias("b")), "v"))
    common = F.size(F.array_intersect("a", "b")).cast("long")  # named once: a filter computes it as often as it is named
    return both.where((100 + percent) * common >= percent * (F.size("a").cast("long") + F.size("b"))).select(pairs.columns)


def _relabelled(marked: DataFrame, found: DataFrame) -> DataFrame:
    """Replace the component ``c`` of posted rows by the component that new links give it."""
    return marked.join(found.withColumnRenamed("node", "c"), "c", "left").select(
        "token", "doc_id", F.coalesce("component", "c").alias("c"))


def _open_lists(marked: DataFrame) -> DataFrame:
    """Posted rows of the lists that still hold more than one component."""
    several = marked.groupBy("token").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("token")
    return marked.join(several, "token", "left_semi")


def _bounded(held: DataFrame) -> DataFrame:
    """``doc_id``, set size ``n``, number ``all`` of shingles ``x``, and their ``over`` and ``bits`` of :func:`_classes`."""
    def run(batches):
        for batch in batches:
            n = np.diff(batch.column(2).offsets.to_numpy()).astype(np.int64)
            flat = batch.column(2).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n), *_classes(flat, n)], ["doc_id", "n", "all", "over", "bits"])

    return held.select("doc_id", "n", "x").mapInArrow(run, "doc_id long, n long, all long, over long, bits array<long>")


def _able(marked: DataFrame, sets: DataFrame, percent: int, passes: int = 3) -> DataFrame:
    """Rows of open lists whose documents can still have a link, with the columns of :func:`_bounded` for shingles that occur elsewhere too.

    A link of two sets has at least percent / (100 + percent) of their sizes' sum in common, so each side needs
    that many shingles that occur elsewhere too: at least ``percent`` of its own. Documents below that leave,
    which makes further shingles unique; the bound holds after any number of passes, so passes end when one
    takes less than a third of the rows.
    """
    now, rows = marked, marked.count()
    for _ in range(passes):
        each = now.select("doc_id").distinct().join(sets, "doc_id").select("doc_id", "n", F.explode("items").alias("x"))
        often = each.groupBy("x").agg(F.count("*").alias("k")).where("k > 1").select("x")
        held = each.join(often, "x").groupBy("doc_id").agg(F.first("n").alias("n"), F.collect_list("x").alias("x")).where(100 * F.size("x").cast("long") >= percent * F.col("n"))
        with small_batches(sets.sparkSession):
            bounds = cut_lineage(_bounded(held), "bounds")
        now = cut_lineage(_open_lists(now.select("token", "doc_id", "c").join(bounds, "doc_id")), "able")
        before, rows = rows, now.count()
        if 3 * rows > 2 * before:
            break
    return now


def links(docs: DataFrame, sigs: DataFrame, width: int, percent: int = 80, matches: int | None = None,
          heads: int = HEADS, rounds: int = ROUNDS) -> DataFrame:
    """Confirmed links between components of sets that are enough to tell every component: ``u``, ``v``.

    ``sigs`` has one row per distinct set: its number ``doc_id``, ``sig``, and id and ``mark`` of a document that has it
    (``head``, ``mark``), whose text gives the whole set.

    In each round every set of an inverted list is held against a few heads of the list, which a hash
    that changes with the round picks, unless links already join the two. So a large group of copies closes
    with a number of tests in proportion to its size. What is left after the rounds are sets outside a
    list's main component: those that can still reach the similarity are tested pair by pair.
    """
    matches = matches_for(percent) if matches is None else matches
    post = cut_lineage(posted(sigs, matches), "posted")
    ids = checked(sigs.select("doc_id", "head", "mark").join(post.select("doc_id").distinct(), "doc_id", "left_semi"), "posted-ids")
    texts = docs.withColumnRenamed("doc_id", "head").join(ids, ["head", "mark"]).select("doc_id", "text").dropDuplicates(["doc_id"])
    with small_batches(docs.sparkSession):
        sets = cut_lineage(_whole_sets(texts, width), "sets")
    near = cut_lineage(sigs.select("doc_id", "sig").join(sets.select("doc_id", "n", "over", "bits"), "doc_id"), "near")

    def tested(pairs: DataFrame) -> DataFrame:
        ordered = pairs.where("u <> v").select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"), F.greatest("cu", "cv").alias("cu"), F.least("cu", "cv").alias("cv")).distinct()
        return cut_lineage(_confirmed(_agreeing(ordered, near, matches, percent), sets, percent).select(
            F.col("cu").alias("u"), F.col("cv").alias("v")).distinct(), "links")

    marked, found = post.select("token", "doc_id", F.col("doc_id").alias("c")), []
    for turn in range(rounds + 1):
        marked = cut_lineage(_open_lists(marked), "open")
        pairs_left = marked.groupBy("token", "c").agg(F.count("*").alias("n")).groupBy("token").agg(
            ((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2).alias("p"), F.sum("n").alias("n")).agg(
            F.coalesce(F.sum("p"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if turn == rounds or pairs_left[0] <= 2 * heads * pairs_left[1]:
            break
        best = [F.min(F.struct(F.xxhash64("doc_id", F.lit(turn * heads + k)), F.col("doc_id").alias("v"), F.col("c").alias("cv"))).alias(f"h{k}")
                for k in range(heads)]
        chosen = marked.groupBy("token").agg(*best).select("token", F.explode(F.array_distinct(F.array(
            *[F.struct(f"h{k}.v", f"h{k}.cv") for k in range(heads)]))).alias("h")).select("token", "h.v", "h.cv")
        new = tested(marked.join(chosen, "token").where("c <> cv").select(F.col("doc_id").alias("u"), "v", F.col("c").alias("cu"), "cv"))
        found.append(new)
        if new.count() * 100 < pairs_left[1]:
            break
        marked = _relabelled(marked, components(new))
    able = _able(marked, sets, percent)
    # Without NULLs, and with a column for every word, Java compiles the join's loop: it runs for every pair of every list.
    bits = [f"b{k}" for k in range(WORDS)]
    last = able.select("token", "doc_id", "c", *[F.coalesce(a, F.lit(0)).alias(a) for a in ("n", "all", "over")],
                       *[F.coalesce(F.get("bits", F.lit(k)), F.lit(0)).alias(b) for k, b in enumerate(bits)])
    main = last.groupBy("token", "c").agg(F.count("*").alias("k")).groupBy("token").agg(F.max(F.struct("k", "c"))["c"].alias("main"))
    small = last.join(main, "token").where("c <> main")
    other = last.select("token", F.col("doc_id").alias("v"), *[F.col(a).alias(f"{a}v") for a in ("c", "n", "all", "over", *bits)])
    common = sum((F.bit_count(F.col(b).bitwiseAND(F.col(f"{b}v"))) for b in bits), F.least("over", "overv"))
    need = percent * (F.col("n") + F.col("nv"))
    once = (F.col("cv") == F.col("main")) | (F.col("doc_id") > F.col("v"))
    found.append(tested(small.join(other, "token").where(
        (F.col("c") != F.col("cv")) & once & ((100 + percent) * F.least("all", "allv") >= need) & ((100 + percent) * common >= need)).select(
        F.col("doc_id").alias("u"), "v", F.col("c").alias("cu"), "cv")))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """Component of every document under links of Jaccard similarity ``percent`` or more on word shingles.

    Returns ``doc_id``, ``n_shingles``, ``component_id`` (smallest id that links reach, itself included),
    ``kept`` (it is that document). Words are split at ASCII white space, A-Z lower-cased; a text with fewer
    than ``width`` words has one shingle. NULL, empty and blank texts have no shingle, link with nothing and
    are kept. Equal sets are joined by their key, so copies never make pairs. Rows with the same id are one
    document; rows without an id link with nothing, have a NULL component and are kept. Other columns of
    the input are not read.

    Candidates come from signatures of 48 coordinates: as many must be equal as a pair at the similarity misses less than once in
    a million (24 at 80 per cent; 29 per cent and less are refused). Every candidate is confirmed on whole sets of
    64-bit shingle hashes. Each distinct set is compared under a number of its own, so an id on several rows
    brings the links of all its texts. Building the result runs jobs that write intermediates to the shared folder.
    """
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn("mark", F.xxhash64(F.coalesce("text", F.lit(""))))
    with small_batches(df.sparkSession):
        sigs = cut_lineage(signatures(docs, width), "signatures")
    some = sigs.where("n_shingles > 0 and doc_id is not null")
    keys = ["key_a", "key_b", "n_shingles"]
    heads = cut_lineage(some.groupBy(*keys).agg(F.min(F.struct("doc_id", "mark")).alias("one"), F.first("sig").alias("sig")).select(
        *keys, "one.doc_id", "one.mark", "sig", F.monotonically_increasing_id().alias("node")), "sets-heads")
    numbered = heads.select(F.col("node").alias("doc_id"), F.col("doc_id").alias("head"), "mark", "sig")
    found = cut_lineage(components(links(docs, numbered, width, percent).unionByName(_shared_ids(some, heads))), "found")
    least = found.join(heads.select("node", "doc_id"), "node").groupBy("component").agg(F.min("doc_id").alias("least"))
    groups = heads.join(found.join(least, "component").select("node", "least"), "node", "left").select(
        *keys, F.coalesce("least", "doc_id").alias("component"))
    return (sigs.join(groups, keys, "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNull(), None).otherwise(
                F.coalesce("component", "doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def _shared_ids(some: DataFrame, heads: DataFrame) -> DataFrame:
    """Links between the sets of one id (an id on several rows with different texts): ``u``, ``v``, each to the first of them."""
    keys = ["key_a", "key_b", "n_shingles"]
    twice = some.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    held = some.join(twice, "doc_id").join(heads.select(*keys, "node"), keys).select("doc_id", "node").distinct()
    first = held.groupBy("doc_id").agg(F.min("node").alias("v"))
    return held.join(first, "doc_id").where("node <> v").select(F.col("node").alias("u"), "v").distinct()
