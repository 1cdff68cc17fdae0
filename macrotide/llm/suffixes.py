"""Repeated byte strings by suffix arrays over content-keyed shards, and their removal from texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macrotide.llm.anchors import anchors
from macrotide.llm.text import Rolling, mix, slices
from macrotide.session import cut_lineage

LENGTH, GRAM = 200, 24
SHARD_BYTES, HOT_CONTEXTS = 2 << 20, 16_000
LONGEST = 1 << 16  # two distances below it are packed beside a place
SCAN_BYTES = 1 << 20  # texts hashed at a time: a worker holds some hundred bytes per byte of it


# ---- one shard -------------------------------------------------------------------------------------------------------


def _sorted_directly(words: list[np.ndarray], places: np.ndarray) -> np.ndarray:
    """Order of suffixes by keys of 8 bytes each, key after key; only tied runs that differ in a key are sorted by it."""
    key = words[0][places].astype(np.uint64)
    order = places[np.argsort(key, kind="stable")]
    key = words[0][order].astype(np.uint64)
    same = key[1:] == key[:-1]
    tied = np.flatnonzero(_in_run(same)) if len(order) else np.zeros(0, np.int64)
    run = np.cumsum(np.append(True, ~same))[tied] if len(order) else tied
    for w in words[1:]:
        if not len(tied):
            break
        key = w[order[tied]].astype(np.uint64)
        near = run[1:] == run[:-1]
        differs = np.append(False, near & (key[1:] != key[:-1]))
        if differs.any():
            mixed = np.isin(run, run[differs])
            part = np.flatnonzero(mixed)
            by = np.lexsort((key[part], run[part]))
            at = order[tied[part]][by]
            order[tied[part]] = at
            key[part] = key[part][by]
        same = near & (key[1:] == key[:-1])
        keep = _in_run(same)
        run = np.cumsum(np.append(True, ~same))[keep]
        tied = tied[keep]
    return order


def _in_run(same: np.ndarray) -> np.ndarray:
    """Rows that equal a neighbour, from the flags of equal adjacent rows."""
    out = np.zeros(len(same) + 1, bool)
    out[:-1] |= same
    out[1:] |= same
    return out


def _covered(n: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, first, 1)
    np.add.at(change, last + 1, -1)
    return np.cumsum(change[:-1]) > 0


def _next_true(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The first flagged place from each given one on; the last place of all if there is none."""
    places = np.append(np.flatnonzero(flags), len(flags) - 1)
    return places[np.minimum(np.searchsorted(places[:-1], at), len(places) - 1)]


def suffix_array(data: np.ndarray, depth: int, first: np.ndarray | None = None, last: np.ndarray | None = None) -> np.ndarray:
    """Suffixes in order of their first ``depth`` bytes at least, by sorting in two stages.

    Suffixes that are smaller than their successor are sorted directly. Each of the others follows its first
    byte by a smaller suffix, so a scan over the buckets of first bytes, in order, puts them in place: the
    predecessors of a finished bucket, in its order, are the next ones of the buckets of their own bytes.

    With ranges of places, only their suffixes are ordered, and those after a range up to one that is sorted directly.
    """
    n = len(data)
    if n < 2:
        return np.arange(n)
    change = np.append(np.flatnonzero(data[1:] != data[:-1]), n - 1)
    nxt = change[np.searchsorted(change, np.arange(n))]  # last place of the run of equal bytes
    smaller = np.zeros(n, bool)
    inner = nxt < n - 1
    smaller[inner] = data[nxt[inner]] < data[nxt[inner] + 1]
    chosen = np.ones(n, bool) if first is None else _covered(n, first, _next_true(smaller, last + 1))
    direct = _sorted_directly(_keys(data, depth), np.flatnonzero(smaller & chosen))
    induced = chosen & ~smaller
    direct_byte = data[direct]
    border = np.searchsorted(direct_byte, np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    if induced[n - 1]:
        waiting[data[n - 1]].append(np.array([n - 1]))  # the last suffix is larger than the empty one
    out = []

    def hand_on(done: np.ndarray, byte: int) -> np.ndarray:
        """Deal the larger predecessors of finished suffixes to their buckets; return those of the same bucket."""
        before = done[done > 0] - 1
        before = before[induced[before]]
        key = data[before]
        rest = before[key != byte]
        if len(rest):
            rest = rest[np.argsort(data[rest], kind="stable")]
            cuts = np.flatnonzero(np.diff(data[rest])) + 1
            for part in np.split(rest, cuts):
                waiting[data[part[0]]].append(part)
        return before[key == byte]

    for byte in range(256):
        wave = np.concatenate(waiting[byte]) if waiting[byte] else np.zeros(0, np.int64)
        while len(wave):
            out.append(wave)
            wave = hand_on(wave, byte)
        own = direct[border[byte]:border[byte + 1]]
        if len(own):
            out.append(own)
            hand_on(own, byte)
    return np.concatenate(out)


def _keys(data: np.ndarray, depth: int) -> list[np.ndarray]:
    """Big-endian 8-byte words at every place, for each 8 bytes of depth: overlapping views of one padded copy."""
    count = -(-depth // 8)
    padded = np.concatenate([data, np.zeros(8 * count + 8, np.uint8)])
    return [np.ndarray((len(data),), ">u8", padded, 8 * k, (1,)) for k in range(count)]


def repeated(data: np.ndarray, first: np.ndarray, last: np.ndarray, length: int) -> np.ndarray:
    """Flags of all places: a string of ``length`` bytes starts here, within a range, and at another such place.

    ``first`` and ``last`` are the ranges of starts.
    """
    valid = _covered(len(data), first, last)
    order = suffix_array(data, length, first, last)
    order = order[valid[order]]
    out = np.zeros(len(data), bool)
    if len(order) < 2:
        return out
    words, tail = _keys(data, length), length % 8
    alive = np.arange(len(order) - 1)
    for k, w in enumerate(words):
        a, b = w[order[alive]].astype(np.uint64), w[order[alive + 1]].astype(np.uint64)
        if tail and k == len(words) - 1:
            a, b = (x >> np.uint64(64 - 8 * tail) for x in (a, b))
        alive = alive[a == b]
    out[order[alive]] = out[order[alive + 1]] = True
    return out


# ---- all texts -------------------------------------------------------------------------------------------------------


def _repeated_anchors(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """Anchors that more than one place has: ``anchor``; counted by slice and by task before the shuffle."""
    def run(batches):
        for _, part in slices(batches, limit=SCAN_BYTES):
            found, n = np.unique(anchors(part, length, gram)[2], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int32))], ["anchor", "n"])

    return texts.select("text").mapInArrow(run, "anchor long, n int").groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor")


def _places(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """Anchors of every text: ``anchor``, ``context`` (hash of all bytes of its strings), ``key`` of the text, ``place``.

    ``place`` packs the first start the anchor stands for, how many follow, and where the anchor lies.
    """
    def run(batches):
        for batch, part in slices(batches, limit=SCAN_BYTES):
            owner, at, h, first, last = anchors(part, length, gram)
            key = batch.column(batch.schema.get_field_index("key")).to_numpy()[owner]
            context = Rolling(part.data).between(first, last + length) ^ mix((at - first).astype(np.uint64))
            place = ((first - part.start[owner]) << 32) | ((last - first) << 16) | (at - first)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(context.view(np.int64)), pa.array(key), pa.array(place)], ["anchor", "context", "key", "place"])

    return texts.mapInArrow(run, "anchor long, context long, key long, place long")


def _contexts(texts: DataFrame, length: int) -> DataFrame:
    """Bytes of the listed contexts of each text: ``anchor``, ``context``, ``lone``, ``key``, ``first``, ``starts``, ``bytes``."""
    def run(batches):
        for batch, part in slices(batches):
            listed = batch.column(batch.schema.get_field_index("listed"))
            border = listed.offsets.to_numpy()
            inner = listed.flatten()
            anchor, context, place, lone = (inner.field(n).to_numpy(zero_copy_only=False) for n in ("anchor", "context", "place", "lone"))
            owner = np.repeat(np.arange(len(part.start)), np.diff(border))
            first, starts = place >> 32, ((place >> 16) & 0xFFFF) + 1
            begin = part.start[owner] + first
            data = part.data
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor), pa.array(context), pa.array(lone), pa.array(batch.column(batch.schema.get_field_index("key")).to_numpy()[owner]),
                 pa.array(first), pa.array(starts), pa.array([data[b:b + n + length - 1].tobytes() for b, n in zip(begin, starts)], pa.binary())],
                ["anchor", "context", "lone", "key", "first", "starts", "bytes"])

    return texts.mapInArrow(run, "anchor long, context long, lone boolean, key long, first long, starts long, bytes binary")


def _found(table: pa.Table, length: int) -> pa.RecordBatch:
    """Repeated starts of one shard's lone contexts, as ranges: ``key``, ``first``, ``last``."""
    table = table.combine_chunks()
    ids = np.stack([table["anchor"].to_numpy(), table["context"].to_numpy()])
    pick = np.sort(np.unique(ids, axis=1, return_index=True)[1])  # a context once, should its text have come twice
    table = table.take(pa.array(pick)).combine_chunks()
    column = table["bytes"].combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    begin, starts = offsets[:-1] - offsets[0], table["starts"].to_numpy()
    flag = repeated(data, begin, begin + starts - 1, length)
    lone = np.flatnonzero(table["lone"].to_numpy(zero_copy_only=False))
    owner = np.repeat(lone, starts[lone])
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(starts[lone]) - starts[lone], starts[lone])
    hit = flag[begin[owner] + nth]
    owner, nth = owner[hit], nth[hit]
    new = np.append(True, (owner[1:] != owner[:-1]) | (nth[1:] != nth[:-1] + 1)) if len(owner) else np.zeros(0, bool)
    a = np.flatnonzero(new)
    b = np.append(a[1:], len(owner)) - 1 if len(a) else a
    base = table["first"].to_numpy()[owner[a]]
    return pa.RecordBatch.from_arrays(
        [pa.array(table["key"].to_numpy()[owner[a]]), pa.array(base + nth[a]), pa.array(base + nth[b])], ["key", "first", "last"])


def _shards(contexts: DataFrame, length: int) -> DataFrame:
    """Suffix arrays over shards: whole anchor groups of at least SHARD_BYTES together, partition by partition."""
    def run(batches):
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if size > SHARD_BYTES and batch.num_rows:
                # Rows are in order of their anchor: cut where the anchor changes.
                tail = held[-1]["anchor"][-1].as_py()
                names = batch["anchor"].to_numpy()
                until = int(np.argmax(names != tail)) if (names != tail).any() else len(names)
                if until < len(names):
                    yield _found(pa.Table.from_batches([*held, batch.slice(0, until)]), length)
                    held, size, batch = [], 0, batch.slice(until)
            if batch.num_rows:
                held.append(batch)
                size += batch.nbytes
        if held:
            yield _found(pa.Table.from_batches(held), length)

    return contexts.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, "key long, first long, last long")


def _by_hash(contexts: DataFrame, length: int) -> DataFrame:
    """The same for anchors too frequent for one shard: their strings are counted by two 64-bit hashes, combined before the shuffle."""
    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                column = part.column(part.schema.get_field_index("bytes")).cast(pa.large_binary())
                offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
                data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
                starts = part["starts"].to_numpy()
                owner = np.repeat(np.arange(len(starts)), starts)
                nth = np.arange(len(owner)) - np.repeat(np.cumsum(starts) - starts, starts)
                at = offsets[owner] - offsets[0] + nth
                rolling = Rolling(data)
                one, two = rolling.between(at, at + length), rolling.between(at, at + length // 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(part["key"].to_numpy()[owner]),
                     pa.array(part["first"].to_numpy()[owner] + nth), pa.array(part["lone"].to_numpy(zero_copy_only=False)[owner])],
                    ["one", "two", "key", "first", "lone"])

    strings = cut_lineage(contexts.dropDuplicates(["anchor", "context"]).mapInArrow(run, "one long, two long, key long, first long, lone boolean"), "hot-strings")
    often = strings.groupBy("one", "two").agg(F.count("*").alias("n")).where("n > 1").select("one", "two")
    return strings.where("lone").join(often, ["one", "two"], "left_semi").select("key", "first", F.col("first").alias("last"))


def repeats(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT_CONTEXTS) -> DataFrame:
    """Ranges of starts of strings that also start elsewhere, per distinct text: ``key``, ``ranges`` (array of first, last).

    ``texts`` has ``doc_id``, ``text``, ``key`` (hash of the text). Every string of ``length`` bytes belongs to an anchor,
    and equal strings to equal anchors at the same distance, so anchor groups can be told apart without any text. A
    context, all bytes of an anchor's strings, that occurs twice is settled. Contexts that occur once meet those of
    the same anchor in a shard, whose suffix array has equal strings side by side. Anchors of one place only are
    left out before anything is stored: texts are scanned twice instead. All sides grow with the input, so joins are
    shuffles at every size.
    """
    if not gram < length < LONGEST:
        raise ValueError(f"length {length} must lie between gram ({gram}) and {LONGEST}")
    often = _repeated_anchors(texts, length, gram)
    places = cut_lineage(_places(texts.select("key", "text"), length, gram).join(often.hint("merge"), "anchor", "left_semi"), "places")
    contexts = cut_lineage(places.groupBy("anchor", "context").agg(F.count("*").alias("n"), F.min(F.struct("key", "place")).alias("one")), "contexts")
    groups = contexts.groupBy("anchor").agg(F.count("*").alias("m")).where("m > 1")
    needed = cut_lineage(contexts.join(groups.hint("merge"), "anchor").select("anchor", "context", (F.col("n") == 1).alias("lone"), "m", "one.key", "one.place"), "needed")
    ranges = places.join(contexts.where("n > 1").select("anchor", "context").hint("merge"), ["anchor", "context"], "left_semi").select(
        "key", F.shiftright("place", 32).alias("first"), F.shiftright("place", 16).bitwiseAND(0xFFFF).alias("more")).select(
        "key", "first", (F.col("first") + F.col("more")).alias("last")).distinct()

    for part, find in ((needed.where(F.col("m") <= hot), _shards), (needed.where(F.col("m") > hot), _by_hash)):
        if find is _by_hash and part.isEmpty():
            continue
        lists = part.groupBy("key").agg(F.collect_list(F.struct("anchor", "context", "place", "lone")).alias("listed"))
        one = texts.groupBy("key").agg(F.min("doc_id").alias("_one"))
        lists = lists.join(one.hint("merge"), "key").select(F.col("key").alias("_key"), "_one", "listed").hint("merge")
        cut = texts.join(lists, (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_one"))).select("key", "text", "listed")
        ranges = ranges.unionByName(cut_lineage(find(_contexts(cut, length), length), "repeats"))
    return ranges.groupBy("key").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Texts without the bytes that a repeated string of ``length`` bytes covers: ``doc_id``, ``n_bytes``, ``spans``, ``kept``.

    Texts are UTF-8 bytes (NULL: none); ``spans`` are the maximal removed runs (begin, end), ``kept`` the remaining
    bytes. Strings never cross texts and are judged on the input: the first occurrence goes too. Texts shorter
    than ``length`` keep all. Repeated rows count as copies, whatever their id; an empty input gives an empty
    result; other columns are not read. Texts are told apart by a 64-bit hash where their places are listed.
    Building the result runs jobs that keep intermediates in the shared folder.
    """
    docs = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("key", F.xxhash64("text"))
    found = repeats(docs, length, gram)

    def run(batches):
        for batch, part in slices(batches):
            listed = batch.column(batch.schema.get_field_index("ranges"))
            spans, kept = [], []
            for i, ranges in enumerate(listed):
                text = part.data[part.start[i]:part.end[i]]
                if not ranges.is_valid or not len(ranges):
                    spans.append([])
                    kept.append(text.tobytes())
                    continue
                inner = ranges.values
                change = np.zeros(len(text) + 1, np.int64)
                np.add.at(change, inner.field("first").to_numpy(), 1)
                np.add.at(change, inner.field("last").to_numpy() + length, -1)
                gone = np.cumsum(change[:-1]) > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                spans.append([{"begin": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2])])
                kept.append(text[~gone].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(part.end - part.start), pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
                 pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.join(found.hint("merge"), "key", "left").select("doc_id", "text", "ranges").mapInArrow(
        run, f"doc_id {kind}, n_bytes long, spans array<struct<begin:long,end:long>>, kept binary")
