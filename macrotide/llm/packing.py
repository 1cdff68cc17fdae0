"""Best-fit packing of documents into training sequences of several permitted lengths."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macrotide.llm.mixing import word_count

CAPACITIES = (512, 1024, 2048, 4096, 8192)
GROUP_ITEMS = 20_000


def sequence_cost(capacity: int) -> float:
    """Cost of one sequence: its length, a share that grows with the square of it, and a fixed part."""
    return capacity + capacity * capacity / 65_536 + 32


def best_fit(lengths: list[int], capacities=CAPACITIES, cost: Callable[[int], float] = sequence_cost) -> list[tuple[int, int, int]]:
    """Bin number, offset in the bin and final capacity for each length; lengths are at most the largest capacity.

    Longest first. A piece goes into the open bin that it fills best. If none has room, a bin opens at the
    size that costs least for each word it can come to hold, given the words still to place. In the end
    every bin shrinks to the smallest permitted size that holds its contents.
    """
    sizes = sorted(capacities)
    costs = [cost(c) for c in sizes]
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    left = sum(lengths)
    room: list[tuple[int, int]] = []  # (free words, bin), ascending
    used: list[int] = []
    place = [(0, 0)] * len(lengths)
    for i in order:
        n = lengths[i]
        at = bisect_left(room, (n, -1))
        if at < len(room):
            free, b = room.pop(at)
        else:
            fit = [k for k, c in enumerate(sizes) if c >= n]
            k = min(fit, key=lambda k: (costs[k] / min(sizes[k], left), -sizes[k]))
            free, b = sizes[k], len(used)
            used.append(0)
        place[i] = (b, used[b])
        used[b] += n
        left -= n
        if free > n:
            insort(room, (free - n, b))
    final = [next(c for c in sizes if c >= u) for u in used]
    return [(b, offset, final[b]) for b, offset in place]


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacities=CAPACITIES,
         cost: Callable[[int], float] = sequence_cost, length_col: str | None = None, group_items: int = GROUP_ITEMS) -> DataFrame:
    """Where every piece of every document goes: ``doc_id``, ``piece``, ``piece_start``, ``length``, ``bin_id``,
    ``bin_capacity``, ``bin_offset`` (all in words, or in the unit of ``length_col``).

    A document longer than the largest capacity is cut into pieces of that capacity and a rest, so every word is
    placed once. A document without words (NULL, empty, blank, or a NULL or negative length) has one row of length
    0 without a bin. Repeated rows and ids are packed each for itself; an empty input gives an empty result;
    other columns are not read.

    Pieces are dealt by hash into groups of about ``group_items``, each packed by one task over rows of three
    numbers; only the last few bins of a group can be less full than those of one global packing.
    """
    top = max(capacities)
    size = word_count(F.col(text_col)) if length_col is None else F.greatest(F.coalesce(F.col(length_col), F.lit(0)), F.lit(0)).cast("long")
    kind = df.schema[id_col].dataType.simpleString()
    items = df.select(F.col(id_col).alias("doc_id"), size.alias("_size"))
    pieces = items.select("doc_id", "_size", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0), F.floor((F.col("_size") - 1) / top)))).alias("piece"))
    pieces = pieces.select("doc_id", "piece", (F.col("piece") * top).alias("piece_start"),
                           F.least(F.lit(top).cast("long"), F.col("_size") - F.col("piece") * top).alias("length"))
    groups = max(1, -(-items.agg(F.coalesce(F.sum(F.floor(F.col("_size") / top) + 1), F.lit(0))).first()[0] // group_items))
    placed = pieces.where("length > 0").withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece", "length"), F.lit(groups)))
    schema = f"doc_id {kind}, piece long, piece_start long, length long, bin_id long, bin_capacity long, bin_offset long"

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        found = best_fit(rows["length"].tolist(), capacities, cost)
        first = int(rows["_group"].iloc[0]) << 32
        rows["bin_id"] = [first + b for b, _, _ in found]
        rows["bin_capacity"] = [c for _, _, c in found]
        rows["bin_offset"] = [o for _, o, _ in found]
        return rows.drop(columns="_group")

    packed = placed.groupBy("_group").applyInPandas(run, schema)
    none = F.lit(None).cast("long")
    return packed.unionByName(pieces.where("length <= 0").select(
        "doc_id", "piece", "piece_start", F.lit(0).cast("long").alias("length"), none.alias("bin_id"), none.alias("bin_capacity"), none.alias("bin_offset")))
