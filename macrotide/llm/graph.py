"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macrotide.session import cut_lineage


def components(edges: DataFrame, left: str = "u", right: str = "v", rounds: int = 60) -> DataFrame:
    """Smallest node reachable from every node that has an edge: columns ``node``, ``component``.

    Alternates two steps until nothing changes: every node hands its larger neighbours to its smallest
    one, then its smaller neighbours. Both aggregate before the shuffle; each round's edges are written to
    the shared folder. Self-loops and NULL ends are ignored; no edges give no rows.
    """
    now = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u <> v").distinct()
    state = None
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        outward = (both.where("v > u").join(least, "u")
                   .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        inner = outward.groupBy("u").agg(F.min("v").alias("m"))
        inward = outward.join(inner, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = cut_lineage(inward.unionByName(inner.select("u", F.col("m").alias("v"))).distinct(), "components")
        was, state = state, now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v").cast("decimal(38,0)"))).first()
        if state == was:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
    raise RuntimeError(f"components did not settle in {rounds} rounds")
