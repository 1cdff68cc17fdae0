"""Exact order statistics of groups of any size, by repeated narrowing.

A window or ``percentile`` would bring a whole group into one task. Here every wanted rank has an open interval that
holds it, at first the whole line. A mergeable quantile sketch of the values inside proposes two bounds around the rank; exact
counts, combined before the shuffle, tell which of the five places (below, at the first bound, between, at the second,
above) has it. A round narrows an interval about 300 times. Once an interval has a bounded number of values, they are
gathered beside the counts and the rank is read off. Frequent values become bounds, so ties cannot hold a round up.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macrotide.operators.joins import join_null_safe
from macrotide.operators.windows import clip
from macrotide.session import cut_lineage

# The sketch's rank error is at most n / _ACCURACY; its levels are _LEVELS steps apart, and bounds lie one step outside a rank's own.
_ACCURACY = 10_000
_LEVELS = 1_000
# Values of one interval that are gathered in one buffer.
GATHERED = 10_000


def _sketch(value: Column) -> Column:
    return F.percentile_approx(value, [i / _LEVELS for i in range(_LEVELS + 1)], _ACCURACY)


def order_statistics(df: DataFrame, keys: list[str], value: str,
                     ranks: dict[str, tuple[float, Column]], gathered: int = GATHERED) -> DataFrame:
    """Values at given ranks, one row per key: ``keys..., n, <name>...``.

    ``ranks`` maps a name to ``(p, rank)``: ``rank`` is a 0-based position as an expression of ``n``, the number of present
    values; ``p`` tells about where it lies and is not used. Keys without a present value give no row; NULL keys are a group.
    Two passes over the rows serve groups of up to some three million values, two more each 300 times larger.
    Runs its jobs when it is called.
    """
    names = list(ranks)
    each = range(len(names))
    v = F.col("_v")
    present = df.select(*keys, F.col(value).cast("double").alias("_v")).filter(v.isNotNull() & ~F.isnan("_v"))
    nothing = F.lit(None).cast("double")
    share = 3 / _LEVELS + 2 / _ACCURACY  # of an interval's values that can lie between the two bounds
    sized = present.groupBy(*keys).agg(F.count("*").alias("n"), _sketch(v).alias("_q"))
    # Written once per round: sketches are not recomputed, and joins are planned by the real size. Few keys are
    # broadcast and the rows are not shuffled; many keys are shuffled with the rows, where AQE splits a hot key because
    # the other side has a single row for it.
    state = cut_lineage(sized.select(*keys, "n", *[c for i, (_, rank) in enumerate(ranks.values()) for c in (
        rank.cast("long").alias(f"_p{i}"), nothing.alias(f"_lo{i}"), nothing.alias(f"_hi{i}"), F.col("n").alias(f"_m{i}"), F.col("_q").alias(f"_q{i}"),
        nothing.alias(f"_v{i}"))]), "intervals")

    def inside(i: int) -> Column:
        return (F.col(f"_lo{i}").isNull() | (v > F.col(f"_lo{i}"))) & (F.col(f"_hi{i}").isNull() | (v < F.col(f"_hi{i}")))

    while True:
        # Bounds a, b: sketch levels one step outside the rank's own; a small interval is taken whole.
        small = [F.col(f"_m{i}") <= gathered for i in each]
        step = [F.floor(F.col(f"_p{i}") / F.col(f"_m{i}") * _LEVELS).cast("int") for i in each]
        bounded = state.select(
            *state.columns,
            *[F.when(~small[i], F.get(f"_q{i}", F.greatest(step[i] - 1, F.lit(0)))).alias(f"_a{i}") for i in each],
            *[F.when(~small[i], F.get(f"_q{i}", F.least(step[i] + 2, F.lit(_LEVELS)))).alias(f"_b{i}") for i in each]
        ).drop(*[f"_q{i}" for i in each])
        limits = bounded.select(*keys, *[f"_{x}{i}" for i in each for x in ("lo", "hi", "a", "b", "m", "v")]).where(
            reduce(Column.__or__, [F.col(f"_v{i}").isNull() for i in each]))
        # Rows collapse to one count per place, and per value where values are gathered, before the shuffle.
        places, gathers = [], []
        for i in each:
            a, b = F.col(f"_a{i}"), F.col(f"_b{i}")
            place = F.when(v < a, 0).when(v == a, 1).when(b.isNull() | (v < b), 2).when(v == b, 3).otherwise(4)
            places.append(F.when(F.col(f"_v{i}").isNull() & inside(i), place).alias(f"_at{i}"))
            gathers.append((F.col(f"_m{i}") * share <= gathered) | (F.col(f"_m{i}") <= gathered))
        placed = join_null_safe(present, limits, keys).select(*keys, "_v", *places, *[g.alias(f"_g{i}") for i, g in enumerate(gathers)])
        wanted = reduce(Column.__or__, [F.coalesce(F.col(f"_g{i}") & (F.col(f"_at{i}") == 2), F.lit(False)) for i in each])
        collapsed = placed.groupBy(*keys, *[f"_at{i}" for i in each], *[f"_g{i}" for i in each], F.when(wanted, v).alias("_v")).agg(F.count("*").alias("_c"))
        counts = []
        for i in each:
            at, c = F.col(f"_at{i}"), F.col("_c")
            upto = lambda place, at=at, c=c: F.sum(F.when(at <= place, c).otherwise(0))
            counts += [*[upto(k).alias(f"_{name}{i}") for k, name in enumerate(("lt_a", "le_a", "lt_b", "le_b"))],
                       F.flatten(F.collect_list(F.when((at == 2) & F.col(f"_g{i}"), F.array_repeat(v, c.cast("int"))))).alias(f"_all{i}")]
        counted = join_null_safe(bounded, collapsed.groupBy(*keys).agg(*counts), keys, "left")
        out = []
        for i in each:
            p, m, a, b = (F.col(f"_{x}{i}") for x in "pmab")
            lt_a, le_a, lt_b, le_b = (F.col(f"_{x}{i}") for x in ("lt_a", "le_a", "lt_b", "le_b"))
            done = F.col(f"_v{i}").isNotNull()
            below, first, between, second = p < lt_a, p < le_a, p < lt_b, p < le_b  # in this order
            picked = F.get(F.sort_array(f"_all{i}"), (p - le_a).cast("int"))
            got = F.when(F.size(f"_all{i}") == lt_b - le_a, picked)
            out += [
                F.when(done, F.col(f"_v{i}")).when(below, nothing).when(first, a).when(between, got).when(second, b).alias(f"_v{i}"),
                F.when(below, p).when(between, p - le_a).when(second, p).otherwise(p - le_b).alias(f"_p{i}"),
                F.when(below, F.col(f"_lo{i}")).when(between, F.coalesce(a, F.col(f"_lo{i}"))).otherwise(b).alias(f"_lo{i}"),
                F.when(below, a).when(between, F.coalesce(b, F.col(f"_hi{i}"))).otherwise(F.col(f"_hi{i}")).alias(f"_hi{i}"),
                F.when(below, lt_a).when(between, lt_b - le_a).otherwise(m - le_b).alias(f"_m{i}")]
        state = cut_lineage(counted.select(*keys, "n", *out), "intervals")
        open_ = reduce(Column.__or__, [F.col(f"_v{i}").isNull() for i in each])
        if state.where(open_).isEmpty():
            return state.select(*keys, "n", *[F.col(f"_v{i}").alias(name) for i, name in enumerate(names)])
        again = join_null_safe(present, state.where(open_), keys).groupBy(*keys).agg(
            *[_sketch(F.when(F.col(f"_v{i}").isNull() & inside(i) & (F.col(f"_m{i}") > gathered), v)).alias(f"_q{i}") for i in each])
        state = cut_lineage(join_null_safe(state, again, keys, "left"), "intervals")


def winsorize_large(df: DataFrame, column: str, keys: list[str], lower: float = 0.05,
                    upper: float = 0.05) -> DataFrame:
    """Winsorize groups of any size with exact bounds (see ``windows.winsorize`` for the rule)."""
    n = F.col("n")
    bounds = cut_lineage(order_statistics(df, keys, column, {
        "_lo": (lower, F.floor(n * lower)),
        "_hi": (1.0 - upper, n - F.floor(n * upper) - 1),
    }).select(*keys, "_lo", "_hi"), "bounds")
    return join_null_safe(df, bounds, keys, "left").select([
        clip(F.col(c), F.col("_lo"), F.col("_hi")).alias(c) if c == column else F.col(c) for c in df.columns
    ])


def quantiles(df: DataFrame, keys: list[str], value: str, probabilities: dict[str, float]) -> DataFrame:
    """Linearly interpolated quantiles, one row per key."""
    n = F.col("n")
    ranks: dict[str, tuple[float, Column]] = {}
    for name, p in probabilities.items():
        ranks[f"_{name}_a"] = (p, F.floor((n - 1) * p))
        ranks[f"_{name}_b"] = (p, F.ceil((n - 1) * p))
    found = order_statistics(df, keys, value, ranks)
    out = []
    for name, p in probabilities.items():
        a, b = F.col(f"_{name}_a"), F.col(f"_{name}_b")
        weight = (n - 1) * F.lit(p) - F.floor((n - 1) * p)
        out.append((a + (b - a) * weight).alias(name))
    return found.select(*keys, *out)
