"""Exact quantiles with linear interpolation over columns of any size."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.session import materialise

STEPS = 64  # parts into which one pass cuts the bracket of every group


def quantile_of_counts(value: str, prob: float, count: str) -> Column:
    """Quantile of a (value, count) table whose domain is bounded, such as dates."""
    return F.expr(f"percentile({value}, {prob}D, {count})")


def exact_quantiles(
    df: DataFrame,
    wanted: dict[str, tuple[Column, float]],
    limit: int = 500_000,
    accuracy: int = 50_000,
) -> dict[str, float | None]:
    """``{name: (column, probability)}`` to ``{name: quantile}``.

    Only one-row results reach the driver. While more than ``limit`` rows could
    hold the wanted rank, a sketch proposes a bracket, one pass counts the rows
    below and inside it, and the bracket is taken only if the rank is proven to
    lie inside (else it is tried wider). What is left is ranked exactly by its
    distinct values, so a value shared by a third of the rows costs one entry.
    The two values around the rank are the same with and without a bracket.
    """
    counts = df.agg(*[F.count(c).alias(n) for n, (c, _) in wanted.items()]).first()
    total = {n: counts[n] for n in wanted}
    rank = {n: wanted[n][1] * (total[n] - 1) for n in wanted}
    bounds: dict[str, tuple[float, float] | None] = dict.fromkeys(wanted)
    below, inside, width = dict.fromkeys(wanted, 0), dict(total), dict.fromkeys(wanted, 2.0)

    pending = [n for n in wanted if inside[n] > limit]
    while pending:
        sketches, values = [], {}
        for n in pending:
            c = wanted[n][0].cast("double")
            values[n] = c if bounds[n] is None else F.when(c.between(*bounds[n]), c)
            centre = (rank[n] - below[n]) / inside[n]
            margin = width[n] / accuracy + 2.0 / inside[n]
            probs = [max(0.0, centre - margin), min(1.0, centre + margin)]
            sketches.append(F.percentile_approx(values[n], probs, accuracy).alias(n))
        proposed = df.agg(*sketches).first()
        checks = []
        for n in pending:
            c = wanted[n][0].cast("double")
            checks.append(F.count(F.when(c < proposed[n][0], 1)).alias(f"below_{n}"))
            checks.append(F.count(F.when(c.between(*proposed[n]), 1)).alias(f"inside_{n}"))
        seen = df.agg(*checks).first()
        again = []
        for n in pending:
            b, i = seen[f"below_{n}"], seen[f"inside_{n}"]
            if b <= math.floor(rank[n]) and math.ceil(rank[n]) < b + i:
                smaller = i < inside[n]
                bounds[n], below[n], inside[n], width[n] = tuple(proposed[n]), b, i, 2.0
                if smaller and i > limit and bounds[n][0] < bounds[n][1]:
                    again.append(n)
            else:
                width[n] *= 4
                again.append(n)
        pending = again

    pairs, keep = [], F.lit(False)
    for n, (c, _) in wanted.items():
        c = c.cast("double")
        inside_c = c if bounds[n] is None else F.when(c.between(*bounds[n]), c)
        pairs.append(F.struct(F.lit(n).alias("name"), inside_c.alias("v")))
    distinct = (
        df.select(F.inline(F.array(*pairs))).where(F.col("v").isNotNull()).groupBy("name", "v").count()
    )
    spread = distinct.withColumn("upto", F.sum("count").over(Window.partitionBy("name").orderBy("v")))
    picks = []
    for n in wanted:
        for side, at in (("lo", math.floor(rank[n])), ("hi", math.ceil(rank[n]))):
            here = (F.col("name") == n) & (F.col("upto") > at - below[n])
            picks.append(F.min(F.when(here, F.col("v"))).alias(f"{side}_{n}"))
    found = spread.agg(*picks).first()
    return {n: _between(found[f"lo_{n}"], found[f"hi_{n}"], rank[n]) for n in wanted}


def _between(low: float | None, high: float | None, rank: float) -> float | None:
    """Linear between the two values around a rank, the same at every size."""
    if low is None or low == high:
        return low
    return (math.ceil(rank) - rank) * low + (rank - math.floor(rank)) * high


def grouped_quantiles(
    df: DataFrame, by: list[str], value: Column, prob: float, limit: int = 500_000, accuracy: int = 10_000
) -> DataFrame:
    """Exact quantile of every group at once: the columns ``by``, ``n`` (values), ``q``.

    As many jobs for any number of groups. While some group has more than ``limit`` rows that could hold the
    wanted rank, one pass proposes cuts between which each such group's rank should lie, and a second counts
    the rows below and inside; a bracket is taken only if the rank is proven to lie inside (else it is
    tried wider). What is left of a group, at most ``limit`` rows or a value they share, is ranked
    by its distinct values. Group states are stored, so Spark knows their size before it joins them.
    A null in ``by`` is a value like others; a group whose values are all null has n = 0 and a null q.
    """
    names = [f"_g{i}" for i in range(len(by))]
    rows = df.select(*[F.col(c).alias(g) for c, g in zip(by, names)], value.cast("double").alias("_v"))
    null = F.lit(None).cast("double")
    state = rows.groupBy(*names).agg(F.count("_v").alias("n"))
    state = state.select(*names, "n", null.alias("lo"), null.alias("hi"), F.lit(0).cast("long").alias("below"), F.col("n").alias("inside"), F.lit(1).alias("width"), F.lit(True).alias("open"))
    state = materialise(state, "groups")
    rank = F.lit(prob) * (F.col("n") - 1)
    todo = F.col("open") & (F.col("inside") > limit) & (F.col("lo").isNull() | (F.col("lo") < F.col("hi")))

    def met(states: DataFrame) -> DataFrame:
        other = states.select(*[F.col(g).alias(f"{g}_s") for g in names], *[c for c in states.columns if c not in names])
        same = reduce(Column.__and__, [F.col(g).eqNullSafe(F.col(f"{g}_s")) for g in names])
        inside = (F.col("lo").isNull() | (F.col("_v") >= F.col("lo"))) & (F.col("hi").isNull() | (F.col("_v") <= F.col("hi")))
        return rows.where(F.col("_v").isNotNull()).join(other, same).where(inside)

    while state.where(todo).limit(1).count():
        probs = F.array(*[F.lit(i / STEPS) for i in range(STEPS + 1)])
        cuts = met(state.where(todo)).groupBy(*names).agg(F.percentile_approx("_v", probs, accuracy).alias("cuts"))
        at = F.floor((rank - F.col("below")) / F.col("inside") * STEPS).cast("int")
        low, high = F.get("cuts", F.greatest(at - F.col("width"), F.lit(0))), F.get("cuts", F.least(at + 1 + F.col("width"), F.lit(STEPS)))
        same = reduce(Column.__and__, [state[g].eqNullSafe(cuts[g]) for g in names])
        proposed = materialise(state.where(todo).join(cuts, same).select(*[state[g] for g in names], "lo", "hi", low.alias("new_lo"), high.alias("new_hi")), "cuts")
        seen = met(proposed).groupBy(*names).agg(
            F.first("new_lo").alias("new_lo"),
            F.first("new_hi").alias("new_hi"),
            F.count_if(F.col("_v") < F.col("new_lo")).alias("less"),
            F.count_if(F.col("_v").between(F.col("new_lo"), F.col("new_hi"))).alias("held"),
        )
        same = reduce(Column.__and__, [state[g].eqNullSafe(seen[g]) for g in names])
        joined = state.join(seen, same, "left")
        less = F.col("below") + F.col("less")
        proven = (less <= F.floor(rank)) & (F.ceil(rank) < less + F.col("held"))
        whole = F.col("width") >= STEPS
        pick = lambda new, old: F.when(proven, new).otherwise(F.col(old)).alias(old)
        state = joined.select(
            *[state[g] for g in names],
            "n",
            pick(F.col("new_lo"), "lo"),
            pick(F.col("new_hi"), "hi"),
            pick(less, "below"),
            F.when(proven, 1).when(proven.isNull(), F.col("width")).otherwise(F.least(F.col("width") * 4, F.lit(STEPS))).alias("width"),
            F.when(proven, F.col("held") < F.col("inside")).when(proven.isNull(), F.col("open")).otherwise(~whole).alias("open"),
            pick(F.col("held"), "inside"),
        )
        state = materialise(state, "groups")

    distinct = met(state.select(*names, "n", "lo", "hi", "below")).groupBy(*names, "n", "below", "_v").agg(F.count(F.lit(1)).alias("c"))
    spread = distinct.withColumn("upto", F.col("below") + F.sum("c").over(Window.partitionBy(*names).orderBy("_v")))
    found = spread.groupBy(*names, "n").agg(
        F.min(F.when(F.col("upto") > F.floor(rank), F.col("_v"))).alias("low"),
        F.min(F.when(F.col("upto") > F.ceil(rank), F.col("_v"))).alias("high"),
    )
    between = (F.ceil(rank) - rank) * F.col("low") + (rank - F.floor(rank)) * F.col("high")
    q = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(between)
    found = found.select(*[F.col(g).alias(c) for c, g in zip(by, names)], "n", q.alias("q"))
    empty = state.where("n = 0").select(*[F.col(g).alias(c) for c, g in zip(by, names)], "n", null.alias("q"))
    return found.unionByName(empty)
