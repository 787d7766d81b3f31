"""Running sums over groups of any size.

A plain window sorts a whole group in one task, so one hot key would stall the
job. Here rows are dealt by sampled ranges of (keys, order), whatever the size
of a key, and stored. A window runs inside one range; a key that goes on from
earlier ranges gets their sum as an offset. At most one key of a range does,
so there are no more offsets than ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.session import materialise


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column],
    value: Column,
    out: str,
) -> DataFrame:
    """Inclusive running sum of ``value`` per ``keys`` in the given order.

    NULL keys are a group, NULLs in the order sort where the order says, and
    the sum of whole or decimal numbers does not depend on the ranges.
    """
    keys = list(keys)
    dealt = df.withColumn("_v", value).repartitionByRange(*[F.col(k) for k in keys], *order_by)
    dealt = materialise(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
    totals = dealt.groupBy("_range", *keys).agg(F.sum("_v").alias("_s"))
    # one row per range and key; only a key that spans ranges has a sum before one
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("_offset", F.sum("_s").over(earlier)).where("_offset is not null")
    offsets = materialise(offsets.select(F.col("_range").alias("_at"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_offset"), "offsets")
    inside = Window.partitionBy("_range", *keys).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    run = dealt.withColumn("_run", F.sum("_v").over(inside))
    on = run["_range"] == offsets["_at"]
    for i, k in enumerate(keys):
        on = on & run[k].eqNullSafe(offsets[f"_k{i}"])
    total = F.col("_run") + F.coalesce("_offset", F.lit(0))
    return run.join(offsets, on, "left").withColumn(out, total).select(*df.columns, out)


def last_before(df: DataFrame, order_by: Sequence[Column], value: Column, out: str) -> DataFrame:
    """``out``: the last non-null ``value`` up to and with each row, in a total order of any length.

    Rows are dealt by sampled ranges and stored; a window carries the value inside a range, and one row
    per range carries it on to the next ones.
    """
    dealt = df.withColumn("_v", value).repartitionByRange(*order_by)
    dealt = materialise(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy("_range").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    run = dealt.withColumn("_run", F.last("_v", ignorenulls=True).over(inside))
    place = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order_by)])
    ends = dealt.groupBy("_range").agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), place)).alias("_end"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    before = materialise(ends.select(F.col("_range").alias("_at"), F.last("_end", ignorenulls=True).over(earlier).alias("_before")), "offsets")
    met = run.join(before, run["_range"] == before["_at"])
    return met.withColumn(out, F.coalesce("_run", "_before")).select(*df.columns, out)


def first_rows(df: DataFrame, n: Column, order_by: Sequence[Column], keys: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows of each key (of all rows without keys) in a total order."""
    numbered = running_sum(df, list(keys), order_by, F.lit(1).cast("bigint"), "_rn")
    return numbered.where(F.col("_rn") <= n).drop("_rn")
