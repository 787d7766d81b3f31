"""Sums over a total order, without a window over the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.session import materialise


def sums_before(rows: DataFrame, order: list[Column], value: str) -> DataFrame:
    """`rows` with `before`: the sum of `value` over all rows that come earlier in `order`.

    Rows are dealt by sampled ranges of the order and stored; the window runs within a range, and one
    row per range carries the ranges' own sums. The sums do not depend on where the ranges are cut.
    """
    dealt = materialise(rows.repartitionByRange(*order).withColumn("range_no", F.spark_partition_id()), "ranges")
    totals = dealt.groupBy("range_no").agg(F.sum(value).alias("own"))
    offsets = totals.select("range_no", (F.sum("own").over(Window.orderBy("range_no")) - F.col("own")).alias("offset"))
    inside = Window.partitionBy("range_no").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = dealt.withColumn("inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return summed.join(offsets, "range_no").withColumn("before", F.col("inside") + F.col("offset")).drop("inside", "offset", "range_no")
