"""Field-level comparison of two keyed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_ITEMS = 20


def field_diffs(
    expected: DataFrame, actual: DataFrame, key: Sequence[str], fields: Sequence[str]
) -> DataFrame:
    """One row per key and differing field; a missing row or value equals NULL."""
    key = list(key)
    e = expected.select(*key, F.struct(*fields).alias("_e"))
    a = actual.select(*key, F.struct(*fields).alias("_a"))
    pairs = [
        F.struct(
            F.lit(f).alias("campo"),
            F.col("_e").getField(f).cast("string").alias("esperado"),
            F.col("_a").getField(f).cast("string").alias("obtido"),
        )
        for f in fields
    ]
    long = e.join(a, key, "full_outer").select(*key, F.inline(F.array(*pairs)))
    return long.where(~F.col("esperado").eqNullSafe(F.col("obtido")))


def diff_text() -> Column:
    def shown(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit("None"))

    return F.concat(F.col("campo"), F.lit(": expected="), shown("esperado"), F.lit(" actual="), shown("obtido"))


def summarise(diffs: DataFrame, key: Sequence[str], max_items: int = MAX_ITEMS) -> DataFrame:
    """One row ``passed, diff_count, diffs, truncated``; at most ``max_items`` texts are gathered."""
    count = diffs.agg(F.count(F.lit(1)).alias("n")).scalar()
    shown = (
        diffs.withColumn("_t", diff_text())
        .select(F.struct(*key, "campo", "_t").alias("d"))
        .orderBy("d")
        .limit(max_items)
    )
    return (
        shown.agg(F.array_sort(F.collect_list("d")).alias("d"))
        .select(F.transform("d", lambda x: x.getField("_t")).alias("diffs"), count.alias("diff_count"))
        .select(
            (F.col("diff_count") == 0).alias("passed"),
            "diff_count",
            "diffs",
            (F.col("diff_count") > max_items).alias("truncated"),
        )
    )
