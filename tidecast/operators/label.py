"""Next-period label and the split by time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidecast import schemas as S
from tidecast.operators.prefix import running_sum
from tidecast.operators.quantiles import quantile_of_counts

REQUIRED = {"cliente_id", "data_referencia", "saldo_m1"}


def drop_stale_labels(df: DataFrame) -> DataFrame:
    return df.drop(S.LABEL, S.LEGACY_LABEL)


def next_period_label(df: DataFrame) -> DataFrame:
    """Balance and date of the customer's next row; rows without one are dropped.

    A frame that lacks the needed columns passes through unchanged.
    """
    if not REQUIRED.issubset(df.columns):
        return df
    w = Window.partitionBy("cliente_id").orderBy("data_referencia")
    return df.withColumns(
        {
            S.LABEL: F.lead("saldo_m1").over(w),
            S.NEXT_DATE: F.lead("data_referencia").over(w),
        }
    ).where(F.col(S.LABEL).isNotNull())


def training_view(panel: DataFrame) -> DataFrame:
    """Labelled rows as a view; the panel itself is never overwritten by it."""
    return next_period_label(drop_stale_labels(panel))


def temporal_split(
    labelled: DataFrame,
    test_share: float = 0.2,
    val_share: float = 0.15,
    min_rows: int = 10,
) -> DataFrame:
    """Adds ``split``: train, val, test, or NULL for rows whose label falls into the test span.

    Both cutoffs are interpolated quantiles of the row dates, so all rows of a
    date stay together. They are found on per-date counts and enter the plan
    as literals. If there are too few rows, or a side stays empty, the split
    goes by position in date order instead.
    """
    d, nd = F.unix_date("data_referencia"), F.unix_date(S.NEXT_DATE)
    counts = labelled.groupBy(d.alias("d"), nd.alias("nd")).agg(F.count(F.lit(1)).alias("n"))
    first = counts.agg(quantile_of_counts("d", 1 - test_share, "n").alias("c"), F.sum("n").alias("n")).first()
    if (first["n"] or 0) < min_rows:
        return split_by_position(labelled, test_share, val_share)
    tc = first["c"]
    kept = counts.where((F.col("d") < tc) & (F.col("nd") < tc))
    vc = kept.agg(quantile_of_counts("d", 1 - val_share, "n").alias("c")).first()["c"]
    if vc is None or kept.where(F.col("d") < vc).isEmpty():
        return split_by_position(labelled, test_share, val_share)
    return labelled.withColumn(
        "split",
        F.when(d >= tc, "test").when((nd < tc) & (d < vc), "train").when(nd < tc, "val"),
    )


def split_by_position(labelled: DataFrame, test_share: float, val_share: float) -> DataFrame:
    """First rows in date and customer order train, the next validate, the last test."""
    n = labelled.count()
    head = max(1, int(n * (1 - test_share)))
    train = max(1, int(min(head, n) * (1 - val_share)))
    numbered = running_sum(
        labelled,
        keys=[],
        order_by=[F.col("data_referencia"), F.col("cliente_id")],
        value=F.lit(1).cast("bigint"),
        out="_rn",
    )
    return numbered.withColumn(
        "split",
        F.when(F.col("_rn") <= train, "train").when(F.col("_rn") <= head, "val").otherwise("test"),
    ).drop("_rn")


def hash_split(labelled: DataFrame, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Random-like split by key hash: repeatable on any cluster; test also serves early stopping."""
    key = F.concat_ws("|", "cliente_id", F.date_format("data_referencia", "yyyy-MM-dd"), F.lit(str(seed)))
    bucket = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % 10_000
    return labelled.withColumn("split", F.when(bucket < int(test_share * 10_000), "test").otherwise("train"))
