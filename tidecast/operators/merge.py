"""Batches into the panel: union, latest-wins, retention, id high-water mark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.functions import calendar as C
from tidecast.operators.prefix import first_rows

PANEL_KEY = ["cliente_id", "data_referencia"]

# Customer id patterns, tried in this order, and their formats.
ID_FORMS = [(r"CUST(\d+)", "CUST%06d"), (r"CLI_(\d+)", "CLI_%05d")]


def append(base: DataFrame, batch: DataFrame) -> DataFrame:
    """Plain union by name; a row delivered twice stays twice."""
    return base.unionByName(batch, allowMissingColumns=True)


def newest_version(batch: DataFrame, key: Sequence[str], version: Column) -> DataFrame:
    """One row per key: the one of the newest version."""
    w = Window.partitionBy(*key).orderBy(version.desc())
    return batch.withColumn("_pos", F.row_number().over(w)).where("_pos = 1").drop("_pos")


def upsert(base: DataFrame, batch: DataFrame, key: Sequence[str] = PANEL_KEY) -> DataFrame:
    """Latest wins: rows of the batch replace rows with the same key.

    The batch must hold one row per key. Catalyst broadcasts its keys when they
    are small enough, so the base is then not shuffled at all.
    """
    kept = base.join(batch.select(*key), list(key), "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


def upsert_newest(base: DataFrame, batch: DataFrame, version: Sequence[str], key: Sequence[str] = PANEL_KEY) -> DataFrame:
    """Newest version wins: a row of the batch replaces a row of the same key unless that one is newer.

    Both sides hold one row per key. ``version`` are columns compared in order, NULL before all else; of
    equal versions the batch's row stands, so a repeated batch changes nothing. Batches may come in any
    order. Only keys and versions of the batch meet the base, which Catalyst need not shuffle for a small batch.
    """
    key = list(key)
    own = batch.select(*key, F.struct(*version).alias("_batch"))
    met = base.withColumn("_base", F.struct(*version)).join(own, key, "left")
    newer = F.col("_batch").isNotNull() & (F.col("_base") > F.col("_batch"))
    kept = met.where(F.col("_batch").isNull() | newer).drop("_base", "_batch")
    outdated = met.where(newer).select(*key)
    return kept.unionByName(batch.join(outdated, key, "left_anti"), allowMissingColumns=True)


def keep_newest(df: DataFrame, max_rows: int) -> DataFrame:
    """The newest ``max_rows`` rows by date, then by customer id; rows without a date are the oldest.

    Counts per date find the date at which the limit falls. Newer dates pass as
    they are; only rows of that date are ranked, with all columns as tie-break.
    """
    dates = df.groupBy(F.col("data_referencia").alias("_date")).agg(F.count(F.lit(1)).alias("_n"))
    newest = Window.orderBy(F.col("_date").desc_nulls_last())  # one row per date
    dates = dates.withColumn("_left", F.lit(max_rows) - (F.sum("_n").over(newest) - F.col("_n"))).where("_left > 0")
    met = df.join(dates, df["data_referencia"].eqNullSafe(dates["_date"]))
    whole = met.where("_n <= _left").select(*df.columns)
    cut = met.where("_n > _left").drop("_n", "_date")
    order = [F.col(c) for c in ["cliente_id", *(c for c in df.columns if c != "cliente_id")]]
    return whole.unionByName(first_rows(cut, F.col("_left"), order).select(*df.columns))


def latest_per_customer(df: DataFrame) -> DataFrame:
    """Newest panel row of each customer; at most one row per month and customer is compared."""
    w = Window.partitionBy("cliente_id").orderBy(F.desc("data_referencia"))
    return df.withColumn("_pos", F.row_number().over(w)).where("_pos = 1").drop("_pos")


def next_customer(df: DataFrame, id_col: str = "cliente_id") -> DataFrame:
    """Next free customer number and id: one row ``next_index, next_id``."""
    maxima = [
        F.max(F.regexp_extract(id_col, pattern, 1).try_cast("bigint")).alias(f"m{i}")
        for i, (pattern, _) in enumerate(ID_FORMS)
    ]
    row = df.agg(*maxima, F.countDistinct(id_col).alias("n"))
    index, text = F.col("n") + 1, F.format_string(ID_FORMS[-1][1], F.col("n") + 1)
    for i, (_, form) in reversed(list(enumerate(ID_FORMS))):
        seen = F.col(f"m{i}").isNotNull()
        index = F.when(seen, F.col(f"m{i}") + 1).otherwise(index)
        text = F.when(seen, F.format_string(form, F.col(f"m{i}") + 1)).otherwise(text)
    return row.select(index.alias("next_index"), text.alias("next_id"))


def months_missing(expected: DataFrame, present: DataFrame, date: str = "data_referencia") -> DataFrame:
    want = expected.select(C.month_key(date).alias("mes_ref")).distinct()
    have = present.select(C.month_key(date).alias("mes_ref")).distinct()
    return want.join(have, "mes_ref", "left_anti")


def fingerprint(rows: Column, max_date: Column) -> Column:
    """First 16 hex digits of SHA-256 over ``rows|newest date``."""
    newest = F.concat(F.date_format(max_date, "yyyy-MM-dd"), F.lit("T00:00:00"))
    return F.substring(F.sha2(F.concat_ws("|", rows.cast("string"), newest), 256), 1, 16)


def dataset_fingerprint(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("linhas"),
        fingerprint(F.count(F.lit(1)), F.max("data_referencia")).alias("dataset_fingerprint"),
    )
