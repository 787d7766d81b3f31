"""Append-only ledgers with latest-per-key views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast import schemas as S
from tidecast.sources.tables import read_or_empty

DECIMAL = T.DecimalType(38, 10)


def _as_decimal(c: Column, t: T.DataType) -> Column:
    if isinstance(t, (T.DoubleType, T.FloatType)):
        return c.cast(DECIMAL)
    if isinstance(t, T.ArrayType):
        return F.transform(c, lambda x: _as_decimal(x, t.elementType))
    if isinstance(t, T.MapType):
        return F.transform_values(c, lambda _, v: _as_decimal(v, t.valueType))
    if isinstance(t, T.StructType):
        inner = F.struct(*[_as_decimal(c.getField(f.name), f.dataType).alias(f.name) for f in t])
        return F.when(c.isNotNull(), inner)
    return c


def decimals_inside(df: DataFrame, column: str) -> DataFrame:
    """Floats at any depth of a column become decimals, driven by its schema."""
    return df.withColumn(column, _as_decimal(F.col(column), df.schema[column].dataType))


def append_rows(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


# run ledger


def append_run(
    spark: SparkSession, path: str, run_id: str, phase: str, status: str, payload: DataFrame
) -> None:
    """One ledger row; the payload frame has one row and is kept as JSON."""
    row = payload.select(
        F.lit(run_id).alias("run_id"),
        F.lit(phase).alias("phase"),
        F.lit(status).alias("status"),
        F.to_json(F.struct("*")).alias("payload"),
        F.current_timestamp().alias("updated_at"),
    )
    append_rows(row, path)


def latest_runs(ledger: DataFrame) -> DataFrame:
    """Last state of each run: the newest phase replaces all earlier ones."""
    state = F.struct("updated_at", "phase", "status", "payload")
    return ledger.groupBy("run_id").agg(F.max(state).alias("s")).select("run_id", "s.*")


def run_result(ledger: DataFrame, run_id: str) -> DataFrame:
    return latest_runs(ledger.where(F.col("run_id") == run_id))


def read_run_ledger(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, S.RUN_LEDGER)


# ingest ledger


def read_ingest_ledger(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, S.INGEST_LEDGER)


def latest_versions(ledger: DataFrame) -> DataFrame:
    return (
        ledger.groupBy("key")
        .agg(F.max(F.struct("marked_at", "version")).alias("s"))
        .select("key", "s.version", "s.marked_at")
    )


def unprocessed(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files the ledger lacks or holds in another version."""
    done = latest_versions(ledger).select("key", "version")
    return listing.join(done, ["key", "version"], "left_anti")


def mark_processed(files: DataFrame, path: str, at: Column | None = None) -> None:
    """Called after the batch is committed, never before: a failed batch comes again."""
    at = F.current_timestamp() if at is None else at
    append_rows(files.select("key", "version", at.cast("timestamp").alias("marked_at")), path)


def due(ledger: DataFrame, now: Column, step_minutes: int) -> DataFrame:
    """Whether the last mark is at least ``step_minutes`` old, or absent."""
    last = F.max("marked_at")
    elapsed = (F.unix_micros(now) - F.unix_micros(last)) / 60e6
    return ledger.agg(F.coalesce(elapsed >= step_minutes, F.lit(True)).alias("due"))


def should_run(listing: DataFrame, ledger: DataFrame, busy: bool = False) -> DataFrame:
    """Decision row; the files it rests on are the rows of ``new_files``."""
    new = new_files(listing, ledger, busy)
    count = F.count(F.lit(1))
    return new.agg(
        (count > 0).alias("has_new_data"),
        count.alias("incoming_count"),
        F.when(F.lit(busy), "job_running").when(count == 0, "no_new_data").alias("skip_reason"),
    )


def new_files(listing: DataFrame, ledger: DataFrame, busy: bool = False) -> DataFrame:
    """Key, version and time of every file a run would take; none while a job is running."""
    new = unprocessed(listing, ledger).select("key", "version", "modified")
    return new.where("false") if busy else new
