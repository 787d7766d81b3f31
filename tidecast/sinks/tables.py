"""Published tables: partitioned Parquet, catalog entries, CSV and JSON exports.

Writes that replace data overwrite only the partitions they touch and go
through the commit protocol, so a repeated task or run leaves no duplicate rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast import schemas as S
from tidecast.functions.recode import safe_int
from tidecast.sinks import snapshots as SN


BATCH = 500  # partitions named in one catalog statement


def _partitioned(df: DataFrame, path: str, by: list[str], append: bool) -> None:
    """Rebalancing splits a hot partition over several tasks and joins tiny ones."""
    out = df.hint("rebalance", *by).write.partitionBy(*by)
    if append:
        out.mode("append").parquet(path)
    else:
        out.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of the schema in its order; absent ones become NULL."""
    have = set(df.columns)
    cols = [F.col(f.name) if f.name in have else F.lit(None) for f in schema]
    return df.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(cols, schema)])


def write_predictions(df: DataFrame, path: str, append: bool = False) -> None:
    """Each touched (year, month, segment) is replaced; ``append`` adds rows instead."""
    _partitioned(conform(df, S.PREDICTIONS), path, S.PREDICTION_PARTITIONS, append)


def metric_defaults(row: DataFrame) -> DataFrame:
    """Missing counts and champion figures read as 0, missing texts as empty."""
    zero = ["champion_rmse", "champion_wape", "champion_mape"]
    text = ["modelo_versao", "data_referencia_lote", "champion_modelo_versao"]
    return (
        conform(row, S.METRICS)
        .withColumns({c: safe_int(c) for c in ("total_linhas", "linhas_adicionadas")})
        .fillna(0.0, zero)
        .fillna("", text)
        .fillna("{}", ["metricas_segmento", "metricas_baseline"])
        .fillna(False, ["is_champion"])
    )


def write_metrics(rows: DataFrame, path: str) -> None:
    """One partition per run; the same run on the same date replaces its row."""
    _partitioned(metric_defaults(rows), path, S.METRIC_PARTITIONS, append=False)


def write_panel(df: DataFrame, path: str) -> None:
    """Panel partitioned by year and month; touched months of the current version are replaced."""
    _partitioned(conform(df, S.STORED_PANEL), SN.current(df.sparkSession, path), ["ano", "mes"], append=False)


def replace_panel(df: DataFrame, path: str) -> None:
    """Reconcile: the whole panel is written anew from its source, as a version that readers see once it is whole."""
    SN.publish(conform(df, S.STORED_PANEL), path, ["ano", "mes"])


def write_landing(batch: DataFrame, path: str, day: Column, run_id: str) -> None:
    """Copy of the batch itself under ``dt=/run_id=``."""
    stamped = batch.withColumn("dt", F.date_format(day, "yyyy-MM-dd")).withColumn("run_id", F.lit(run_id))
    _partitioned(stamped, path, ["dt", "run_id"], append=False)


def write_csv(df: DataFrame, path: str, single: bool = False) -> None:
    """Header CSV; ``single`` is meant for small results such as reports."""
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def register_partitions(spark: SparkSession, table: str, written: DataFrame, by: list[str]) -> int:
    """Adds the partitions of a written frame to the catalog, BATCH of them in a statement."""
    rows = written.select(*by).distinct().collect()
    for i in range(0, len(rows), BATCH):
        specs = " ".join(f"PARTITION ({', '.join(f'`{c}` = {_literal(r[c])}' for c in by)})" for r in rows[i : i + BATCH])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {specs}")
    return len(rows)


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def discover_partitions(spark: SparkSession, table: str) -> None:
    """Registers what lies on disk, for tables written before the catalog entry."""
    spark.sql(f"MSCK REPAIR TABLE {table}")


def add_columns(spark: SparkSession, table: str, columns: dict[str, str]) -> None:
    """New columns read as NULL in old partitions; columns already there are skipped."""
    have = set(spark.table(table).columns)
    new = [f"`{c}` {t}" for c, t in columns.items() if c not in have]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(new)})")


