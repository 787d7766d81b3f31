"""Published Parquet tables, the catalog and incoming files."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast import schemas as S
from tidecast.sources.bank import path_missing, read_by_name


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet below a path with a fixed schema; a path not there yet is an empty table."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if path_missing(exc):
            return spark.createDataFrame([], schema)
        raise


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """All runs below the root; columns an old file lacks read as NULL."""
    return read_or_empty(spark, path, S.PREDICTIONS)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The fixed schema keeps ``run_date`` a text where inference would make it a date."""
    return read_or_empty(spark, path, S.METRICS)


def read_partitioned(spark: SparkSession, path: str) -> DataFrame:
    """Partition columns from the path, else year and month from the reference date."""
    df = spark.read.option("mergeSchema", True).parquet(path)
    ref = F.col("data_referencia").cast("date")
    for name, from_date in {"ano": F.year(ref), "mes": F.month(ref)}.items():
        known = F.col(name).cast("int") if name in df.columns else F.lit(None).cast("int")
        df = df.withColumn(name, F.coalesce(known, from_date))
    return df


def parse_key_list(raw) -> list[str]:
    """Keys given as a list, a JSON array or a comma list; blanks drop out."""
    if isinstance(raw, str):
        text = raw.strip()
        raw = json.loads(text) if text.startswith("[") else text.split(",")
    return [k.strip() for k in (raw or []) if k and k.strip()]


def read_incoming(
    spark: SparkSession, keys, schema: T.StructType | None = None, root: str = ""
) -> DataFrame | None:
    """All listed CSV files as one frame.

    Columns are bound by name, so files may differ in them; with a schema the
    types are given, without one they are inferred per file.
    """
    paths = [f"{root}{k}" for k in parse_key_list(keys)]
    if not paths:
        return None
    if schema is not None:
        return read_by_name(spark, paths, schema)
    reader = spark.read.option("header", True)
    frames = [reader.option("inferSchema", True).csv(p) for p in paths]
    frames = [f for f in frames if f.columns]
    if not frames:
        return None
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def file_key(path: Column) -> Column:
    """One spelling per file, whichever reader reports it."""
    return F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")


def file_version(length: Column, modified: Column) -> Column:
    """A rewritten file gets a new version."""
    return F.concat_ws("-", length.cast("string"), F.unix_micros(modified).cast("string"))


def list_files(spark: SparkSession, root: str, suffix: str = ".csv") -> DataFrame:
    """``key, version, modified`` of the files below a folder; only metadata is read."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    except AnalysisException as exc:
        if path_missing(exc):
            return spark.createDataFrame([], S._schema("key string, version string, modified timestamp"))
        raise
    return files.where(F.lower("path").endswith(suffix)).select(
        file_key(F.col("path")).alias("key"),
        file_version(F.col("length"), F.col("modificationTime")).alias("version"),
        F.col("modificationTime").alias("modified"),
    )


def input_status(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    """One row: does the folder hold at least one file."""
    any_file = list_files(spark, root, suffix="").limit(1)
    has = F.count(F.lit(1)) > 0
    return any_file.agg(
        F.lit(run_id).alias("run_id"),
        has.alias("has_data"),
        F.when(has, "validated").otherwise("no_input").alias("status"),
    )


def create_external(
    spark: SparkSession, name: str, path: str, schema: T.StructType, partitions: list[str]
) -> None:
    """Catalog entry over Parquet files somebody else writes."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet {by} LOCATION '{path}'")
