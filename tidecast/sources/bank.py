"""Raw bank tables: CSV dimensions plus one Parquet fact table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast import schemas as S


@dataclass
class Bank:
    customers: DataFrame
    accounts: DataFrame
    loans: DataFrame
    branches: DataFrame
    transactions: DataFrame


def read_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType | None = None
) -> DataFrame:
    """Header CSV; without a schema the types are inferred by one more pass.

    With a schema the columns are bound by name, so a file may order them
    otherwise or lack some (then NULL); see ``read_by_name``.
    """
    if schema is None:
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    return read_by_name(spark, [path] if isinstance(path, str) else path, schema).select(*schema.names)


def read_by_name(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """Header CSVs as one frame, bound by column name, with file facts and faults.

    The header of each path is read, paths with equal headers are one scan, and
    every value is read as text and cast. Absent columns are NULL. Adds ``_file``,
    ``_changed`` and ``_version`` of the file, and ``_unparsed``: the number of
    values that are not empty but have no value of the column's type. Part files
    of one folder must agree in their header, else the read fails.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        header = tuple(spark.read.option("header", True).csv(path).columns)
        groups.setdefault(header, []).append(path)
    frames = []
    for header, members in groups.items():
        if not header:
            continue
        text = T.StructType([T.StructField(c, T.StringType()) for c in header])
        rows = spark.read.option("header", True).option("enforceSchema", False).schema(text).csv(members)
        own = {c.strip().lower(): c for c in header}
        meta, casts, faults = F.col("_metadata"), [], F.lit(0)
        for f in schema:
            if f.name.lower() not in own:
                casts.append(F.lit(None).cast(f.dataType).alias(f.name))
                continue
            raw = F.col(f"`{own[f.name.lower()]}`")
            value = raw if isinstance(f.dataType, T.StringType) else F.trim(raw).try_cast(f.dataType)
            casts.append(value.alias(f.name))
            faults = faults + ((F.trim(raw) != "") & value.isNull()).cast("int")
        file = [
            F.regexp_replace(meta["file_path"], "^([a-z0-9]+):/+", "$1:/").alias("_file"),
            meta["file_modification_time"].alias("_changed"),
            F.concat_ws("-", meta["file_size"].cast("string"), F.unix_micros(meta["file_modification_time"]).cast("string")).alias("_version"),
        ]
        frames.append(rows.select(*casts, *file, F.coalesce(faults, F.lit(0)).alias("_unparsed")))
    if not frames:
        facts = "_file string, _changed timestamp, _version string, _unparsed int"
        return spark.createDataFrame([], T.StructType([*schema, *S._schema(facts)]))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def path_missing(exc: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in (exc.getCondition() or str(exc))


def read_csv_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A missing object reads as an empty table of the same schema."""
    try:
        return read_csv(spark, path, schema)
    except AnalysisException as exc:
        if path_missing(exc):
            return spark.createDataFrame([], schema)
        raise


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def load_bank(spark: SparkSession, root: str) -> Bank:
    """Three required sources, two optional ones."""
    required = ["customers.csv", "accounts.csv", "transactions.parquet"]
    missing = [name for name in required if not exists(spark, f"{root}/{name}")]
    if missing:
        raise FileNotFoundError(f"missing below {root}: {missing}")
    tx = spark.read.parquet(f"{root}/transactions.parquet")
    tx = tx.withColumn("transaction_date", tx["transaction_date"].cast("date"))
    return Bank(
        customers=read_csv(spark, f"{root}/customers.csv", S.CUSTOMERS),
        accounts=read_csv(spark, f"{root}/accounts.csv", S.ACCOUNTS),
        loans=read_csv_or_empty(spark, f"{root}/loans.csv", S.LOANS),
        branches=read_csv_or_empty(spark, f"{root}/branches.csv", S.BRANCHES),
        transactions=tx,
    )
