"""Session settings and scratch folders."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: str = "*", app: str = "tidecast", **conf: str) -> SparkSession:
    """Session for tests and benches; a cluster brings its own."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config(CHECKPOINT_KEY, tempfile.mkdtemp(prefix="run-tidecast-"))
    )
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Every timestamp in the data model is UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach: the cluster's checkpoint folder, else its warehouse."""
    root = spark.conf.get(CHECKPOINT_KEY, None)
    return root.rstrip("/") if root else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stages"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, never used before."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a stage that nothing reads any more."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def materialise(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a frame that several jobs read and read it back.

    The written table survives lost executors and spares every later job the
    recomputation.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
