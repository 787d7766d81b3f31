"""Whole-table versions: readers see the old table or the new one, never a part.

A version is a folder of its own below the table; an empty marker file below ``_versions``, created
last, makes it the current one. Its name holds a rising number and the folder's name, so nothing is
overwritten and a listing tells the current version. A failed write leaves a folder that no marker names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

MARKERS, MARK = "_versions", "~"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, folder) of all published versions, oldest first; there are as many as were not retired."""
    fs, markers = _fs(spark, f"{path.rstrip('/')}/{MARKERS}")
    if not fs.exists(markers):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(markers))
    return [(int(n.split(MARK)[0]), f"{path.rstrip('/')}/{n.split(MARK)[1]}") for n in names]


def current(spark: SparkSession, path: str) -> str:
    """Folder of the current version; a table without versions is its own folder."""
    known = versions(spark, path)
    return known[-1][1] if known else path


def publish(df: DataFrame, path: str, by: list[str]) -> str:
    """Write a new version, partitioned and rebalanced by ``by``, and make it the current one."""
    spark, path = df.sparkSession, path.rstrip("/")
    name = f"v-{uuid.uuid4().hex}"
    df.hint("rebalance", *by).write.partitionBy(*by).mode("errorifexists").parquet(f"{path}/{name}")
    while True:
        number = max((n for n, _ in versions(spark, path)), default=0) + 1
        fs, marker = _fs(spark, f"{path}/{MARKERS}/{number:012d}{MARK}{name}")
        fs.create(marker, False).close()
        rivals = [f for n, f in versions(spark, path) if n == number and not f.endswith(name)]
        if not rivals:  # of two writers with one number both publish again, so the last marker stays unique
            return f"{path}/{name}"
        fs.delete(marker, False)


def retire(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Remove all but the newest ``keep`` versions, markers first; returns how many. Readers of older ones fail."""
    old = versions(spark, path)[: -max(keep, 1)]
    for number, folder in old:
        fs, target = _fs(spark, folder)
        fs.delete(_fs(spark, f"{path.rstrip('/')}/{MARKERS}/{number:012d}{MARK}{target.getName()}")[1], False)
        fs.delete(target, True)
    return len(old)
