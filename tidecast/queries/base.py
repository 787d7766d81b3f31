"""Registry of runnable queries and the frames they share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.operators import label as L
from tidecast.operators import panel as P
from tidecast.plans import blend as B
from tidecast.session import fresh_path, materialise, use_utc
from tidecast.sinks import tables as TB
from tidecast.sources import tables as ST
from tidecast.sources import warehouse as W
from tidecast.sources.bank import exists

AS_OF = "2002-01-01"
NOW = "2024-01-01 09:05:00"


class Lab:
    """Frames over one data folder.

    The bank views, ``panel_plan`` and ``panel_c`` are lazy plans over the raw
    tables. Panel, labelled rows, predictions and run metrics are tables in the
    product these queries belong to, so the lab stores each on first use in the
    shared folder and the queries read it from there. ``*_c`` frames keep completed transactions
    only; the plain ones take every status, which gives more customers a full
    history.
    """

    _open: dict[tuple[str, str], Lab] = {}

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = use_utc(spark), root
        self._stored: list[str] = []

    @classmethod
    def of(cls, spark: SparkSession, root: str) -> Lab:
        """The session's lab for a folder, as long as its stored tables are there."""
        key = (spark.sparkContext.applicationId, root)
        lab = cls._open.get(key)
        if lab is None or not all(exists(spark, path) for path in lab._stored):
            lab = cls._open[key] = cls(spark, root)
        use_utc(spark)
        return lab

    def _store(self, df: DataFrame, name: str) -> DataFrame:
        stored = materialise(df, name)
        self._stored += [f.rsplit("/", 1)[0] for f in stored.inputFiles()[:1]]
        return stored

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")

    @cached_property
    def bank(self):
        return W.load_bank(self.spark, self.root)

    @cached_property
    def events(self) -> DataFrame:
        e = self.table("events")
        return e.withColumn("ts", F.col("ts").cast("timestamp"))

    @cached_property
    def panel_c(self) -> DataFrame:
        return P.monthly_panel(self.bank, AS_OF)

    @cached_property
    def panel_plan(self) -> DataFrame:
        return P.monthly_panel(self.bank, AS_OF, status=None)

    @cached_property
    def panel(self) -> DataFrame:
        return self._store(self.panel_plan, "panel")

    @cached_property
    def labelled_c(self) -> DataFrame:
        return L.training_view(self.panel_c)

    @cached_property
    def labelled(self) -> DataFrame:
        return self._store(L.training_view(self.panel), "labelled")

    @cached_property
    def scored(self) -> DataFrame:
        return self._store(B.scored_rows(self.labelled), "scored")

    @cached_property
    def predictions(self) -> DataFrame:
        """The published table, partitioned by year, month and segment."""
        path = fresh_path(self.spark, "predictions")
        TB.write_predictions(B.published_predictions(self.scored), path)
        self._stored.append(path)
        return ST.read_predictions(self.spark, path)

    @cached_property
    def metrics(self) -> DataFrame:
        return self._store(B.published_metrics(self.scored), "metrics")


@dataclass
class Query:
    run: Callable[[Lab], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(key: str, sql: str | None = None):
    def register(fn):
        if key in REGISTRY:
            raise KeyError(f"{key} is registered twice")
        REGISTRY[key] = Query(fn, sql)
        return fn

    return register


def day(c: str = "data_referencia"):
    """Dates leave the checks as text."""
    return F.date_format(c, "yyyy-MM-dd").alias(c)


def stamp(c, name: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(name)
