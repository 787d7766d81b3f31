"""Batches into the panel, file by file or all at once."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast import schemas as S
from tidecast.functions import calendar as C
from tidecast.operators import merge as MG
from tidecast.session import delete_path, fresh_path, materialise
from tidecast.sinks import ledger as LG
from tidecast.sinks import snapshots as SN
from tidecast.sinks import tables as TB
from tidecast.sources import tables as ST

FILES = "path string, modificationTime timestamp, length bigint, content binary"


def read_panel(spark: SparkSession, path: str) -> DataFrame:
    """The current version of the panel; what is read stays that version."""
    return ST.read_or_empty(spark, SN.current(spark, path), S.PANEL)


def merge_into_panel(spark: SparkSession, batch: DataFrame, path: str) -> tuple[int, int]:
    """Newest version wins on (customer, date); rows of the touched months before and after.

    A row of the batch replaces a stored one only if that is not of a newer file (``versao_em``,
    ``versao_arquivo``; absent ones are oldest), so files may come in any order and in separate runs.

    Only the months the batch touches are read, staged, and overwritten: the
    span of the batch prunes partitions, the semi-join leaves out untouched
    months inside it. A repeated batch gives the same table.
    """
    batch = TB.conform(batch, S.STORED_PANEL)
    month = F.col("ano") * 12 + F.col("mes")
    span = batch.agg(F.min(month).alias("lo"), F.max(month).alias("hi")).first()
    if span["lo"] is None:
        return 0, 0
    months = batch.select("ano", "mes").distinct()
    touched = ST.read_or_empty(spark, SN.current(spark, path), S.STORED_PANEL).where(month.between(span["lo"], span["hi"]))
    touched = touched.join(months, ["ano", "mes"], "left_semi")
    before = touched.count()
    stage = fresh_path(spark, "merge")
    MG.upsert_newest(touched, batch, S.VERSION.fieldNames()).write.parquet(stage)
    merged = spark.read.schema(S.STORED_PANEL).parquet(stage)
    after = merged.count()
    TB.write_panel(merged, path)
    delete_path(spark, stage)
    return before, after


def dated(batch: DataFrame) -> DataFrame:
    """Calendar columns from the reference date, so a file need not bring them."""
    own = batch.columns
    calendar = C.with_calendar(batch.withColumn("_day", F.col("data_referencia")), "_day")
    return calendar.withColumn("data_referencia", F.col("_day")).select(*dict.fromkeys([*own, *C.CALENDAR]))


def usable() -> Column:
    """Rows that can enter the panel: a customer, a date, and no value that failed to parse."""
    return F.col("cliente_id").isNotNull() & F.col("data_referencia").isNotNull() & (F.col("_unparsed") == 0)


def ingest_batch(
    spark: SparkSession,
    batch: DataFrame,
    path: str,
    run_id: str,
    landing: str | None = None,
    rejects: str | None = None,
) -> DataFrame:
    """Merge, landing copy, rejected rows and the one-row ingest report.

    Of several rows of a key, in this batch and in the panel, the one of the newest file wins
    (``_changed``, ``_file`` as ``read_incoming`` brings them; equal ones by the column
    values). Rows that come without a file count as written now. Rows that
    cannot enter the panel are appended to ``rejects`` (by default beside the panel)
    before the merge, so every row of a file is in one of the two.
    """
    given = set(batch.columns)
    for name, kind in {"_changed": "timestamp", "_file": "string", "_unparsed": "int"}.items():
        if name not in batch.columns:
            batch = batch.withColumn(name, F.lit(0 if kind == "int" else None).cast(kind))
    if "_changed" not in given:
        batch = batch.withColumn("_changed", F.lit(spark.sql("SELECT current_timestamp() AS t").first()[0]))
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        refused = batch.where(~usable())
        n_refused = refused.count()
        if n_refused:
            LG.append_rows(refused.withColumn("run_id", F.lit(run_id)), rejects or f"{path.rstrip('/')}-rejects")
        version = F.struct("_changed", "_file", *[c for c in batch.columns if c in S.PANEL_COLUMNS])
        newest = dated(MG.newest_version(batch.where(usable()), MG.PANEL_KEY, version))
        newest = newest.withColumns({"versao_em": F.col("_changed"), "versao_arquivo": F.col("_file")})
        newest = materialise(TB.conform(newest, S.STORED_PANEL), "batch")
        whole = read_panel(spark, path).count()
        before, after = merge_into_panel(spark, newest, path)
        if landing:
            TB.write_landing(TB.conform(newest, S.PANEL), landing, F.col("data_referencia"), run_id)
        facts = newest.agg(F.count(F.lit(1)).alias("n"), F.max("data_referencia").alias("d")).first()
    finally:
        batch.unpersist()
    return spark.range(1).select(
        F.lit(run_id).alias("run_id"),
        F.date_format(F.lit(facts["d"]).cast("date"), "yyyy-MM-dd").alias("data_referencia"),
        F.lit(facts["n"]).cast("bigint").alias("rows_incoming"),
        F.lit(n_refused).cast("bigint").alias("rows_rejected"),
        F.lit(after - before).cast("bigint").alias("rows_added"),
        F.lit(whole).cast("bigint").alias("rows_before"),
        F.lit(whole + after - before).cast("bigint").alias("total_rows"),
        F.lit(landing).cast("string").alias("landing_key"),
    )


def ingest_new_files(
    spark: SparkSession, incoming: str, panel: str, ledger: str, run_id: str, landing: str | None = None
) -> DataFrame | None:
    """Batch form: files the ledger lacks or knows in another version.

    Unlike a stream checkpoint this also takes rewritten files. Returns the
    ingest report, or nothing when there is no new file.
    """
    new = ST.list_files(spark, incoming)
    new = materialise(LG.unprocessed(new, LG.read_ingest_ledger(spark, ledger)), "new-files")
    keys = [r["key"] for r in new.select("key").orderBy("key").collect()]  # the reader takes a list of paths
    batch = ST.read_incoming(spark, keys, S.PANEL)
    if batch is None:
        return None
    report = ingest_batch(spark, batch, panel, run_id, landing)
    LG.mark_processed(new, ledger)
    return report


def replay(
    spark: SparkSession,
    incoming: str,
    panel: str,
    checkpoint: str,
    ledger: str | None = None,
    files_per_batch: int | None = 1,
    suffix: str = ".csv",
) -> int:
    """Drains the incoming folder as a stream into the panel.

    The stream carries the files' metadata only; each batch reads its files by
    column name, as the batch form does. ``files_per_batch=1`` replays one file
    after the other, ``None`` merges all pending files in one batch. A file is
    entered in the ledger only after its rows are in the panel or the rejects.
    Returns the number of batches.
    """
    reader = spark.readStream.format("binaryFile").schema(FILES).option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    files = reader.load(incoming).where(F.lower("path").endswith(suffix)).select(
        ST.file_key(F.col("path")).alias("key"),
        ST.file_version(F.col("length"), F.col("modificationTime")).alias("version"),
    )

    done = 0

    def take(batch: DataFrame, batch_id: int) -> None:
        nonlocal done
        new = materialise(batch, "new-files")
        keys = [r["key"] for r in new.select("key").orderBy("key").collect()]
        if not keys:
            return
        ingest_batch(spark, ST.read_incoming(spark, keys, S.PANEL), panel, f"replay-{batch_id}")
        if ledger:
            LG.mark_processed(new, ledger)
        done += 1

    query = (
        files.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return done
