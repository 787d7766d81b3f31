"""15-minute slots over a stream of records: sums of every micro-batch are stored and merged when read."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.functions.money import exact_sum, money_sum
from tidecast.sources.tables import read_or_empty

SLOT, DELAY = "15 minutes", "10 minutes"
MARK = T.StructType().add("marca", "timestamp")


def event_stream(spark: SparkSession, root: str, schema: T.StructType, name: str = "events.parquet") -> DataFrame:
    stream = spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(root)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def slot_totals(rows: DataFrame, key: str, value: str, ts: str = "ts") -> DataFrame:
    """The answer over rows at rest; a row without a time is in no slot."""
    return (
        rows.groupBy(F.window(ts, SLOT).alias("w"), key)
        .agg(F.count(F.lit(1)).alias("n"), money_sum(value).alias("total"))
        .select(F.col("w.start").alias("slot_15m"), key, "n", "total")
    )


def mark_before(spark: SparkSession, path: str, batch: int) -> datetime | None:
    """Latest event of all batches before this one; one row, whatever came so far."""
    return read_or_empty(spark, f"{path}/marcas/lote={batch - 1}", MARK).agg(F.max("marca")).first()[0] if batch else None


def add_batch(rows: DataFrame, batch: int, path: str, key: str, value: str, ts: str = "ts", delay: str = DELAY) -> None:
    """Stores the sums of one micro-batch and the mark of the latest event so far.

    Both folders bear the batch's number and depend on nothing later, so a batch that is run again after a
    failure replaces what it wrote. A slot whose end lies ``delay`` or more before the mark of the earlier
    batches was closed when the batch came: its rows are ``atrasado``, and count all the same.
    """
    spark, mark = rows.sparkSession, mark_before(rows.sparkSession, path, batch)
    late = F.coalesce(F.col("w.end") <= F.lit(mark).cast("timestamp") - F.expr(f"INTERVAL {delay}"), F.lit(False))
    sums = rows.groupBy(F.window(ts, SLOT).alias("w"), key).agg(F.count(F.lit(1)).alias("n"), exact_sum(value).alias("total"), F.max(ts).alias("ultimo"))
    part = sums.select(F.col("w.start").alias("slot_15m"), key, "n", "total", "ultimo", late.alias("atrasado"))
    part.write.mode("overwrite").parquet(f"{path}/partes/lote={batch}")
    latest = F.greatest(F.date_trunc("millisecond", F.max("ultimo")), F.lit(mark).cast("timestamp"))
    done = spark.read.schema(part.schema).parquet(f"{path}/partes/lote={batch}")
    done.agg(latest.alias("marca")).write.mode("overwrite").parquet(f"{path}/marcas/lote={batch}")


def drain(stream: DataFrame, path: str, checkpoint: str, key: str, value: str, ts: str = "ts", delay: str = DELAY) -> None:
    """Takes in all that is there, then ends; no state is kept but the stored sums. ``path`` goes with its checkpoint."""
    query = (
        stream.writeStream.foreachBatch(lambda rows, batch: add_batch(rows, batch, path, key, value, ts, delay))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def slots(spark: SparkSession, path: str, schema: T.StructType, key: str, delay: str = DELAY) -> DataFrame:
    """Every slot with all rows taken in so far, however late they came.

    ``aberto``: the latest event is less than ``delay`` past the slot's end, so rows are still expected.
    ``corrigido``: rows came after the slot had been closed. Sums of the batches are exact decimals, so
    the totals do not depend on how the rows were dealt to batches. Nothing taken in gives no rows.
    """
    part = T.StructType([T.StructField("slot_15m", T.TimestampType()), schema[key], T.StructField("n", T.LongType())])
    part = part.add("total", "decimal(28,4)").add("atrasado", "boolean")
    parts = read_or_empty(spark, f"{path}/partes", part)
    latest = read_or_empty(spark, f"{path}/marcas", MARK).agg(F.max("marca")).first()[0]
    end = F.col("slot_15m") + F.expr(f"INTERVAL {SLOT}")
    return (
        parts.groupBy("slot_15m", key)
        .agg(F.sum("n").alias("n"), F.sum("total").cast("double").alias("total"), F.bool_or("atrasado").alias("corrigido"))
        .withColumn("aberto", end > F.lit(latest).cast("timestamp") - F.expr(f"INTERVAL {delay}"))
    )
