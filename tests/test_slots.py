"""Stream of 15-minute slots: rows that come after their slot was closed."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidecast.streaming import slots as SL

SCHEMA = "ts timestamp, kind string, value double"
NOON = datetime(2024, 5, 1, 12)


def rows_at(spark, minutes, value=1.1):
    data = [(NOON + timedelta(minutes=m), f"k{i % 2}", value + i) for i, m in enumerate(minutes)]
    return spark.createDataFrame([*data, (None, "k0", 5.0)], SCHEMA)


def totals(df):
    return sorted((r["slot_15m"], r["kind"], r["n"], r["total"]) for r in df.collect())


def test_late_rows_are_counted_and_marked(spark, tmp_path):
    source, out, checkpoint = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/checkpoint"
    schema = spark.createDataFrame([], SCHEMA).schema
    read = lambda: SL.slots(spark, out, schema, "kind")
    assert read().collect() == []
    spark.createDataFrame([], SCHEMA).coalesce(1).write.parquet(source)
    came = [range(0, 60, 4), [-120, -119, 2, 61, 62], [], [58, 59, 200]]
    for i, minutes in enumerate(came):
        if minutes:
            rows_at(spark, minutes, i + 0.1).coalesce(1).write.mode("append").parquet(source)
        SL.drain(SL.event_stream(spark, source, schema, "*.parquet"), out, checkpoint, "kind", "value")
        assert totals(read()) == totals(SL.slot_totals(spark.read.schema(schema).parquet(source), "kind", "value"))
    got = {(r["slot_15m"], r["kind"]): (r["aberto"], r["corrigido"]) for r in read().collect()}
    late = {k[0] for k, v in got.items() if v[1]}
    assert late == {NOON - timedelta(hours=2), NOON}  # not 12:45, whose end was within the delay when rows came
    assert {k[0] for k, v in got.items() if v[0]} == {NOON + timedelta(minutes=195)}


def test_a_batch_run_again_replaces_itself(spark, tmp_path):
    out = str(tmp_path)
    first, second = rows_at(spark, range(30)), rows_at(spark, [5, 90])
    for batch, rows in ((0, first), (0, first), (1, second), (1, second), (2, first.where("ts > '2030-01-01'"))):
        SL.add_batch(rows, batch, out, "kind", "value")
    got = SL.slots(spark, out, first.schema, "kind")
    assert totals(got) == totals(SL.slot_totals(first.union(second), "kind", "value"))
    assert {r["slot_15m"] for r in got.where("corrigido").collect()} == {NOON}
    assert got.where(F.col("aberto")).count() == 1
