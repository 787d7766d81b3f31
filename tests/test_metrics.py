import math

import pytest
from conftest import rows

from tidecast.functions import scoring as SC
from tidecast.operators import metrics as MT


def frame(spark, y, p):
    return spark.createDataFrame(list(zip(map(float, y), map(float, p))), "y double, p double")


def measured(spark, y, p):
    return frame(spark, y, p).agg(*SC.metric_aggregates("y", "p")).first().asDict()


def test_golden(spark):
    got = measured(spark, [100, 200, 300], [110, 190, 280])
    want = {"rmse": 14.142136, "mae": 13.333333, "r2": 0.97, "wape": 6.666667, "smape": 7.182855, "mape": 7.222222}
    for k, v in want.items():
        assert got[k] == pytest.approx(v, abs=1e-6)


def test_zero_rules(spark):
    got = measured(spark, [0, 0], [0, 5])
    assert (got["wape"], got["mape"], got["r2"]) == (0.0, 0.0, 0.0)
    assert got["smape"] == pytest.approx(200.0)
    assert measured(spark, [0, 0], [0, 0])["smape"] == 0.0
    assert measured(spark, [7, 7], [7, 7])["r2"] == 1.0
    assert measured(spark, [7], [8])["r2"] is None
    report = frame(spark, [0, 0], [1, 1]).agg(SC.wape_sql("p", "y")).first()[0]
    assert report is None


def scored(spark):
    data = [
        ("r1", "v", "2024-01-01T00:00:00+00:00", "A", 110.0, 100.0, 110.0, 120.0),
        ("r1", "v", "2024-01-01T00:00:00+00:00", "A", 190.0, 200.0, 190.0, 150.0),
        ("r1", "v", "2024-01-01T00:00:00+00:00", "B", 280.0, 300.0, 280.0, 200.0),
    ]
    cols = (
        "run_id string, modelo_versao string, dt_processamento string, segmento string, saldo_realizado double, "
        "base_naive double, saldo_predito double, base_media double"
    )
    from pyspark.sql import functions as F

    return spark.createDataFrame(data, cols).withColumn("data_referencia", F.lit("2023-12-31").cast("date"))


def test_naive_baseline(spark):
    got = {r["baseline"]: r["wape"] for r in MT.baseline_metrics(scored(spark)).collect()}
    assert got["naive_saldo_m1"] == pytest.approx(6.896552, abs=1e-6)


def test_run_row(spark):
    import json

    r = MT.run_metrics(scored(spark)).first()
    segments = json.loads(r["metricas_segmento"])
    assert list(segments) == ["A"] and set(segments["A"]) == {"rmse", "mae", "r2", "wape", "smape", "mape"}
    base = json.loads(r["metricas_baseline"])
    assert base["naive_wape"] == 6.8966 and base["beats_naive"] is True and base["modelo_wape"] == 0.0
    assert r["total_linhas"] == r["linhas_adicionadas"] == 3
    assert not math.isnan(r["wape"])


def test_summary(spark):
    from pyspark.sql import functions as F

    s = [F.struct(F.lit(w).alias("wape")) for w in (20.0, 25.0, 22.0)]
    got = spark.range(1).select(SC.baseline_summary(*s).alias("s")).select("s.*").first()
    assert got["beats_naive"] and got["beats_media_saldos"] and got["wape_gain_vs_naive_pp"] == 5.0


def test_groups_below_two_rows_are_left_out(spark):
    assert rows(MT.segment_metrics(scored(spark), ["segmento"]), "segmento") == [("A",)]
