from unittest.mock import MagicMock

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidecast import jobs as J
from tidecast import schemas as S
from tidecast.operators import features as FT
from tidecast.operators import label as L
from tidecast.operators import train as TR
from tidecast.queries import learning
from tidecast.queries.base import REGISTRY
from tidecast.session import fresh_path
from tidecast.sources import tables as ST


def test_parameters():
    p = TR.parameters('{"n_estimators": "10", "learning_rate": "0.1", "other": "x"}')
    assert (p["n_estimators"], p["learning_rate"], p["max_depth"], p["other"]) == (10, 0.1, 6, "x")
    assert TR.parameters("")["n_estimators"] == 300


def test_row_stats_skip_nulls(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (None, None, 4.0), (1.0, 2.0, 6.0)], "a double, b double, c double")
    mean, dev = FT.row_stats(["a", "b", "c"])
    got = df.select(mean.alias("m"), dev.alias("s")).collect()
    assert got[0]["m"] == 1.5 and got[0]["s"] == pytest.approx(np.std([1, 2], ddof=1))
    assert got[1]["m"] == 4.0 and got[1]["s"] is None
    assert got[2]["s"] == pytest.approx(np.std([1, 2, 6], ddof=1))


def test_null_fill_and_unseen_label(lab, spark):
    rows = lab.labelled.withColumn("saldo_m3", F.when(F.col("mes") != 5, F.col("saldo_m3")))
    p = FT.fit(rows)
    out = FT.transform(rows, p)
    assert out.where(" OR ".join(f"{c} IS NULL" for c in S.LAGS)).isEmpty()
    x = np.array([r[0] for r in rows.where("saldo_m3 IS NOT NULL").select("saldo_m3").collect()])
    assert p.medians["saldo_m3"] == pytest.approx(np.median(x))
    with pytest.raises(Exception, match="unseen value in uf"):
        FT.transform(rows.withColumn("uf", F.lit("ZZ")), p).select("x_uf").collect()
    assert FT.FeatureParams.from_json(p.to_json()) == p


def test_rows_without_profile_still_score(lab):
    rows = lab.labelled.withColumn("uf", F.when(F.col("mes") != 3, F.col("uf"))).withColumn("idade", F.lit(None).cast("int"))
    p = FT.fit(rows)
    assert p.labels["uf"][-1] == "nan"
    assert TR.assemble(FT.transform(rows, p)).where("features IS NULL").isEmpty()


def test_scaling_is_population(lab):
    out = FT.transform(lab.labelled, FT.fit(lab.labelled), training=True)
    m, s, n = out.agg(F.avg("x_saldo_m2"), F.stddev_pop("x_saldo_m2"), F.count("*")).first()
    assert m == pytest.approx(0, abs=1e-9) and s == pytest.approx(1)
    assert n < lab.labelled.count()


@pytest.fixture(scope="module")
def trained(spark, lab):
    cfg = J.Config(root=fresh_path(spark, "job"), run_id="r1", params={"n_estimators": "4", "max_depth": "3"})
    J.build_panel(spark, lab.bank, cfg, "2002-01-01", status=None)
    return cfg, J.retrain(spark, cfg).first()


def test_retrain_publishes_everything(spark, lab, trained):
    cfg, row = trained
    assert row["is_champion"] and row["champion_modelo_versao"] == row["modelo_versao"]
    assert row["modelo_versao"].startswith("gbt-saldo-v1-")
    predictions = ST.read_predictions(spark, cfg.predictions)
    split = L.temporal_split(lab.labelled)
    test = split.where("split = 'test'").select(
        "cliente_id", F.date_format("data_referencia", "yyyy-MM-dd").alias("data_referencia"), S.LABEL
    )
    # every published row carries the actual of its own customer and date
    joined = predictions.join(test, ["cliente_id", "data_referencia"])
    assert joined.count() == predictions.count() > 0
    assert joined.where(F.col("saldo_realizado") != F.col(S.LABEL)).isEmpty()
    top = TR.top_features(spark.read.json(f"{cfg.root}/models/importance/r1"))
    assert top.count() == 10
    assert J.current_champion(spark, cfg).first()["run_id"] == "r1"


def test_same_data_same_version_and_no_second_promotion(spark, trained):
    cfg, row = trained
    again = J.Config(root=cfg.root, run_id="r2", params=cfg.params)
    second = J.retrain(spark, again).first()
    assert second["modelo_versao"] == row["modelo_versao"]
    assert not second["is_champion"] and second["champion_modelo_versao"] == row["modelo_versao"]
    assert second["champion_mape"] == pytest.approx(row["mape"])
    assert ST.read_metrics(spark, cfg.metrics).count() == 2


def test_reports_of_the_stored_tables(spark, trained):
    cfg, row = trained
    paths = J.export_reports(spark, cfg)
    evolution = spark.read.option("header", True).csv(paths[0])
    assert evolution.columns[:3] == ["dt_processamento", "run_id", "rmse"] and evolution.count() >= 1
    metrics, predictions = J.published(spark, cfg)
    from tidecast.plans import reports as R

    best = R.model_benchmark(metrics, predictions).first()
    assert best["modelo_versao"] == row["modelo_versao"] and best["wape"] == pytest.approx(row["wape"], abs=0.01)
    months = J.P.months_of(J.IN.read_panel(spark, cfg.panel))
    assert J.verify(spark, cfg, months, months).where("item = 'geral'").first()["ok"]


def test_command_line():
    from tidecast.cli import arguments

    a = arguments(["retrain", "--root", "x", "--params", '{"n_estimators": "5"}'])
    assert TR.parameters(a.params)["n_estimators"] == 5 and a.run_id == "manual"


def test_queries_train_with_the_defaults(monkeypatch):
    given = []
    for name in ("fresh_path", "consistent", "F", "R", "ST", "TB"):
        monkeypatch.setattr(learning, name, MagicMock())
    monkeypatch.setattr(TR, "assemble", MagicMock())
    monkeypatch.setattr(TR, "score_per_segment", MagicMock())
    monkeypatch.setattr(TR, "train", lambda rows, val, p=None: given.append(p))
    monkeypatch.setattr(TR, "train_per_segment", lambda rows, val, p=None: given.append(p))
    monkeypatch.setattr(J, "prepare", MagicMock())
    monkeypatch.setattr(J, "retrain", lambda spark, cfg: given.append(cfg.params) or MagicMock())
    lab = MagicMock()
    del lab.trained
    for key in ("ML-18", "ML-19"):
        REGISTRY[key].run(lab)
    assert [TR.parameters(p) for p in given] == [TR.DEFAULTS] * 3
