import pytest
from conftest import rows

from tidecast.operators import registry as RG

COLS = (
    "wape double, r2 double, total_linhas bigint, champion_wape double, champion_r2 double, "
    "champion_total_linhas bigint"
)


@pytest.mark.parametrize(
    "new, champ, reason",
    [
        ((50.0, 0.1, 10), (None, None, None), "primeiro_champion"),
        ((20.45, 0.8453, 12168), (24.29, 0.8368, 6819), "criterios_atendidos"),
        ((19.5, 0.9, 100), (20.0, 0.9, 100), "wape"),
        ((10.0, 0.88, 100), (20.0, 0.90, 100), "r2"),
        ((10.0, 0.9, 8000), (20.0, 0.9, 12000), "total_linhas"),
        ((19.0, 0.89, 100), (20.0, 0.9, 100), "criterios_atendidos"),
        ((19.5, 0.5, 1), (20.0, 0.9, 100), "wape"),
    ],
)
def test_gate(spark, new, champ, reason):
    got = RG.evaluate(spark.createDataFrame([new + champ], COLS)).first()
    assert got["promotion_reason"] == reason
    assert got["promoted"] == (reason in (RG.FIRST, RG.PASSED))


def brute(runs):
    champ, won = None, []
    for rid, wape, r2, n in runs:
        ok = champ is None or (
            wape <= champ[0] - 1.0 + 1e-9 and not r2 < champ[1] - 0.01 - 1e-9 and n >= champ[2]
        )
        if ok:
            champ = (wape, r2, n)
            won.append(rid)
    return won


def log(spark, runs):
    data = [
        (f"2024-01-{i + 1:02d}T00:00:00+00:00", rid, f"v{i}", w, 1.0, 2.0, r2, n)
        for i, (rid, w, r2, n) in enumerate(runs)
    ]
    return spark.createDataFrame(
        data,
        "dt_processamento string, run_id string, modelo_versao string, wape double, rmse double, mape double, "
        "r2 double, total_linhas bigint",
    )


RUNS = [
    ("a", 30.0, 0.5, 10), ("b", 29.5, 0.9, 20), ("c", 28.0, 0.6, 9), ("d", 27.0, 0.6, 30),
    ("e", 20.0, 0.55, 40), ("f", 26.0, 0.59, 40), ("g", 24.0, 0.7, 41), ("h", 24.0, 0.7, 41),
]


def test_replay_against_brute_force(spark):
    assert [r["run_id"] for r in RG.promotions(log(spark, RUNS))] == brute(RUNS)
    assert RG.promotions(log(spark, RUNS).where("false")) == []


def test_standing_champion(spark):
    from tidecast import schemas as S
    from tidecast.sinks.tables import conform

    runs = conform(log(spark, RUNS), S.METRICS).drop(
        "is_champion", "champion_modelo_versao", "champion_rmse", "champion_wape", "champion_mape"
    )
    got = {r["run_id"]: (r["is_champion"], r["champion_wape"]) for r in RG.replay_champions(runs).collect()}
    won, champ = brute(RUNS), None
    for rid, wape, _, _ in RUNS:
        champ = wape if rid in won else champ
        assert got[rid] == (rid in won, champ)


def test_as_of(spark):
    from pyspark.sql import functions as F

    runs = log(spark, RUNS).withColumn("is_champion", F.col("run_id").isin(brute(RUNS)))
    history = RG.champion_history(runs)
    at = spark.createDataFrame(
        [("2023-12-31T00:00:00+00:00",), ("2024-01-01T00:00:00+00:00",), ("2024-01-05T12:00:00+00:00",),
         ("2024-02-01T00:00:00+00:00",)],
        "t string",
    )
    got = {r["t"]: r["champion_run_id"] for r in RG.champion_as_of(at, "t", history).collect()}
    assert list(got[k] for k in sorted(got)) == [None, "a", "d", brute(RUNS)[-1]]
    assert rows(RG.current_champion(runs), "run_id") == [(brute(RUNS)[-1],)]
