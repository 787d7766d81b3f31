"""Preparation, training and promotion.

Forecasts of trained trees have no SQL form, but what surrounds them has: which
rows are tested, their actuals and baselines, that errors follow from forecasts.
Training has the default parameters: number of trees, depth and patience.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidecast import jobs as J
from tidecast import schemas as S
from tidecast.functions import scoring as SC
from tidecast.operators import boosting as B
from tidecast.operators import features as FT
from tidecast.operators import label as L
from tidecast.operators import metrics as MT
from tidecast.operators import panel as P
from tidecast.operators import registry as RG
from tidecast.operators import train as TR
from tidecast.plans import reports as R
from tidecast.queries.aggregates import rounded_metrics, sql_rounded
from tidecast.queries.base import Lab, day, query
from tidecast.queries.oracle import MEAN6, metrics, sql, wape
from tidecast.session import fresh_path
from tidecast.sinks import tables as TB
from tidecast.sources import tables as ST

KEYS = "cliente_id, strftime(data_referencia, '%Y-%m-%d') AS data_referencia"
SQ = " + ".join(f"(saldo_m{i} - {MEAN6}) * (saldo_m{i} - {MEAN6})" for i in range(1, 7))
DERIVED = f"""{MEAN6} AS media_saldo_historico, saldo_m1 - saldo_m6 AS tendencia_saldo,
       sqrt(({SQ}) / 5) AS volatilidade_saldo,
       (saldo_m1 - saldo_m2) / (abs(saldo_m2) + 1) AS variacao_pct_saldo,
       saldo_m1 / (renda_mensal + 1) AS saldo_por_renda,
       valor_creditos_mes / (valor_debitos_mes + 1) AS credito_debito_ratio"""


@query("ML-1", sql(f"SELECT {KEYS}, {DERIVED} FROM lab"))
def _(lab: Lab):
    return FT.derived_features(lab.labelled).select("cliente_id", day(), *FT.DERIVED)


@query("ML-2", sql("SELECT customer_id, strftime(period, '%Y-%m-%d') AS period, " + ", ".join(
    f"round(coalesce(saldo_m{i}, (SELECT median(saldo_m{i}) FROM lagm_c)), 4) AS saldo_m{i}" for i in range(1, 7)
) + " FROM lagm_c"))
def _(lab: Lab):
    months = P.with_lags(P.customer_months(lab.bank.transactions, lab.bank.accounts))
    filled = FT.fill_lags(months, FT.lag_medians(months))
    return filled.select("customer_id", day("period"), *[F.round(c, 4).alias(c) for c in S.LAGS])


TRIMMED = "(SELECT * FROM lab WHERE saldo_m1 <= (SELECT quantile_cont(saldo_m1, 0.99) FROM lab))"


@query("ML-3", sql(f"SELECT {KEYS}, saldo_m1 FROM {TRIMMED}"))
def _(lab: Lab):
    rows = lab.labelled
    return FT.trim_upper(rows, FT.trim_cut(rows)).select("cliente_id", day(), "saldo_m1")


@query("ML-4", sql(f"""
SELECT {KEYS}, segmento, (dense_rank() OVER (ORDER BY segmento) - 1)::INTEGER AS x_segmento,
       (dense_rank() OVER (ORDER BY uf) - 1)::INTEGER AS x_uf,
       (dense_rank() OVER (ORDER BY genero) - 1)::INTEGER AS x_genero
FROM lab"""))
def _(lab: Lab):
    labels = FT.label_values(lab.labelled)
    codes = [FT.label_code(c, labels[c]).alias(f"x_{c}") for c in FT.CATEGORICAL]
    return lab.labelled.select("cliente_id", day(), "segmento", *codes)


def _scaled(source: str, fitted: str) -> str:
    """Rows of ``source`` scaled by mean and population deviation of the trimmed ``fitted``."""
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in FT.SCALED)
    cols = ", ".join(f"round((r.{c} - f.m_{c}) / f.s_{c}, 6) AS x_{c}" for c in FT.SCALED)
    return f"""
SELECT cliente_id, strftime(data_referencia, '%Y-%m-%d') AS data_referencia, {cols}
FROM (SELECT *, {DERIVED} FROM {source}) r,
     (SELECT {stats} FROM (SELECT *, {DERIVED} FROM {fitted})
      WHERE saldo_m1 <= (SELECT quantile_cont(saldo_m1, 0.99) FROM {fitted})) f"""


def scaled_columns(df):
    return df.select("cliente_id", day(), *[F.round(f"x_{c}", 6).alias(f"x_{c}") for c in FT.SCALED])


@query("ML-5", sql(_scaled(TRIMMED, "lab")))
def _(lab: Lab):
    return scaled_columns(FT.transform(lab.labelled, FT.fit(lab.labelled), training=True))


@query("ML-6", sql(_scaled("(SELECT * FROM panel WHERE ano >= 2000)", "(SELECT * FROM lab WHERE ano < 2000)")))
def _(lab: Lab):
    fitted = FT.fit(lab.labelled.where("ano < 2000"))
    again = FT.FeatureParams.from_json(fitted.to_json())
    return scaled_columns(FT.transform(lab.panel.where("ano >= 2000"), again))


def split_sql(rows: str) -> str:
    """The rows with their split; both dates are quantiles of these rows."""
    d, nd = (f"date_diff('day', DATE '1970-01-01', {c})" for c in ("data_referencia", "proxima_data"))
    return f"""
SELECT s.*, CASE WHEN d >= tc THEN 'test' WHEN nd < tc AND d < vc THEN 'train' WHEN nd < tc THEN 'val' END AS split
FROM (SELECT *, {d} AS d, {nd} AS nd FROM {rows}) s,
     (SELECT quantile_cont({d}, 0.8) AS tc FROM {rows}),
     (SELECT quantile_cont({d}, 0.85) AS vc FROM {rows}, (SELECT quantile_cont({d}, 0.8) AS c FROM {rows})
      WHERE {d} < c AND {nd} < c)"""


TESTED = f"(SELECT * FROM ({split_sql(TRIMMED)}) WHERE split = 'test')"


@query("ML-7", sql(f"SELECT {KEYS}, split FROM ({split_sql('lab')})"))
def _(lab: Lab):
    return L.temporal_split(lab.labelled).select("cliente_id", day(), "split")


@query("ML-8", sql(f"""
SELECT segmento, {sql_rounded()} FROM (
  SELECT segmento, {metrics("saldo_realizado", "base_media")} FROM scored GROUP BY 1)"""))
def _(lab: Lab):
    cols = SC.metric_aggregates("saldo_realizado", "base_media")
    return rounded_metrics(lab.scored.groupBy("segmento").agg(*cols))


@query("ML-9", sql(f"""
SELECT 'naive_saldo_m1' AS baseline, {sql_rounded()}
FROM (SELECT {metrics("saldo_realizado", "base_naive")} FROM scored)
UNION ALL SELECT 'media_saldos_m1_m6', {sql_rounded()}
FROM (SELECT {metrics("saldo_realizado", "base_media")} FROM scored)"""))
def _(lab: Lab):
    return rounded_metrics(MT.baseline_metrics(lab.scored))


@query("ML-10", sql("""
SELECT run_id, round(wape, 4) AS modelo_wape, naive_wape, beats_naive, wape_gain_vs_naive_pp,
       media_saldos_wape, wape < a_wape - 1e-9 AS beats_media_saldos, round(n_rmse, 4) AS naive_rmse
FROM met"""))
def _(lab: Lab):
    return lab.metrics.select(
        "run_id",
        R.base_metric("modelo_wape").alias("modelo_wape"),
        R.base_metric("naive_wape").alias("naive_wape"),
        R.base_metric("beats_naive", "boolean").alias("beats_naive"),
        R.base_metric("wape_gain_vs_naive_pp").alias("wape_gain_vs_naive_pp"),
        R.base_metric("media_saldos_wape").alias("media_saldos_wape"),
        R.base_metric("beats_media_saldos", "boolean").alias("beats_media_saldos"),
        F.round(R.base_metric("baselines.naive_saldo_m1.rmse"), 4).alias("naive_rmse"),
    )


def prepared(lab: Lab):
    """Training, validation and test rows, and the model; made once for a lab."""
    if not hasattr(lab, "trained"):
        ready = lab._store(TR.assemble(J.prepare(lab.labelled)), "ready")
        rows, val, test = (ready.where(F.col("split") == s) for s in ("train", "val", "test"))
        lab.trained = rows, val, test, TR.train(rows, val)
    return lab.trained


def consistent(scored):
    """What a check can know of a forecast; the months' sum is moved off the ties of its rounding."""
    error = F.abs(F.col("saldo_realizado") - F.col("saldo_predito"))
    near = F.abs(F.col("erro_absoluto") - error) <= 0.0001 + 1e-9 * error
    return scored.select(
        "cliente_id", day(), "segmento", F.round("saldo_realizado", 4).alias("saldo_realizado"),
        F.round("base_naive", 4).alias("base_naive"), F.round(F.col("base_media") * 6 + 0.0031, 1).alias("soma_meses"), near.alias("erro_confere"),
    )


CONSISTENT = sql(f"""
SELECT {KEYS}, segmento, round({S.LABEL}, 4) AS saldo_realizado, round(saldo_m1, 4) AS base_naive,
       round({MEAN6} * 6 + 0.0031::DOUBLE, 1) AS soma_meses, TRUE AS erro_confere FROM {TESTED}""")


@query("ML-11", CONSISTENT)
def _(lab: Lab):
    _, _, test, model = prepared(lab)
    return consistent(TR.score(model, test))


@query("ML-12", sql(f"""
SELECT {KEYS}, CASE WHEN ('0x' || left(md5(cliente_id || '|' || strftime(data_referencia, '%Y-%m-%d') || '|42'), 8))
                           ::BIGINT % 10000 < 2000 THEN 'test' ELSE 'train' END AS split
FROM lab"""))
def _(lab: Lab):
    return L.hash_split(lab.labelled).select("cliente_id", day(), "split")


@query("ML-13", "SELECT feature, TRUE AS entre_0_e_1, 1.0::DOUBLE AS soma FROM (VALUES " + ", ".join(f"('{c}')" for c in FT.FEATURES) + ") v(feature)")
def _(lab: Lab):
    ranking = TR.importance(prepared(lab)[-1], lab.spark)
    total = ranking.agg(F.round(F.sum("importance"), 6)).scalar()
    return ranking.select("feature", F.col("importance").between(0, 1).alias("entre_0_e_1"), total.alias("soma"))


@query("TOP-2", f"SELECT i + 1 AS posicao, TRUE AS em_ordem FROM range({TR.TOP_FEATURES}) r(i)")
def _(lab: Lab):
    ranking = TR.importance(prepared(lab)[-1], lab.spark)
    top = TR.top_features(ranking).select(F.col("feature").alias("nome"), F.col("importance").alias("valor"))
    above = ranking.join(top, F.col("importance") > F.col("valor")).groupBy("nome").agg(F.count(F.lit(1)).alias("maiores"))
    order = Window.orderBy(F.desc("valor"), "nome")  # ten rows
    placed = top.join(above, "nome", "left").withColumn("posicao", F.row_number().over(order).cast("bigint"))
    return placed.select("posicao", (F.coalesce("maiores", F.lit(0)) < F.col("posicao")).alias("em_ordem"))


@query("ML-14", sql("""
SELECT cliente_id, data_referencia, CASE WHEN ano > 1997 THEN saldo_predito END AS saldo_predito,
       CASE WHEN ano > 1997 THEN saldo_realizado END AS saldo_realizado,
       CASE WHEN ano <= 1997 THEN saldo_predito END AS saldo_previsto,
       CASE WHEN ano <= 1997 THEN saldo_realizado END AS saldo_real,
       uf, dt_processamento, modelo_versao, run_id, erro_absoluto, erro_percentual, ano, mes, segmento
FROM pred"""))
def _(lab: Lab):
    return TB.conform(lab.predictions, S.PREDICTIONS)


def _canonical() -> str:
    return " || '|' || ".join(
        f"'{m}=' || coalesce(CAST(CAST({m} AS DECIMAL(38,6)) AS VARCHAR), 'null')" for m in sorted(S.METRIC_NAMES)
    )


@query("ML-15", sql(f"SELECT run_id, 'gbt-saldo-v1-' || left(md5({_canonical()}), 8) AS versao FROM met0"))
def _(lab: Lab):
    return lab.metrics.select("run_id", TR.model_version().alias("versao"))


@query("ML-16", sql("SELECT run_id, reason AS promotion_reason, is_champion AS promoted FROM met"))
def _(lab: Lab):
    return RG.gate_history(lab.metrics).select("run_id", "promotion_reason", "promoted")


@query("ML-17", sql("""
SELECT run_id, modelo_versao, round(wape, 6) AS wape, total_linhas, dt_processamento AS promoted_at,
       lead(dt_processamento) OVER (ORDER BY dt_processamento) AS replaced_at
FROM met WHERE is_champion"""))
def _(lab: Lab):
    h = RG.champion_history(lab.metrics)
    return h.drop("r2").withColumn("wape", F.round("wape", 6))


@query("ML-18", sql(f"""
SELECT 'retrain-1' AS run_id, (SELECT count(*) FROM lab) AS total_linhas, 0::BIGINT AS linhas_adicionadas,
       (SELECT strftime(max(data_referencia), '%Y-%m-%d') FROM lab) AS data_referencia_lote,
       round({wape('abs(' + S.LABEL + ' - saldo_m1)', S.LABEL)}, 4) AS naive_wape, count(*) AS linhas_previstas FROM {TESTED}"""))
def _(lab: Lab):
    cfg = J.Config(root=fresh_path(lab.spark, "job"), run_id="retrain-1")
    TB.replace_panel(lab.panel, cfg.panel)
    row = J.retrain(lab.spark, cfg)
    scored = ST.read_predictions(lab.spark, cfg.predictions).agg(F.count(F.lit(1))).scalar()
    naive = F.round(R.base_metric("naive_wape"), 4).alias("naive_wape")
    return row.select("run_id", "total_linhas", "linhas_adicionadas", "data_referencia_lote", naive, scored.alias("linhas_previstas"))


@query("ML-19", CONSISTENT)
def _(lab: Lab):
    rows, val, test, model = prepared(lab)
    return consistent(TR.score_per_segment(TR.train_per_segment(rows, val), test, model))


@query("SNK-12", sql(f"SELECT {KEYS}, TRUE AS igual FROM {TESTED}"))
def _(lab: Lab):
    _, _, test, model = prepared(lab)
    path = fresh_path(lab.spark, "champion")
    model.save(lab.spark, path)
    back = TR.score(B.Booster.load(lab.spark, path), test).select("cliente_id", "data_referencia", F.col("saldo_predito").alias("lido"))
    return TR.score(model, test).join(back, ["cliente_id", "data_referencia"]).select("cliente_id", day(), (F.col("lido") == F.col("saldo_predito")).alias("igual"))
