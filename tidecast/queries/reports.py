"""Reports: checked with wider rounding than their presentation default."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidecast.plans import reports as R
from tidecast.queries.base import NOW, Lab, query, stamp
from tidecast.queries.oracle import money_avg, money_sum, sql, wape

D = R.Digits(money=None, pct=4, fine=6, text=4)

W4 = f"round({wape()}, 4)"
MAPE4 = "round(avg(erro_percentual), 4)"
BIAS = money_avg("(saldo_predito - saldo_realizado)")
TS = "strptime(left(dt_processamento, 19), '%Y-%m-%dT%H:%M:%S')"
SINCE = f"{TS} >= TIMESTAMP '{NOW}' - INTERVAL 6 HOURS"
SLOT = f"time_bucket(INTERVAL 15 MINUTES, {TS})"
NEWEST = "ORDER BY dt_processamento DESC, run_id"


def now():
    return F.lit(NOW).cast("timestamp")


def pred(lab: Lab):
    return R.unified(lab.predictions)


def _pred_query(key, fn, body):
    query(key, sql(body))(lambda lab: fn(pred(lab)))


def _met_query(key, fn, body):
    query(key, sql(body))(lambda lab: fn(lab.metrics))


_pred_query("Q01", lambda p: R.overview(p, D), f"""
SELECT ano, mes, segmento, count(*) AS registros, {MAPE4} AS mape_medio_diag, {W4} AS wape_pct,
       {money_avg("saldo_predito")} AS saldo_predito_medio
FROM pred GROUP BY 1, 2, 3""")

_pred_query("Q02", lambda p: R.error_by_segment(p, D), f"""
SELECT segmento, count(*) AS registros, {MAPE4} AS mape_medio_diag, {W4} AS wape_pct,
       {money_avg("erro_absoluto")} AS mae_medio,
       {money_avg("saldo_realizado")} AS saldo_realizado_medio
FROM pred GROUP BY 1""")

_pred_query("Q03", lambda p: R.mape_against_wape(p, D), f"""
SELECT segmento, {MAPE4} AS mape_medio, {W4} AS wape_pct,
       {money_avg("abs(saldo_realizado)")} AS saldo_realizado_medio_abs
FROM pred GROUP BY 1""")

_pred_query("Q04", lambda p: R.seasonality(p, D), f"""
SELECT ano, mes, segmento, count(*) AS n, {MAPE4} AS mape_diag, {W4} AS wape_pct,
       round(stddev_samp(erro_percentual), 4) AS volatilidade_mape
FROM pred GROUP BY 1, 2, 3""")

_pred_query("Q05", lambda p: R.evolution_by_version(p, D), f"""
SELECT modelo_versao, min(dt_processamento) AS treinado_em, count(*) AS registros,
       {MAPE4} AS mape_diag, {W4} AS wape_pct, {money_avg("erro_absoluto")} AS mae
FROM pred GROUP BY 1""")

_pred_query("Q06", R.segment_detail, """
SELECT cliente_id, saldo_predito, saldo_realizado, erro_percentual, modelo_versao, run_id
FROM pred WHERE segmento = 'VAREJO' ORDER BY dt_processamento DESC, cliente_id LIMIT 20""")

_pred_query("Q07", lambda p: R.customer_truth(p, d=D), """
SELECT cliente_id, segmento, ano, mes, saldo_predito, saldo_realizado AS gabarito_saldo_realizado,
       erro_absoluto, round(erro_percentual, 4) AS erro_pct_diag, modelo_versao, run_id,
       dt_processamento
FROM pred ORDER BY dt_processamento DESC, segmento, cliente_id LIMIT 100""")

query("Q08", sql(f"""
SELECT segmento, count(*) AS registros, {money_avg("saldo_predito")} AS media_predito,
       {money_avg("saldo_realizado")} AS media_gabarito, {BIAS} AS vies_medio, {W4} AS wape_pct
FROM pred
WHERE modelo_versao = (SELECT modelo_versao FROM pred ORDER BY dt_processamento DESC LIMIT 1)
GROUP BY 1"""))(lambda lab: R.truth_of_latest_model(pred(lab), lab.metrics, D))

_met_query("Q09", lambda m: R.training_evolution(m, D), """
SELECT run_date, run_id, total_linhas, linhas_adicionadas, data_referencia_lote,
       round(rmse, 4) AS rmse, mae, round(r2, 6) AS r2, round(wape, 6) AS wape,
       round(smape, 6) AS smape, round(mape, 6) AS mape_diag, modelo_versao, dt_processamento
FROM met0""")

_met_query("Q10", lambda m: R.baselines_against_model(m, d=D), f"""
SELECT dt_processamento, run_id, round(wape, 4) AS modelo_wape, naive_wape, media_saldos_wape,
       beats_naive, wape_gain_vs_naive_pp AS ganho_pp_vs_naive
FROM met {NEWEST} LIMIT 10""")

_met_query("Q11", lambda m: R.latest_against_champion(m, d=D), f"""
SELECT dt_processamento, run_id, modelo_versao, round(rmse, 4) AS rmse, round(wape, 4) AS wape,
       is_champion, champion_modelo_versao, round(champion_rmse, 4) AS champion_rmse,
       round(champion_wape, 4) AS champion_wape
FROM met {NEWEST} LIMIT 5""")

_met_query("Q12", lambda m: R.promotion_history(m, D), """
SELECT run_id, modelo_versao, champion_modelo_versao, round(rmse, 4) AS rmse,
       round(wape, 4) AS wape, dt_processamento
FROM met WHERE is_champion""")

_met_query("Q13", lambda m: R.current_champion(m, d=D), f"""
SELECT champion_modelo_versao, round(champion_rmse, 4) AS champion_rmse,
       round(champion_wape, 4) AS champion_wape, dt_processamento
FROM met WHERE is_champion {NEWEST} LIMIT 1""")

query("Q14", sql(f"""
SELECT c.run_id, c.modelo_versao, c.dt_processamento, c.total_linhas AS linhas_treino,
       round(c.rmse, 4) AS rmse, c.mae, round(c.wape, 4) AS wape, round(c.r2, 6) AS r2,
       g.registros_holdout, g.clientes, g.wape_gabarito, g.mae_gabarito, g.vies_medio,
       round(s.wape_varejo, 4) AS wape_varejo, round(s.wape_prime, 4) AS wape_prime,
       round(s.wape_private, 4) AS wape_private, c.naive_wape AS baseline_naive_wape,
       c.media_saldos_wape AS baseline_media_saldos_wape, c.beats_naive,
       c.wape_gain_vs_naive_pp AS ganho_pp_vs_naive
FROM (SELECT * FROM met WHERE is_champion {NEWEST} LIMIT 1) c
LEFT JOIN segwide s USING (run_id)
JOIN (SELECT modelo_versao, count(*) AS registros_holdout, count(DISTINCT cliente_id) AS clientes,
             {W4} AS wape_gabarito, {money_avg("erro_absoluto")} AS mae_gabarito,
             {BIAS} AS vies_medio
      FROM pred GROUP BY 1) g ON g.modelo_versao = c.modelo_versao"""))(
    lambda lab: R.model_benchmark(lab.metrics, pred(lab), D)
)

query("Q15", sql(f"""
SELECT segmento, count(*) AS registros, {W4} AS wape_pct, {MAPE4} AS mape_diag
FROM pred WHERE dt_processamento = (SELECT max(dt_processamento) FROM pred) GROUP BY 1"""))(lambda lab: R.segment_error_latest(pred(lab), lab.metrics, D))

_met_query("Q16", lambda m: R.segment_json_latest(m, D), f"""
SELECT m.run_id, m.modelo_versao, round(m.rmse, 4) AS rmse_global, round(m.wape, 4) AS wape_global,
       round(wape_varejo, 4) AS wape_varejo, round(wape_prime, 4) AS wape_prime,
       round(wape_private, 4) AS wape_private, round(rmse_varejo, 4) AS rmse_varejo,
       round(rmse_prime, 4) AS rmse_prime, round(rmse_private, 4) AS rmse_private
FROM (SELECT * FROM met0 {NEWEST} LIMIT 1) m LEFT JOIN segwide USING (run_id)""")

_met_query("Q17", lambda m: R.segment_wape_series(m, d=D), f"""
SELECT dt_processamento, run_id, round(wape, 4) AS wape_global,
       round(wape_varejo, 4) AS wape_varejo, round(wape_prime, 4) AS wape_prime,
       round(wape_private, 4) AS wape_private, is_champion
FROM met LEFT JOIN segwide USING (run_id) {NEWEST} LIMIT 30""")

_met_query("Q18", lambda m: R.all_segments(m, d=D), """
SELECT dt_processamento, run_id, segmento, round(rmse, 4) AS rmse, round(wape, 4) AS wape,
       round(mape, 4) AS mape_diag, round(r2, 6) AS r2
FROM seg ORDER BY dt_processamento DESC, segmento, run_id LIMIT 200""")

query("Q19", sql("""
SELECT dt_processamento, run_id, segmento, round(wape, 6) AS wape
FROM seg WHERE dt_processamento = (SELECT max(dt_processamento) FROM met0)
ORDER BY seg.wape DESC, segmento LIMIT 1"""))(
    lambda lab: R.worst_segment(lab.metrics).withColumn("wape", F.round("wape", 6))
)

query("Q20", sql(f"""
SELECT strftime(slot, '%Y-%m-%d %H:%M:%S') AS slot_15m, round(rmse, 4) AS rmse,
       round(wape, 4) AS wape, round(mape, 6) AS mape_diag, round(r2, 6) AS r2, total_linhas,
       linhas_adicionadas, modelo_versao, is_champion
FROM (SELECT *, {SLOT} AS slot,
             row_number() OVER (PARTITION BY {SLOT} {NEWEST}) AS pos
      FROM met WHERE {SINCE})
WHERE pos = 1"""))(
    lambda lab: R.latest_run_per_slot(lab.metrics, now(), d=D).withColumn(
        "slot_15m", stamp("slot_15m", "slot_15m")
    )
)

query("Q21", sql(f"""
SELECT strftime(date_trunc('minute', {TS}), '%Y-%m-%d %H:%M:%S') AS processado_em,
       dt_processamento, round(rmse, 4) AS rmse, round(wape, 4) AS wape,
       round(mape, 6) AS mape_diag, linhas_adicionadas, modelo_versao, is_champion
FROM met {NEWEST} LIMIT 60"""))(
    lambda lab: R.runs_by_minute(lab.metrics, d=D).withColumn(
        "processado_em", stamp("processado_em", "processado_em")
    )
)

query("Q22", sql(f"""
SELECT strftime({SLOT}, '%Y-%m-%d %H:%M:%S') AS slot_15m, count(*) AS registros,
       {MAPE4} AS mape_diag, {W4} AS wape_pct, {money_avg("erro_absoluto")} AS mae,
       max(modelo_versao) AS modelo_versao
FROM pred WHERE {SINCE} GROUP BY 1"""))(
    lambda lab: R.error_by_slot(pred(lab), now(), d=D).withColumn(
        "slot_15m", stamp("slot_15m", "slot_15m")
    )
)


def _t(c: str, scale: int = 4) -> str:
    # decimal ties go away from zero on Spark; the nudge keeps binary doubles from falling short
    return (
        f"CAST(CAST(round({c} * (1 + 1e-15::DOUBLE), {scale}) AS DECIMAL(24,{scale})) AS VARCHAR)"
    )


query("Q23", sql(f"""
SELECT 'RETREINO' AS tipo, dt_processamento AS col1, run_id AS col2,
       total_linhas::VARCHAR AS col3, linhas_adicionadas::VARCHAR AS col4, {_t("wape")} AS col5,
       {_t("rmse")} AS col6, {_t("r2", 6)} AS col7, modelo_versao AS col8,
       is_champion::VARCHAR AS col9, coalesce(champion_modelo_versao, '-') AS col10,
       coalesce({_t("champion_wape")}, '-') AS col11
FROM (SELECT * FROM met {NEWEST} LIMIT 15)
UNION ALL
SELECT 'GABARITO_MES', ano::VARCHAR || '-' || lpad(mes::VARCHAR, 2, '0'), segmento,
       count(*)::VARCHAR, {_t(money_avg("saldo_predito"))}, {_t(money_avg("saldo_realizado"))},
       {_t(wape())}, '-', '-', '-', '-', '-'
FROM pred GROUP BY ano, mes, segmento
UNION ALL
SELECT 'SEG_ULTIMO_PROC', segmento, count(*)::VARCHAR, {_t(wape())},
       '-', '-', '-', '-', '-', '-', '-', '-'
FROM pred WHERE dt_processamento = (SELECT max(dt_processamento) FROM pred) GROUP BY segmento"""))(
    lambda lab: R.full_diagnosis(lab.metrics, pred(lab), d=D)
)

_met_query("Q24", lambda m: R.moving_wape(m, d=D), f"""
SELECT dt_processamento, round(rmse, 4) AS rmse, round(wape, 4) AS wape,
       round(avg5, 4) AS wape_media_5, is_champion
FROM (SELECT *, avg(wape) OVER (ORDER BY dt_processamento, run_id
                                ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS avg5 FROM met)
{NEWEST} LIMIT 30""")

_met_query(
    "Q25",
    lambda m: R.runs_with_prefix(m, "lote-").select(
        "run_id", "dt_processamento", F.round("rmse", 4).alias("rmse"), "mae",
        F.round("wape", 6).alias("wape"), "total_linhas", "linhas_adicionadas", "is_champion",
        "data_referencia_lote", "run_date", "champion_modelo_versao",
    ),
    """
SELECT run_id, dt_processamento, round(rmse, 4) AS rmse, mae, round(wape, 6) AS wape, total_linhas,
       linhas_adicionadas, is_champion, data_referencia_lote, run_date, champion_modelo_versao
FROM met WHERE run_id LIKE 'lote-%'""",
)

_met_query("Q26", lambda m: R.evolution_latest(m, d=D), f"""
SELECT dt_processamento, run_id, round(rmse, 4) AS rmse, round(wape, 4) AS wape,
       round(mape, 6) AS mape_diag, linhas_adicionadas, modelo_versao, is_champion
FROM met {NEWEST} LIMIT 30""")

query("Q27", sql("""
SELECT cliente_id, segmento, ano, mes, saldo_predito, saldo_realizado AS gabarito, erro_absoluto,
       modelo_versao, run_id
FROM pred WHERE dt_processamento = (SELECT max(dt_processamento) FROM pred)
ORDER BY segmento, cliente_id LIMIT 100"""))(lambda lab: R.customer_sample_latest(pred(lab), lab.metrics, d=D))

_pred_query("Q28", R.treasury_totals, f"""
SELECT segmento, ano, mes, {money_sum("saldo_predito")} AS saldo_predito_total,
       count(*) AS clientes
FROM pred GROUP BY 1, 2, 3""")

_pred_query("Q29", lambda p: R.truth_sample(p, d=D), """
SELECT cliente_id, segmento, saldo_predito AS predito, saldo_realizado AS gabarito,
       erro_absoluto AS erro_abs, modelo_versao, run_id
FROM pred ORDER BY dt_processamento DESC, cliente_id LIMIT 50""")

_pred_query("Q30", R.unified_sample, """
SELECT saldo_predito, saldo_realizado, segmento, dt_processamento
FROM pred ORDER BY dt_processamento DESC, cliente_id LIMIT 5""")

_pred_query("Q31", R.rows_by_partition, """
SELECT ano, mes, segmento, count(*) AS registros FROM pred GROUP BY 1, 2, 3""")

_pred_query("Q32", lambda p: R.truth_by_month_and_segment(p, D), f"""
SELECT ano, mes, segmento, count(*) AS registros, {money_avg("saldo_predito")} AS media_predito,
       {money_avg("saldo_realizado")} AS media_gabarito, {W4} AS wape_pct
FROM pred GROUP BY 1, 2, 3""")

_met_query("Q33", lambda m: R.recent_promotions(m, d=D), f"""
SELECT run_id, round(wape, 4) AS wape, round(r2, 6) AS r2, total_linhas, is_champion, modelo_versao
FROM met {NEWEST} LIMIT 5""")

_met_query("Q34", lambda m: R.recent_ingests(m, d=D), f"""
SELECT run_date, run_id, linhas_adicionadas, round(rmse, 4) AS rmse, round(mape, 6) AS mape,
       modelo_versao
FROM met0 {NEWEST} LIMIT 20""")

_met_query(
    "Q35",
    lambda m: R.new_column_sample(m).select(
        "dt_processamento",
        "run_id",
        F.round("wape", 6).alias("wape"),
        F.round(R.seg_metric("VAREJO", "wape"), 6).alias("wape_varejo"),
    ),
    f"""
SELECT dt_processamento, run_id, round(wape, 6) AS wape, round(wape_varejo, 6) AS wape_varejo
FROM met0 LEFT JOIN segwide USING (run_id) {NEWEST} LIMIT 5""",
)

_met_query(
    "RPT-1",
    lambda m: R.metric_evolution(m)
    .withColumn("rmse", F.round("rmse", 4))
    .withColumn("wape", F.round("wape", 6))
    .withColumn("r2", F.round("r2", 6)),
    """
SELECT dt_processamento, run_id, round(rmse, 4) AS rmse, round(wape, 6) AS wape, mae,
       round(r2, 6) AS r2, linhas_adicionadas, total_linhas, modelo_versao, is_champion,
       data_referencia_lote
FROM met""",
)

_pred_query("RPT-2", lambda p: R.truth_by_month(p, D), f"""
SELECT ano, mes, count(*) AS registros, {money_avg("saldo_predito")} AS media_predito,
       {money_avg("saldo_realizado")} AS media_gabarito, coalesce({W4}, 0) AS wape_pct
FROM pred GROUP BY 1, 2""")

_pred_query("RPT-3", R.detail_sample, """
SELECT cliente_id, segmento, data_referencia, ano, mes, saldo_predito, saldo_realizado,
       erro_absoluto, modelo_versao, run_id
FROM pred ORDER BY data_referencia, cliente_id LIMIT 500""")
