"""Data quality and reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidecast.operators import panel as P
from tidecast.operators import quality as QA
from tidecast.operators import reconcile as RC
from tidecast.queries.base import Lab, day, query
from tidecast.queries.joins import month_diffs
from tidecast.queries.oracle import MEAN6, sql, wape
from tidecast.queries.reports import pred
from tidecast.queries.tables import run_phases
from tidecast.session import materialise

DIFFS = """
  SELECT * FROM (
    SELECT coalesce(e.customer_id, a.customer_id) AS customer_id, coalesce(e.period, a.period) AS period,
           unnest(['qtd', 'saldo']) AS campo,
           unnest([e.qtd_transacoes_mes::VARCHAR, CAST(e.saldo_raw AS DECIMAL(24,4))::VARCHAR]) AS esperado,
           unnest([a.qtd_transacoes_mes::VARCHAR, CAST(a.saldo_raw AS DECIMAL(24,4))::VARCHAR]) AS obtido
    FROM custm e FULL JOIN custm_c a ON e.customer_id = a.customer_id AND e.period = a.period)
  WHERE esperado IS DISTINCT FROM obtido"""
TEXT = "campo || ': expected=' || coalesce(esperado, 'None') || ' actual=' || coalesce(obtido, 'None')"


@query("QA-1", sql(f"""
SELECT customer_id, strftime(period, '%Y-%m-%d') AS period, {TEXT} AS diff FROM ({DIFFS})"""))
def _(lab: Lab):
    return month_diffs(lab).select("customer_id", day("period"), RC.diff_text().alias("diff"))


@query("QA-2", sql(f"""
SELECT FALSE AS passed, (SELECT count(*) FROM ({DIFFS})) AS diff_count, TRUE AS truncated,
       string_agg(t, ' ; ' ORDER BY customer_id, period, campo) AS diffs
FROM (SELECT *, {TEXT} AS t FROM ({DIFFS}) ORDER BY customer_id, period, campo LIMIT 20)
UNION ALL SELECT TRUE, 0, FALSE, ''"""))
def _(lab: Lab):
    key = ["customer_id", "period"]
    diffs = materialise(month_diffs(lab), "diffs")
    none = diffs.where("campo = 'outro'")
    out = RC.summarise(diffs, key).union(RC.summarise(none, key))
    return out.withColumn("diffs", F.array_join("diffs", " ; "))


def _months(frame: str) -> str:
    return f"(SELECT DISTINCT strftime(data_referencia, '%Y-%m') AS mes_ref FROM {frame})"


CHECK_SIZES = f"""
  SELECT count(*) AS e, count(s.mes_ref) AS n, count(*) - count(t.mes_ref) AS f,
         (SELECT count(*) FROM met0) AS r,
         (SELECT count(*) FROM (SELECT DISTINCT ano, mes, segmento FROM pred)) AS p
  FROM {_months("panel")} w LEFT JOIN {_months("panel_c")} s USING (mes_ref)
  LEFT JOIN {_months("lab")} t USING (mes_ref)"""


@query("QA-3", sql(f"""
SELECT unnest(['lotes_enviados', 'meses_no_treino', 'metricas', 'predicoes', 'geral']) AS item,
       unnest([n >= e, f = 0, r > 0, p > 0, n >= e AND f = 0 AND r > 0 AND p > 0]) AS ok,
       unnest([n::VARCHAR || '/' || e::VARCHAR, f::VARCHAR, r::VARCHAR, p::VARCHAR, '']) AS detalhe
FROM ({CHECK_SIZES})"""))
def _(lab: Lab):
    return QA.processing_checklist(
        P.months_of(lab.panel),
        P.months_of(lab.panel_c),
        P.months_of(lab.labelled),
        lab.metrics,
        lab.scored.select("ano", "mes", "segmento").distinct(),
    )


@query("QA-4", sql("""
SELECT *, dataset_fingerprint IS DISTINCT FROM lag(dataset_fingerprint) OVER (ORDER BY dt_processamento) AS mudou
FROM (SELECT run_id, dt_processamento,
             left(sha256(total_linhas::VARCHAR || '|' || data_referencia_lote || 'T00:00:00'), 16)
               AS dataset_fingerprint FROM met0)"""))
def _(lab: Lab):
    return QA.fingerprint_drift(lab.metrics)


@query("QA-5", sql(f"""
SELECT run_id, modelo_versao, round(w, 6) AS wape_publicado, round(wape, 6) AS wape_treino, round(w - wape, 6) AS desvio_pp
FROM (SELECT run_id, modelo_versao, {wape()} AS w FROM (
  SELECT * REPLACE (CASE WHEN run_id = (SELECT max(run_id) FROM pred) THEN erro_absoluto * 2 ELSE erro_absoluto END AS erro_absoluto)
  FROM pred) GROUP BY 1, 2) JOIN met USING (run_id, modelo_versao)
WHERE w - wape > 2"""))
def _(lab: Lab):
    p = pred(lab)  # the last run's published errors are twice those it was trained with
    last = F.col("run_id") == p.agg(F.max("run_id")).scalar()
    drifted = p.withColumn("erro_absoluto", F.when(last, F.col("erro_absoluto") * 2).otherwise(F.col("erro_absoluto")))
    out = QA.wape_drift(drifted, lab.metrics)
    return out.withColumns({c: F.round(c, 6) for c in ("wape_publicado", "wape_treino", "desvio_pp")})


@query("QA-6", sql("""
SELECT run_id, count(DISTINCT cliente_id) AS clientes, (SELECT count(*) FROM customer) AS base,
       count(DISTINCT cliente_id) / (SELECT count(*) FROM customer) AS cobertura
FROM pred GROUP BY 1"""))
def _(lab: Lab):
    return QA.coverage(lab.predictions, lab.bank.customers)


@query("QA-7", sql(f"""
SELECT s.cliente_id, strftime(s.data_referencia, '%Y-%m-%d') AS data_referencia, s.segmento, s.saldo_predito,
       p.media AS media_historico, s.saldo_predito < p.media * 1.0::DOUBLE AS abaixo_media,
       s.saldo_predito < 0 AS abaixo_limiar
FROM scored s JOIN (SELECT cliente_id, data_referencia, {MEAN6} AS media FROM panel) p
  USING (cliente_id, data_referencia)
WHERE s.saldo_predito < p.media * 1.0::DOUBLE OR s.saldo_predito < 0"""))
def _(lab: Lab):
    return QA.drop_alerts(pred(lab), lab.panel)


@query("QA-8", sql("""
SELECT cliente_id, segmento, ano, mes, saldo_predito, round(corte, 6) AS corte, modelo_versao, run_id
FROM (SELECT * FROM pred WHERE modelo_versao = 'blend-saldo-v1-2000')
JOIN (SELECT segmento, quantile_cont(saldo_predito, 0.8) AS corte FROM pred
      WHERE modelo_versao = 'blend-saldo-v1-2000' GROUP BY 1) USING (segmento)
WHERE saldo_predito > corte"""))
def _(lab: Lab):
    return QA.campaign_snapshot(pred(lab), "blend-saldo-v1-2000").withColumn("corte", F.round("corte", 6))


@query("QA-9", sql("""
SELECT run_id, validacao, CASE validacao WHEN 'validated' THEN 0 ELSE 1 END::INTEGER AS diff_count,
       CASE WHEN validacao <> 'validated' THEN 'status: expected=validated actual=' || validacao END AS diff,
       CASE validacao WHEN 'validated' THEN 'success' ELSE 'failed' END AS status
FROM (SELECT run_id, CASE WHEN linhas_adicionadas >= 10 THEN 'validated' ELSE 'no_input' END AS validacao FROM met0)"""))
def _(lab: Lab):
    return QA.finalise(run_phases(lab))


@query("QA-10", sql("""
SELECT ano, round(quantile_cont(dias, 0.5), 6) AS p50_dias, round(quantile_cont(dias, 0.95), 6) AS p95_dias,
       count(*) AS registros
FROM (SELECT ano, (epoch(strptime(left(dt_processamento, 19), '%Y-%m-%dT%H:%M:%S'))
                   - epoch(data_referencia::TIMESTAMP)) / 86400.0::DOUBLE AS dias FROM pred)
GROUP BY 1"""))
def _(lab: Lab):
    out = QA.latency_percentiles(lab.predictions)
    return out.withColumns({c: F.round(c, 6) for c in ("p50_dias", "p95_dias")})


@query("QA-11", sql("""
SELECT run_id, dt_processamento, round(wape, 6) AS wape,
       round(wape - lag(wape) OVER (ORDER BY dt_processamento), 6) AS delta_wape,
       round(stddev_samp(wape) OVER (ORDER BY dt_processamento ROWS UNBOUNDED PRECEDING), 6) AS desvio_wape
FROM met0"""))
def _(lab: Lab):
    out = QA.stability(lab.metrics)
    return out.withColumns({c: F.round(c, 6) for c in ("wape", "delta_wape", "desvio_wape")})


@query("QA-12", sql("""
SELECT run_id, data_referencia_lote FROM met0
WHERE data_referencia_lote >= strftime(DATE '2001-06-30' - INTERVAL 24 MONTHS, '%Y-%m-%d')"""))
def _(lab: Lab):
    as_of = F.lit("2001-06-30").cast("date")
    return QA.retained(lab.metrics, as_of, date="data_referencia_lote").select("run_id", "data_referencia_lote")


