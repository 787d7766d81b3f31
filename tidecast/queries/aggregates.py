"""Aggregations, windows, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidecast import schemas as S
from tidecast.functions import calendar as C
from tidecast.functions import money as M
from tidecast.operators import features as FT
from tidecast.operators import merge as MG
from tidecast.operators import metrics as MT
from tidecast.operators import panel as P
from tidecast.operators import quality as QA
from tidecast.operators.quantiles import exact_quantiles, quantile_of_counts
from tidecast.plans import reports as R
from tidecast.plans import usecases as U
from tidecast.queries.base import Lab, day, query, stamp
from tidecast.queries.oracle import LAGS, metrics, money_avg, money_sum, sql, wape
from tidecast.queries.reports import pred

ROUND = {"rmse": 4, "mae": 6, "r2": 6, "wape": 6, "smape": 6, "mape": 6}


def rounded_metrics(df, prefix=""):
    return df.withColumns({prefix + k: F.round(prefix + k, n) for k, n in ROUND.items()})


def sql_rounded(prefix: str = "") -> str:
    return ", ".join(f"round({prefix}{k}, {n}) AS {prefix}{k}" for k, n in ROUND.items())


def one_row(lab: Lab, values: dict):
    """Scalars found by a job, as a one-row frame."""
    return lab.spark.range(1).select(*[F.lit(v).cast("double").alias(k) for k, v in values.items()])


@query("AGG-1", sql("""
SELECT customer_id, account_id, strftime(period, '%Y-%m-%d') AS period, saldo_d::DOUBLE AS saldo_conta,
       cred_d::DOUBLE AS valor_creditos_mes, deb_d::DOUBLE AS valor_debitos_mes,
       qtd AS qtd_transacoes_mes
FROM accm_c"""))
def _(lab: Lab):
    return P.account_month_report(lab.bank.transactions, lab.bank.accounts).withColumn("period", day("period"))


@query("AGG-2", sql("""
SELECT customer_id, strftime(period, '%Y-%m-%d') AS period, saldo_raw, valor_creditos_mes,
       valor_debitos_mes, qtd_transacoes_mes FROM custm_c"""))
def _(lab: Lab):
    return P.customer_months(lab.bank.transactions, lab.bank.accounts).withColumn("period", day("period"))


@query("AGG-3", sql("""
SELECT customer_id, a.n AS qtd_produtos_ativos, l.n AS qtd_emprestimos
FROM (SELECT customer_id, count(*)::INTEGER AS n FROM bank_acc WHERE account_status = 'active' GROUP BY 1) a
FULL JOIN (SELECT customer_id, count(*)::INTEGER AS n FROM bank_loan GROUP BY 1) l USING (customer_id)"""))
def _(lab: Lab):
    return P.active_accounts(lab.bank.accounts).join(P.active_loans(lab.bank.loans), "customer_id", "full_outer")


@query("AGG-4", sql("SELECT cliente_id, count(*) AS linhas FROM panel GROUP BY 1"))
def _(lab: Lab):
    return lab.panel.groupBy("cliente_id").agg(F.count(F.lit(1)).alias("linhas"))


@query("AGG-5", sql("SELECT customer_id, max(med_cred) AS mediana_creditos FROM hist GROUP BY 1"))
def _(lab: Lab):
    months = P.complete_lags(P.with_lags(P.customer_months(lab.bank.transactions, lab.bank.accounts, None)))
    return months.groupBy("customer_id").agg(F.median("valor_creditos_mes").alias("mediana_creditos"))


@query("AGG-6", sql("""
SELECT """ + ", ".join(f"round(median(saldo_m{i}), 6) AS saldo_m{i}" for i in range(1, 7)) + " FROM lab"))
def _(lab: Lab):
    return one_row(lab, {c: round(v, 6) for c, v in FT.lag_medians(lab.labelled).items()})


@query("AGG-7", sql("""
SELECT round(quantile_cont(saldo_m1, 0.99), 6) AS corte_saldo,
       round(quantile_cont(date_diff('day', DATE '1970-01-01', data_referencia), 0.8), 6) AS corte_teste,
       round(quantile_cont(date_diff('day', DATE '1970-01-01', data_referencia), 0.85), 6) AS corte_val
FROM lab"""))
def _(lab: Lab):
    cut = exact_quantiles(lab.labelled, {"c": (F.col("saldo_m1"), 0.99)})["c"]
    days = lab.labelled.groupBy(F.unix_date("data_referencia").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    return days.agg(
        F.lit(round(cut, 6)).alias("corte_saldo"),
        F.round(quantile_of_counts("d", 0.8, "n"), 6).alias("corte_teste"),
        F.round(quantile_of_counts("d", 0.85, "n"), 6).alias("corte_val"),
    )


@query("AGG-8", sql(f"""
SELECT {sql_rounded()} FROM (SELECT {metrics("saldo_realizado", "saldo_predito")} FROM scored)"""))
def _(lab: Lab):
    return rounded_metrics(MT.holdout_metrics(lab.scored))


@query("AGG-9", sql(f"""
SELECT segmento, registros, {sql_rounded()} FROM (
  SELECT segmento, count(*) AS registros, {metrics("saldo_realizado", "saldo_predito")}
  FROM scored GROUP BY 1 HAVING count(*) >= 2)"""))
def _(lab: Lab):
    per = MT.segment_metrics(lab.scored, ["segmento"])
    entries = F.array_sort(F.collect_list(F.struct("segmento", F.struct("registros", *S.METRIC_NAMES).alias("m"))))
    text = per.agg(F.to_json(F.map_from_entries(entries)).alias("j"))
    kind = "map<string,struct<registros:bigint," + S.METRIC_STRUCT.removeprefix("struct<") + ">"
    back = text.select(F.explode(F.from_json("j", kind)).alias("segmento", "m"))
    return rounded_metrics(back.select("segmento", "m.*"))


@query("AGG-10", sql(f"""
SELECT ano, mes, segmento, count(*) AS registros, round(avg(erro_percentual), 6) AS mape,
       round({wape()}, 6) AS wape_pct, {money_avg("saldo_predito")} AS predito_medio
FROM pred GROUP BY 1, 2, 3"""))
def _(lab: Lab):
    d = R.Digits(money=None, pct=6, fine=6)
    out = R.overview(pred(lab), d)
    return out.select(
        "ano", "mes", "segmento", "registros", F.col("mape_medio_diag").alias("mape"), "wape_pct",
        F.col("saldo_predito_medio").alias("predito_medio"),
    )


@query("AGG-11", sql("SELECT segmento, round(stddev_samp(erro_percentual), 4) AS desvio FROM pred GROUP BY 1"))
def _(lab: Lab):
    return lab.scored.groupBy("segmento").agg(F.round(F.stddev_samp("erro_percentual"), 4).alias("desvio"))


@query("AGG-12", sql("SELECT modelo_versao, count(DISTINCT cliente_id) AS clientes FROM pred GROUP BY 1"))
def _(lab: Lab):
    return lab.scored.groupBy("modelo_versao").agg(F.countDistinct("cliente_id").alias("clientes"))


@query("AGG-13", sql(f"""
SELECT segmento, {money_avg("(saldo_predito - saldo_realizado)")} AS vies FROM pred GROUP BY 1"""))
def _(lab: Lab):
    bias = F.col("saldo_predito") - F.col("saldo_realizado")
    return lab.scored.groupBy("segmento").agg(M.money_avg(bias).alias("vies"))


@query("AGG-14", sql("""
SELECT segmento, min(dt_processamento) AS desde, max(modelo_versao) AS modelo FROM pred GROUP BY 1"""))
def _(lab: Lab):
    return lab.scored.groupBy("segmento").agg(
        F.min("dt_processamento").alias("desde"), F.max("modelo_versao").alias("modelo")
    )


SLOTS = f"""
SELECT strftime(time_bucket(INTERVAL 15 MINUTES, ts), '%Y-%m-%d %H:%M:%S') AS slot_15m, event_type,
       count(*) AS n, {money_sum("value")} AS total FROM events GROUP BY 1, 2"""


@query("AGG-15", SLOTS)
def _(lab: Lab):
    return (
        lab.events.groupBy(C.slot_15m("ts").alias("slot_15m"), "event_type")
        .agg(F.count(F.lit(1)).alias("n"), M.money_sum("value").alias("total"))
        .withColumn("slot_15m", stamp("slot_15m", "slot_15m"))
    )


@query("AGG-16", f"""
SELECT event_type AS category, {money_avg("value")} AS avg_value, {money_sum("value")} AS total_value,
       count(*) AS record_count FROM events GROUP BY 1""")
def _(lab: Lab):
    return category_summary(lab.events, "event_type", "value")


def category_summary(df, category: str, value: str):
    v = F.col(value).cast("double")
    return df.groupBy(F.col(category).alias("category")).agg(
        M.money_avg(v).alias("avg_value"),
        M.money_sum(v).alias("total_value"),
        F.count(F.lit(1)).alias("record_count"),
    )


@query("AGG-17", f"SELECT user_id, {money_sum('value')} AS total FROM events GROUP BY 1")
def _(lab: Lab):
    return lab.events.groupBy("user_id").agg(M.money_sum("value").alias("total"))


@query("AGG-18", sql(f"""
SELECT ano, mes, count(*) AS registros, {money_avg("saldo_predito")} AS media_predito,
       {money_avg("saldo_realizado")} AS media_gabarito, round(coalesce({wape()}, 0), 6) AS wape_pct
FROM pred GROUP BY 1, 2"""))
def _(lab: Lab):
    return R.truth_by_month(pred(lab), R.Digits(money=None, pct=6))


@query("AGG-19", sql(f"""
SELECT segmento, ano, mes, {money_sum("saldo_predito")} AS saldo_predito_total, count(*) AS clientes
FROM pred GROUP BY 1, 2, 3"""))
def _(lab: Lab):
    return R.treasury_totals(pred(lab))


@query("AGG-20", sql("""
SELECT strftime(data_referencia, '%Y-%m') AS mes_ref, count(*) AS linhas,
       (SELECT count(DISTINCT cliente_id) FROM panel) AS clientes_unicos
FROM panel GROUP BY 1"""))
def _(lab: Lab):
    unique = lab.panel.agg(F.countDistinct("cliente_id").alias("n")).scalar()
    return P.months_of(lab.panel).withColumn("clientes_unicos", unique).orderBy("mes_ref")


@query("AGG-21", sql("""
SELECT count(*) AS linhas,
       left(sha256(count(*)::VARCHAR || '|' || strftime(max(data_referencia), '%Y-%m-%d') || 'T00:00:00'), 16)
         AS dataset_fingerprint
FROM lab"""))
def _(lab: Lab):
    return MG.dataset_fingerprint(lab.labelled)


@query("AGG-22", """
SELECT max(c_custkey) + 1 AS next_index, 'CUST' || lpad((max(c_custkey) + 1)::VARCHAR, 6, '0') AS next_id
FROM customer""")
def _(lab: Lab):
    return MG.next_customer(lab.bank.customers, "customer_id")


@query("AGG-23", sql("""
SELECT count(*) AS lotes, count(k.mes_ref) AS enviados, count(*) - count(k.mes_ref) AS pendentes,
       CAST(coalesce(sum(linhas) FILTER (k.mes_ref IS NULL), 0) AS BIGINT) AS linhas_pendentes
FROM (SELECT strftime(data_referencia, '%Y-%m') AS mes_ref, count(*) AS linhas FROM panel GROUP BY 1) m
LEFT JOIN (SELECT DISTINCT strftime(data_referencia, '%Y-%m') AS mes_ref FROM panel_c) k
USING (mes_ref)"""))
def _(lab: Lab):
    sent = P.months_of(lab.panel_c).select("mes_ref", F.lit(True).alias("enviado"))
    open_month = F.col("enviado").isNull()
    return (
        P.months_of(lab.panel)
        .join(sent, "mes_ref", "left")
        .agg(
            F.count(F.lit(1)).alias("lotes"),
            F.count("enviado").alias("enviados"),
            F.count(F.when(open_month, 1)).alias("pendentes"),
            F.coalesce(F.sum(F.when(open_month, F.col("linhas"))), F.lit(0)).alias("linhas_pendentes"),
        )
    )


@query("AGG-24", sql("""
SELECT cliente_id, segmento, data_referencia, saldo_predito, round(corte, 6) AS corte
FROM pred JOIN (SELECT segmento, quantile_cont(saldo_predito, 0.8) AS corte FROM pred GROUP BY 1)
USING (segmento) WHERE saldo_predito > corte"""))
def _(lab: Lab):
    return QA.above_segment_quantile(pred(lab)).select(
        "cliente_id", "segmento", "data_referencia", "saldo_predito", F.round("corte", 6).alias("corte")
    )


@query("AGG-25", sql(f"""
SELECT (1 + (base_naive > q1)::INTEGER + (base_naive > q2)::INTEGER + (base_naive > q3)::INTEGER)::INTEGER
         AS quartil, count(*) AS registros, round({wape()}, 6) AS wape_pct
FROM scored, (SELECT quantile_cont(base_naive, 0.25) AS q1, quantile_cont(base_naive, 0.5) AS q2,
                     quantile_cont(base_naive, 0.75) AS q3 FROM scored)
GROUP BY 1"""))
def _(lab: Lab):
    return U.wape_by_balance_quartile(lab.scored).withColumn("wape_pct", F.round("wape_pct", 6))


# windows


@query("WIN-1", sql("""
SELECT t.transaction_id, a.customer_id, t.account_id,
       CAST(sum(CAST(t.signed AS DECIMAL(18,4))) OVER (PARTITION BY t.account_id
              ORDER BY t.transaction_date, t.transaction_id ROWS UNBOUNDED PRECEDING)
            + CAST(a.saldo_abertura AS DECIMAL(18,4)) AS DOUBLE) AS balance
FROM bank_tx t JOIN bank_acc a USING (account_id) WHERE t.status = 'completed'"""))
def _(lab: Lab):
    return P.running_balance(lab.bank.transactions, lab.bank.accounts).select(
        "transaction_id", "customer_id", "account_id", "balance"
    )


@query("WIN-2", sql(f"""
SELECT customer_id, strftime(period, '%Y-%m-%d') AS period, {LAGS} FROM lagm_c"""))
def _(lab: Lab):
    months = P.customer_months(lab.bank.transactions, lab.bank.accounts)
    return P.with_lags(months).select("customer_id", day("period"), *S.LAGS)


@query("WIN-3", sql("""
SELECT cliente_id, strftime(data_referencia, '%Y-%m-%d') AS data_referencia, saldo_alvo,
       strftime(proxima_data, '%Y-%m-%d') AS _proxima_data FROM lab"""))
def _(lab: Lab):
    return lab.labelled.select("cliente_id", day(), S.LABEL, day(S.NEXT_DATE))


@query("WIN-4", sql("""
SELECT cliente_id, strftime(data_referencia, '%Y-%m-%d') AS data_referencia, saldo_m1 FROM panel
QUALIFY row_number() OVER (PARTITION BY cliente_id ORDER BY data_referencia DESC) = 1"""))
def _(lab: Lab):
    return MG.latest_per_customer(lab.panel).select("cliente_id", day(), "saldo_m1")


@query("WIN-5", sql("""
SELECT run_id, dt_processamento FROM met0
QUALIFY row_number() OVER (PARTITION BY time_bucket(INTERVAL 15 MINUTES,
          strptime(left(dt_processamento, 19), '%Y-%m-%dT%H:%M:%S')) ORDER BY dt_processamento DESC) = 1"""))
def _(lab: Lab):
    w = Window.partitionBy(C.slot_15m(C.parse_iso("dt_processamento"))).orderBy(F.desc("dt_processamento"))
    ranked = lab.metrics.select("run_id", "dt_processamento", F.row_number().over(w).alias("rn"))
    return ranked.where("rn = 1").drop("rn")


@query("WIN-6", sql("""
SELECT run_id, round(avg(wape) OVER (ORDER BY dt_processamento ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6)
         AS wape_media_5 FROM met0"""))
def _(lab: Lab):
    w = Window.orderBy("dt_processamento", "run_id").rowsBetween(-4, 0)
    return lab.metrics.select("run_id", F.round(F.avg("wape").over(w), 6).alias("wape_media_5"))


_SIX = [f"saldo_m{i}" for i in range(1, 7)]
_PRESENT = " + ".join(f"({c} IS NOT NULL)::INTEGER" for c in _SIX)
_TOTAL = " + ".join(f"coalesce({c}, 0)" for c in _SIX)
_SPREAD = " + ".join(f"coalesce({c} - m, 0) * coalesce({c} - m, 0)" for c in _SIX)


@query("WIN-7", sql(f"""
SELECT customer_id, strftime(period, '%Y-%m-%d') AS period, m AS media_saldo,
       sqrt(({_SPREAD}) / nullif(k - 1, 0)) AS desvio_saldo, saldo_m1 - saldo_m6 AS tendencia_saldo
FROM (SELECT *, {_PRESENT} AS k, ({_TOTAL}) / ({_PRESENT}) AS m FROM lagm_c)"""))
def _(lab: Lab):
    months = P.with_lags(P.customer_months(lab.bank.transactions, lab.bank.accounts))
    mean, deviation = FT.row_stats(S.LAGS)
    return months.select(
        "customer_id",
        day("period"),
        mean.alias("media_saldo"),
        deviation.alias("desvio_saldo"),
        (F.col("saldo_m1") - F.col("saldo_m6")).alias("tendencia_saldo"),
    )


# top-k


@query("TOP-1", sql("""
SELECT * FROM (
""" + "\nUNION ALL\n".join(
    f"SELECT {n} AS top, run_id FROM (SELECT run_id FROM met0 ORDER BY dt_processamento DESC, run_id LIMIT {n})"
    for n in (1, 5, 10, 15, 20, 30, 60, 100, 200)
) + ")"))
def _(lab: Lab):
    newest = lab.metrics.select("run_id", "dt_processamento")
    parts = [
        newest.orderBy(F.desc("dt_processamento"), "run_id").limit(n).select(F.lit(n).alias("top"), "run_id")
        for n in (1, 5, 10, 15, 20, 30, 60, 100, 200)
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


@query("TOP-3", sql("""
SELECT segmento, round(wape, 6) AS wape FROM seg
WHERE dt_processamento = (SELECT max(dt_processamento) FROM met0)
ORDER BY seg.wape DESC, segmento LIMIT 1"""))
def _(lab: Lab):
    return R.worst_segment(lab.metrics).select("segmento", F.round("wape", 6).alias("wape"))


@query("TOP-4", sql("""
SELECT cliente_id, strftime(data_referencia, '%Y-%m-%d') AS data_referencia, saldo_m1
FROM panel ORDER BY panel.data_referencia DESC, cliente_id LIMIT 1000"""))
def _(lab: Lab):
    return MG.keep_newest(lab.panel, max_rows=1000).select("cliente_id", day(), "saldo_m1")


@query("TOP-5", sql("""
SELECT cliente_id, data_referencia, erro_absoluto FROM pred ORDER BY data_referencia, cliente_id LIMIT 500"""))
def _(lab: Lab):
    return R.detail_sample(pred(lab)).select("cliente_id", "data_referencia", "erro_absoluto")


@query("TOP-6", sql("SELECT customer_id FROM bank_cust ORDER BY 1 LIMIT 200"))
def _(lab: Lab):
    return P.first_customers(lab.bank, 200).customers.select("customer_id")


@query("TOP-7", sql("""
SELECT row_number() OVER (ORDER BY dt_processamento DESC, segmento, cliente_id) AS pos, cliente_id
FROM pred ORDER BY 1 LIMIT 300"""))
def _(lab: Lab):
    by = [F.desc("dt_processamento"), F.asc("segmento"), F.asc("cliente_id")]
    top = lab.scored.select("dt_processamento", "segmento", "cliente_id").orderBy(*by).limit(300)
    return top.select(
        F.row_number().over(Window.orderBy(*by)).cast("bigint").alias("pos"), "cliente_id"
    )


# set operations


@query("SET-1", sql("""
SELECT 'bruto' AS modo, count(*) AS linhas, count(DISTINCT cliente_id || data_referencia::VARCHAR) AS chaves
FROM (SELECT cliente_id, data_referencia FROM panel
      UNION ALL SELECT cliente_id, data_referencia FROM panel WHERE data_referencia >= DATE '2000-01-01')
UNION ALL SELECT 'ultimo', count(*), count(*) FROM panel"""))
def _(lab: Lab):
    base = lab.panel.select("cliente_id", "data_referencia", "saldo_m1")
    batch = base.where(F.col("data_referencia") >= F.lit("2000-01-01").cast("date"))

    def sizes(df, mode):
        return df.agg(
            F.lit(mode).alias("modo"),
            F.count(F.lit(1)).alias("linhas"),
            F.countDistinct("cliente_id", "data_referencia").alias("chaves"),
        )

    return sizes(MG.append(base, batch), "bruto").union(sizes(MG.upsert(base, batch), "ultimo"))


@query("SET-2", sql("""
SELECT 'RUN' AS tipo, run_id AS col1, total_linhas::VARCHAR AS col2 FROM met0
UNION ALL SELECT 'MES', ano::VARCHAR || '-' || lpad(mes::VARCHAR, 2, '0'), count(*)::VARCHAR
FROM pred GROUP BY ano, mes
UNION ALL SELECT 'SEG', segmento, count(*)::VARCHAR FROM pred GROUP BY segmento"""))
def _(lab: Lab):
    p = lab.scored
    n = F.count(F.lit(1)).cast("string").alias("col2")
    month = F.concat_ws("-", F.col("ano").cast("string"), F.lpad(F.col("mes").cast("string"), 2, "0"))
    runs = lab.metrics.select(F.lit("RUN").alias("tipo"), "run_id", F.col("total_linhas").cast("string"))
    months = p.groupBy("ano", "mes").agg(n).select(F.lit("MES"), month, "col2")
    segs = p.groupBy("segmento").agg(n).select(F.lit("SEG"), "segmento", "col2")
    return runs.union(months).union(segs).toDF("tipo", "col1", "col2").orderBy("tipo", F.desc("col1"))


@query("SET-3", """
SELECT strftime(o_orderdate, '%Y-%m') AS mes_ref FROM orders
EXCEPT SELECT strftime(o_orderdate, '%Y-%m') FROM orders WHERE year(o_orderdate) % 2 = 0""")
def _(lab: Lab):
    orders = lab.table("orders")
    months = orders.select(C.month_key("o_orderdate").alias("mes_ref"))
    even = orders.where(F.year("o_orderdate") % 2 == 0).select(C.month_key("o_orderdate").alias("mes_ref"))
    return months.distinct().exceptAll(even.distinct())


