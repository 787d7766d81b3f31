"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidecast.functions import money as M
from tidecast.operators import merge as MG
from tidecast.operators import panel as P
from tidecast.operators import reconcile as RC
from tidecast.plans import reports as R
from tidecast.plans import usecases as U
from tidecast.queries.base import AS_OF, Lab, day, query
from tidecast.queries.oracle import sql, wape
from tidecast.queries.reports import pred
from tidecast.sinks import ledger as LG


@query("JN-1", sql("""
SELECT t.transaction_id, a.customer_id, t.signed
FROM bank_tx t JOIN bank_acc a USING (account_id) WHERE t.status = 'completed'"""))
def _(lab: Lab):
    tx = P.signed_transactions(lab.bank.transactions, lab.bank.accounts)
    return tx.select("transaction_id", "customer_id", "signed")


@query("JN-2", sql("""
SELECT t.transaction_id, coalesce(a.saldo_abertura, 100) AS saldo_abertura
FROM (SELECT transaction_id, account_id FROM bank_tx UNION ALL SELECT 'TX-SEM-CONTA', 'NENHUMA') t
LEFT JOIN bank_acc a USING (account_id)"""))
def _(lab: Lab):
    known = P.account_owners(lab.bank.accounts)
    stray = lab.spark.range(1).select(F.lit("TX-SEM-CONTA"), F.lit("NENHUMA"))
    rows = lab.bank.transactions.select("transaction_id", "account_id").union(stray)
    return rows.join(known, "account_id", "left").select(
        "transaction_id", F.coalesce("saldo_abertura", F.lit(M.OPENING_FLOOR)).alias("saldo_abertura")
    )


@query("JN-3", sql("""
SELECT c.customer_id, b.city
FROM (SELECT customer_id, branch_code FROM bank_cust UNION ALL SELECT 'CLIENTE-SEM-AGENCIA', NULL) c
LEFT JOIN (SELECT DISTINCT branch_code, city FROM bank_branch) b USING (branch_code)"""))
def _(lab: Lab):
    cities = P.branch_cities(lab.bank.branches)
    stray = lab.spark.range(1).select(F.lit("CLIENTE-SEM-AGENCIA"), F.lit(None).cast(lab.bank.customers.schema["branch_code"].dataType))
    rows = lab.bank.customers.select("customer_id", "branch_code").union(stray)
    return rows.join(cities, "branch_code", "left").select("customer_id", "city")


@query("JN-4", sql("SELECT cliente_id AS customer_id, qtd_produtos_ativos FROM profile"))
def _(lab: Lab):
    n = P.active_accounts(lab.bank.accounts)
    return lab.bank.customers.join(n, "customer_id", "left").select(
        "customer_id", F.coalesce("qtd_produtos_ativos", F.lit(1)).alias("qtd_produtos_ativos")
    )


@query("JN-5", sql("SELECT cliente_id AS customer_id, possui_credito FROM profile"))
def _(lab: Lab):
    n = P.active_loans(lab.bank.loans)
    return lab.bank.customers.join(n, "customer_id", "left").select(
        "customer_id", (F.coalesce("qtd_emprestimos", F.lit(0)) > 0).cast("int").alias("possui_credito")
    )


@query("JN-6", sql("""
SELECT c.customer_id, max(h.med_cred) AS med_cred
FROM bank_cust c LEFT JOIN hist_c h USING (customer_id) GROUP BY 1"""))
def _(lab: Lab):
    months = P.complete_lags(P.with_lags(P.customer_months(lab.bank.transactions, lab.bank.accounts)))
    med = months.groupBy("customer_id").agg(F.median("valor_creditos_mes").alias("med_cred"))
    return lab.bank.customers.select("customer_id").join(med, "customer_id", "left")


@query("JN-7", sql("""
SELECT l.customer_id, strftime(l.period, '%Y-%m-%d') AS period, p.segmento, p.uf, p.idade
FROM lagm_c l JOIN profile p ON p.cliente_id = l.customer_id"""))
def _(lab: Lab):
    months = P.customer_months(lab.bank.transactions, lab.bank.accounts)
    bank = lab.bank
    doubled = type(bank)(
        bank.customers.unionByName(bank.customers), bank.accounts, bank.loans, bank.branches, bank.transactions
    )
    profile = P.customer_profile(doubled, F.lit(AS_OF).cast("date"))
    profile = profile.withColumnRenamed("cliente_id", "customer_id")
    return months.join(profile, "customer_id", "left").select(
        "customer_id", day("period"), "segmento", "uf", "idade"
    )


@query("JN-8", sql("""
SELECT t.transaction_id, t.account_id FROM bank_tx t
WHERE account_id IN (SELECT account_id FROM bank_acc WHERE customer_id IN (
  SELECT customer_id FROM bank_cust ORDER BY customer_id LIMIT 400))"""))
def _(lab: Lab):
    return P.first_customers(lab.bank, 400).transactions.select("transaction_id", "account_id")


@query("JN-9", sql("""
SELECT customer_id, strftime(period, '%Y-%m-%d') AS period, saldo_m1 FROM hist WHERE n >= 9"""))
def _(lab: Lab):
    months = P.complete_lags(P.with_lags(P.customer_months(lab.bank.transactions, lab.bank.accounts, None)))
    return P.with_history(months, min_months=9).select("customer_id", day("period"), "saldo_m1")


LISTING = """
  SELECT 'incoming/lote_' || strftime(o_orderdate, '%Y-%m') || '.csv' AS key,
         count(*)::VARCHAR AS version FROM orders GROUP BY 1"""
LEDGER = """
  SELECT 'incoming/lote_' || strftime(o_orderdate, '%Y-%m') || '.csv' AS key,
         count(*) FILTER (month(o_orderdate) % 2 = 0 OR o_orderstatus <> 'P')::VARCHAR AS version
  FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01' GROUP BY 1"""


def monthly_files(lab: Lab):
    """Monthly order files with their row count as version, and an older ledger."""
    o = lab.table("orders").select("o_orderdate", "o_orderstatus")
    key = F.concat(F.lit("incoming/lote_"), F.date_format("o_orderdate", "yyyy-MM"), F.lit(".csv"))
    listing = o.groupBy(key.alias("key")).agg(F.count(F.lit(1)).cast("string").alias("version"))
    counted = (F.month("o_orderdate") % 2 == 0) | (F.col("o_orderstatus") != "P")
    ledger = (
        o.where(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
        .groupBy(key.alias("key"))
        .agg(F.count(F.when(counted, 1)).cast("string").alias("version"))
        .withColumn("marked_at", F.lit("2024-01-01 08:00:00").cast("timestamp"))
    )
    return listing, ledger


@query("JN-10", f"""
SELECT l.key, l.version FROM ({LISTING}) l
WHERE NOT EXISTS (SELECT 1 FROM ({LEDGER}) d WHERE d.key = l.key AND d.version = l.version)""")
def _(lab: Lab):
    return LG.unprocessed(*monthly_files(lab))


@query("JN-11", sql("""
SELECT DISTINCT strftime(data_referencia, '%Y-%m') AS mes_ref FROM panel
EXCEPT SELECT strftime(data_referencia, '%Y-%m') FROM panel_c"""))
def _(lab: Lab):
    return MG.months_missing(lab.panel, lab.panel_c)


@query("JN-12", sql("""
SELECT cliente_id, data_referencia, p.modelo_versao FROM pred p
JOIN (SELECT modelo_versao FROM pred ORDER BY dt_processamento DESC LIMIT 1) u
  ON p.modelo_versao = u.modelo_versao"""))
def _(lab: Lab):
    p = lab.predictions
    latest = p.agg(F.max(F.struct("dt_processamento", "modelo_versao"))["modelo_versao"].alias("v"))
    return p.where(F.col("modelo_versao") == latest.scalar()).select(
        "cliente_id", "data_referencia", "modelo_versao"
    )


@query("JN-13", sql(f"""
SELECT c.run_id, c.modelo_versao, count(*) AS registros, round({wape()}, 6) AS wape_pct
FROM pred p JOIN (SELECT run_id, modelo_versao FROM met WHERE is_champion
                  ORDER BY dt_processamento DESC LIMIT 1) c ON p.modelo_versao = c.modelo_versao
GROUP BY 1, 2"""))
def _(lab: Lab):
    d = R.Digits(money=None, pct=6, fine=6)
    return R.model_benchmark(lab.metrics, pred(lab), d).select(
        "run_id",
        "modelo_versao",
        F.col("registros_holdout").alias("registros"),
        F.col("wape_gabarito").alias("wape_pct"),
    )


@query("JN-14", sql("SELECT run_id, segmento, mae, round(wape, 6) AS wape FROM seg"))
def _(lab: Lab):
    return R.exploded_segments(lab.metrics).select(
        "run_id", "segmento", "metricas.mae", F.round("metricas.wape", 6).alias("wape")
    )


@query("JN-15", sql("""
SELECT cliente_id, strftime(data_referencia, '%Y-%m-%d') AS data_referencia, saldo_alvo, saldo_m1, uf
FROM lab"""))
def _(lab: Lab):
    keys = ["cliente_id", "data_referencia"]
    values = lab.labelled.select(*keys, "saldo_alvo")
    return values.join(lab.panel.select(*keys, "saldo_m1", "uf"), keys).withColumn("data_referencia", day())


@query("JN-16", sql(f"""
SELECT m.run_id, m.modelo_versao, round(m.wape, 6) AS wape, m.total_linhas, m.is_champion,
       p.registros, p.wape_publicado
FROM met m JOIN (SELECT run_id, modelo_versao, count(*) AS registros,
                        round({wape()}, 6) AS wape_publicado FROM pred GROUP BY 1, 2) p
USING (run_id, modelo_versao)"""))
def _(lab: Lab):
    out = U.runs_with_predictions(lab.metrics, pred(lab))
    return out.withColumns({c: F.round(c, 6) for c in ("wape", "wape_publicado")})


@query("JN-17", sql("""
SELECT p.cliente_id, p.segmento, p.ano, p.mes, p.saldo_predito, c.c_acctbal AS limite
FROM pred p JOIN customer c ON p.cliente_id = 'CUST' || lpad(c.c_custkey::VARCHAR, 12, '0')
WHERE p.segmento IN (SELECT segmento FROM seg
                     WHERE dt_processamento = (SELECT max(dt_processamento) FROM met0) AND wape < 70)"""))
def _(lab: Lab):
    limits = lab.bank.accounts.groupBy(F.col("customer_id").alias("cliente_id")).agg(
        F.max("balance").alias("limite")
    )
    return U.limits_for_trusted_segments(pred(lab), lab.metrics, limits, max_wape=70.0)


@query("JN-18", sql("""
SELECT champion_run_id, CAST(sum(n) AS BIGINT) AS eventos, min(hora) AS desde FROM (
  SELECT e.hora, count(*) AS n, max(k.run_id) AS champion_run_id
  FROM (SELECT strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS hora FROM events) e
  LEFT JOIN (SELECT run_id, dt_processamento AS since,
                    lead(dt_processamento) OVER (ORDER BY dt_processamento) AS until
             FROM met WHERE is_champion) k
    ON e.hora >= k.since AND (k.until IS NULL OR e.hora < k.until)
  GROUP BY 1)
GROUP BY 1"""))
def _(lab: Lab):
    return U.events_by_live_champion(lab.events, "ts", lab.metrics)


@query("JN-19", sql("""
SELECT customer_id, strftime(period, '%Y-%m-%d') AS period, campo, esperado, obtido FROM (
  SELECT coalesce(e.customer_id, a.customer_id) AS customer_id, coalesce(e.period, a.period) AS period,
         unnest(['qtd', 'saldo']) AS campo,
         unnest([e.qtd_transacoes_mes::VARCHAR, CAST(e.saldo_raw AS DECIMAL(24,4))::VARCHAR]) AS esperado,
         unnest([a.qtd_transacoes_mes::VARCHAR, CAST(a.saldo_raw AS DECIMAL(24,4))::VARCHAR]) AS obtido
  FROM custm e FULL JOIN custm_c a ON e.customer_id = a.customer_id AND e.period = a.period)
WHERE esperado IS DISTINCT FROM obtido"""))
def _(lab: Lab):
    return month_diffs(lab).withColumn("period", day("period"))


def month_diffs(lab: Lab):
    def side(status):
        m = P.customer_months(lab.bank.transactions, lab.bank.accounts, status)
        return m.select(
            "customer_id",
            "period",
            F.col("qtd_transacoes_mes").alias("qtd"),
            F.col("saldo_raw").cast("decimal(24,4)").alias("saldo"),
        )

    return RC.field_diffs(side(None), side("completed"), ["customer_id", "period"], ["qtd", "saldo"])


