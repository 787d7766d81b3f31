"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidecast import schemas as S
from tidecast.functions import calendar as C
from tidecast.functions import money as M
from tidecast.functions import recode as R
from tidecast.operators import label as L
from tidecast.operators import panel as P
from tidecast.plans import reports as RP
from tidecast.queries.base import AS_OF, Lab, day, query
from tidecast.queries.oracle import money_sum, sql
from tidecast.sinks import ledger as LG

DAY = "strftime({0}, '%Y-%m-%d') AS {0}"
PANEL_SELECT = ", ".join(
    DAY.format("data_referencia") if c == "data_referencia" else c for c in S.PANEL_COLUMNS
)


def panel_text(df):
    return df.select(*[day() if c == "data_referencia" else c for c in S.PANEL_COLUMNS])


@query("PRJ-1", sql("""
SELECT 'filtrado' AS modo, transaction_id, status FROM bank_tx WHERE status = 'completed'
UNION ALL SELECT 'sem_filtro', transaction_id, status FROM bank_tx"""))
def _(lab: Lab):
    cols = ["transaction_id", "status"]
    tx = lab.bank.transactions
    kept = P.keep_status(tx).select(F.lit("filtrado").alias("modo"), *cols)
    return kept.union(P.keep_status(tx, "").select(F.lit("sem_filtro").alias("modo"), *cols))


@query("PRJ-2", sql("SELECT transaction_id, transaction_type, amount, signed FROM bank_tx"))
def _(lab: Lab):
    return lab.bank.transactions.select(
        "transaction_id", "transaction_type", "amount", M.signed_amount().alias("signed")
    )


@query("PRJ-3", sql("SELECT transaction_id, valor_creditos, valor_debitos FROM bank_tx"))
def _(lab: Lab):
    return lab.bank.transactions.select(
        "transaction_id",
        M.amount_of_types(M.CREDIT_TYPES).alias("valor_creditos"),
        M.amount_of_types(M.DEBIT_TYPES).alias("valor_debitos"),
    )


@query("PRJ-4", sql("""
SELECT account_id, CAST(saldo_abertura AS DECIMAL(18,4))::DOUBLE AS saldo_abertura FROM bank_acc
UNION ALL SELECT 'sem saldo', 100.0::DOUBLE"""))
def _(lab: Lab):
    opening = M.exact(M.opening_balance()).cast("double").alias("saldo_abertura")
    nobody = lab.spark.range(1).select(
        F.lit("sem saldo").alias("account_id"), F.lit(None).cast("double").alias("balance")
    )
    return lab.bank.accounts.select("account_id", "balance").union(nobody).select("account_id", opening)


@query("PRJ-5", sql("""
SELECT o_orderkey, strftime(last_day(o_orderdate), '%Y-%m-%d') AS data_referencia,
       month(o_orderdate)::INTEGER AS mes, year(o_orderdate)::INTEGER AS ano,
       ((month(o_orderdate) - 1) // 3 + 1)::INTEGER AS trimestre,
       (month(o_orderdate) IN (11, 12))::INTEGER AS is_fim_de_ano,
       (month(o_orderdate) = 1)::INTEGER AS is_inicio_de_ano
FROM orders"""))
def _(lab: Lab):
    orders = lab.table("orders").select("o_orderkey", F.to_date("o_orderdate").alias("period"))
    return C.with_calendar(orders).drop("period").withColumn("data_referencia", day())


@query("PRJ-6", sql("SELECT cliente_id, idade, tempo_relacionamento FROM profile"))
def _(lab: Lab):
    as_of = F.lit(AS_OF).cast("date")
    return lab.bank.customers.select(
        F.col("customer_id").alias("cliente_id"),
        C.age_years(as_of).alias("idade"),
        C.tenure_months(as_of).alias("tempo_relacionamento"),
    )


@query("PRJ-7", sql("SELECT customer_id, left(upper(gender), 1) AS genero FROM bank_cust"))
def _(lab: Lab):
    return lab.bank.customers.select("customer_id", R.gender_letter().alias("genero"))


@query("PRJ-8", sql("SELECT cliente_id, segmento, uf, score_credito FROM profile"))
def _(lab: Lab):
    c = lab.bank.customers.join(P.branch_cities(lab.bank.branches), "branch_code", "left")
    return c.select(
        F.col("customer_id").alias("cliente_id"), R.segment().alias("segmento"), R.state().alias("uf")
    ).withColumn("score_credito", R.score().cast("int"))


@query("PRJ-9", sql("""
SELECT cliente_id, possui_investimento, possui_credito, possui_seguro, qtd_produtos_ativos
FROM profile"""))
def _(lab: Lab):
    return P.customer_profile(lab.bank, F.lit(AS_OF).cast("date")).select(
        "cliente_id", "possui_investimento", "possui_credito", "possui_seguro", "qtd_produtos_ativos"
    )


@query("PRJ-10", sql("""
SELECT c.customer_id,
       round_even(least(greatest(coalesce(max(h.med_cred), 3000) * 1.25::DOUBLE, 1000), 50000) * 100, 0) / 100
         AS renda_mensal
FROM bank_cust c LEFT JOIN hist h USING (customer_id) GROUP BY 1"""))
def _(lab: Lab):
    months = P.complete_lags(P.with_lags(P.customer_months(lab.bank.transactions, lab.bank.accounts, None)))
    med = months.groupBy("customer_id").agg(F.median("valor_creditos_mes").alias("m"))
    return lab.bank.customers.join(med, "customer_id", "left").select(
        "customer_id", P.income_estimate(F.col("m")).alias("renda_mensal")
    )


@query("PRJ-11", """
SELECT o_orderkey, CASE WHEN o_totalprice / 20 >= 20000 THEN 'PRIVATE'
                        WHEN o_totalprice / 20 >= 8000 THEN 'PRIME' ELSE 'VAREJO' END AS segmento
FROM orders""")
def _(lab: Lab):
    return lab.table("orders").select(
        "o_orderkey", R.income_segment(F.col("o_totalprice") / 20).alias("segmento")
    )


@query("PRJ-12", sql(f"SELECT {PANEL_SELECT} FROM panel WHERE strftime(data_referencia, '%Y-%m') = '1999-06'"))
def _(lab: Lab):
    return panel_text(P.require_rows(P.month_slice(lab.panel, "1999-06"), "panel of 1999-06"))


@query("PRJ-13", sql("""
SELECT CASE WHEN data_referencia < DATE '2000-03-01' THEN 'historico' ELSE 'lote' END AS parte,
       cliente_id, strftime(data_referencia, '%Y-%m-%d') AS data_referencia, saldo_m1
FROM panel WHERE data_referencia < DATE '2000-04-01'"""))
def _(lab: Lab):
    history, batch = P.split_at_month(lab.panel, "2000-03")
    cols = ["cliente_id", day(), "saldo_m1"]
    return history.select(F.lit("historico").alias("parte"), *cols).union(
        batch.select(F.lit("lote").alias("parte"), *cols)
    )


@query("PRJ-14", sql("""
SELECT mes_ref, pos, n FROM (
  SELECT mes_ref, row_number() OVER (ORDER BY mes_ref) - 1 AS pos, count(*) OVER () AS n
  FROM (SELECT DISTINCT strftime(data_referencia, '%Y-%m') AS mes_ref FROM panel))
WHERE pos = greatest(1, n - 3)"""))
def _(lab: Lab):
    return P.cutoff_month(lab.panel, -3).withColumn("pos", F.col("pos").cast("bigint"))


@query("PRJ-15", sql("""
SELECT customer_id, strftime(period, '%Y-%m-%d') AS period, saldo_m1, saldo_m6
FROM lagm_c WHERE saldo_m6 IS NOT NULL"""))
def _(lab: Lab):
    months = P.with_lags(P.customer_months(lab.bank.transactions, lab.bank.accounts))
    kept = P.require_rows(P.complete_lags(months), "months with six lags")
    return kept.select("customer_id", day("period"), "saldo_m1", "saldo_m6")


@query("PRJ-16", sql(f"SELECT {PANEL_SELECT} FROM panel_c"))
def _(lab: Lab):
    return panel_text(lab.panel_c)


@query("PRJ-17", sql("""
SELECT cliente_id, strftime(data_referencia, '%Y-%m-%d') AS data_referencia, saldo_alvo FROM lab_c"""))
def _(lab: Lab):
    stale = lab.panel_c.withColumns({S.LABEL: F.lit(-1.0), S.LEGACY_LABEL: F.lit(-2.0)})
    return L.training_view(stale).select("cliente_id", day(), S.LABEL)


@query("PRJ-18", sql("""
SELECT cliente_id, data_referencia, ano <= 1997 AS legado, saldo_predito, saldo_realizado FROM pred"""))
def _(lab: Lab):
    old = lab.predictions.withColumn("legado", F.col("saldo_predito").isNull())
    return RP.unified(old).select(
        "cliente_id", "data_referencia", "legado", "saldo_predito", "saldo_realizado"
    )


@query("PRJ-19", """
SELECT l_orderkey, l_linenumber, abs(real - pred) AS erro_absoluto,
       CASE WHEN real = 0 THEN 0.0::DOUBLE ELSE abs(real - pred) / abs(real) * 100 END AS erro_percentual
FROM (SELECT l_orderkey, l_linenumber, l_extendedprice * l_discount AS real,
             l_extendedprice * l_tax AS pred FROM lineitem)""")
def _(lab: Lab):
    li = lab.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_extendedprice") * F.col("l_discount")).alias("real"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("pred"),
    )
    err = M.abs_error("real", "pred")
    return li.select(
        "l_orderkey", "l_linenumber", err.alias("erro_absoluto"), M.pct_error("real", err).alias("erro_percentual")
    )


@query("PRJ-20", f"""
SELECT l_returnflag, l_discount,
       100.0::DOUBLE * {money_sum("l_tax")} / nullif({money_sum("l_discount")}, 0) AS razao_pct
FROM lineitem GROUP BY 1, 2""")
def _(lab: Lab):
    return (
        lab.table("lineitem")
        .groupBy("l_returnflag", "l_discount")
        .agg(M.safe_ratio_pct(M.money_sum("l_tax"), M.money_sum("l_discount")).alias("razao_pct"))
    )


@query("PRJ-21", sql("SELECT run_id FROM seg GROUP BY 1"))
def _(lab: Lab):
    filled = lab.metrics.withColumn(
        "metricas_segmento", F.when(F.col("metricas_segmento") != "{}", F.col("metricas_segmento"))
    )
    return filled.where(RP.has_json("metricas_segmento")).select("run_id")


@query("PRJ-22", sql("""
SELECT run_id, cliente_id FROM pred WHERE segmento = 'PRIVATE'
  AND run_id IN (SELECT run_id FROM met WHERE is_champion = true)"""))
def _(lab: Lab):
    champions = lab.metrics.where(F.col("is_champion")).select("run_id")
    rows = lab.predictions.where(F.col("segmento") == "PRIVATE")
    return rows.join(champions, "run_id", "left_semi").select("run_id", "cliente_id")


@query("PRJ-23", sql("SELECT run_id, linhas_adicionadas FROM met0 WHERE run_id LIKE 'diario-%'"))
def _(lab: Lab):
    return RP.runs_with_prefix(lab.metrics, "diario-").select("run_id", "linhas_adicionadas")


@query("PRJ-24", """
SELECT event_id, event_type FROM events
WHERE ts >= (TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 6 HOURS) AND ts < TIMESTAMP '2024-01-20 00:00:00'""")
def _(lab: Lab):
    now = F.lit("2024-01-20 00:00:00").cast("timestamp")
    since = now - F.make_dt_interval(hours=F.lit(6))
    return lab.events.where((F.col("ts") >= since) & (F.col("ts") < now)).select("event_id", "event_type")


@query("PRJ-25", sql("""
SELECT cliente_id, run_id FROM pred WHERE dt_processamento = (SELECT max(dt_processamento) FROM pred)"""))
def _(lab: Lab):
    p = lab.predictions
    newest = p.agg(F.max("dt_processamento")).scalar()
    return p.where(F.col("dt_processamento") == newest).select("cliente_id", "run_id")


@query("PRJ-26", """
SELECT o_orderkey, coalesce(CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 0 END, 0)::INTEGER AS aberto
FROM orders""")
def _(lab: Lab):
    status = F.col("o_orderstatus")
    flag = F.when(status == "O", F.lit(True)).when(status == "F", F.lit(False))
    return lab.table("orders").select("o_orderkey", R.flag_int(flag).alias("aberto"))


@query("PRJ-27", """
SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer""")
def _(lab: Lab):
    c = lab.table("customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return L.next_period_label(c)


@query("PRJ-28", """
SELECT l_orderkey, l_linenumber,
       CAST(l_quantity AS DECIMAL(38,10))::VARCHAR AS q,
       CAST(l_discount AS DECIMAL(38,10))::VARCHAR AS d0,
       CAST(l_tax AS DECIMAL(38,10))::VARCHAR AS tax
FROM lineitem""")
def _(lab: Lab):
    nested = lab.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.struct(
            F.col("l_quantity").alias("q"),
            F.array("l_discount").alias("ds"),
            F.create_map(F.lit("tax"), F.col("l_tax")).alias("m"),
        ).alias("payload"),
    )
    safe = LG.decimals_inside(nested, "payload")
    return safe.select(
        "l_orderkey",
        "l_linenumber",
        F.col("payload.q").cast("string").alias("q"),
        F.col("payload.ds")[0].cast("string").alias("d0"),
        F.col("payload.m")["tax"].cast("string").alias("tax"),
    )
