"""Shared CTEs of the DuckDB check queries.

``sql(body)`` prefixes exactly the CTEs a body needs. A ``_c`` suffix marks the
completed-only variant of a frame.
"""

from __future__ import annotations

import re

AS_OF = "DATE '2002-01-01'"
LAGS = ", ".join(f"saldo_m{i}" for i in range(1, 7))
MEAN6 = "((saldo_m1 + saldo_m2 + saldo_m3 + saldo_m4 + saldo_m5 + saldo_m6) / 6)"
DEC = "DECIMAL(18,4)"


def money_sum(c: str) -> str:
    return f"CAST(sum(CAST({c} AS {DEC})) AS DOUBLE)"


def money_avg(c: str) -> str:
    return f"({money_sum(c)} / count({c}))"


def wape(err: str = "erro_absoluto", real: str = "saldo_realizado") -> str:
    return f"(100.0::DOUBLE * {money_sum(err)} / nullif({money_sum(f'abs({real})')}, 0))"


def metrics(y: str, p: str, prefix: str = "") -> str:
    e = f"abs({y} - {p})"
    h = f"((abs({y}) + abs({p})) / 2)"
    sse = f"sum(({y} - {p}) * ({y} - {p}))"
    sst = f"(var_pop({y}) * count({y}))"
    return f"""
      sqrt({sse} / count({y})) AS {prefix}rmse,
      {money_avg(e)} AS {prefix}mae,
      CASE WHEN count({y}) < 2 THEN NULL
           WHEN {sst} = 0 AND {sse} = 0 THEN 1.0::DOUBLE
           WHEN {sst} = 0 THEN 0.0::DOUBLE ELSE 1 - {sse} / {sst} END AS {prefix}r2,
      coalesce({wape(e, y)}, 0.0::DOUBLE) AS {prefix}wape,
      coalesce(avg(CASE WHEN {h} > 0 THEN {e} / {h} END) * 100, 0.0::DOUBLE) AS {prefix}smape,
      coalesce(avg(CASE WHEN {y} <> 0 THEN {e} / abs({y}) END) * 100, 0.0::DOUBLE) AS {prefix}mape"""


CTES: dict[str, str] = {}

CTES["bank_cust"] = """
  SELECT 'CUST' || lpad(c_custkey::VARCHAR, 12, '0') AS customer_id,
         DATE '1940-01-01' + ((c_custkey * 37) % 20000)::INTEGER AS dob,
         CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'male' END AS gender,
         DATE '1985-01-01' + ((c_custkey * 13) % 6000)::INTEGER AS account_open_date,
         CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'retail' WHEN 'AUTOMOBILE' THEN 'corporate'
              WHEN 'MACHINERY' THEN 'corporate' WHEN 'FURNITURE' THEN 'premium'
              ELSE 'other' END AS customer_segment,
         c_nationkey::VARCHAR AS branch_code
  FROM customer"""
CTES["bank_acc"] = """
  SELECT 'ACC' || lpad((c_custkey * 2 + b)::VARCHAR, 12, '0') AS account_id,
         'CUST' || lpad(c_custkey::VARCHAR, 12, '0') AS customer_id,
         c_acctbal AS balance,
         CASE WHEN (c_custkey + b) % 5 = 0 THEN 'closed' ELSE 'active' END AS account_status,
         greatest(coalesce(c_acctbal * 0.1::DOUBLE, 100), 100::DOUBLE) AS saldo_abertura
  FROM customer, (VALUES (0), (1)) v(b)"""
CTES["bank_branch"] = """
  SELECT n_nationkey::VARCHAR AS branch_code,
         CASE n_nationkey % 3 WHEN 0 THEN 'Melbourne' WHEN 1 THEN 'Sydney' ELSE n_name END AS city
  FROM nation"""
CTES["bank_loan"] = """
  SELECT 'LOAN' || lpad(o_orderkey::VARCHAR, 12, '0') AS loan_id,
         'CUST' || lpad(o_custkey::VARCHAR, 12, '0') AS customer_id
  FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority LIKE '5%'"""
CTES["bank_tx"] = """
  SELECT *,
         CASE transaction_type WHEN 'deposit' THEN amount WHEN 'withdrawal' THEN -amount
              WHEN 'payment' THEN -amount WHEN 'transfer' THEN amount * -0.5::DOUBLE
              ELSE 0.0::DOUBLE END AS signed,
         CASE WHEN transaction_type = 'deposit' THEN amount ELSE 0.0::DOUBLE END AS valor_creditos,
         CASE WHEN transaction_type IN ('withdrawal', 'payment') THEN amount
              ELSE 0.0::DOUBLE END AS valor_debitos
  FROM (SELECT 'TX' || lpad(o_orderkey::VARCHAR, 12, '0') AS transaction_id,
               'ACC' || lpad((o_custkey * 2 + o_orderkey % 2)::VARCHAR, 12, '0') AS account_id,
               CASE left(o_orderpriority, 1) WHEN '1' THEN 'deposit' WHEN '2' THEN 'withdrawal'
                    WHEN '3' THEN 'payment' WHEN '4' THEN 'transfer' ELSE 'fee' END AS transaction_type,
               o_totalprice AS amount, o_orderdate::DATE AS transaction_date,
               CASE o_orderstatus WHEN 'P' THEN 'pending' ELSE 'completed' END AS status
        FROM orders)"""
CTES["profile"] = f"""
  SELECT c.customer_id AS cliente_id,
         least(greatest(floor(date_diff('day', c.dob, {AS_OF}) / 365)::INTEGER, 18), 90) AS idade,
         CASE c.customer_segment WHEN 'retail' THEN 'VAREJO' WHEN 'corporate' THEN 'PRIME'
              WHEN 'premium' THEN 'PRIVATE' ELSE 'VAREJO' END AS segmento,
         least(greatest(floor(date_diff('day', c.account_open_date, {AS_OF}) / 30)::INTEGER, 1), 240)
           AS tempo_relacionamento,
         CASE b.city WHEN 'Melbourne' THEN 'VIC' WHEN 'Sydney' THEN 'NSW' ELSE 'VIC' END AS uf,
         left(upper(c.gender), 1) AS genero,
         (c.customer_segment = 'premium')::INTEGER AS possui_investimento,
         (c.customer_id IN (SELECT customer_id FROM bank_loan))::INTEGER AS possui_credito,
         (c.customer_segment IN ('premium', 'corporate'))::INTEGER AS possui_seguro,
         CASE c.customer_segment WHEN 'premium' THEN 850 WHEN 'corporate' THEN 750
              ELSE 650 END::INTEGER AS score_credito,
         coalesce(a.n, 1)::INTEGER AS qtd_produtos_ativos
  FROM bank_cust c
  LEFT JOIN (SELECT branch_code, min(city) AS city FROM bank_branch GROUP BY 1) b USING (branch_code)
  LEFT JOIN (SELECT customer_id, count(*) AS n FROM bank_acc
             WHERE account_status = 'active' GROUP BY 1) a USING (customer_id)"""

for sfx, cond in (("", "TRUE"), ("_c", "status = 'completed'")):
    CTES[f"accm{sfx}"] = f"""
  SELECT a.customer_id, t.account_id, t.period,
         sum(t.mov) OVER (PARTITION BY t.account_id ORDER BY t.period ROWS UNBOUNDED PRECEDING)
           + CAST(a.saldo_abertura AS {DEC}) AS saldo_d,
         t.cred AS cred_d, t.deb AS deb_d, t.qtd
  FROM (SELECT account_id, date_trunc('month', transaction_date)::DATE AS period,
               sum(CAST(signed AS {DEC})) AS mov, sum(CAST(valor_creditos AS {DEC})) AS cred,
               sum(CAST(valor_debitos AS {DEC})) AS deb, count(transaction_id) AS qtd
        FROM bank_tx WHERE {cond} GROUP BY 1, 2) t
  JOIN bank_acc a USING (account_id)"""
    CTES[f"custm{sfx}"] = f"""
  SELECT customer_id, period, CAST(sum(saldo_d) AS DOUBLE) AS saldo_raw,
         CAST(sum(cred_d) AS DOUBLE) AS valor_creditos_mes,
         CAST(sum(deb_d) AS DOUBLE) AS valor_debitos_mes,
         CAST(sum(qtd) AS BIGINT) AS qtd_transacoes_mes
  FROM accm{sfx} GROUP BY 1, 2"""
    CTES[f"lagm{sfx}"] = f"""
  SELECT customer_id, period, valor_creditos_mes, valor_debitos_mes, qtd_transacoes_mes,
         saldo_raw AS saldo_m1,
         {", ".join(f"lag(saldo_raw, {k - 1}) OVER w AS saldo_m{k}" for k in range(2, 7))}
  FROM custm{sfx} WINDOW w AS (PARTITION BY customer_id ORDER BY period)"""
    CTES[f"hist{sfx}"] = f"""
  SELECT *, count(*) OVER (PARTITION BY customer_id) AS n,
         median(valor_creditos_mes) OVER (PARTITION BY customer_id) AS med_cred
  FROM lagm{sfx} WHERE saldo_m6 IS NOT NULL"""
    CTES[f"panel{sfx}"] = f"""
  SELECT p.cliente_id, p.idade,
         round_even(least(greatest(h.med_cred * 1.25::DOUBLE, 1000), 50000) * 100, 0) / 100 AS renda_mensal,
         p.segmento, p.tempo_relacionamento, p.uf, p.genero, p.possui_investimento,
         p.possui_credito, p.possui_seguro, p.score_credito,
         last_day(h.period) AS data_referencia, {LAGS},
         h.qtd_transacoes_mes, h.valor_debitos_mes, h.valor_creditos_mes, p.qtd_produtos_ativos,
         month(h.period)::INTEGER AS mes, quarter(h.period)::INTEGER AS trimestre,
         year(h.period)::INTEGER AS ano,
         (month(h.period) IN (11, 12))::INTEGER AS is_fim_de_ano,
         (month(h.period) = 1)::INTEGER AS is_inicio_de_ano
  FROM hist{sfx} h JOIN profile p ON p.cliente_id = h.customer_id
  WHERE h.n >= 6"""
    CTES[f"lab{sfx}"] = f"""
  SELECT * FROM (
    SELECT *, lead(saldo_m1) OVER w AS saldo_alvo, lead(data_referencia) OVER w AS proxima_data
    FROM panel{sfx} WINDOW w AS (PARTITION BY cliente_id ORDER BY data_referencia))
  WHERE saldo_alvo IS NOT NULL"""

CTES["scored"] = f"""
  SELECT *, CASE WHEN saldo_realizado = 0 THEN 0.0::DOUBLE
                 ELSE erro_absoluto / abs(saldo_realizado) * 100 END AS erro_percentual
  FROM (SELECT *, abs(saldo_realizado - saldo_predito) AS erro_absoluto
        FROM (SELECT cliente_id, data_referencia,
                     saldo_m1 * 0.6::DOUBLE + {MEAN6} * 0.4::DOUBLE AS saldo_predito,
                     saldo_alvo AS saldo_realizado, saldo_m1 AS base_naive, {MEAN6} AS base_media,
                     uf,
                     strftime(TIMESTAMP '2024-01-01' + to_seconds(((ano - 1995) * 12 + mes - 1) * 420),
                              '%Y-%m-%dT%H:%M:%S') || '+00:00' AS dt_processamento,
                     'blend-saldo-v1-' || ano::VARCHAR AS modelo_versao,
                     CASE WHEN mes % 2 = 0 THEN 'lote-' ELSE 'diario-' END
                       || strftime(data_referencia, '%Y%m') AS run_id,
                     ano, mes, segmento
              FROM lab))"""
# the unified prediction table; legacy years keep their values in other columns
CTES["pred"] = """
  SELECT cliente_id, strftime(data_referencia, '%Y-%m-%d') AS data_referencia, saldo_predito,
         saldo_realizado, uf, dt_processamento, modelo_versao, run_id, erro_absoluto,
         erro_percentual, ano, mes, segmento
  FROM scored"""
CTES["met0"] = f"""
  SELECT run_id, modelo_versao, dt_processamento, left(dt_processamento, 10) AS run_date,
         strftime(max(data_referencia), '%Y-%m-%d') AS data_referencia_lote,
         count(*) AS linhas_adicionadas,
         CAST(sum(count(*)) OVER (ORDER BY dt_processamento, run_id) AS BIGINT) AS total_linhas,
         {metrics("saldo_realizado", "saldo_predito")},
         {metrics("saldo_realizado", "base_naive", "n_")},
         {metrics("saldo_realizado", "base_media", "a_")}
  FROM scored GROUP BY 1, 2, 3"""
CTES["seg"] = f"""
  SELECT run_id, dt_processamento, segmento, count(*) AS registros,
         {metrics("saldo_realizado", "saldo_predito")}
  FROM scored GROUP BY 1, 2, 3 HAVING count(*) >= 2"""
CTES["segwide"] = """
  SELECT run_id, """ + ", ".join(
    f"max(CASE WHEN segmento = '{s}' THEN {m} END) AS {m}_{s.lower()}"
    for s in ("VAREJO", "PRIME", "PRIVATE")
    for m in ("wape", "rmse")
) + """
  FROM seg GROUP BY 1"""
CTES["runs"] = """
  SELECT *, row_number() OVER (ORDER BY dt_processamento, run_id) AS rn FROM met0"""
CTES["fold"] = """
  SELECT rn, rn AS champ, TRUE AS won, 'primeiro_champion' AS reason FROM runs WHERE rn = 1
  UNION ALL
  SELECT r.rn, CASE WHEN g.reason = 'criterios_atendidos' THEN r.rn ELSE f.champ END,
         g.reason = 'criterios_atendidos', g.reason
  FROM fold f JOIN runs r ON r.rn = f.rn + 1 JOIN runs k ON k.rn = f.champ,
       LATERAL (SELECT CASE WHEN r.wape > k.wape - 1.0 + 1e-9 THEN 'wape'
                            WHEN r.r2 < k.r2 - 0.01 - 1e-9 THEN 'r2'
                            WHEN r.total_linhas < k.total_linhas THEN 'total_linhas'
                            ELSE 'criterios_atendidos' END AS reason) g"""
CTES["met"] = """
  SELECT r.*, f.won AS is_champion, f.reason, k.modelo_versao AS champion_modelo_versao,
         k.run_id AS champion_run_id, k.rmse AS champion_rmse, k.wape AS champion_wape,
         k.mape AS champion_mape,
         round(r.n_wape, 4) AS naive_wape, round(r.a_wape, 4) AS media_saldos_wape,
         r.wape < r.n_wape - 1e-9 AS beats_naive,
         round(r.n_wape - r.wape, 4) AS wape_gain_vs_naive_pp
  FROM runs r JOIN fold f USING (rn) JOIN runs k ON k.rn = f.champ"""

_WORD = re.compile(r"[a-z_][a-z0-9_]*")


def sql(body: str) -> str:
    """The body below the CTEs it names, directly or through others."""
    need: set[str] = set()
    todo = [body]
    while todo:
        for word in set(_WORD.findall(todo.pop().lower())):
            if word in CTES and word not in need:
                need.add(word)
                todo.append(CTES[word])
    if not need:
        return body
    parts = [f"{name} AS ({CTES[name]}\n)" for name in CTES if name in need]
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + body
