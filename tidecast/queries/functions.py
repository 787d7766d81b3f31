"""Scalar function families, each over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidecast.functions import calendar as C
from tidecast.functions import money as M
from tidecast.functions import recode as R
from tidecast.queries.base import Lab, query, stamp


@query("FN-str", """
SELECT c_custkey, upper(c_mktsegment) AS maiuscula, lower(c_mktsegment) AS minuscula,
       left(upper(c_mktsegment), 1) AS inicial, lpad(c_nationkey::VARCHAR, 2, '0') AS nacao,
       c_name || '/' || c_mktsegment AS junto, c_name LIKE 'Customer#00000%' AS prefixo,
       regexp_extract(c_name, '#([0-9]+)', 1)::BIGINT AS numero,
       'CUST' || lpad(c_custkey::VARCHAR, 6, '0') AS codigo,
       trim(split_part(c_mktsegment || ' , ' || c_name, ',', 2)) AS parte
FROM customer""")
def _(lab: Lab):
    m = F.col("c_mktsegment")
    return lab.table("customer").select(
        "c_custkey",
        F.upper(m).alias("maiuscula"),
        F.lower(m).alias("minuscula"),
        R.gender_letter(m).alias("inicial"),
        F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("nacao"),
        F.concat("c_name", F.lit("/"), m).alias("junto"),
        F.col("c_name").like("Customer#00000%").alias("prefixo"),
        F.regexp_extract("c_name", "#([0-9]+)", 1).cast("bigint").alias("numero"),
        F.format_string("CUST%06d", "c_custkey").alias("codigo"),
        F.trim(F.split(F.concat_ws(" , ", m, "c_name"), ",")[1]).alias("parte"),
    )


@query("FN-date", """
SELECT event_id, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hora,
       strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS minuto,
       (minute(ts) // 15)::INTEGER AS quarto,
       strftime(date_trunc('hour', ts) + to_minutes((minute(ts) // 15) * 15), '%Y-%m-%d %H:%M:%S') AS slot_15m,
       strftime(last_day(ts), '%Y-%m-%d') AS fim_mes, year(ts)::INTEGER AS ano, month(ts)::INTEGER AS mes,
       quarter(ts)::INTEGER AS trimestre,
       date_diff('day', ts::DATE, DATE '2024-02-01')::INTEGER AS dias,
       strftime(date_trunc('second', ts) - INTERVAL 6 HOURS, '%Y-%m-%d %H:%M:%S') AS antes,
       strftime(ts, '%Y-%m') = '2024-01' AS mesmo_mes,
       strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS iso
FROM events""")
def _(lab: Lab):
    ts = F.col("ts")
    hour = F.date_trunc("hour", ts)
    quarter = F.expr("minute(ts) div 15").cast("int")
    iso = C.iso_utc(ts)
    return lab.events.select(
        "event_id",
        stamp(hour, "hora"),
        stamp(F.date_trunc("minute", ts), "minuto"),
        quarter.alias("quarto"),
        stamp(C.slot_15m("ts"), "slot_15m"),
        F.date_format(F.last_day(ts), "yyyy-MM-dd").alias("fim_mes"),
        F.year(ts).alias("ano"),
        F.month(ts).alias("mes"),
        F.quarter(ts).alias("trimestre"),
        F.datediff(F.lit("2024-02-01").cast("date"), ts).alias("dias"),
        stamp(C.parse_iso(iso) - F.make_dt_interval(hours=F.lit(6)), "antes"),
        (C.month_key(ts) == "2024-01").alias("mesmo_mes"),
        iso.alias("iso"),
    )


@query("FN-math", """
SELECT l_orderkey, l_linenumber, abs(l_extendedprice * (l_discount - l_tax)) AS absoluto,
       round(l_extendedprice / 7, 4) AS arredondado, round(sqrt(l_extendedprice), 6) AS raiz,
       least(greatest(l_extendedprice, 5000.0::DOUBLE), 40000.0::DOUBLE) AS limitado,
       coalesce(nullif(l_discount, 0), -1) AS sem_zero,
       (l_extendedprice - l_quantity) / (abs(l_quantity) + 1) AS variacao
FROM lineitem""")
def _(lab: Lab):
    price, qty = F.col("l_extendedprice"), F.col("l_quantity")
    return lab.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.abs(price * (F.col("l_discount") - F.col("l_tax"))).alias("absoluto"),
        F.round(price / 7, 4).alias("arredondado"),
        F.round(F.sqrt(price), 6).alias("raiz"),
        M.clip(price, 5000.0, 40000.0).alias("limitado"),
        F.coalesce(F.nullif("l_discount", F.lit(0.0)), F.lit(-1.0)).alias("sem_zero"),
        ((price - qty) / (F.abs(qty) + 1)).alias("variacao"),
    )


@query("FN-json", """
SELECT event_id, (props->>'$.k')::DOUBLE AS k, (props->>'$.k')::DOUBLE > 50 AS alto,
       '{"tipo":"' || event_type || '","k":' || (props->>'$.k') || '}' AS dump
FROM events""")
def _(lab: Lab):
    k = F.get_json_object("props", "$.k")
    parsed = F.from_json("props", "map<string,string>")
    dump = F.to_json(F.struct(F.col("event_type").alias("tipo"), parsed["k"].cast("int").alias("k")))
    return lab.events.select(
        "event_id", k.cast("double").alias("k"), (k.cast("double") > 50).alias("alto"), dump.alias("dump")
    )


@query("FN-map", """
SELECT c_custkey, chave, valor FROM (
  SELECT c_custkey, unnest(['mercado', 'nacao', 'segmento']) AS chave,
         unnest([c_mktsegment, c_nationkey::VARCHAR,
                 CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'VAREJO' WHEN 'FURNITURE' THEN 'PRIVATE'
                      ELSE 'PRIME' END]) AS valor FROM customer)""")
def _(lab: Lab):
    table = {"HOUSEHOLD": "VAREJO", "FURNITURE": "PRIVATE"}
    a = F.create_map(F.lit("mercado"), F.col("c_mktsegment"), F.lit("nacao"), F.col("c_nationkey").cast("string"))
    b = F.create_map(F.lit("segmento"), R.recode(F.col("c_mktsegment"), table, "PRIME"))
    return lab.table("customer").select(
        "c_custkey", F.explode(F.map_concat(a, b)).alias("chave", "valor")
    )


@query("FN-hash", """
SELECT o_orderkey, left(md5(o_orderkey::VARCHAR || '|' || o_orderstatus), 8) AS md5_8,
       left(sha256(o_orderkey::VARCHAR || '|' || strftime(o_orderdate, '%Y-%m-%d')), 16) AS sha_16
FROM orders""")
def _(lab: Lab):
    key = F.col("o_orderkey").cast("string")
    return lab.table("orders").select(
        "o_orderkey",
        F.substring(F.md5(F.concat_ws("|", key, "o_orderstatus")), 1, 8).alias("md5_8"),
        F.substring(
            F.sha2(F.concat_ws("|", key, F.date_format("o_orderdate", "yyyy-MM-dd")), 256), 1, 16
        ).alias("sha_16"),
    )


@query("FN-cast", """
SELECT event_id, coalesce(TRY_CAST(v AS BIGINT), 0) AS inteiro, lower(v) IN ('1', 'true', 'yes') AS sinal,
       event_id::VARCHAR AS texto
FROM (SELECT event_id, CASE event_type WHEN 'click' THEN 'TRUE' WHEN 'view' THEN 'yes'
        WHEN 'error' THEN '1' WHEN 'signup' THEN user_id::VARCHAR ELSE 'x' || user_id::VARCHAR END AS v
      FROM events)""")
def _(lab: Lab):
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    v = (
        F.when(kind == "click", "TRUE")
        .when(kind == "view", "yes")
        .when(kind == "error", "1")
        .when(kind == "signup", user)
        .otherwise(F.concat(F.lit("x"), user))
    )
    return lab.events.select(
        "event_id",
        R.safe_int(v).alias("inteiro"),
        R.as_flag(v).alias("sinal"),
        F.col("event_id").cast("string").alias("texto"),
    )


@query("FN-cond", """
SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END, 0) AS valor,
       nullif(o_orderstatus, 'F') AS estado,
       CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice ELSE 0.0::DOUBLE END AS urgente
FROM orders""")
def _(lab: Lab):
    price = F.col("o_totalprice")
    return lab.table("orders").select(
        "o_orderkey",
        F.coalesce(F.when(F.col("o_orderstatus") != "P", price), F.lit(0.0)).alias("valor"),
        F.nullif("o_orderstatus", F.lit("F")).alias("estado"),
        F.when(F.col("o_orderpriority") == "1-URGENT", price).otherwise(F.lit(0.0)).alias("urgente"),
    )
