"""Sources, sinks and incremental processing.

Each query writes what it derives from the given tables to a new path in the
shared folder and returns what reading that path gives back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidecast import jobs as J
from tidecast import schemas as S
from tidecast.functions import calendar as C
from tidecast.operators import panel as P
from tidecast.operators import registry as RG
from tidecast.plans import reports as R
from tidecast.queries.aggregates import category_summary
from tidecast.queries.base import AS_OF, Lab, day, query, stamp
from tidecast.queries.joins import LEDGER, LISTING, monthly_files
from tidecast.queries.oracle import money_avg, money_sum, sql
from tidecast.queries.projections import PANEL_SELECT, panel_text
from tidecast.queries.reports import pred
from tidecast.session import fresh_path
from tidecast.sinks import ledger as LG
from tidecast.sinks import tables as TB
from tidecast.sources import bank as SB
from tidecast.sources import tables as ST
from tidecast.streaming import ingest as IN
from tidecast.streaming import slots as SL

ORDERS_CSV = """
SELECT o_orderkey, o_custkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
       o_orderpriority FROM orders"""
ORDER_SCHEMA = S._schema(
    "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate date, o_orderpriority string"
)


def orders_csv(lab: Lab, where=None, backwards: bool = False) -> str:
    path = fresh_path(lab.spark, "orders-csv")
    o = lab.table("orders")
    o = o.where(where) if where is not None else o
    cols = ["o_orderkey", "o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("o_orderdate"), "o_orderpriority"]
    TB.write_csv(o.select(*(cols[::-1] if backwards else cols)), path)
    return path


def first_half():
    return F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")


@query("SRC-1", ORDERS_CSV)
def _(lab: Lab):
    return SB.read_csv(lab.spark, orders_csv(lab, backwards=True), ORDER_SCHEMA).withColumn("o_orderdate", day("o_orderdate"))


@query("SRC-2", "SELECT 'presente' AS fonte, count(*) AS linhas FROM orders UNION ALL SELECT 'ausente', 0")
def _(lab: Lab):
    def rows(path, name):
        df = SB.read_csv_or_empty(lab.spark, path, ORDER_SCHEMA)
        return df.agg(F.lit(name).alias("fonte"), F.count(F.lit(1)).alias("linhas"))

    there = orders_csv(lab)
    return rows(there, "presente").union(rows(there + "-nunca", "ausente"))


@query("SRC-3", sql(f"SELECT {PANEL_SELECT} FROM panel_c"))
def _(lab: Lab):
    root = fresh_path(lab.spark, "bank")
    b = lab.bank
    TB.write_csv(TB.conform(b.customers, S.CUSTOMERS), f"{root}/customers.csv")
    TB.write_csv(TB.conform(b.accounts, S.ACCOUNTS), f"{root}/accounts.csv")
    TB.write_csv(TB.conform(b.branches, S.BRANCHES), f"{root}/branches.csv")
    TB.write_csv(TB.conform(b.loans, S.LOANS), f"{root}/loans.csv")
    TB.conform(b.transactions, S.TRANSACTIONS).write.parquet(f"{root}/transactions.parquet")
    return panel_text(P.monthly_panel(SB.load_bank(lab.spark, root), AS_OF))


@query("SRC-4", f"""
SELECT *, NULL::VARCHAR AS origem FROM ({ORDERS_CSV} WHERE o_orderdate < TIMESTAMP '1998-01-01')
UNION ALL SELECT *, 'extra' FROM ({ORDERS_CSV} WHERE o_orderdate >= TIMESTAMP '1998-01-01')""")
def _(lab: Lab):
    old = orders_csv(lab, first_half())
    new = SB.read_csv(lab.spark, orders_csv(lab, ~first_half()), ORDER_SCHEMA)
    wider = fresh_path(lab.spark, "orders-wide")
    TB.write_csv(new.withColumn("origem", F.lit("extra")), wider)
    both = ST.read_incoming(lab.spark, [old, "", "  ", wider])
    return both.select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
        F.col("o_custkey").cast("bigint").alias("o_custkey"),
        "o_totalprice",
        day("o_orderdate"),
        "o_orderpriority",
        "origem",
    )


@query("SRC-5", """
SELECT forma, linhas FROM (SELECT count(*) AS linhas FROM orders), (VALUES ('json'), ('virgulas'), ('lista')) v(forma)""")
def _(lab: Lab):
    a, b = orders_csv(lab, first_half()), orders_csv(lab, ~first_half())
    forms = {"json": f'["{a}", "{b}"]', "virgulas": f" {a}, ,{b} ", "lista": [a, b]}
    parts = [
        ST.read_incoming(lab.spark, raw, ORDER_SCHEMA).agg(
            F.lit(name).alias("forma"), F.count(F.lit(1)).alias("linhas")
        )
        for name, raw in forms.items()
    ]
    return parts[0].union(parts[1]).union(parts[2])


PRED_COLS = [
    "cliente_id", "data_referencia", "saldo_predito", "saldo_realizado", "run_id", "ano", "mes", "segmento",
]


@query("SRC-6", sql(f"SELECT {', '.join(PRED_COLS)} FROM pred"))
def _(lab: Lab):
    path = fresh_path(lab.spark, "pred")
    TB.write_predictions(lab.predictions, path)
    flat = fresh_path(lab.spark, "pred-flat")
    recent = F.col("ano") >= 2000
    back = ST.read_partitioned(lab.spark, path).where(~recent)
    lab.predictions.where(recent).drop("ano", "mes").write.parquet(flat)
    loose = ST.read_partitioned(lab.spark, flat)
    both = R.unified(back).select(*PRED_COLS).unionByName(R.unified(loose).select(*PRED_COLS))
    return both


@query("SRC-7", f"""
SELECT o_orderpriority AS category, {money_avg("o_totalprice")} AS avg_value,
       {money_sum("o_totalprice")} AS total_value, count(*) AS record_count FROM orders GROUP BY 1""")
def _(lab: Lab):
    return category_summary(SB.read_csv(lab.spark, orders_csv(lab)), "o_orderpriority", "o_totalprice")


ORDER_FILES = {"1": "um.csv", "2": "DOIS.CSV", "3": "tres.txt", "4": "quatro.Csv", "5": "cinco.csv"}


def order_files(lab: Lab, fmt: str = "csv") -> str:
    """Orders as one file per priority, with names in mixed case and one that is no CSV."""
    root = fresh_path(lab.spark, "incoming")
    o = lab.table("orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    for digit, name in ORDER_FILES.items():
        part = o.where(F.col("o_orderpriority").startswith(digit)).drop("o_orderpriority")
        part.write.mode("overwrite").option("header", True).csv(f"{root}/{name}")
    return root


@query("SRC-8", """
SELECT CASE left(o_orderpriority, 1) WHEN '1' THEN 'um.csv' WHEN '2' THEN 'DOIS.CSV' WHEN '4' THEN 'quatro.Csv'
       WHEN '5' THEN 'cinco.csv' ELSE 'tres.txt' END AS pasta, left(o_orderpriority, 1) <> '3' AS csv, count(*) AS linhas
FROM orders GROUP BY ALL""")
def _(lab: Lab):
    root = order_files(lab)
    files = ST.list_files(lab.spark, root).withColumn("pasta", F.element_at(F.split("key", "/"), -2))
    parts = files.where(~F.col("pasta").endswith(".txt")).select("pasta").distinct()
    rows = lab.spark.read.option("header", True).csv([f"{root}/{name}" for name in ORDER_FILES.values()])
    rows = rows.select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).alias("pasta"))
    shown = rows.join(parts.withColumn("csv", F.lit(True)), "pasta", "left")
    return shown.groupBy("pasta", F.coalesce("csv", F.lit(False)).alias("csv")).agg(F.count(F.lit(1)).alias("linhas"))


@query("SRC-9", """
SELECT 'r1' AS run_id, count(*) > 0 AS has_data, 'validated' AS status FROM orders
UNION ALL SELECT 'r2', FALSE, 'no_input'""")
def _(lab: Lab):
    root = orders_csv(lab)
    return ST.input_status(lab.spark, root, "r1").union(ST.input_status(lab.spark, root + "-nunca", "r2"))


@query("SRC-10", sql("""
SELECT 'com' AS caso, run_id, round(wape, 6) AS wape FROM (
  SELECT run_id, wape FROM met WHERE is_champion ORDER BY dt_processamento DESC LIMIT 1)
UNION ALL SELECT 'sem', NULL, NULL"""))
def _(lab: Lab):
    cfg = J.Config(root=fresh_path(lab.spark, "registry"))
    none = J.current_champion(lab.spark, cfg).agg(
        F.lit("sem").alias("caso"), F.max("run_id").alias("run_id"), F.max("wape").alias("wape")
    )
    history = RG.champion_history(lab.metrics)
    LG.append_rows(TB.conform(history, J.CHAMPIONS), cfg.champions)
    some = J.current_champion(lab.spark, cfg).select(
        F.lit("com").alias("caso"), "run_id", F.round("wape", 6).alias("wape")
    )
    return some.union(none)


def catalog_name(stem: str) -> str:
    return f"{stem}_{uuid.uuid4().hex[:12]}"


def catalog_predictions(lab: Lab) -> tuple[str, str]:
    path, name = fresh_path(lab.spark, "pred"), catalog_name("pred")
    TB.write_predictions(lab.predictions, path)
    ST.create_external(lab.spark, name, path, S.PREDICTIONS, S.PREDICTION_PARTITIONS)
    return name, path


BY_PART = "SELECT ano, mes, segmento, count(*) AS registros FROM pred GROUP BY 1, 2, 3"


@query("SRC-11", sql(BY_PART))
def _(lab: Lab):
    name, _ = catalog_predictions(lab)
    TB.discover_partitions(lab.spark, name)
    return R.rows_by_partition(lab.spark.table(name))


# sinks


@query("SNK-1", sql(f"SELECT {PANEL_SELECT}, saldo_alvo FROM lab_c"))
def _(lab: Lab):
    path = fresh_path(lab.spark, "treino")
    rows = lab.labelled_c.select(*S.PANEL_COLUMNS, S.LABEL)
    for _ in range(2):
        TB.write_csv(rows, path)
    back = SB.read_csv(lab.spark, path, rows.schema)
    return back.withColumn("data_referencia", day())


@query("SNK-2", sql("""
SELECT modo, count(*) AS linhas, count(DISTINCT (ano, mes, segmento)) AS particoes
FROM (SELECT 'substitui' AS modo, ano, mes, segmento FROM pred
      UNION ALL SELECT 'acrescenta', ano, mes, segmento FROM pred
      UNION ALL SELECT 'acrescenta', ano, mes, segmento FROM pred WHERE ano = 1999)
GROUP BY 1"""))
def _(lab: Lab):
    def sizes(mode, append):
        path = fresh_path(lab.spark, "pred")
        TB.write_predictions(lab.predictions, path)
        TB.write_predictions(lab.predictions.where("ano = 1999"), path, append=append)
        return ST.read_predictions(lab.spark, path).agg(
            F.lit(mode).alias("modo"),
            F.count(F.lit(1)).alias("linhas"),
            F.countDistinct("ano", "mes", "segmento").alias("particoes"),
        )

    return sizes("substitui", False).union(sizes("acrescenta", True))


MET_COLS = "run_date, run_id, linhas_adicionadas, total_linhas, is_champion, champion_modelo_versao"


@query("SNK-3", sql(f"SELECT {MET_COLS}, round(wape, 6) AS wape, round(champion_wape, 6) AS champion_wape FROM met"))
def _(lab: Lab):
    path = fresh_path(lab.spark, "met")
    TB.write_metrics(lab.metrics, path)
    TB.write_metrics(lab.metrics.where(F.col("run_id").startswith("lote-")), path)
    return ST.read_metrics(lab.spark, path).select(
        *MET_COLS.split(", "), F.round("wape", 6).alias("wape"), F.round("champion_wape", 6).alias("champion_wape")
    )


@query("SNK-4", sql("""
SELECT run_id, 0::BIGINT AS linhas_adicionadas, total_linhas, 0.0::DOUBLE AS champion_mape,
       '' AS data_referencia_lote FROM met0"""))
def _(lab: Lab):
    bare = lab.metrics.drop("linhas_adicionadas", "champion_mape", "data_referencia_lote")
    return TB.metric_defaults(bare).select(
        "run_id", "linhas_adicionadas", "total_linhas", "champion_mape", "data_referencia_lote"
    )


@query("SNK-5", sql("""
SELECT run_id, modelo_versao, linhas_adicionadas, round(mae, 6) AS mae, round(wape, 6) AS wape FROM met0"""))
def _(lab: Lab):
    path = fresh_path(lab.spark, "json")
    TB.write_json(lab.metrics, path)
    back = lab.spark.read.schema(S.METRICS).json(path)
    return back.select(
        "run_id", "modelo_versao", "linhas_adicionadas", F.round("mae", 6).alias("mae"), F.round("wape", 6).alias("wape")
    )


@query("SNK-6", sql("""
SELECT strftime(data_referencia, '%Y-%m-%d') AS dt, 'r7' AS run_id, cliente_id, saldo_m1 FROM panel
WHERE data_referencia >= DATE '2001-01-01'"""))
def _(lab: Lab):
    path = fresh_path(lab.spark, "landing")
    batch = lab.panel.where(F.col("data_referencia") >= F.lit("2001-01-01").cast("date"))
    TB.write_landing(batch, path, F.col("data_referencia"), "r7")
    back = lab.spark.read.parquet(path)
    return back.select(
        F.date_format(F.col("dt").cast("date"), "yyyy-MM-dd").alias("dt"),
        F.col("run_id").cast("string").alias("run_id"),
        "cliente_id",
        "saldo_m1",
    )


@query("SNK-7", sql(BY_PART))
def _(lab: Lab):
    name, path = catalog_predictions(lab)
    written = ST.read_predictions(lab.spark, path)
    for _ in range(2):
        TB.register_partitions(lab.spark, name, written, S.PREDICTION_PARTITIONS)
    return R.rows_by_partition(lab.spark.table(name))


@query("SNK-8", sql("SELECT DISTINCT ano, mes, segmento FROM pred"))
def _(lab: Lab):
    name, _ = catalog_predictions(lab)
    TB.discover_partitions(lab.spark, name)
    found = lab.spark.sql(f"SHOW PARTITIONS {name}")
    part = [F.regexp_extract("partition", f"{c}=([^/]+)", 1) for c in S.PREDICTION_PARTITIONS]
    return found.select(
        part[0].cast("int").alias("ano"), part[1].cast("int").alias("mes"), part[2].alias("segmento")
    )


@query("SNK-9", sql("SELECT cliente_id, data_referencia, saldo_predito, ano >= 1998 AS novo FROM pred"))
def _(lab: Lab):
    old_cols = [c for c in S.PREDICTIONS.fieldNames() if c not in ("saldo_predito", "saldo_realizado")]
    path, name = fresh_path(lab.spark, "pred"), catalog_name("pred")
    old = lab.predictions.where("ano < 1998").select(*old_cols)
    old.write.partitionBy(*S.PREDICTION_PARTITIONS).parquet(path)
    old_schema = S.T.StructType([S.PREDICTIONS[c] for c in old_cols])
    ST.create_external(lab.spark, name, path, old_schema, S.PREDICTION_PARTITIONS)
    TB.write_predictions(lab.predictions.where("ano >= 1998"), path)
    for _ in range(2):
        TB.add_columns(lab.spark, name, {"saldo_predito": "double", "saldo_realizado": "double"})
    TB.discover_partitions(lab.spark, name)
    t = lab.spark.table(name)
    return R.unified(t.withColumn("novo", F.col("saldo_predito").isNotNull())).select(
        "cliente_id", "data_referencia", "saldo_predito", "novo"
    )


@query("SNK-10", f"""
SELECT event_type AS category, {money_avg("value")} AS avg_value, {money_sum("value")} AS total_value,
       count(*) AS record_count, 1 AS arquivos FROM events GROUP BY 1""")
def _(lab: Lab):
    path = fresh_path(lab.spark, "summary")
    out = category_summary(lab.events, "event_type", "value")
    TB.write_csv(out, path, single=True)
    back = SB.read_csv(lab.spark, path, out.schema)
    files = ST.list_files(lab.spark, path).agg(F.count(F.lit(1)).cast("int")).scalar()
    return back.withColumn("arquivos", files)


@query("SNK-11", sql(f"""
SELECT 'mes' AS relatorio, count(*) AS linhas FROM (SELECT DISTINCT ano, mes FROM pred)
UNION ALL SELECT 'detalhe', least(count(*), 500) FROM pred
UNION ALL SELECT 'evolucao', count(*) FROM met0"""))
def _(lab: Lab):
    p, root = pred(lab), fresh_path(lab.spark, "reports")
    frames = {"mes": R.truth_by_month(p), "detalhe": R.detail_sample(p), "evolucao": R.metric_evolution(lab.metrics)}
    parts = []
    for name, df in frames.items():
        TB.write_csv(df, f"{root}/{name}", single=True)
        back = SB.read_csv(lab.spark, f"{root}/{name}", df.schema)
        parts.append(back.agg(F.lit(name).alias("relatorio"), F.count(F.lit(1)).alias("linhas")))
    return parts[0].union(parts[1]).union(parts[2])


@query("SNK-13", sql("""
SELECT run_id, CASE WHEN linhas_adicionadas >= 10 THEN 'success' ELSE 'failed' END AS status,
       'finalize' AS phase, linhas_adicionadas AS linhas FROM met0"""))
def _(lab: Lab):
    path = fresh_path(lab.spark, "runs")
    LG.append_rows(run_phases(lab), path)
    latest = LG.latest_runs(LG.read_run_ledger(lab.spark, path))
    return latest.select(
        "run_id", "status", "phase", F.get_json_object("payload", "$.linhas").cast("bigint").alias("linhas")
    )


def run_phases(lab: Lab):
    """Three ledger rows per run: check, validate and finalise."""
    enough = F.col("linhas_adicionadas") >= 10
    status = [
        ("check_new_data", F.lit("new_data")),
        ("validate", F.when(enough, "validated").otherwise("no_input")),
        ("finalize", F.when(enough, "success").otherwise("failed")),
    ]
    at = C.parse_iso("dt_processamento")
    rows = [
        F.struct(F.lit(p).alias("phase"), s.alias("status"), (at + F.make_dt_interval(secs=F.lit(i))).alias("updated_at"))
        for i, (p, s) in enumerate(status)
    ]
    payload = F.to_json(F.struct(F.col("linhas_adicionadas").alias("linhas")))
    long = lab.metrics.select("run_id", payload.alias("payload"), F.inline(F.array(*rows)))
    return long.select("run_id", "phase", "status", "payload", "updated_at")


# incremental


@query("STR-1", f"""
SELECT l.key, l.version, d.key IS NOT NULL AS alterado FROM ({LISTING}) l
LEFT JOIN ({LEDGER}) d USING (key) WHERE d.version IS DISTINCT FROM l.version""")
def _(lab: Lab):
    listing, ledger = monthly_files(lab)
    known = LG.latest_versions(ledger).select("key", F.lit(True).alias("alterado"))
    return LG.unprocessed(listing, ledger).join(known, "key", "left").fillna(False, ["alterado"])


@query("STR-2", f"SELECT key, version FROM ({LISTING})")
def _(lab: Lab):
    listing, ledger = monthly_files(lab)
    path = fresh_path(lab.spark, "ledger")
    LG.append_rows(TB.conform(ledger, S.INGEST_LEDGER), path)
    LG.mark_processed(LG.unprocessed(listing, LG.read_ingest_ledger(lab.spark, path)), path)
    return LG.latest_versions(LG.read_ingest_ledger(lab.spark, path)).select("key", "version")


@query("STR-3", f"""
WITH n AS (SELECT l.key, l.version FROM ({LISTING}) l
  WHERE NOT EXISTS (SELECT 1 FROM ({LEDGER}) d WHERE d.key = l.key AND d.version = l.version))
SELECT 'novos' AS caso, (SELECT count(*) > 0 FROM n) AS has_new_data, (SELECT count(*) FROM n) AS incoming_count,
       NULL::VARCHAR AS skip_reason, key, version FROM n
UNION ALL SELECT 'ocupado', FALSE, 0, 'job_running', NULL, NULL
UNION ALL SELECT 'nada', FALSE, 0, 'no_new_data', NULL, NULL""")
def _(lab: Lab):
    listing, ledger = monthly_files(lab)
    done = listing.withColumn("marked_at", F.current_timestamp())
    cases = {"novos": (listing, ledger, False), "ocupado": (listing, ledger, True), "nada": (listing, done, False)}
    rows = []
    for name, (files, marks, busy) in cases.items():
        files = files.withColumn("modified", F.lit(None).cast("timestamp"))
        new = LG.new_files(files, marks, busy).select(F.lit(name).alias("caso"), "key", "version")
        rows.append(LG.should_run(files, marks, busy).withColumn("caso", F.lit(name)).join(new, "caso", "left"))
    return rows[0].union(rows[1]).union(rows[2])


@query("STR-4", """
SELECT m AS minutos, (epoch(TIMESTAMP '2024-01-30 00:00:00') - epoch(max(ts))) / 60 >= m AS due
FROM events, (VALUES (2), (15), (100000)) v(m) GROUP BY 1 UNION ALL SELECT 0, TRUE""")
def _(lab: Lab):
    ledger = lab.events.select(F.col("ts").alias("marked_at"))
    now = F.lit("2024-01-30 00:00:00").cast("timestamp")
    out = LG.due(ledger.where("false"), now, 10).select(F.lit(0).alias("minutos"), "due")
    for m in (2, 15, 100000):
        out = out.union(LG.due(ledger, now, m).select(F.lit(m), "due"))
    return out


CUT = "2001-01-01"


def seeded_panel(lab: Lab):
    """Stored history, and the later months as incoming CSV files, one per month.

    The files order their columns the other way round and bring no year or
    month. All months came before with other balances, in one file that is older.
    """
    root = fresh_path(lab.spark, "replay")
    panel = lab.panel
    later = F.col("data_referencia") >= F.lit(CUT).cast("date")
    TB.write_panel(panel.where(~later), f"{root}/panel")
    batch = panel.where(later).withColumn("lote", C.month_key("data_referencia"))
    batch = batch.select(*[c for c in reversed(panel.columns) if c not in ("ano", "mes")], "lote")
    older = batch.withColumn("saldo_m1", F.col("saldo_m1") + 1).drop("lote")
    TB.write_csv(older, f"{root}/incoming/a", single=True)
    batch.repartition("lote").write.partitionBy("lote").option("header", True).csv(f"{root}/incoming/b")
    return root, panel.where(later)


@query("STR-5", sql(f"""
SELECT 'r1' AS run_id, strftime(max(data_referencia), '%Y-%m-%d') AS data_referencia,
       count(*) FILTER (data_referencia >= DATE '{CUT}') AS rows_incoming,
       0::BIGINT AS rows_rejected, count(*) FILTER (data_referencia >= DATE '{CUT}') AS rows_added,
       count(*) FILTER (data_referencia < DATE '{CUT}') AS rows_before, count(*) AS total_rows
FROM panel"""))
def _(lab: Lab):
    root, batch = seeded_panel(lab)
    report = IN.ingest_batch(lab.spark, batch, f"{root}/panel", "r1", landing=f"{root}/landing")
    return report.drop("landing_key")


def replayed(lab: Lab, files_per_batch):
    root, _ = seeded_panel(lab)
    batches = IN.replay(
        lab.spark, f"{root}/incoming", f"{root}/panel", f"{root}/checkpoint", f"{root}/ledger", files_per_batch
    )
    marked = LG.latest_versions(LG.read_ingest_ledger(lab.spark, f"{root}/ledger"))
    files = marked.agg(F.count(F.lit(1))).scalar()
    panel = panel_text(IN.read_panel(lab.spark, f"{root}/panel"))
    return panel.withColumns({"lotes": F.lit(batches).cast("bigint"), "arquivos": files})


LATER = f"(SELECT 1 + count(DISTINCT data_referencia) FROM panel WHERE data_referencia >= DATE '{CUT}')"


@query("STR-5-order", sql(f"SELECT {PANEL_SELECT} FROM panel"))
def _(lab: Lab):
    """The newer half of the months first, then the older half, and at last an older file with other balances of them all."""
    root, _ = seeded_panel(lab)
    keys = sorted(r["key"] for r in ST.list_files(lab.spark, f"{root}/incoming/b").select("key").collect())
    older = [r["key"] for r in ST.list_files(lab.spark, f"{root}/incoming/a").select("key").collect()]
    half = len(keys) // 2
    for i, run in enumerate([keys[half:], keys[:half], older]):
        IN.ingest_batch(lab.spark, ST.read_incoming(lab.spark, run, S.PANEL), f"{root}/panel", f"r{i}")
    return panel_text(IN.read_panel(lab.spark, f"{root}/panel"))


@query("STR-6", sql(f"SELECT {PANEL_SELECT}, {LATER} AS lotes, {LATER} AS arquivos FROM panel"))
def _(lab: Lab):
    return replayed(lab, 1)


@query("STR-7", sql(f"SELECT {PANEL_SELECT}, 1::BIGINT AS lotes, {LATER} AS arquivos FROM panel"))
def _(lab: Lab):
    return replayed(lab, None)


@query("STR-8", sql(f"SELECT {PANEL_SELECT} FROM panel"))
def _(lab: Lab):
    path = fresh_path(lab.spark, "panel")
    TB.replace_panel(lab.panel_c, path)
    TB.replace_panel(lab.panel, path)
    return panel_text(IN.read_panel(lab.spark, path))


@query("STR-9", f"""
SELECT strftime(slot, '%Y-%m-%d %H:%M:%S') AS slot_15m, event_type, n, total,
       slot + INTERVAL 15 MINUTES > (SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL 10 MINUTES AS aberto, FALSE AS corrigido
FROM (SELECT time_bucket(INTERVAL 15 MINUTES, ts) AS slot, event_type, count(*) AS n,
             {money_sum("value")} AS total FROM events GROUP BY 1, 2)""")
def _(lab: Lab):
    root = fresh_path(lab.spark, "slots")
    stream = SL.event_stream(lab.spark, lab.root, lab.table("events").schema)
    SL.drain(stream, f"{root}/out", f"{root}/checkpoint", "event_type", "value")
    out = SL.slots(lab.spark, f"{root}/out", stream.schema, "event_type").select("slot_15m", "event_type", "n", "total", "aberto", "corrigido")
    return out.withColumn("slot_15m", stamp("slot_15m", "slot_15m"))
