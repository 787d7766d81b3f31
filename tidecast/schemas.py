"""Schemas of the bank tables, the panel and the published tables."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _schema(columns: str) -> T.StructType:
    """Schema from ``name type`` pairs; needs no running session."""
    pairs = (c.split() for c in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Column names and order of the exchanged tables.
CUSTOMERS = _schema(
    "customer_id string, first_name string, last_name string, dob date, gender string, "
    "national_id string, email string, phone_number string, kyc_status string, "
    "account_open_date date, customer_segment string, branch_code string"
)
ACCOUNTS = _schema(
    "account_id string, customer_id string, account_type string, currency string, "
    "balance double, branch_code string, account_status string, created_at date, closed_at date"
)
LOANS = _schema(
    "loan_id string, customer_id string, loan_type string, principal_amount double, "
    "interest_rate double, loan_term_months int, start_date date, end_date date, "
    "payment_frequency string, loan_status string, past_due_amount double"
)
BRANCHES = _schema(
    "branch_code string, branch_name string, city string, region string, manager_id string, "
    "open_date date, branch_status string, latitude double, longitude double"
)
TRANSACTIONS = _schema(
    "transaction_id string, account_id string, transaction_type string, amount double, "
    "currency string, transaction_date date, branch_code string, merchant_category string, "
    "status string"
)
LAGS = ["saldo_m1", "saldo_m2", "saldo_m3", "saldo_m4", "saldo_m5", "saldo_m6"]
PANEL = _schema(
    "cliente_id string, idade int, renda_mensal double, segmento string, "
    "tempo_relacionamento int, uf string, genero string, possui_investimento int, "
    "possui_credito int, possui_seguro int, score_credito int, data_referencia date, "
    "saldo_m1 double, saldo_m2 double, saldo_m3 double, saldo_m4 double, saldo_m5 double, "
    "saldo_m6 double, qtd_transacoes_mes bigint, valor_debitos_mes double, "
    "valor_creditos_mes double, qtd_produtos_ativos int, mes int, trimestre int, ano int, "
    "is_fim_de_ano int, is_inicio_de_ano int"
)
PANEL_COLUMNS = PANEL.fieldNames()
# Beside each stored panel row: the file it came from and when that was written; NULL is older than any file.
VERSION = _schema("versao_em timestamp, versao_arquivo string")
STORED_PANEL = T.StructType([*PANEL.fields, *VERSION.fields])
LABEL = "saldo_alvo"
LEGACY_LABEL = "saldo_previsto"
NEXT_DATE = "_proxima_data"

PREDICTIONS = _schema(
    "cliente_id string, data_referencia string, saldo_predito double, saldo_realizado double, "
    "saldo_previsto double, saldo_real double, uf string, dt_processamento string, "
    "modelo_versao string, run_id string, erro_absoluto double, erro_percentual double, "
    "ano int, mes int, segmento string"
)
PREDICTION_PARTITIONS = ["ano", "mes", "segmento"]

METRICS = _schema(
    "rmse double, mae double, r2 double, wape double, smape double, mape double, "
    "metricas_segmento string, metricas_baseline string, modelo_versao string, "
    "dt_processamento string, total_linhas bigint, linhas_adicionadas bigint, "
    "data_referencia_lote string, is_champion boolean, champion_modelo_versao string, "
    "champion_rmse double, champion_wape double, champion_mape double, "
    "run_date string, run_id string"
)
METRIC_PARTITIONS = ["run_date", "run_id"]

METRIC_NAMES = ["rmse", "mae", "r2", "wape", "smape", "mape"]
METRIC_STRUCT = "struct<" + ",".join(f"{m}:double" for m in METRIC_NAMES) + ">"
SEGMENTS = ["VAREJO", "PRIME", "PRIVATE"]

INGEST_LEDGER = _schema("key string, version string, marked_at timestamp")
RUN_LEDGER = _schema(
    "run_id string, phase string, status string, payload string, updated_at timestamp"
)
