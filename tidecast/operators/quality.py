"""Checks over runs, predictions and panels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast import schemas as S
from tidecast.functions import calendar as C
from tidecast.functions import scoring as SC
from tidecast.operators import merge as MG
from tidecast.operators.quantiles import grouped_quantiles
from tidecast.session import materialise

DRIFT_PP = 2.0
RETENTION_MONTHS = 24


def by_run():
    """The run log in time order; one row per retraining."""
    return Window.orderBy("dt_processamento", "run_id")


def processing_checklist(
    expected_months: DataFrame,
    sent_months: DataFrame,
    trained_months: DataFrame,
    metric_runs: DataFrame,
    prediction_parts: DataFrame,
) -> DataFrame:
    """Rows ``(item, ok, detalhe)`` and a last one over all; months come as ``mes_ref``."""

    def count(df: DataFrame) -> Column:
        return df.agg(F.count(F.lit(1)).alias("n")).scalar()

    wanted = expected_months.select("mes_ref").distinct()
    missing = wanted.join(trained_months.select("mes_ref").distinct(), "mes_ref", "left_anti")
    sizes = wanted.agg(F.count(F.lit(1)).alias("esperados")).select(
        "esperados",
        count(sent_months.select("mes_ref").distinct().join(wanted, "mes_ref", "left_semi")).alias("enviados"),
        count(missing).alias("faltando"),
        count(metric_runs).alias("retreinos"),
        count(prediction_parts).alias("particoes"),
    )

    def item(name: str, ok: Column, detail: Column) -> Column:
        return F.struct(F.lit(name).alias("item"), ok.alias("ok"), detail.cast("string").alias("detalhe"))

    c = F.col
    rules = {
        "lotes_enviados": (c("enviados") >= c("esperados"), F.concat_ws("/", c("enviados"), c("esperados"))),
        "meses_no_treino": (c("faltando") == 0, c("faltando")),
        "metricas": (c("retreinos") > 0, c("retreinos")),
        "predicoes": (c("particoes") > 0, c("particoes")),
    }
    overall = F.lit(True)
    for ok, _ in rules.values():
        overall = overall & ok
    items = [item(n, ok, d) for n, (ok, d) in rules.items()]
    items.append(item("geral", overall, F.lit("")))
    return sizes.select(F.inline(F.array(*items)))


def fingerprint_drift(metrics: DataFrame) -> DataFrame:
    """Data fingerprint of each run and whether it changed since the run before."""
    fp = MG.fingerprint(F.col("total_linhas"), F.col("data_referencia_lote").cast("date"))
    marked = metrics.select("run_id", "dt_processamento", fp.alias("dataset_fingerprint"))
    before = F.lag("dataset_fingerprint").over(by_run())
    return marked.withColumn("mudou", ~F.col("dataset_fingerprint").eqNullSafe(before))


def wape_drift(predictions: DataFrame, metrics: DataFrame, margin: float = DRIFT_PP) -> DataFrame:
    """Runs whose published WAPE exceeds their own training WAPE by the margin."""
    published = predictions.groupBy("run_id", "modelo_versao").agg(
        SC.wape_sql("erro_absoluto", "saldo_realizado").alias("wape_publicado")
    )
    trained = metrics.select("run_id", "modelo_versao", F.col("wape").alias("wape_treino"))
    drift = F.col("wape_publicado") - F.col("wape_treino")
    return (
        published.join(trained, ["run_id", "modelo_versao"])
        .withColumn("desvio_pp", drift)
        .where(F.col("desvio_pp") > margin)
    )


def coverage(predictions: DataFrame, customers: DataFrame) -> DataFrame:
    """Distinct customers predicted per run against the whole base."""
    base = customers.agg(F.countDistinct("customer_id").alias("n")).scalar()
    return (
        predictions.groupBy("run_id")
        .agg(F.countDistinct("cliente_id").alias("clientes"))
        .withColumn("base", base)
        .withColumn("cobertura", F.try_divide(F.col("clientes"), F.col("base")))
    )


def drop_alerts(
    predictions: DataFrame, panel: DataFrame, floor: float = 0.0, share: float = 1.0
) -> DataFrame:
    """Predictions below the floor or below a share of the customer's mean history."""
    mean = sum((F.col(c) for c in S.LAGS[1:]), F.col(S.LAGS[0])) / len(S.LAGS)
    history = panel.select(
        "cliente_id",
        F.date_format("data_referencia", "yyyy-MM-dd").alias("data_referencia"),
        mean.alias("media_historico"),
    )
    below_mean = F.col("saldo_predito") < F.col("media_historico") * share
    below_floor = F.col("saldo_predito") < floor
    return (
        predictions.select("cliente_id", "data_referencia", "segmento", "saldo_predito")
        .join(history, ["cliente_id", "data_referencia"])
        .where(below_mean | below_floor)
        .withColumn("abaixo_media", below_mean)
        .withColumn("abaixo_limiar", below_floor)
    )


def segment_cutoffs(predictions: DataFrame, prob: float = 0.8) -> DataFrame:
    """Exact quantile of the forecast of every segment: segmento, corte."""
    cuts = grouped_quantiles(predictions, ["segmento"], F.col("saldo_predito"), prob)
    return materialise(cuts.select("segmento", F.col("q").alias("corte")), "cutoffs")


def above_segment_quantile(predictions: DataFrame, prob: float = 0.8) -> DataFrame:
    """Rows above the segment's quantile, with the quantile; rows without a segment are in no campaign."""
    met = predictions.join(segment_cutoffs(predictions, prob), "segmento")
    return met.where(F.col("saldo_predito") > F.col("corte")).select(*predictions.columns, "corte")


def campaign_snapshot(predictions: DataFrame, model: str, prob: float = 0.8) -> DataFrame:
    """Reproducible campaign list: one model version, above the segment's quantile."""
    return above_segment_quantile(predictions.where(F.col("modelo_versao") == model), prob).select(
        "cliente_id", "segmento", "ano", "mes", "saldo_predito", "corte", "modelo_versao", "run_id"
    )


def finalise(phases: DataFrame) -> DataFrame:
    """Outcome of each run: success only if its validation phase says so."""
    status = F.max(F.when(F.col("phase") == "validate", F.col("status")))
    runs = phases.groupBy("run_id").agg(F.coalesce(status, F.lit("unknown")).alias("validacao"))
    ok = F.col("validacao") == "validated"
    return runs.select(
        "run_id",
        "validacao",
        F.when(ok, 0).otherwise(1).alias("diff_count"),
        F.when(~ok, F.concat(F.lit("status: expected=validated actual="), F.col("validacao"))).alias("diff"),
        F.when(ok, "success").otherwise("failed").alias("status"),
    )


def latency_percentiles(predictions: DataFrame, by: str = "ano") -> DataFrame:
    """Days from period close to prediction; equal latencies are counted before ranking.

    Whole seconds are ranked, and what lies between two of them is divided last, in whole numbers as
    long as possible: 20 times the seconds at a rank of twentieths is whole.
    """
    seconds = F.unix_timestamp(C.parse_iso("dt_processamento")) - F.unix_timestamp(F.col("data_referencia").cast("timestamp"))
    counts = predictions.groupBy(by, seconds.alias("s")).agg(F.count(F.lit(1)).alias("n"))
    at = lambda prob: F.rint(F.expr(f"percentile(s, {prob}D, n)") * 20) / F.lit(20 * 86400.0)
    return counts.groupBy(by).agg(
        at(0.5).alias("p50_dias"),
        at(0.95).alias("p95_dias"),
        F.sum("n").alias("registros"),
    )


def stability(metrics: DataFrame) -> DataFrame:
    """Change of WAPE from run to run and its spread so far."""
    upto = by_run().rowsBetween(Window.unboundedPreceding, 0)
    return metrics.select(
        "run_id",
        "dt_processamento",
        "wape",
        (F.col("wape") - F.lag("wape").over(by_run())).alias("delta_wape"),
        F.stddev_samp("wape").over(upto).alias("desvio_wape"),
    )


def retained(metrics: DataFrame, as_of: Column, months: int = RETENTION_MONTHS, date: str = "run_date") -> DataFrame:
    """Runs of the last months; a plain range on the partition column, so it prunes."""
    oldest = F.date_format(F.add_months(as_of, -months), "yyyy-MM-dd")
    return metrics.where(F.col(date) >= oldest)
