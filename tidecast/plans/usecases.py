"""Joins of the published tables with other business tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.functions import scoring as SC
from tidecast.operators import registry as RG
from tidecast.operators.quantiles import exact_quantiles
from tidecast.plans import reports as R

MAX_SEGMENT_WAPE = 25.0


def runs_with_predictions(metrics: DataFrame, predictions: DataFrame) -> DataFrame:
    """Training metrics beside the error of the rows the run published.

    Predictions are summed per run before the join, so only run rows meet.
    """
    published = predictions.groupBy("run_id", "modelo_versao").agg(
        F.count(F.lit(1)).alias("registros"),
        SC.wape_sql("erro_absoluto", "saldo_realizado").alias("wape_publicado"),
    )
    return metrics.select("run_id", "modelo_versao", "wape", "total_linhas", "is_champion").join(
        published, ["run_id", "modelo_versao"]
    )


def limits_for_trusted_segments(
    predictions: DataFrame, metrics: DataFrame, limits: DataFrame, max_wape: float = MAX_SEGMENT_WAPE
) -> DataFrame:
    """Forecasts beside credit limits, for segments the latest run predicts well enough."""
    latest = metrics.orderBy(F.desc("dt_processamento"), "run_id").limit(1)
    trusted = (
        R.exploded_segments(latest).where(F.col("metricas.wape") < max_wape).select("segmento")
    )
    return (
        predictions.join(trusted, "segmento", "left_semi")
        .join(limits, "cliente_id")
        .select("cliente_id", "segmento", "ano", "mes", "saldo_predito", "limite")
    )


def events_by_live_champion(facts: DataFrame, ts: str, metrics: DataFrame) -> DataFrame:
    """Facts counted by the champion that was live in the hour they fell into."""
    from tidecast.functions.calendar import iso_utc

    hourly = facts.groupBy(iso_utc(F.date_trunc("hour", ts)).alias("hora")).agg(
        F.count(F.lit(1)).alias("eventos")
    )
    live = RG.champion_as_of(hourly, "hora", RG.champion_history(metrics))
    return (
        hourly.join(live, "hora")
        .groupBy("champion_run_id")
        .agg(F.sum("eventos").alias("eventos"), F.min("hora").alias("desde"))
    )


def wape_by_balance_quartile(scored: DataFrame, balance: str = "base_naive") -> DataFrame:
    """Error by quartile of the last balance; cutoffs are exact scalars, no global ranking."""
    cuts = exact_quantiles(scored, {f"q{i}": (F.col(balance), i / 4) for i in (1, 2, 3)})
    quartile = F.lit(1)
    for i in (1, 2, 3):
        quartile = quartile + (F.col(balance) > F.lit(cuts[f"q{i}"])).cast("int")
    return scored.groupBy(quartile.alias("quartil")).agg(
        F.count(F.lit(1)).alias("registros"),
        SC.wape_sql("erro_absoluto", "saldo_realizado").alias("wape_pct"),
    )
