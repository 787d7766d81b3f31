"""Hold-out metrics per run, per segment and for the baselines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast import schemas as S
from tidecast.functions import scoring as SC

MIN_SEGMENT_ROWS = 2


def holdout_metrics(df: DataFrame, real: str = "saldo_realizado", pred: str = "saldo_predito") -> DataFrame:
    return df.agg(*SC.metric_aggregates(real, pred))


def segment_metrics(
    df: DataFrame, by: list[str], real: str = "saldo_realizado", pred: str = "saldo_predito"
) -> DataFrame:
    """Metrics per group; groups below two rows are left out."""
    return (
        df.groupBy(*by)
        .agg(F.count(F.lit(1)).alias("registros"), *SC.metric_aggregates(real, pred))
        .where(F.col("registros") >= MIN_SEGMENT_ROWS)
    )


def baseline_metrics(df: DataFrame, real: str = "saldo_realizado") -> DataFrame:
    """One row per baseline: last balance carried forward, and mean of the lags."""
    return (
        df.select(
            F.col(real).alias("y"),
            F.inline(
                F.array(
                    F.struct(F.lit("naive_saldo_m1").alias("baseline"), F.col("base_naive").alias("p")),
                    F.struct(F.lit("media_saldos_m1_m6").alias("baseline"), F.col("base_media").alias("p")),
                )
            ),
        )
        .groupBy("baseline")
        .agg(*SC.metric_aggregates("y", "p"))
    )


def _segment_map() -> Column:
    entry = F.struct(F.col("segmento"), F.col("_m"))
    keep = F.col("segmento").isNotNull() & (F.col("linhas") >= MIN_SEGMENT_ROWS)
    return F.map_from_entries(F.array_sort(F.collect_list(F.when(keep, entry))))


def run_metrics(scored: DataFrame) -> DataFrame:
    """One row per run: global, per-segment and baseline metrics.

    Grouping sets give the run row and its segment rows in one pass and one
    shuffle; the nesting step only sees a handful of rows per run.
    """
    run = ["run_id", "modelo_versao", "dt_processamento"]
    real = F.col("saldo_realizado")
    sets = scored.groupingSets(
        [[F.col(c) for c in run], [F.col(c) for c in [*run, "segmento"]]],
        *[F.col(c) for c in [*run, "segmento"]],
    ).agg(
        F.grouping("segmento").alias("_all"),
        F.count(F.lit(1)).alias("linhas"),
        F.max("data_referencia").alias("lote"),
        *SC.metric_aggregates(real, F.col("saldo_predito"), "m_"),
        *SC.metric_aggregates(real, F.col("base_naive"), "n_"),
        *SC.metric_aggregates(real, F.col("base_media"), "a_"),
    )
    sets = sets.withColumn("_m", SC.metric_struct("m_"))
    whole = F.col("_all") == 1
    per_run = sets.groupBy(*run).agg(
        F.max(F.when(whole, F.col("_m"))).alias("m"),
        F.max(F.when(whole, SC.metric_struct("n_"))).alias("n"),
        F.max(F.when(whole, SC.metric_struct("a_"))).alias("a"),
        F.max(F.when(whole, F.col("linhas"))).alias("linhas_adicionadas"),
        F.max("lote").alias("lote"),
        _segment_map().alias("seg"),
    )
    upto = Window.orderBy("dt_processamento", "run_id").rowsBetween(Window.unboundedPreceding, 0)
    return per_run.select(
        "m.*",
        F.to_json("seg").alias("metricas_segmento"),
        F.to_json(SC.baseline_summary(F.col("m"), F.col("n"), F.col("a"))).alias("metricas_baseline"),
        "modelo_versao",
        "dt_processamento",
        F.sum("linhas_adicionadas").over(upto).alias("total_linhas"),
        "linhas_adicionadas",
        F.date_format("lote", "yyyy-MM-dd").alias("data_referencia_lote"),
        F.substring("dt_processamento", 1, 10).alias("run_date"),
        "run_id",
    )
