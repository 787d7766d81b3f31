"""Published tables from a fixed blend of the last balances.

Stand-in for a trained model wherever a repeatable prediction is wanted: the
forecast is ``0.6 * saldo_m1 + 0.4 * mean(saldo_m1..m6)``, one run per
reference month, one model version per year. The first years fill the legacy
columns only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast import schemas as S
from tidecast.functions import calendar as C
from tidecast.functions import money as M
from tidecast.operators import metrics as MT
from tidecast.operators import registry as RG
from tidecast.session import materialise

W_LAST, W_MEAN = 0.6, 0.4
FIRST_YEAR, LEGACY_UNTIL = 1995, 1997
RUN_ORIGIN = "2024-01-01 00:00:00"
RUN_STEP_SECONDS = 420


def row_mean(cols: list[str]):
    return sum((F.col(c) for c in cols[1:]), F.col(cols[0])) / len(cols)


def scored_rows(labelled: DataFrame) -> DataFrame:
    """Labelled panel rows with forecast, both baselines and run columns."""
    index = (F.col("ano") - FIRST_YEAR) * 12 + F.col("mes") - 1
    started = F.lit(RUN_ORIGIN).cast("timestamp") + F.make_dt_interval(
        secs=(index * RUN_STEP_SECONDS).cast("decimal(18,6)")
    )
    kind = F.when(F.col("mes") % 2 == 0, "lote-").otherwise("diario-")
    mean = row_mean(S.LAGS)
    out = labelled.select(
        "cliente_id",
        "data_referencia",
        (F.col("saldo_m1") * W_LAST + mean * W_MEAN).alias("saldo_predito"),
        F.col(S.LABEL).alias("saldo_realizado"),
        F.col("saldo_m1").alias("base_naive"),
        mean.alias("base_media"),
        "uf",
        C.iso_utc(started).alias("dt_processamento"),
        F.concat(F.lit("blend-saldo-v1-"), F.col("ano").cast("string")).alias("modelo_versao"),
        F.concat(kind, F.date_format("data_referencia", "yyyyMM")).alias("run_id"),
        "ano",
        "mes",
        "segmento",
    )
    out = out.withColumn("erro_absoluto", M.abs_error("saldo_realizado", "saldo_predito"))
    return out.withColumn("erro_percentual", M.pct_error("saldo_realizado", "erro_absoluto"))


def published_predictions(scored: DataFrame) -> DataFrame:
    """Prediction table as written: old runs in the legacy columns, new ones in the others."""
    old = F.col("ano") <= LEGACY_UNTIL
    return scored.select(
        "cliente_id",
        F.date_format("data_referencia", "yyyy-MM-dd").alias("data_referencia"),
        F.when(~old, F.col("saldo_predito")).alias("saldo_predito"),
        F.when(~old, F.col("saldo_realizado")).alias("saldo_realizado"),
        F.when(old, F.col("saldo_predito")).alias("saldo_previsto"),
        F.when(old, F.col("saldo_realizado")).alias("saldo_real"),
        *S.PREDICTIONS.fieldNames()[6:],
    )


def published_metrics(scored: DataFrame) -> DataFrame:
    """Metrics table, one row per run, with the champion replayed in run order.

    The run rows are written first: the replay reads them more than once, and
    the facts behind them should be aggregated only once.
    """
    return RG.replay_champions(materialise(MT.run_metrics(scored), "runs"))
