"""Analytical reports over the prediction and metrics tables.

Every function takes published tables (``unified`` predictions or metrics) and
returns a frame. Filters stay on partition columns where the report allows it,
top-k reports plan as ``TakeOrderedAndProject`` with a full tie-break, and
one-row look-ups enter as scalar subqueries, so no report collects, cross-joins
or broadcasts anything by hand.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast import schemas as S
from tidecast.functions import calendar as C
from tidecast.functions import scoring as SC
from tidecast.functions.money import money_avg, money_sum, rounded


@dataclass(frozen=True)
class Digits:
    """Presentation rounding; ``None`` leaves values alone."""

    money: int | None = 2
    pct: int | None = 2
    fine: int | None = 4
    text: int = 2


def unified(predictions: DataFrame) -> DataFrame:
    """One pair of value columns whatever the age of the run."""
    return predictions.withColumns(
        {
            "saldo_predito": F.coalesce("saldo_predito", "saldo_previsto"),
            "saldo_realizado": F.coalesce("saldo_realizado", "saldo_real"),
        }
    ).drop("saldo_previsto", "saldo_real")


def _wape() -> Column:
    return SC.wape_sql("erro_absoluto", "saldo_realizado")


def _n() -> Column:
    return F.count(F.lit(1))


def _newest(df: DataFrame, n: int, *then: str) -> DataFrame:
    return df.orderBy(F.desc("dt_processamento"), *(then or ("run_id",))).limit(n)


def _latest_stamp(runs: DataFrame) -> Column:
    """Newest stamp of the run log, as a literal, so that it is pushed to the scan of the facts."""
    return F.lit(runs.agg(F.max("dt_processamento")).first()[0])


def _since(now: Column, hours: int) -> Column:
    """Bound as the text the tables hold: text order is time order, and a text is pushed to the scan."""
    return C.iso_utc(now - F.make_dt_interval(hours=F.lit(hours)))


def seg_metric(segment: str, metric: str) -> Column:
    return F.get_json_object("metricas_segmento", f"$.{segment}.{metric}").cast("double")


def base_metric(name: str, kind: str = "double") -> Column:
    return F.get_json_object("metricas_baseline", f"$.{name}").cast(kind)


def has_json(c: str) -> Column:
    return F.col(c).isNotNull() & (F.col(c) != "")


# predictions


def overview(p: DataFrame, d: Digits = Digits()) -> DataFrame:
    return (
        p.groupBy("ano", "mes", "segmento")
        .agg(
            _n().alias("registros"),
            rounded(F.avg("erro_percentual"), d.pct).alias("mape_medio_diag"),
            rounded(_wape(), d.pct).alias("wape_pct"),
            rounded(money_avg("saldo_predito"), d.money).alias("saldo_predito_medio"),
        )
        .orderBy("ano", "mes", "segmento")
    )


def error_by_segment(p: DataFrame, d: Digits = Digits()) -> DataFrame:
    return (
        p.groupBy("segmento")
        .agg(
            _n().alias("registros"),
            rounded(F.avg("erro_percentual"), d.pct).alias("mape_medio_diag"),
            rounded(_wape(), d.pct).alias("wape_pct"),
            rounded(money_avg("erro_absoluto"), d.money).alias("mae_medio"),
            rounded(money_avg("saldo_realizado"), d.money).alias("saldo_realizado_medio"),
        )
        .orderBy(F.desc("wape_pct"))
    )


def mape_against_wape(p: DataFrame, d: Digits = Digits()) -> DataFrame:
    return (
        p.groupBy("segmento")
        .agg(
            rounded(F.avg("erro_percentual"), d.pct).alias("mape_medio"),
            rounded(_wape(), d.pct).alias("wape_pct"),
            rounded(money_avg(F.abs("saldo_realizado")), d.money).alias("saldo_realizado_medio_abs"),
        )
        .orderBy(F.desc("mape_medio"))
    )


def seasonality(p: DataFrame, d: Digits = Digits()) -> DataFrame:
    return (
        p.groupBy("ano", "mes", "segmento")
        .agg(
            _n().alias("n"),
            rounded(F.avg("erro_percentual"), d.pct).alias("mape_diag"),
            rounded(_wape(), d.pct).alias("wape_pct"),
            rounded(F.stddev_samp("erro_percentual"), d.pct).alias("volatilidade_mape"),
        )
        .orderBy("ano", "mes", "segmento")
    )


def evolution_by_version(p: DataFrame, d: Digits = Digits()) -> DataFrame:
    return (
        p.groupBy("modelo_versao")
        .agg(
            F.min("dt_processamento").alias("treinado_em"),
            _n().alias("registros"),
            rounded(F.avg("erro_percentual"), d.pct).alias("mape_diag"),
            rounded(_wape(), d.pct).alias("wape_pct"),
            rounded(money_avg("erro_absoluto"), d.money).alias("mae"),
        )
        .orderBy("treinado_em")
    )


def segment_detail(p: DataFrame, segment: str = "VAREJO", n: int = 20) -> DataFrame:
    rows = p.where(F.col("segmento") == segment).select(
        "cliente_id",
        "saldo_predito",
        "saldo_realizado",
        "erro_percentual",
        "modelo_versao",
        "run_id",
        "dt_processamento",
    )
    return _newest(rows, n, "cliente_id").drop("dt_processamento")


def customer_truth(p: DataFrame, n: int = 100, d: Digits = Digits()) -> DataFrame:
    top = _newest(p, n, "segmento", "cliente_id")
    return top.select(
        "cliente_id",
        "segmento",
        "ano",
        "mes",
        rounded(F.col("saldo_predito"), d.money).alias("saldo_predito"),
        rounded(F.col("saldo_realizado"), d.money).alias("gabarito_saldo_realizado"),
        rounded(F.col("erro_absoluto"), d.money).alias("erro_absoluto"),
        rounded(F.col("erro_percentual"), d.pct).alias("erro_pct_diag"),
        "modelo_versao",
        "run_id",
        "dt_processamento",
    )


def truth_of_latest_model(p: DataFrame, runs: DataFrame, d: Digits = Digits()) -> DataFrame:
    newest = F.struct("dt_processamento", "modelo_versao")
    latest = F.lit(runs.agg(F.max(newest)["modelo_versao"]).first()[0])
    bias = F.col("saldo_predito") - F.col("saldo_realizado")
    return (
        p.where(F.col("modelo_versao") == latest)
        .groupBy("segmento")
        .agg(
            _n().alias("registros"),
            rounded(money_avg("saldo_predito"), d.money).alias("media_predito"),
            rounded(money_avg("saldo_realizado"), d.money).alias("media_gabarito"),
            rounded(money_avg(bias), d.money).alias("vies_medio"),
            rounded(_wape(), d.pct).alias("wape_pct"),
        )
        .orderBy("segmento")
    )


def segment_error_latest(p: DataFrame, runs: DataFrame, d: Digits = Digits()) -> DataFrame:
    return (
        p.where(F.col("dt_processamento") >= _latest_stamp(runs))
        .groupBy("segmento")
        .agg(
            _n().alias("registros"),
            rounded(_wape(), d.pct).alias("wape_pct"),
            rounded(F.avg("erro_percentual"), d.pct).alias("mape_diag"),
        )
        .orderBy(F.desc("wape_pct"))
    )


def customer_sample_latest(p: DataFrame, runs: DataFrame, n: int = 100, d: Digits = Digits()) -> DataFrame:
    return (
        p.where(F.col("dt_processamento") == _latest_stamp(runs))
        .select(
            "cliente_id",
            "segmento",
            "ano",
            "mes",
            rounded(F.col("saldo_predito"), d.money).alias("saldo_predito"),
            rounded(F.col("saldo_realizado"), d.money).alias("gabarito"),
            rounded(F.col("erro_absoluto"), d.money).alias("erro_absoluto"),
            "modelo_versao",
            "run_id",
        )
        .orderBy("segmento", "cliente_id")
        .limit(n)
    )


def treasury_totals(p: DataFrame) -> DataFrame:
    return p.groupBy("segmento", "ano", "mes").agg(
        money_sum("saldo_predito").alias("saldo_predito_total"), _n().alias("clientes")
    )


def truth_sample(p: DataFrame, n: int = 50, d: Digits = Digits()) -> DataFrame:
    return _newest(p, n, "cliente_id").select(
        "cliente_id",
        "segmento",
        rounded(F.col("saldo_predito"), d.money).alias("predito"),
        rounded(F.col("saldo_realizado"), d.money).alias("gabarito"),
        rounded(F.col("erro_absoluto"), d.money).alias("erro_abs"),
        "modelo_versao",
        "run_id",
    )


def unified_sample(p: DataFrame, n: int = 5) -> DataFrame:
    cols = ["saldo_predito", "saldo_realizado", "segmento", "dt_processamento"]
    return _newest(p, n, "cliente_id").select(*cols)


def rows_by_partition(p: DataFrame) -> DataFrame:
    return (
        p.groupBy("ano", "mes", "segmento")
        .agg(_n().alias("registros"))
        .orderBy("ano", "mes", "segmento")
    )


def truth_by_month_and_segment(p: DataFrame, d: Digits = Digits()) -> DataFrame:
    return (
        p.groupBy("ano", "mes", "segmento")
        .agg(
            _n().alias("registros"),
            rounded(money_avg("saldo_predito"), d.money).alias("media_predito"),
            rounded(money_avg("saldo_realizado"), d.money).alias("media_gabarito"),
            rounded(_wape(), d.pct).alias("wape_pct"),
        )
        .orderBy("ano", "mes", "segmento")
    )


def truth_by_month(p: DataFrame, d: Digits = Digits()) -> DataFrame:
    """Month table of the exported report; here a zero denominator gives 0."""
    err = F.abs(F.col("saldo_predito") - F.col("saldo_realizado"))
    return (
        p.groupBy("ano", "mes")
        .agg(
            _n().alias("registros"),
            rounded(money_avg("saldo_predito"), d.money).alias("media_predito"),
            rounded(money_avg("saldo_realizado"), d.money).alias("media_gabarito"),
            rounded(SC.wape_zero(err, "saldo_realizado"), d.pct).alias("wape_pct"),
        )
        .orderBy("ano", "mes")
    )


def detail_sample(p: DataFrame, n: int = 500) -> DataFrame:
    return (
        p.select(
            "cliente_id",
            "segmento",
            "data_referencia",
            "ano",
            "mes",
            "saldo_predito",
            "saldo_realizado",
            F.abs(F.col("saldo_predito") - F.col("saldo_realizado")).alias("erro_absoluto"),
            "modelo_versao",
            "run_id",
        )
        .orderBy("data_referencia", "cliente_id")
        .limit(n)
    )


def error_by_slot(p: DataFrame, now: Column, hours: int = 6, d: Digits = Digits()) -> DataFrame:
    ts = C.parse_iso("dt_processamento")
    return (
        p.where(F.col("dt_processamento") >= _since(now, hours))
        .groupBy(C.slot_15m(ts).alias("slot_15m"))
        .agg(
            _n().alias("registros"),
            rounded(F.avg("erro_percentual"), d.pct).alias("mape_diag"),
            rounded(_wape(), d.pct).alias("wape_pct"),
            rounded(money_avg("erro_absoluto"), d.money).alias("mae"),
            F.max("modelo_versao").alias("modelo_versao"),
        )
        .orderBy(F.desc("slot_15m"))
    )


# training metrics


def training_evolution(m: DataFrame, d: Digits = Digits()) -> DataFrame:
    return m.select(
        "run_date",
        "run_id",
        "total_linhas",
        "linhas_adicionadas",
        "data_referencia_lote",
        rounded(F.col("rmse"), d.pct).alias("rmse"),
        rounded(F.col("mae"), d.money).alias("mae"),
        rounded(F.col("r2"), d.fine).alias("r2"),
        rounded(F.col("wape"), d.fine).alias("wape"),
        rounded(F.col("smape"), d.fine).alias("smape"),
        rounded(F.col("mape"), d.fine).alias("mape_diag"),
        "modelo_versao",
        "dt_processamento",
    ).orderBy("dt_processamento")


def baselines_against_model(m: DataFrame, n: int = 10, d: Digits = Digits()) -> DataFrame:
    return _newest(m.where(has_json("metricas_baseline")), n).select(
        "dt_processamento",
        "run_id",
        rounded(F.col("wape"), d.pct).alias("modelo_wape"),
        rounded(base_metric("naive_wape"), d.pct).alias("naive_wape"),
        rounded(base_metric("media_saldos_wape"), d.pct).alias("media_saldos_wape"),
        base_metric("beats_naive", "boolean").alias("beats_naive"),
        rounded(base_metric("wape_gain_vs_naive_pp"), d.pct).alias("ganho_pp_vs_naive"),
    )


def latest_against_champion(m: DataFrame, n: int = 5, d: Digits = Digits()) -> DataFrame:
    return _newest(m, n).select(
        "dt_processamento",
        "run_id",
        "modelo_versao",
        rounded(F.col("rmse"), d.pct).alias("rmse"),
        rounded(F.col("wape"), d.pct).alias("wape"),
        "is_champion",
        "champion_modelo_versao",
        rounded(F.col("champion_rmse"), d.pct).alias("champion_rmse"),
        rounded(F.col("champion_wape"), d.pct).alias("champion_wape"),
    )


def promotion_history(m: DataFrame, d: Digits = Digits()) -> DataFrame:
    return (
        m.where("is_champion")
        .select(
            "run_id",
            "modelo_versao",
            "champion_modelo_versao",
            rounded(F.col("rmse"), d.pct).alias("rmse"),
            rounded(F.col("wape"), d.pct).alias("wape"),
            "dt_processamento",
        )
        .orderBy(F.desc("dt_processamento"))
    )


def current_champion(m: DataFrame, n: int = 1, d: Digits = Digits()) -> DataFrame:
    return _newest(m.where("is_champion"), n).select(
        "champion_modelo_versao",
        rounded(F.col("champion_rmse"), d.pct).alias("champion_rmse"),
        rounded(F.col("champion_wape"), d.pct).alias("champion_wape"),
        "dt_processamento",
    )


def model_benchmark(m: DataFrame, p: DataFrame, d: Digits = Digits()) -> DataFrame:
    """One row: champion metrics, truth of its predictions, segments and baselines.

    The champion's version filters the predictions as a scalar subquery; the two
    one-row frames then join on that version.
    """
    champion = _newest(m.where("is_champion"), 1)
    version = champion.select("modelo_versao").scalar()
    bias = F.col("saldo_predito") - F.col("saldo_realizado")
    truth = (
        p.where(F.col("modelo_versao") == version)
        .groupBy("modelo_versao")
        .agg(
            _n().alias("registros_holdout"),
            F.countDistinct("cliente_id").alias("clientes"),
            rounded(_wape(), d.pct).alias("wape_gabarito"),
            rounded(money_avg("erro_absoluto"), d.money).alias("mae_gabarito"),
            rounded(money_avg(bias), d.money).alias("vies_medio"),
        )
    )
    return champion.join(truth, "modelo_versao", "left").select(
        "run_id",
        "modelo_versao",
        "dt_processamento",
        F.col("total_linhas").alias("linhas_treino"),
        rounded(F.col("rmse"), d.pct).alias("rmse"),
        rounded(F.col("mae"), d.money).alias("mae"),
        rounded(F.col("wape"), d.pct).alias("wape"),
        rounded(F.col("r2"), d.fine).alias("r2"),
        F.coalesce("registros_holdout", F.lit(0).cast("bigint")).alias("registros_holdout"),
        F.coalesce("clientes", F.lit(0).cast("bigint")).alias("clientes"),
        "wape_gabarito",
        "mae_gabarito",
        "vies_medio",
        *[rounded(seg_metric(s, "wape"), d.pct).alias(f"wape_{s.lower()}") for s in S.SEGMENTS],
        rounded(base_metric("naive_wape"), d.pct).alias("baseline_naive_wape"),
        rounded(base_metric("media_saldos_wape"), d.pct).alias("baseline_media_saldos_wape"),
        base_metric("beats_naive", "boolean").alias("beats_naive"),
        rounded(base_metric("wape_gain_vs_naive_pp"), d.pct).alias("ganho_pp_vs_naive"),
    )


def segment_json_latest(m: DataFrame, d: Digits = Digits()) -> DataFrame:
    return (
        _newest(m, 1)
        .where(has_json("metricas_segmento"))
        .select(
            "run_id",
            "modelo_versao",
            rounded(F.col("rmse"), d.pct).alias("rmse_global"),
            rounded(F.col("wape"), d.pct).alias("wape_global"),
            *[
                rounded(seg_metric(s, k), d.pct).alias(f"{k}_{s.lower()}")
                for k in ("wape", "rmse")
                for s in S.SEGMENTS
            ],
        )
    )


def segment_wape_series(m: DataFrame, n: int = 30, d: Digits = Digits()) -> DataFrame:
    return _newest(m.where(has_json("metricas_segmento")), n).select(
        "dt_processamento",
        "run_id",
        rounded(F.col("wape"), d.pct).alias("wape_global"),
        *[rounded(seg_metric(s, "wape"), d.pct).alias(f"wape_{s.lower()}") for s in S.SEGMENTS],
        "is_champion",
    )


def exploded_segments(m: DataFrame) -> DataFrame:
    """One row per run and segment of the JSON map, new segments included."""
    as_map = F.from_json("metricas_segmento", f"map<string,{S.METRIC_STRUCT}>")
    return m.where(has_json("metricas_segmento")).select(
        "dt_processamento", "run_id", F.explode(as_map).alias("segmento", "metricas")
    )


def all_segments(m: DataFrame, n: int = 200, d: Digits = Digits()) -> DataFrame:
    top = _newest(exploded_segments(m), n, "segmento", "run_id")
    return top.select(
        "dt_processamento",
        "run_id",
        "segmento",
        rounded(F.col("metricas.rmse"), d.pct).alias("rmse"),
        rounded(F.col("metricas.wape"), d.pct).alias("wape"),
        rounded(F.col("metricas.mape"), d.pct).alias("mape_diag"),
        rounded(F.col("metricas.r2"), d.fine).alias("r2"),
    )


def worst_segment(m: DataFrame) -> DataFrame:
    latest = _newest(m.where(has_json("metricas_segmento")), 1)
    return (
        exploded_segments(latest)
        .select("dt_processamento", "run_id", "segmento", F.col("metricas.wape").alias("wape"))
        .orderBy(F.desc("wape"), "segmento")
        .limit(1)
    )


def latest_run_per_slot(m: DataFrame, now: Column, hours: int = 6, d: Digits = Digits()) -> DataFrame:
    ts = C.parse_iso("dt_processamento")
    slot = Window.partitionBy("slot_15m").orderBy(F.desc("dt_processamento"), "run_id")
    return (
        m.where(F.col("dt_processamento") >= _since(now, hours))
        .withColumn("slot_15m", C.slot_15m(ts))
        .withColumn("rn", F.row_number().over(slot))
        .where("rn = 1")
        .select(
            "slot_15m",
            rounded(F.col("rmse"), d.pct).alias("rmse"),
            rounded(F.col("wape"), d.pct).alias("wape"),
            rounded(F.col("mape"), d.fine).alias("mape_diag"),
            rounded(F.col("r2"), d.fine).alias("r2"),
            "total_linhas",
            "linhas_adicionadas",
            "modelo_versao",
            "is_champion",
        )
        .orderBy(F.desc("slot_15m"))
    )


def runs_by_minute(m: DataFrame, n: int = 60, d: Digits = Digits()) -> DataFrame:
    return _newest(m, n).select(
        F.date_trunc("minute", C.parse_iso("dt_processamento")).alias("processado_em"),
        "dt_processamento",
        rounded(F.col("rmse"), d.pct).alias("rmse"),
        rounded(F.col("wape"), d.pct).alias("wape"),
        rounded(F.col("mape"), d.fine).alias("mape_diag"),
        "linhas_adicionadas",
        "modelo_versao",
        "is_champion",
    )


def moving_wape(m: DataFrame, runs: int = 5, n: int = 30, d: Digits = Digits()) -> DataFrame:
    """Mean WAPE over the run and the ones before it; one row per retraining, so one window."""
    w = Window.orderBy("dt_processamento", "run_id").rowsBetween(1 - runs, 0)
    smooth = m.withColumn(f"wape_media_{runs}", F.avg("wape").over(w))
    return _newest(smooth, n).select(
        "dt_processamento",
        rounded(F.col("rmse"), d.pct).alias("rmse"),
        rounded(F.col("wape"), d.pct).alias("wape"),
        rounded(F.col(f"wape_media_{runs}"), d.pct).alias(f"wape_media_{runs}"),
        "is_champion",
    )


def runs_with_prefix(m: DataFrame, prefix: str) -> DataFrame:
    return m.where(F.col("run_id").startswith(prefix)).orderBy(F.desc("dt_processamento"))


def evolution_latest(m: DataFrame, n: int = 30, d: Digits = Digits()) -> DataFrame:
    return _newest(m, n).select(
        "dt_processamento",
        "run_id",
        rounded(F.col("rmse"), d.pct).alias("rmse"),
        rounded(F.col("wape"), d.pct).alias("wape"),
        rounded(F.col("mape"), d.fine).alias("mape_diag"),
        "linhas_adicionadas",
        "modelo_versao",
        "is_champion",
    )


def recent_promotions(m: DataFrame, n: int = 5, d: Digits = Digits()) -> DataFrame:
    return _newest(m, n).select(
        "run_id",
        rounded(F.col("wape"), d.pct).alias("wape"),
        rounded(F.col("r2"), d.fine).alias("r2"),
        "total_linhas",
        "is_champion",
        "modelo_versao",
    )


def recent_ingests(m: DataFrame, n: int = 20, d: Digits = Digits()) -> DataFrame:
    return _newest(m, n).select(
        "run_date",
        "run_id",
        "linhas_adicionadas",
        rounded(F.col("rmse"), d.pct).alias("rmse"),
        rounded(F.col("mape"), d.fine).alias("mape"),
        "modelo_versao",
    )


def new_column_sample(m: DataFrame, n: int = 5) -> DataFrame:
    return _newest(m, n).select("dt_processamento", "run_id", "wape", "metricas_segmento")


EVOLUTION_COLUMNS = [
    "dt_processamento", "run_id", "rmse", "wape", "mae", "r2", "linhas_adicionadas",
    "total_linhas", "modelo_versao", "is_champion", "data_referencia_lote",
]  # fixed value: column order of the exported report


def metric_evolution(m: DataFrame) -> DataFrame:
    """Export of the run history; columns an older table lacks are left out."""
    return m.select(*[c for c in EVOLUTION_COLUMNS if c in m.columns]).orderBy("dt_processamento")


def _text(c: Column, scale: int) -> Column:
    return c.cast(f"decimal(24,{scale})").cast("string")


def full_diagnosis(m: DataFrame, p: DataFrame, runs: int = 15, d: Digits = Digits()) -> DataFrame:
    """Recent runs, truth by month and segment, and the latest segments, as tagged text rows."""

    def tagged(df: DataFrame, tag: str, cols: list[Column]) -> DataFrame:
        cols = cols + [F.lit("-")] * (11 - len(cols))
        return df.select(
            F.lit(tag).alias("tipo"),
            *[c.cast("string").alias(f"col{i}") for i, c in enumerate(cols, start=1)],
        )

    recent = tagged(
        _newest(m, runs),
        "RETREINO",
        [
            F.col("dt_processamento"),
            F.col("run_id"),
            F.col("total_linhas"),
            F.col("linhas_adicionadas"),
            _text(F.col("wape"), d.text),
            _text(F.col("rmse"), d.text),
            _text(F.col("r2"), d.text + 2),
            F.col("modelo_versao"),
            F.col("is_champion"),
            F.coalesce("champion_modelo_versao", F.lit("-")),
            F.coalesce(_text(F.col("champion_wape"), d.text), F.lit("-")),
        ],
    )
    months = tagged(
        p.groupBy("ano", "mes", "segmento").agg(
            _n().alias("registros"),
            money_avg("saldo_predito").alias("pred"),
            money_avg("saldo_realizado").alias("real"),
            _wape().alias("wape"),
        ),
        "GABARITO_MES",
        [
            F.concat_ws("-", F.col("ano").cast("string"), F.lpad(F.col("mes").cast("string"), 2, "0")),
            F.col("segmento"),
            F.col("registros"),
            _text(F.col("pred"), d.text),
            _text(F.col("real"), d.text),
            _text(F.col("wape"), d.text),
        ],
    )
    latest = tagged(
        p.where(F.col("dt_processamento") == _latest_stamp(m))
        .groupBy("segmento")
        .agg(_n().alias("registros"), _wape().alias("wape")),
        "SEG_ULTIMO_PROC",
        [F.col("segmento"), F.col("registros"), _text(F.col("wape"), d.text)],
    )
    return recent.unionByName(months).unionByName(latest).orderBy("tipo", F.desc("col1"))
