"""End-to-end jobs: build the panel, ingest, retrain and publish."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast import schemas as S
from tidecast.functions import calendar as C
from tidecast.operators import features as FT
from tidecast.operators import label as L
from tidecast.operators import merge as MG
from tidecast.operators import metrics as MT
from tidecast.operators import panel as P
from tidecast.operators import quality as QA
from tidecast.operators import registry as RG
from tidecast.operators import train as TR
from tidecast.plans import reports as R
from tidecast.session import materialise, use_utc
from tidecast.sinks import ledger as LG
from tidecast.sinks import tables as TB
from tidecast.sources import tables as ST
from tidecast.sources.bank import Bank
from tidecast.streaming import ingest as IN

CHAMPIONS = S._schema(
    "run_id string, modelo_versao string, promoted_at string, promotion_reason string, "
    "rmse double, mae double, r2 double, wape double, smape double, mape double, "
    "total_linhas bigint, dataset_fingerprint string, linhas_adicionadas bigint, "
    "data_referencia_lote string, model_path string"
)


@dataclass
class Config:
    """Where the tables live and how to train."""

    root: str
    run_id: str = "manual"
    params: dict[str, Any] | str = field(default_factory=dict)
    fit_scope: str = "all"
    append_predictions: bool = False
    catalog: str = ""  # database in which the published tables are registered; empty: none

    @property
    def panel(self) -> str:
        return f"{self.root}/panel"

    @property
    def predictions(self) -> str:
        return f"{self.root}/predictions"

    @property
    def metrics(self) -> str:
        return f"{self.root}/metrics"

    @property
    def champions(self) -> str:
        return f"{self.root}/champion/history"

    @property
    def ledger(self) -> str:
        return f"{self.root}/ingest/ledger"

    @property
    def runs(self) -> str:
        return f"{self.root}/runs"


def build_panel(spark: SparkSession, bank: Bank, cfg: Config, as_of: str, **options) -> DataFrame:
    """Raw tables to the stored panel; also the full reconcile."""
    use_utc(spark)
    panel = materialise(P.monthly_panel(bank, as_of, **options), "panel")
    if panel.isEmpty():
        raise ValueError("no panel row from this source; the stored panel stays")
    TB.replace_panel(panel, cfg.panel)
    return IN.read_panel(spark, cfg.panel)


def champion_table(spark: SparkSession, cfg: Config) -> DataFrame:
    return ST.read_or_empty(spark, cfg.champions, CHAMPIONS)


def current_champion(spark: SparkSession, cfg: Config) -> DataFrame:
    """Latest promotion; no row before the first one."""
    return champion_table(spark, cfg).orderBy(F.desc("promoted_at"), F.desc("run_id")).limit(1)


def _against_champion(row: DataFrame, champion: DataFrame) -> DataFrame:
    """The run row with the champion's figures (NULL when there is none) and the verdict."""
    names = ["wape", "r2", "total_linhas"]
    pairs = row
    for c in [*names, "modelo_versao", "rmse", "mape"]:
        pairs = pairs.withColumn(f"champion_{c}", champion.select(c).scalar())
    return RG.evaluate(pairs)


def retrain(spark: SparkSession, cfg: Config, added: int = 0) -> DataFrame:
    """Label, prepare, trim, split, train, measure, gate and publish; returns the stored metrics row.

    The dates of the split are quantiles of the trimmed rows. With ``fit_scope="train"``
    the split comes first, since it says which rows the preparation may see.
    """
    use_utc(spark)
    labelled = materialise(L.training_view(IN.read_panel(spark, cfg.panel)), "labelled")
    if labelled.isEmpty():
        raise ValueError("no labelled rows in the panel")
    ready = materialise(TR.assemble(prepare(labelled, cfg.fit_scope)).drop(
        *[c for c in FT.feature_columns() if c.startswith("x_")]
    ), "ready")
    rows, val, test = (ready.where(F.col("split") == s) for s in ("train", "val", "test"))
    model = TR.train(rows, val, cfg.params)

    now = spark.sql("SELECT current_timestamp() AS t").select(C.iso_utc(F.col("t"))).first()[0]
    scored = materialise(
        TR.score(model, test).withColumns(
            {"run_id": F.lit(cfg.run_id), "dt_processamento": F.lit(now), "modelo_versao": F.lit("")}
        ),
        "scored",
    )
    size = MG.dataset_fingerprint(labelled).first()
    newest = labelled.agg(F.date_format(F.max("data_referencia"), "yyyy-MM-dd")).first()[0]
    row = (
        MT.run_metrics(scored)
        .withColumn("modelo_versao", TR.model_version())
        .withColumn("total_linhas", F.lit(size["linhas"]).cast("bigint"))
        .withColumn("linhas_adicionadas", F.lit(added).cast("bigint"))
        .withColumn("data_referencia_lote", F.lit(newest))
    )
    row = materialise(row, "run")
    judged = materialise(_against_champion(row, current_champion(spark, cfg)), "judged")
    verdict = judged.first()
    ranking = TR.importance(model, spark)
    if verdict["promoted"]:
        _promote(spark, cfg, model, judged, ranking, size["dataset_fingerprint"], now)

    own = F.col("promoted")
    published = judged.withColumns(
        {
            "is_champion": own,
            **{
                f"champion_{c}": F.when(own, F.col(c)).otherwise(F.col(f"champion_{c}"))
                for c in ("modelo_versao", "rmse", "wape", "mape")
            },
        }
    )
    TB.write_metrics(published, cfg.metrics)
    dated = scored.withColumns(
        {
            "data_referencia": F.date_format("data_referencia", "yyyy-MM-dd"),
            "modelo_versao": F.lit(verdict["modelo_versao"]),
        }
    )
    TB.write_predictions(dated, cfg.predictions, cfg.append_predictions)
    TB.write_json(ranking.coalesce(1), f"{cfg.root}/models/importance/{cfg.run_id}")
    TB.write_json(published.coalesce(1), f"{cfg.root}/models/history/{cfg.run_id}")
    TB.write_json(ranking.coalesce(1), f"{cfg.root}/models/latest/importance")
    TB.write_json(published.coalesce(1), f"{cfg.root}/models/latest/metrics")
    if cfg.catalog:
        _register(spark, cfg, dated, published)
    summary = published.select("modelo_versao", "wape", "r2", "promoted", "promotion_reason", "promotion_detail")
    LG.append_run(spark, cfg.runs, cfg.run_id, "train", "success", summary)
    return TB.metric_defaults(published)


def _register(spark: SparkSession, cfg: Config, predictions: DataFrame, metrics: DataFrame) -> None:
    """Catalog entries of the published tables, and the partitions this run wrote."""
    for name, path, schema, by, rows in (
        ("predictions", cfg.predictions, S.PREDICTIONS, S.PREDICTION_PARTITIONS, predictions),
        ("metrics", cfg.metrics, S.METRICS, S.METRIC_PARTITIONS, TB.conform(TB.metric_defaults(metrics), S.METRICS)),
    ):
        table = f"{cfg.catalog}.{name}"
        ST.create_external(spark, table, path, schema, by)
        TB.register_partitions(spark, table, rows, by)


def prepare(labelled: DataFrame, fit_scope: str = "all") -> DataFrame:
    """Derived, filled, trimmed and split rows with their features."""
    if fit_scope == "train":
        labelled = materialise(L.temporal_split(labelled), "split")
        return FT.transform(labelled, FT.fit(labelled, fit_scope), training=True)
    return L.temporal_split(materialise(FT.transform(labelled, FT.fit(labelled), training=True), "prepared"))


def _promote(spark, cfg: Config, model, judged: DataFrame, ranking: DataFrame, fingerprint: str, now: str) -> None:
    """Model and ranking go to a path of their own; the history row is the commit."""
    base = f"{cfg.root}/champion/{cfg.run_id}"
    model.save(spark, f"{base}/model")
    TB.write_json(ranking.coalesce(1), f"{base}/importance")
    row = judged.withColumns(
        {
            "promoted_at": F.lit(now),
            "dataset_fingerprint": F.lit(fingerprint),
            "model_path": F.lit(f"{base}/model"),
        }
    )
    LG.append_rows(TB.conform(row, CHAMPIONS), cfg.champions)


def ingest(spark: SparkSession, cfg: Config, incoming: str, one_by_one: bool = True) -> int:
    """Drains new files into the panel as a stream; returns the number of batches."""
    use_utc(spark)
    return IN.replay(
        spark,
        incoming,
        cfg.panel,
        checkpoint=f"{cfg.root}/ingest/checkpoint",
        ledger=cfg.ledger,
        files_per_batch=1 if one_by_one else None,
    )


def check_new_data(spark: SparkSession, cfg: Config, incoming: str, busy: bool = False) -> DataFrame:
    """Decision row, also entered in the run ledger."""
    row = materialise(
        LG.should_run(ST.list_files(spark, incoming), LG.read_ingest_ledger(spark, cfg.ledger), busy=busy), "check"
    )
    status = "new_data" if row.first()["has_new_data"] else "no_new_data"
    LG.append_run(spark, cfg.runs, cfg.run_id, "check_new_data", status, row)
    return row


def validate(spark: SparkSession, cfg: Config, source: str) -> DataFrame:
    """Has-input check, also entered in the run ledger."""
    row = materialise(ST.input_status(spark, source, cfg.run_id), "validate")
    LG.append_run(spark, cfg.runs, cfg.run_id, "validate", row.first()["status"], row)
    return row


def finalise(spark: SparkSession, cfg: Config) -> DataFrame:
    """Outcome of the run from its ledger phases; success only after a passed validation."""
    phases = LG.read_run_ledger(spark, cfg.runs).where(F.col("run_id") == cfg.run_id)
    row = materialise(QA.finalise(phases), "finalise")
    LG.append_run(spark, cfg.runs, cfg.run_id, "finalize", row.first()["status"], row)
    return row


def ingest_changed(spark: SparkSession, cfg: Config, incoming: str) -> DataFrame | None:
    """New and rewritten files in one batch, with a landing copy."""
    use_utc(spark)
    return IN.ingest_new_files(spark, incoming, cfg.panel, cfg.ledger, cfg.run_id, f"{cfg.root}/landing")


def published(spark: SparkSession, cfg: Config) -> tuple[DataFrame, DataFrame]:
    """Metrics and unified predictions of all runs."""
    return ST.read_metrics(spark, cfg.metrics), R.unified(ST.read_predictions(spark, cfg.predictions))


def export_reports(spark: SparkSession, cfg: Config) -> list[str]:
    """The three CSV reports; each is small."""
    metrics, predictions = published(spark, cfg)
    frames = {
        "evolucao_metricas": R.metric_evolution(metrics),
        "gabarito_por_mes": R.truth_by_month(predictions),
        "gabarito_detalhe_amostra": R.detail_sample(predictions),
    }
    for name, df in frames.items():
        TB.write_csv(df, f"{cfg.root}/reports/{name}", single=True)
    return [f"{cfg.root}/reports/{name}" for name in frames]


def verify(spark: SparkSession, cfg: Config, expected: DataFrame, sent: DataFrame) -> DataFrame:
    """Checklist over the stored tables; months come as ``mes_ref``."""
    metrics, predictions = published(spark, cfg)
    parts = predictions.select(*S.PREDICTION_PARTITIONS).distinct()
    return QA.processing_checklist(expected, sent, P.months_of(IN.read_panel(spark, cfg.panel)), metrics, parts)
