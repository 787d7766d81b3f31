"""Boosted trees: parameters, training of one or many models, importance, scoring."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast import schemas as S
from tidecast.functions import money as M
from tidecast.operators import boosting as B
from tidecast.operators import features as FT

# Default parameters and the parameters that arrive as text.
DEFAULTS: dict[str, Any] = {
    "n_estimators": 300,
    "max_depth": 6,
    "learning_rate": 0.05,
    "subsample": 0.8,
    "colsample_bytree": 0.8,
    "min_child_weight": 5,
    "gamma": 0.1,
    "random_state": 42,
    "early_stopping_rounds": 20,
}
WHOLE = {"n_estimators", "max_depth", "min_child_weight", "random_state", "early_stopping_rounds"}
KEY = ["cliente_id", "data_referencia"]
VERSION_PREFIX = "gbt-saldo-v1-"
TOP_FEATURES = 10


def parameters(given: Mapping[str, Any] | str | None = None) -> dict[str, Any]:
    """Defaults overlaid with a mapping or JSON text; number texts become numbers."""
    if isinstance(given, str):
        given = json.loads(given) if given.strip() else {}
    merged = {**DEFAULTS, **(given or {})}
    out = {}
    for name, value in merged.items():
        if name in DEFAULTS and isinstance(value, str):
            value = int(float(value)) if name in WHOLE else float(value)
        out[name] = value
    return out


def assemble(prepared: DataFrame) -> DataFrame:
    """Features in one array; a scaled column that is still missing counts as 0, its mean."""
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in FT.feature_columns()])
    return prepared.withColumn("features", x)


def laid_out(rows: DataFrame, validation: DataFrame, model: Column) -> DataFrame:
    """Rows as the learner reads them; the hash of a row's key decides in which subsamples it is."""
    h = F.xxhash64(*[F.col(k).cast("string") for k in KEY])

    def part(df: DataFrame, held: bool) -> DataFrame:
        return df.select(model.alias("model"), h.alias("h"), F.col(S.LABEL).cast("double").alias("y"), F.lit(held).alias("held"), F.col("features").alias("x"))

    return part(rows, False).union(part(validation, True)).where("model is not null and y is not null")


def train(rows: DataFrame, validation: DataFrame, given: Mapping[str, Any] | str | None = None) -> B.Booster:
    """One model; rounds end when the validation error has not fallen for the given patience.

    Equal rows give an equal model, bit by bit, however they are stored.
    """
    return B.fit(laid_out(rows, validation, F.lit("all")), names(), parameters(given))["all"]


def names() -> list[str]:
    return [c.removeprefix("x_") for c in FT.feature_columns()]


def importance(model: B.Booster, spark) -> DataFrame:
    """One row per feature, most important first: its share of the gain of all splits."""
    ranked = spark.createDataFrame(list(model.importance().items()), "feature string, importance double")
    return ranked.orderBy(F.desc("importance"), "feature")


def top_features(ranking: DataFrame, n: int = TOP_FEATURES) -> DataFrame:
    return ranking.orderBy(F.desc("importance"), "feature").limit(n)


def score(model: B.Booster, prepared: DataFrame) -> DataFrame:
    """Forecast beside the row's own keys: identifiers are never re-attached by position.

    ``base_naive`` and ``base_media`` use the raw lags the preparation carried along.
    """
    return forecast_rows(model.transform(prepared))


def forecast_rows(predicted: DataFrame) -> DataFrame:
    """Keys, forecast, actual, baselines and errors of rows with a ``prediction``."""
    mean, _ = FT.row_stats([f"raw_{c}" for c in S.LAGS])
    out = predicted.select(
        "cliente_id",
        "data_referencia",
        F.col("prediction").alias("saldo_predito"),
        F.col(S.LABEL).alias("saldo_realizado"),
        F.col("raw_saldo_m1").alias("base_naive"),
        mean.alias("base_media"),
        "uf",
        "ano",
        "mes",
        "segmento",
    )
    out = out.withColumn("erro_absoluto", M.abs_error("saldo_realizado", "saldo_predito"))
    return out.withColumn("erro_percentual", M.pct_error("saldo_realizado", "erro_absoluto"))


def model_version(metrics: Mapping[str, Column] | None = None, prefix: str = VERSION_PREFIX) -> Column:
    """Prefix and eight hex digits over the metrics at six decimals: equal results, equal version."""
    cols = metrics or {n: F.col(n) for n in S.METRIC_NAMES}
    parts = [
        F.concat(F.lit(f"{n}="), F.coalesce(cols[n].cast("decimal(38,6)").cast("string"), F.lit("null")))
        for n in sorted(cols)
    ]
    return F.concat(F.lit(prefix), F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8))


def train_per_segment(
    rows: DataFrame, validation: DataFrame, given: Mapping[str, Any] | str | None = None
) -> dict[str, B.Booster]:
    """One model per segment, all grown in the same jobs."""
    return B.fit(laid_out(rows, validation, F.col("segmento")), names(), parameters(given))


def score_per_segment(models: dict[str, B.Booster], prepared: DataFrame, otherwise: B.Booster) -> DataFrame:
    """Every row by the model of its segment; a segment without one, or NULL, by the global model."""
    own = F.when(F.col("segmento").isin(list(models)), F.concat(F.lit("="), F.col("segmento"))).otherwise("")
    named = {f"={s}": m for s, m in models.items()} | {"": otherwise}
    return forecast_rows(prepared.withColumn("prediction", B.forecasts(named, F.coalesce(own, F.lit("")), F.col("features"))))
