"""Features of the regression: derived columns, null fill, trim, codes, scaling.

``fit`` reduces the data to a few scalars (medians, cut, labels, means, spreads)
and ``transform`` is a chain of column expressions, so both run inside codegen.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast import schemas as S
from tidecast.functions.recode import flag_int
from tidecast.operators.quantiles import exact_quantiles

# Column groups of the preparation and the trim quantile.
CATEGORICAL = ["segmento", "uf", "genero"]
BOOLEAN = [
    "possui_investimento", "possui_credito", "possui_seguro", "is_fim_de_ano", "is_inicio_de_ano",
]
DERIVED = [
    "media_saldo_historico", "tendencia_saldo", "volatilidade_saldo", "variacao_pct_saldo",
    "saldo_por_renda", "credito_debito_ratio",
]
SCALED = [
    "renda_mensal", *S.LAGS, "media_saldo_historico", "tendencia_saldo", "volatilidade_saldo",
    "saldo_por_renda",
]
IDENTIFIERS = ["cliente_id", "data_referencia"]
TRIM_QUANTILE = 0.99
FEATURES = [c for c in S.PANEL_COLUMNS if c not in IDENTIFIERS] + DERIVED


def row_stats(cols: list[str]) -> tuple[Column, Column]:
    """Mean and sample deviation across columns, NULLs skipped."""
    zero = F.lit(0.0)
    present = sum((F.col(c).isNotNull().cast("int") for c in cols[1:]), F.col(cols[0]).isNotNull().cast("int"))
    total = sum((F.coalesce(c, zero) for c in cols[1:]), F.coalesce(cols[0], zero))
    mean = F.try_divide(total, present)

    def gap(c: str) -> Column:
        d = F.coalesce(F.col(c) - mean, zero)
        return d * d

    spread = sum((gap(c) for c in cols[1:]), gap(cols[0]))
    return mean, F.sqrt(F.try_divide(spread, present - 1))


def derived_features(df: DataFrame) -> DataFrame:
    """Level, trend, spread and ratios of the row; taken before any null fill."""
    mean, deviation = row_stats(S.LAGS)
    m1, m2, m6 = F.col("saldo_m1"), F.col("saldo_m2"), F.col("saldo_m6")
    return df.withColumns(
        {
            "media_saldo_historico": mean,
            "tendencia_saldo": m1 - m6,
            "volatilidade_saldo": deviation,
            "variacao_pct_saldo": (m1 - m2) / (F.abs(m2) + 1),
            "saldo_por_renda": F.try_divide(m1, F.col("renda_mensal") + 1),
            "credito_debito_ratio": F.try_divide(
                F.col("valor_creditos_mes"), F.col("valor_debitos_mes") + 1
            ),
        }
    )


def lag_medians(df: DataFrame) -> dict[str, float]:
    return exact_quantiles(df, {c: (F.col(c), 0.5) for c in S.LAGS})


def fill_lags(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    return df.fillna({c: m for c, m in medians.items() if m is not None})


def trim_cut(df: DataFrame, column: str = "saldo_m1", prob: float = TRIM_QUANTILE) -> float | None:
    return exact_quantiles(df, {"cut": (F.col(column), prob)})["cut"]


def trim_upper(df: DataFrame, cut: float, column: str = "saldo_m1") -> DataFrame:
    return df.where(F.col(column) <= cut)


def _text(column: str) -> Column:
    """Category as text; a missing one is a category of its own."""
    return F.coalesce(F.col(column).cast("string"), F.lit("nan"))


def label_values(df: DataFrame, columns: list[str] = CATEGORICAL) -> dict[str, list[str]]:
    """Sorted values of each categorical column; their domains are code tables."""
    row = df.agg(*[F.array_sort(F.collect_set(_text(c))).alias(c) for c in columns]).first()
    return {c: list(row[c]) for c in columns}


def label_code(column: str, values: list[str]) -> Column:
    """Position in the sorted values; a value not seen in the fit is an error."""
    position = F.array_position(F.array(*[F.lit(v) for v in values]), _text(column))
    unseen = F.raise_error(F.concat(F.lit(f"unseen value in {column}: "), _text(column)))
    return F.when(position > 0, (position - 1).cast("int")).otherwise(unseen.cast("int"))


def scale_params(df: DataFrame, columns: list[str] = SCALED) -> dict[str, tuple[float, float]]:
    """Mean and population deviation; a constant column keeps its unit."""
    row = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"s_{c}") for c in columns],
    ).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"] or 1.0) for c in columns}


@dataclass
class FeatureParams:
    medians: dict[str, float] = field(default_factory=dict)
    cut: float | None = None
    labels: dict[str, list[str]] = field(default_factory=dict)
    scale: dict[str, tuple[float, float]] = field(default_factory=dict)
    means: dict[str, float] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @staticmethod
    def from_json(text: str) -> FeatureParams:
        raw = json.loads(text)
        raw["scale"] = {c: tuple(v) for c, v in raw["scale"].items()}
        return FeatureParams(**raw)


def fit(labelled: DataFrame, scope: str = "all") -> FeatureParams:
    """Fit on all labelled rows (default) or, with ``scope='train'``, on the training span only."""
    if scope == "train":
        labelled = labelled.where(F.col("split") == "train")
    base = derived_features(labelled)
    p = FeatureParams(medians=lag_medians(base))
    filled = fill_lags(base, p.medians)
    p.cut = trim_cut(filled)
    kept = trim_upper(filled, p.cut) if p.cut is not None else filled
    p.labels = label_values(kept)
    p.scale = scale_params(kept)
    plain = [c for c in FEATURES if c not in {*CATEGORICAL, *BOOLEAN, *SCALED}]
    found = kept.agg(*[F.avg(c).alias(c) for c in plain]).first().asDict() if plain else {}
    p.means = {c: float(v) for c, v in found.items() if v is not None}
    return p


def transform(df: DataFrame, p: FeatureParams, training: bool = False) -> DataFrame:
    """Fitted preparation; keys, dates and labels of the row are carried along.

    The trim applies to training data only. New rows are filled with the fitted
    medians, and unscaled features with the fitted means, so a row scores the same
    whatever batch it comes in. ``raw_<lag>`` keeps each lag as it came.
    """
    raw = df.withColumns({f"raw_{c}": F.col(c) for c in S.LAGS})
    out = fill_lags(derived_features(raw), p.medians)
    out = out.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in p.means.items()})
    if training and p.cut is not None:
        out = trim_upper(out, p.cut)
    out = out.withColumns({f"x_{c}": label_code(c, p.labels[c]) for c in CATEGORICAL})
    out = out.withColumns({f"x_{c}": flag_int(c) for c in BOOLEAN})
    return out.withColumns({f"x_{c}": (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in p.scale.items()})


def feature_columns() -> list[str]:
    made = {*CATEGORICAL, *BOOLEAN, *SCALED}
    return [f"x_{c}" if c in made else c for c in FEATURES]
