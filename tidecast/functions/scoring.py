"""Regression quality as aggregate expressions over (actual, predicted)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidecast.functions.money import exact_sum, wide_sum
from tidecast.schemas import METRIC_NAMES

EPS = 1e-9


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def wape_sql(err: Column | str, real: Column | str) -> Column:
    """Report form: NULL when all actuals are 0."""
    return F.try_divide(
        F.lit(100.0) * exact_sum(_c(err)).cast("double"), exact_sum(F.abs(_c(real))).cast("double")
    )


def wape_zero(err: Column | str, real: Column | str) -> Column:
    """Training form: 0 when all actuals are 0."""
    return F.coalesce(wape_sql(err, real), F.lit(0.0))


def metric_columns(real: Column | str, pred: Column | str) -> dict[str, Column]:
    """RMSE, MAE, R2, WAPE, SMAPE and MAPE in one pass with map-side combine.

    All sums are exact, so equal rows give equal bits in any layout.

    R2 of a constant actual is 1 for a perfect fit and 0 otherwise, and NULL
    below two rows. SMAPE and MAPE skip rows whose denominator is 0.
    """
    y, p = _c(real), _c(pred)
    err = F.abs(y - p)
    sse = wide_sum((y - p) * (y - p))
    # Squares around the mean from sums around 0; equal actuals have none, whatever the last digit says.
    around = F.greatest(wide_sum(y * y) - wide_sum(y) * wide_sum(y) / F.count(y), F.lit(0.0))
    sst = F.when(F.min(y) == F.max(y), F.lit(0.0)).otherwise(around)
    half = (F.abs(y) + F.abs(p)) / 2
    return {
        "rmse": F.sqrt(sse / F.count(y)),
        "mae": F.try_divide(exact_sum(err).cast("double"), F.count(err)),
        "r2": F.when(F.count(y) < 2, F.lit(None).cast("double"))
        .when((sst == 0) & (sse == 0), F.lit(1.0))
        .when(sst == 0, F.lit(0.0))
        .otherwise(1 - sse / sst),
        "wape": wape_zero(err, y),
        "smape": F.coalesce(F.try_divide(wide_sum(F.when(half > 0, err / half)), F.count_if(half > 0)) * 100, F.lit(0.0)),
        "mape": F.coalesce(F.try_divide(wide_sum(F.when(y != 0, err / F.abs(y))), F.count_if(y != 0)) * 100, F.lit(0.0)),
    }


def metric_aggregates(real: Column | str, pred: Column | str, prefix: str = "") -> list[Column]:
    return [c.alias(prefix + n) for n, c in metric_columns(real, pred).items()]


def metric_struct(prefix: str = "") -> Column:
    return F.struct(*[F.col(prefix + n).alias(n) for n in METRIC_NAMES])


def baseline_summary(model: Column, naive: Column, mean: Column) -> Column:
    """Model against the two baselines; each argument is a metric struct."""
    m, n, a = (s.getField("wape") for s in (model, naive, mean))
    return F.struct(
        F.round(m, 4).alias("modelo_wape"),
        F.struct(naive.alias("naive_saldo_m1"), mean.alias("media_saldos_m1_m6")).alias("baselines"),
        F.round(n, 4).alias("naive_wape"),
        (m < n - EPS).alias("beats_naive"),
        F.round(n - m, 4).alias("wape_gain_vs_naive_pp"),
        F.round(a, 4).alias("media_saldos_wape"),
        (m < a - EPS).alias("beats_media_saldos"),
    )
