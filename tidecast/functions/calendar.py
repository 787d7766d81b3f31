"""Month and time-slot expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the panel: season flags, clamps of age and tenure, timestamp text.
YEAR_END_MONTHS, YEAR_START_MONTH = [11, 12], 1
AGE_RANGE, TENURE_RANGE = (18, 90), (1, 240)
CALENDAR = ["data_referencia", "mes", "ano", "trimestre", "is_fim_de_ano", "is_inicio_de_ano"]
ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss'+00:00'"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(c: Column | str) -> Column:
    return F.trunc(_c(c), "MM").cast("date")


def month_key(c: Column | str) -> Column:
    return F.date_format(_c(c), "yyyy-MM")


def with_calendar(df: DataFrame, period: str = "period") -> DataFrame:
    """Month-end date and the calendar columns of the panel."""
    end = F.last_day(F.col(period))
    return df.withColumns(
        {
            "data_referencia": end,
            "mes": F.month(end),
            "ano": F.year(end),
            "trimestre": F.quarter(end),
            "is_fim_de_ano": F.month(end).isin(YEAR_END_MONTHS).cast("int"),
            "is_inicio_de_ano": (F.month(end) == YEAR_START_MONTH).cast("int"),
        }
    )


def whole_units_between(as_of: Column, since: Column, days_per_unit: int, low: int, high: int) -> Column:
    units = F.floor(F.datediff(as_of, since) / F.lit(days_per_unit)).cast("int")
    return F.when(units.isNotNull(), F.least(F.greatest(units, F.lit(low)), F.lit(high)))


def age_years(as_of: Column, dob: Column | str = "dob") -> Column:
    return whole_units_between(as_of, _c(dob), 365, *AGE_RANGE)


def tenure_months(as_of: Column, opened: Column | str = "account_open_date") -> Column:
    return whole_units_between(as_of, _c(opened), 30, *TENURE_RANGE)


def iso_utc(ts: Column) -> Column:
    """The one timestamp text of the published tables, so text order is time order."""
    return F.date_format(ts, ISO_UTC)


def parse_iso(c: Column | str) -> Column:
    return _c(c).cast("timestamp")


def slot_15m(ts: Column | str) -> Column:
    return F.window(_c(ts), "15 minutes").getField("start")
