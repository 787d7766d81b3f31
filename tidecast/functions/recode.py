"""Recodes and bands of the customer profile."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code tables of the customer profile.
SEGMENT_BY_TYPE = {"retail": "VAREJO", "corporate": "PRIME", "premium": "PRIVATE"}
DEFAULT_SEGMENT = "VAREJO"
STATE_BY_CITY = {"Melbourne": "VIC", "Sydney": "NSW"}
DEFAULT_STATE = "VIC"
SCORE_BY_SEGMENT = {"VAREJO": 650, "PRIME": 750, "PRIVATE": 850}
DEFAULT_SCORE = 650
INCOME_BANDS = [(20000, "PRIVATE"), (8000, "PRIME")]
TRUE_WORDS = ["1", "true", "yes"]


def recode(c: Column, table: dict, default) -> Column:
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    return F.coalesce(F.try_element_at(lookup, c), F.lit(default))


def segment(c: Column | str = "customer_segment") -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return recode(F.lower(c), SEGMENT_BY_TYPE, DEFAULT_SEGMENT)


def state(c: Column | str = "city") -> Column:
    return recode(F.col(c) if isinstance(c, str) else c, STATE_BY_CITY, DEFAULT_STATE)


def score(c: Column | str = "segmento") -> Column:
    return recode(F.col(c) if isinstance(c, str) else c, SCORE_BY_SEGMENT, DEFAULT_SCORE)


def income_segment(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    out = F.lit(DEFAULT_SEGMENT)
    for floor, name in sorted(INCOME_BANDS):
        out = F.when(c >= floor, F.lit(name)).otherwise(out)
    return out


def gender_letter(c: Column | str = "gender") -> Column:
    """First letter, upper case; a missing gender reads 'N'."""
    c = F.col(c) if isinstance(c, str) else c
    return F.substring(F.upper(F.coalesce(c, F.lit("nan"))), 1, 1)


def as_flag(c: Column | str) -> Column:
    """'1', 'true' and 'yes' in any case are true, all else false."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.lower(c.cast("string")).isin(TRUE_WORDS), F.lit(False))


def safe_int(c: Column | str, default: int = 0) -> Column:
    """Whole part of a number or number text; anything else gives the default."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.try_cast("bigint"), F.lit(default).cast("bigint"))


def flag_int(c: Column | str) -> Column:
    """0/1 column with NULL read as 0."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("int"), F.lit(0))
