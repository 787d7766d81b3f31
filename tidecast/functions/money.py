"""Money expressions.

Sums of money never run on DOUBLE: exact addition does not depend on the order
in which partial sums meet, so a rerun (or a lost executor) gives the same
bits, and equal data give an equal model version. Sums per account or customer
run on whole ten-thousandths (BIGINT, the fast path, good for 9e14 per group);
sums over whole tables run on DECIMAL. Both leave as DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(18,4)"

# Share of the amount that enters the balance, by type.
SIGN_BY_TYPE = {"deposit": 1.0, "withdrawal": -1.0, "payment": -1.0, "transfer": -0.5}
CREDIT_TYPES = ["deposit"]
DEBIT_TYPES = ["withdrawal", "payment"]
OPENING_SHARE, OPENING_FLOOR = 0.1, 100.0


UNIT = 10_000.0


def units(c: Column | str) -> Column:
    """Money as whole ten-thousandths."""
    c = F.col(c) if isinstance(c, str) else c
    return F.rint(c * F.lit(UNIT)).cast("bigint")


def from_units(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c) / F.lit(UNIT)


def exact(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(EXACT)


def exact_sum(c: Column | str) -> Column:
    return F.sum(exact(c))


def wide_sum(c: Column) -> Column:
    """Sum of any doubles below 1e26 as DECIMAL with 12 digits after the point: squares and ratios too.

    Each value is turned into a decimal of its own, and these add up exactly, so the sum is the same in
    all bits however the rows lie and whichever task is repeated. Leaves as DOUBLE; a value beyond the
    range is an error, not a silent NULL.
    """
    return F.sum(c.cast("decimal(38,12)")).cast("double")


def money_sum(c: Column | str) -> Column:
    return exact_sum(c).cast("double")


def money_avg(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.try_divide(money_sum(c), F.count(c))


def signed_amount(kind: Column | str = "transaction_type", amount: Column | str = "amount") -> Column:
    kind = F.col(kind) if isinstance(kind, str) else kind
    amount = F.col(amount) if isinstance(amount, str) else amount
    share = F.lit(0.0)
    for name, factor in SIGN_BY_TYPE.items():
        share = F.when(kind == name, F.lit(factor)).otherwise(share)
    return amount * share


def amount_of_types(types: list[str]) -> Column:
    return F.when(F.col("transaction_type").isin(types), F.col("amount")).otherwise(F.lit(0.0))


def opening_balance(balance: Column | str = "balance") -> Column:
    """Tenth of the account balance, at least 100; no balance counts as 100."""
    balance = F.col(balance) if isinstance(balance, str) else balance
    return F.greatest(balance * F.lit(OPENING_SHARE), F.lit(OPENING_FLOOR))


def clip(c: Column, low: float | int, high: float | int) -> Column:
    """Both bounds inclusive; NULL stays NULL."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def safe_ratio_pct(num: Column, den: Column) -> Column:
    """100*num/den, NULL when the denominator is 0."""
    return F.try_divide(F.lit(100.0) * num, den)


def rounded(c: Column, digits: int | None) -> Column:
    """Presentation rounding; ``None`` leaves the value alone."""
    return c if digits is None else F.round(c, digits)


def abs_error(real: Column | str, pred: Column | str) -> Column:
    real = F.col(real) if isinstance(real, str) else real
    pred = F.col(pred) if isinstance(pred, str) else pred
    return F.abs(real - pred)


def pct_error(real: Column | str, err: Column | str) -> Column:
    """Row error in percent; 0 when the actual is 0."""
    real = F.col(real) if isinstance(real, str) else real
    err = F.col(err) if isinstance(err, str) else err
    return F.when(real == 0, F.lit(0.0)).otherwise(F.try_divide(err, F.abs(real)) * 100)
