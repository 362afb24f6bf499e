"""Expressions on the two-sided amount columns and on rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MULTIPLY = "multiply"
DIVIDE = "divide"


def transaction_amount() -> Column:
    return F.coalesce("withdrawal_amt", "deposit_amt")


def transaction_currency() -> Column:
    return F.coalesce("withdrawal_currency", "deposit_currency")


def to_sgd(amount: str, rate: str, rate_mode: str = MULTIPLY) -> Column:
    """`amount` in SGD.

    Multiplication stays decimal, hence exact. Division is done in doubles and gives null
    for a zero rate.
    """
    if rate_mode == MULTIPLY:
        return F.col(amount) * F.col(rate)
    if rate_mode == DIVIDE:
        return F.try_divide(F.col(amount).cast("double"), F.col(rate).cast("double"))
    raise ValueError(f"rate_mode must be {MULTIPLY!r} or {DIVIDE!r}, not {rate_mode!r}")


def to_sgd_in_floats(amount: str, rate: str) -> Column:
    """Division after narrowing both inputs to single precision; the quotient is a double."""
    return F.try_divide(F.col(amount).try_cast("float"), F.col(rate).try_cast("float"))
