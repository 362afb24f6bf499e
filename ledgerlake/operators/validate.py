"""Schema checks, row rules and the split of a batch into valid and rejected rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.text import trimmed

REJECT_REASON = "reject_reason"


class SchemaMismatch(ValueError):
    """A table lacks columns or has them with another type."""


def validate_schema(df: DataFrame, expected: T.StructType | Iterable[str]) -> DataFrame:
    """`df` itself, when it has the expected columns; more columns are fine.

    Types are compared as well when `expected` is a schema.
    """
    actual = {field.name: field.dataType for field in df.schema.fields}
    if isinstance(expected, T.StructType):
        wanted = {field.name: field.dataType for field in expected.fields}
    else:
        wanted = dict.fromkeys(expected)
    missing = sorted(wanted.keys() - actual.keys())
    if missing:
        raise SchemaMismatch(f"missing columns: {missing}")
    wrong = {
        name: f"{actual[name].simpleString()} instead of {kind.simpleString()}"
        for name, kind in wanted.items()
        if kind is not None and kind != actual[name]
    }
    if wrong:
        raise SchemaMismatch(f"wrong types: {wrong}")
    return df


def _either(first: str, second: str) -> Column:
    return F.col(first).isNotNull() | F.col(second).isNotNull()


def _has_text(column: str) -> Column:
    return F.coalesce(trimmed(column) != "", F.lit(False))


def validate_transactions(df: DataFrame) -> DataFrame:
    """Rows with an amount and a currency on whichever side. The condition reaches the scan."""
    return df.where(
        _either("withdrawal_amt", "deposit_amt")
        & _either("withdrawal_currency", "deposit_currency")
    )


def validate_data(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two-rule check: (valid, rejected).

    Only rows with both amounts are rejected. Rows with a negative amount are in neither
    output; use `with_reject_reason` for a complete split.
    """
    both = F.col("withdrawal_amt").isNotNull() & F.col("deposit_amt").isNotNull()
    no_negative = F.lit(True)
    for amount in ("deposit_amt", "withdrawal_amt"):
        no_negative = no_negative & (F.col(amount).isNull() | (F.col(amount) >= 0))
    return df.where(~both & no_negative), df.where(both)


def reject_rules() -> list[tuple[str, Column]]:
    """(reason, condition), most basic rule first. No condition is ever null."""
    withdrawn = F.col("withdrawal_amt").isNotNull()
    deposited = F.col("deposit_amt").isNotNull()
    in_withdrawal_currency = _has_text("withdrawal_currency")
    in_deposit_currency = _has_text("deposit_currency")
    smallest = F.least("withdrawal_amt", "deposit_amt")  # skips nulls
    return [
        ("both_amounts", withdrawn & deposited),
        ("no_amount", ~withdrawn & ~deposited),
        ("negative_amount", F.coalesce(smallest < 0, F.lit(False))),
        ("both_currencies", in_withdrawal_currency & in_deposit_currency),
        ("no_currency", ~in_withdrawal_currency & ~in_deposit_currency),
        ("side_mismatch", withdrawn != in_withdrawal_currency),
    ]


def with_reject_reason(df: DataFrame) -> DataFrame:
    """`df` with the first rule each row breaks, or null."""
    reason = F.coalesce(*[F.when(broken, F.lit(name)) for name, broken in reject_rules()])
    return df.withColumn(REJECT_REASON, reason)


def split_by_reason(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid without the reason, rejected with it). Every row is in exactly one of them."""
    reason = F.col(REJECT_REASON)
    return df.where(reason.isNull()).drop(REJECT_REASON), df.where(reason.isNotNull())
