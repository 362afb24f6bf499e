"""Exchange rates: preparation, lookup by currency and date, conversion of both sides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.money import DIVIDE, to_sgd, to_sgd_in_floats
from ledgerlake.functions.text import trimmed
from ledgerlake.operators.joins import BROADCAST_BYTES, lookup_join
from ledgerlake.operators.validate import REJECT_REASON

UNKNOWN_CURRENCY = "unknown_currency"


def prepare_fx(fx: DataFrame) -> DataFrame:
    return fx.withColumnRenamed("target_currency", "currency")


def day_rates(fx: DataFrame, run_date: str | None = None) -> DataFrame:
    """(currency, rate_to_sgd) of one day, without the currencies that have no rate."""
    day = fx if run_date is None else fx.where(F.col("run_date") == run_date)
    return prepare_fx(day).where(F.col("rate_to_sgd").isNotNull()).select("currency", "rate_to_sgd")


def effective_rates(fx: DataFrame, max_lag_days: int = 0) -> DataFrame:
    """(value_date, currency, rate_to_sgd): the rate to use on each date.

    That is the rate of the same date, or else the newest one that is at most `max_lag_days`
    older. Each rate is offered to the dates it may serve and every date keeps the nearest,
    so the work is (lag + 1) times the number of rates and the facts stay out of it.
    """
    known = prepare_fx(fx).where(F.col("rate_to_sgd").isNotNull())
    if max_lag_days == 0:
        same_day = F.col("run_date").cast("string").alias("value_date")
        return known.select(same_day, "currency", "rate_to_sgd")
    offered = known.withColumn("lag", F.explode(F.sequence(F.lit(0), F.lit(max_lag_days)))).select(
        F.date_add(F.col("run_date").cast("date"), F.col("lag")).cast("string").alias("value_date"),
        "currency",
        "rate_to_sgd",
        "lag",
    )
    return offered.groupBy("value_date", "currency").agg(
        F.min_by("rate_to_sgd", "lag").alias("rate_to_sgd")
    )


def duplicate_rates(fx: DataFrame) -> DataFrame:
    """(run_date, target_currency, rates) that would double transactions in a lookup."""
    return (
        fx.groupBy("run_date", "target_currency")
        .agg(F.count(F.lit(1)).alias("rates"))
        .where(F.col("rates") > 1)
    )


def require_unique_rates(fx: DataFrame) -> DataFrame:
    """`fx` itself, or an error that names some of the doubled rates."""
    doubled = duplicate_rates(fx).take(5)
    if doubled:
        raise ValueError(f"more than one rate per day and currency: {doubled}")
    return fx


def enrich_with_fx(
    txn: DataFrame, rates: DataFrame, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Transactions with the rate of their currency; those without a rate are dropped."""
    known = rates.where(F.col("rate_to_sgd").isNotNull())
    return lookup_join(txn, known, ["currency"], "inner", limit)


def enrich_by_date(
    txn: DataFrame,
    rates: DataFrame,
    how: str = "inner",
    date_column: str = "value_date",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Transactions with the rate of their currency on the date in `date_column`."""
    dated = rates.withColumnRenamed("value_date", date_column)
    return lookup_join(txn, dated, [date_column, "currency"], how, limit)


def unknown_currencies(txn: DataFrame, rates: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Transactions whose currency has no rate."""
    return lookup_join(txn, rates.select("currency").distinct(), ["currency"], "left_anti", limit)


def convert_both_sides(
    txn: DataFrame, fx: DataFrame, rate_mode: str = DIVIDE, in_floats: bool = False,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """`deposit_sgd_amt` and `withdrawal_sgd_amt`, each by its own currency on the value date.

    The rates table plays two roles; none of its columns stay in the result. Currencies are
    compared trimmed on both sides. A side without a rate gets null.
    """
    convert = to_sgd_in_floats if in_floats else (lambda a, r: to_sgd(a, r, rate_mode))
    out = txn
    for side in ("deposit", "withdrawal"):
        rates = fx.select(
            F.col("run_date").alias("value_date"),
            trimmed("target_currency").alias("side_key"),
            F.col("rate_to_sgd").alias("side_rate"),
        )
        out = (
            lookup_join(
                out.withColumn("side_key", trimmed(f"{side}_currency")),
                rates,
                ["value_date", "side_key"],
                "left",
                limit,
            )
            .withColumn(f"{side}_sgd_amt", convert(f"{side}_amt", "side_rate"))
            .drop("side_key", "side_rate")
        )
    return out.select(*txn.columns, "deposit_sgd_amt", "withdrawal_sgd_amt")


def reject_unknown_currency(txn: DataFrame) -> DataFrame:
    """Extend the reject reason of left-joined rows: a valid row without rate is rejected."""
    missing = F.when(F.col("rate_to_sgd").isNull(), F.lit(UNKNOWN_CURRENCY))
    return txn.withColumn(REJECT_REASON, F.coalesce(F.col(REJECT_REASON), missing))
