"""Row-wise reshaping: clean-up, masking, schema conformance, wide and long form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.money import (
    MULTIPLY,
    to_sgd,
    transaction_amount,
    transaction_currency,
)
from ledgerlake.functions.text import hashed, trimmed
from ledgerlake.schemas import INGESTION_DATE, LONG_TRANSACTIONS


def trim_strings(df: DataFrame, blank_as_null: bool = False) -> DataFrame:
    """Trim every string column, in one projection."""
    return df.select(
        [
            trimmed(f.name, blank_as_null).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def stamp_ingestion_date(df: DataFrame, run_date: str) -> DataFrame:
    return df.withColumn(INGESTION_DATE, F.lit(run_date))


def add_currency_column(df: DataFrame) -> DataFrame:
    return df.withColumn("currency", transaction_currency())


def add_amount_column(df: DataFrame) -> DataFrame:
    return df.withColumn("amount", transaction_amount())


def convert_to_sgd(df: DataFrame, rate_mode: str = MULTIPLY) -> DataFrame:
    return df.withColumn("amount_sgd", to_sgd("amount", "rate_to_sgd", rate_mode))


def mask_pii(df: DataFrame, salt: str | None = None) -> DataFrame:
    """Replace `account_no` by its hash."""
    return df.withColumn("account_no_hash", hashed("account_no", salt)).drop("account_no")


def unparsed_column(df: DataFrame, target: T.StructType) -> Column:
    """The name of the first column whose cell `conform` would lose, as `unparsed_<name>`, or null.

    Blank cells are no values, so they are not lost; nor are cells that have the target's type.
    """
    types = {field.name: field.dataType for field in df.schema.fields}
    lost = [
        F.when(
            F.col(f.name).isNotNull()
            & F.col(f.name).try_cast(f.dataType).isNull()
            & (F.trim(F.col(f.name).cast("string")) != ""),
            F.lit(f"unparsed_{f.name}"),
        )
        for f in target.fields
        if types.get(f.name, f.dataType) != f.dataType
    ]
    return F.coalesce(*lost, F.lit(None).cast("string"))


def conform(df: DataFrame, target: T.StructType) -> DataFrame:
    """Exactly the target's columns, order and types.

    Missing columns become null, and so do cells that do not parse as the target type.
    """
    present = set(df.columns)
    return df.select(
        [
            (F.col(f.name).try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType))
            .alias(f.name)
            for f in target.fields
        ]
    )


def to_long(df: DataFrame, id_columns: list[str]) -> DataFrame:
    """One row per side that has an amount, from one pass over the wide rows."""
    sides = F.array(
        *[
            F.struct(
                F.lit(side).alias("type"),
                F.col(f"{side}_amt").alias("amount"),
                F.col(f"{side}_currency").alias("currency"),
            )
            for side in ("withdrawal", "deposit")
        ]
    )
    return (
        df.withColumn("side", F.explode(F.filter(sides, lambda s: s["amount"].isNotNull())))
        .withColumn(
            "transaction_id",
            F.concat_ws("-", *[F.col(c).cast("string") for c in id_columns], F.col("side.type")),
        )
        .select(
            "transaction_id", "account_no", "side.amount", "side.currency", "side.type", "value_date"
        )
        .select(LONG_TRANSACTIONS.names)
    )


def to_wide(df: DataFrame) -> DataFrame:
    """Each long row as a wide row with one side filled."""
    filled = [
        F.when(F.col("type") == side, F.col(source)).alias(f"{side}_{suffix}")
        for side in ("withdrawal", "deposit")
        for suffix, source in (("amt", "amount"), ("currency", "currency"))
    ]
    return df.select("transaction_id", "account_no", "value_date", *filled)


def add_event_partitions(df: DataFrame, timestamp: str, hourly: bool = False) -> DataFrame:
    """Partition columns `date` and, on request, `hour`."""
    out = df.withColumn("date", F.to_date(timestamp).cast("string"))
    return out.withColumn("hour", F.hour(timestamp)) if hourly else out
