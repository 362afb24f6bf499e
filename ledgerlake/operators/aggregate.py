"""Aggregates per currency and day, counters and reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.money import MULTIPLY, to_sgd
from ledgerlake.operators.project import stamp_ingestion_date
from ledgerlake.operators.validate import REJECT_REASON
from ledgerlake.schemas import MONEY_TOTAL


def aggregate_by_currency(enriched: DataFrame, run_date: str) -> DataFrame:
    """Count and SGD total per currency of rows that already carry `amount_sgd`.

    The total is summed in the type of `amount_sgd`, exactly for decimals, and is a double.
    """
    totals = enriched.groupBy("currency").agg(
        F.count(F.lit(1)).alias("txn_count"),
        F.sum("amount_sgd").cast("double").alias("total_value_sgd"),
    )
    return stamp_ingestion_date(totals, run_date)


def currency_totals(txn: DataFrame, *keys: str) -> DataFrame:
    """Row count and amount total per key, in the transactions' own currency.

    The map side reduces each task's rows to one per key, so a key that holds most of the
    rows costs as much as any other.
    """
    total = F.sum("amount")
    if isinstance(txn.schema["amount"].dataType, T.DecimalType):
        total = total.cast(MONEY_TOTAL)
    return txn.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), total.alias("amount"))


def price_totals(
    totals: DataFrame, rates: DataFrame, keys: list[str], rate_mode: str = MULTIPLY
) -> DataFrame:
    """`totals` in SGD: (keys, txn_count, total_value_sgd as a double).

    All rows of a key share its rate, so it is applied once per key and the join sees the
    totals instead of the rows. Either side may be the larger one; adaptive execution
    chooses, from sizes known after the aggregation. A key with two rates counts twice, as
    it would row by row.
    """
    priced = totals.join(rates.where(F.col("rate_to_sgd").isNotNull()), keys).withColumn(
        "value", to_sgd("amount", "rate_to_sgd", rate_mode)
    )
    return priced.groupBy(*keys).agg(
        F.sum("rows").alias("txn_count"), F.sum("value").cast("double").alias("total_value_sgd")
    )


def salted_totals(txn: DataFrame, keys: list[str], salts: int) -> DataFrame:
    """`currency_totals` in two reduce steps.

    The salt follows the input task, so a map task still sends one row per key, and the
    rows of one key are merged by up to `salts` tasks before the last step.
    """
    salted = txn.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    merged = currency_totals(salted, *keys, "__salt")
    return merged.groupBy(*keys).agg(
        F.sum("rows").alias("rows"), F.sum("amount").cast(merged.schema["amount"].dataType).alias("amount")
    )


def quality_counters() -> list[Column]:
    """Counters over rows with a final reject reason, for `agg` or `observe`.

    input = valid + reject, and valid = output + unknown currency.
    """
    reason = F.col(REJECT_REASON)
    unknown = F.coalesce(reason == "unknown_currency", F.lit(False))
    return [
        F.count(F.lit(1)).alias("input_count"),
        F.count_if(reason.isNull() | unknown).alias("valid_count"),
        F.count_if(reason.isNotNull() & ~unknown).alias("reject_count"),
        F.count_if(unknown).alias("unknown_currency_count"),
        F.count_if(reason.isNull()).alias("output_count"),
    ]


def reconcile(
    source: DataFrame, target: DataFrame, keys: list[str], measures: list[str]
) -> DataFrame:
    """Row counts and sums of both tables per key, and whether they agree.

    Both tables go through one aggregation, so there is one shuffle of partial sums and no
    join. A key that only one table has appears with zero rows of the other.
    """
    sides = ("source", "target")
    both = source.select(*keys, *measures, F.lit("source").alias("__side")).unionAll(
        target.select(*keys, *measures, F.lit("target").alias("__side"))
    )
    is_side = {side: F.col("__side") == side for side in sides}
    sums = [
        F.coalesce(F.sum(F.when(is_side[side], F.col(m))), F.lit(0)).alias(f"{side}_{m}")
        for m in measures
        for side in sides
    ]
    counts = [F.count_if(is_side[side]).alias(f"{side}_count") for side in sides]
    agrees = F.col("source_count") == F.col("target_count")
    for m in measures:
        agrees = agrees & (F.col(f"source_{m}") == F.col(f"target_{m}"))
    return both.groupBy(*keys).agg(*counts, *sums).withColumn("ok", agrees)


def reconcile_rows(
    source: DataFrame, target: DataFrame, keys: list[str], columns: list[str], buckets: int = 4096
) -> DataFrame:
    """(keys, source_rows, target_rows, status) of the keys whose rows are not the same on both sides;
    status is missing (in the target), extra or changed.

    Both sides are first compared by an order-independent digest per bucket of keys, which needs no
    more than a row per bucket and task in the shuffle. Only rows of buckets that differ are then
    compared key by key. Nulls are values, in keys and in columns; rows may repeat.
    """
    cells = [*keys, *columns]
    types = {c: source.schema[c].dataType for c in cells}
    differing = [c for c in cells if target.schema[c].dataType != types[c]]
    if differing:
        raise TypeError(f"columns of different types: {differing}")
    digest = F.xxhash64(*(F.col(c).isNull() for c in cells), *cells).cast("decimal(20,0)")
    place = F.pmod(F.xxhash64(*(F.col(k).isNull() for k in keys), *keys), F.lit(buckets)).cast("int")
    sides = [
        side.select(*cells).select(*keys, place.alias("bucket"), digest.alias("digest"), F.lit(sign).alias("side"))
        for sign, side in ((1, source), (-1, target))
    ]
    # Equal rows of both sides cancel out.
    signed = F.sum(F.col("digest") * F.col("side"))
    both = sides[0].unionAll(sides[1])
    suspects = both.groupBy("bucket").agg(signed.alias("rest"), F.sum("side").alias("more"))
    suspects = suspects.where("rest <> 0 OR more <> 0").select("bucket")
    rows = both.join(F.broadcast(suspects), "bucket", "left_semi")  # a number per bucket at most
    found = rows.groupBy(*keys).agg(
        signed.alias("rest"), F.count_if(F.col("side") > 0).alias("source_rows"), F.count_if(F.col("side") < 0).alias("target_rows")
    )
    status = (
        F.when(F.col("target_rows") == 0, "missing").when(F.col("source_rows") == 0, "extra").otherwise("changed")
    )
    wrong = found.where((F.col("rest") != 0) | (F.col("source_rows") != F.col("target_rows")))
    return wrong.select(*keys, "source_rows", "target_rows", status.alias("status"))
