"""The jobs' input tables, derived from the given tables."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.project import trim_strings
from ledgerlake.schemas import FX_RATES, INGESTION_DATE, MONEY

RUN_DATE = "1998-06-15"
FX_FIRST_DAY = "1995-01-01"
FX_DAYS = 2500
BATCH_DATE = "2024-01-30"
CODES = [f"C{number:02d}" for number in range(30)]
ROW_ID = ["l_orderkey", "l_linenumber"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide transactions, one per order line, with every kind of defect the rules look for."""
    plain_code = (F.col("l_suppkey") % len(CODES)).cast("int")
    spelling = (
        F.when(F.col("l_partkey") % 41 == 0, F.lit(None).cast("int"))
        .when(F.col("l_partkey") % 37 == 0, F.lit(2 * len(CODES)))
        .when(F.col("l_partkey") % 11 == 0, plain_code + len(CODES))
        .otherwise(plain_code)
    )
    currency = F.get(F.lit([*CODES, *[f" {code} " for code in CODES], "   "]), spelling)
    price = F.col("l_extendedprice")
    mills = F.when(F.col("l_partkey") % 29 == 0, F.lit(Decimal("0.005"))).otherwise(F.lit(Decimal("0.000")))
    amount = (F.when(F.col("l_partkey") % 47 == 0, -price).otherwise(price).cast(MONEY) + mills).cast(MONEY)
    both = F.col("l_orderkey") % 50 == 0
    one = F.col("l_orderkey") % 53 != 0
    withdrawn = both | (one & (F.col("l_returnflag") == "R"))
    deposited = both | (one & (F.col("l_returnflag") != "R"))
    day = F.col("l_shipdate").cast("date").cast("string")
    account = F.concat(F.lit(" AC"), F.lpad(F.col("l_suppkey").cast("string"), 8, "0"))
    return table(spark, sf_dir, "lineitem").select(
        account.alias("account_no"),
        day.alias("date"),
        F.col("l_linestatus").alias("transaction_details"),
        F.lit(None).cast("string").alias("chq_no"),
        day.alias("value_date"),
        F.when(withdrawn, amount).alias("withdrawal_amt"),
        F.when(withdrawn, currency).alias("withdrawal_currency"),
        F.when(deposited, amount).alias("deposit_amt"),
        F.when(deposited, currency).alias("deposit_currency"),
        F.col("l_quantity").cast(MONEY).alias("balance_amt"),
        *ROW_ID,
    )


def trimmed_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trim_strings(transactions(spark, sf_dir))


def yearly_batches(txn: DataFrame) -> DataFrame:
    """Transactions delivered in one batch per year, on its last day."""
    return txn.withColumn(INGESTION_DATE, F.concat(F.substring("value_date", 1, 4), F.lit("-12-31")))


def fx_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rates of all nations' currencies, with gaps, a small unit and one without rates."""
    first = F.lit(FX_FIRST_DAY).cast("date")
    days = F.sequence(first, F.date_add(first, FX_DAYS - 1))
    nation = F.col("n_nationkey")
    rate = F.expr(
        """CAST(CASE WHEN n_nationkey = 23 THEN 0.0000113456 + (year(day) - 1995) * 0.0000001
        ELSE 0.5 + n_nationkey * 0.05 + (year(day) - 1995) * 0.01 END AS DECIMAL(18,12))"""
    )
    return (
        table(spark, sf_dir, "nation")
        .select("n_nationkey", F.explode(days).alias("day"))
        .where((F.dayofmonth("day") + nation) % 9 != 0)
        .select(
            F.col("day").cast("string").alias("run_date"),
            F.lit("SGD").alias("base_currency"),
            F.concat(F.lit("C"), F.lpad(nation.cast("string"), 2, "0")).alias("target_currency"),
            F.when(nation != 24, rate).alias("rate_to_sgd"),
        )
        .select(FX_RATES.names)
    )


def fx_replies(rates: DataFrame) -> DataFrame:
    """Replies of the rates service, one row per day."""
    rated = rates.where(F.col("rate_to_sgd").isNotNull())
    # A day has at most one rate per nation.
    per_day = rated.groupBy("run_date", "base_currency").agg(
        F.map_from_entries(F.collect_list(F.struct("target_currency", "rate_to_sgd"))).alias("rates")
    )
    epoch_day = F.date_diff(F.col("run_date").cast("date"), F.lit("1970-01-01").cast("date"))
    return per_day.select(
        (epoch_day.cast("long") * 86400).alias("timestamp"),
        F.col("base_currency").alias("base"),
        "rates",
    )


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change feed of customer segments, from the events table."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.col("user_id").alias("id"),
        F.col("ts").alias("updated_at"),
        F.when(kind == "signup", "I").when(kind == "error", "D").otherwise("U").alias("op"),
        kind.alias("segment"),
        "value",
    )


def changes_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes(spark, sf_dir).where(F.to_date("updated_at") < F.lit(BATCH_DATE).cast("date"))


def changes_of_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes(spark, sf_dir).where(F.to_date("updated_at") >= F.lit(BATCH_DATE).cast("date"))


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts: one per event."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("claim_id"),
        F.col("user_id").alias("id"),
        F.to_date("ts").alias("claim_date"),
        F.col("value").cast(MONEY).alias("amount"),
    )


def plain(df: DataFrame) -> DataFrame:
    """`df` with decimals as doubles and dates as text, for comparison between engines."""
    def cell(field: T.StructField):
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return F.col(field.name).cast("string").alias(field.name)
        return F.col(field.name)

    return df.select([cell(field) for field in df.schema.fields])
