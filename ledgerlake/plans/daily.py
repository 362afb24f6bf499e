"""Daily jobs on transactions: bronze, currency aggregate, silver detail, gold; and backfill."""

from __future__ import annotations

import math
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.dates import day_reason, known_day, names_no_day, normal_day, parsed_day
from ledgerlake.functions.money import DIVIDE, MULTIPLY
from ledgerlake.operators.aggregate import currency_totals, price_totals, quality_counters
from ledgerlake.operators.enrich import (
    day_rates,
    effective_rates,
    enrich_by_date,
    enrich_with_fx,
    reject_unknown_currency,
    require_unique_rates,
)
from ledgerlake.operators.project import (
    add_amount_column,
    add_currency_column,
    conform,
    convert_to_sgd,
    mask_pii,
    stamp_ingestion_date,
    trim_strings,
    unparsed_column,
)
from ledgerlake.operators.validate import (
    REJECT_REASON,
    split_by_reason,
    validate_schema,
    validate_transactions,
    with_reject_reason,
)
from ledgerlake.plans.layout import LakePaths
from ledgerlake.schemas import BRONZE, GOLD, INGESTION_DATE, TRANSACTIONS
from ledgerlake.session import scratch_path
from ledgerlake.sinks.lake import (
    partitions_for,
    replace_dates,
    replace_period,
    stored_bytes,
    write_day,
    write_fx,
)
from ledgerlake.sources.buckets import filesystem, listed
from ledgerlake.sources.lake import (
    read_day,
    read_days,
    read_fx_data,
    read_fx_days,
    read_fx_of_days,
    read_transactions,
)
from ledgerlake.sources.landing import CORRUPT, read_csv, split_corrupt, split_fx_snapshot

_DAY = "__day"  # a row's value date, parsed


def currency_aggregate(
    txn: DataFrame, fx: DataFrame, run_date: str, rate_mode: str = MULTIPLY
) -> DataFrame:
    """Count and SGD total per currency of one day's transactions."""
    valid = validate_transactions(txn).transform(add_currency_column).transform(add_amount_column)
    totals = currency_totals(valid, "currency")
    priced = price_totals(totals, day_rates(fx), ["currency"], rate_mode)
    return stamp_ingestion_date(priced, run_date)


def currency_aggregate_by_date(
    txn: DataFrame, rates: DataFrame, rate_mode: str = MULTIPLY
) -> DataFrame:
    """`currency_aggregate` of every ingestion date at once, each with its own day's rates.

    `rates` has (value_date, currency, rate_to_sgd), see `effective_rates`.
    """
    valid = validate_transactions(txn).transform(add_currency_column).transform(add_amount_column)
    keys = [INGESTION_DATE, "currency"]
    dated = rates.withColumnRenamed("value_date", INGESTION_DATE)
    return price_totals(currency_totals(valid, *keys), dated, keys, rate_mode)


def _in_sgd(rows: DataFrame, rate_mode: str) -> DataFrame:
    """Rows as they are stored: `amount_sgd` as a double, half the size of the exact product."""
    converted = convert_to_sgd(rows, rate_mode)
    return converted.withColumn("amount_sgd", F.col("amount_sgd").cast("double"))


def silver_detail(
    txn: DataFrame, fx: DataFrame, run_date: str, rate_mode: str = MULTIPLY
) -> DataFrame:
    """Valid transactions with currency and rate, one row each."""
    valid = validate_transactions(txn).transform(add_currency_column).transform(add_amount_column)
    enriched = enrich_with_fx(valid, day_rates(fx))
    return stamp_ingestion_date(_in_sgd(enriched, rate_mode), run_date)


def gold_rows(
    txn: DataFrame, fx: DataFrame, max_lag_days: int = 1, rate_mode: str = DIVIDE
) -> DataFrame:
    """Every transaction, masked and converted, or with the reason why it is rejected.

    Rates are those of the value date, or up to `max_lag_days` older where that day has none. A
    row without a date, with text that is none, or with a day that cannot be, is rejected as such.
    """
    checked = with_reject_reason(trim_strings(txn, blank_as_null=True)).transform(mask_pii)
    day, parsed = F.col(_DAY), checked.withColumn(_DAY, parsed_day("value_date"))
    reason = F.coalesce(REJECT_REASON, day_reason("value_date", day))
    checked = parsed.withColumns({REJECT_REASON: reason, "value_date": normal_day("value_date", day)}).drop(_DAY)
    sided = checked.transform(add_currency_column).transform(add_amount_column)
    enriched = enrich_by_date(sided, effective_rates(fx, max_lag_days), "left")
    return reject_unknown_currency(enriched).transform(_in_sgd, rate_mode)


def bronze_rows(raw: DataFrame, run_date: str) -> DataFrame:
    """Raw rows trimmed and stamped, their value dates in one spelling."""
    trimmed = trim_strings(raw)
    if "value_date" in raw.columns:
        trimmed = trimmed.withColumn("value_date", normal_day("value_date"))
    return stamp_ingestion_date(trimmed, run_date)


def checked_rows(raw: DataFrame, run_date: str) -> DataFrame:
    """`bronze_rows` with the first column that bronze cannot take as a reason, or null; text that is no
    date counts as well. Dates are parsed once."""
    rows = stamp_ingestion_date(trim_strings(raw), run_date)
    reason = unparsed_column(rows, BRONZE)
    if "value_date" not in rows.columns:
        return rows.withColumn(REJECT_REASON, reason)
    day, parsed = F.col(_DAY), rows.withColumn(_DAY, parsed_day("value_date"))
    reason = F.coalesce(reason, F.when(names_no_day("value_date", day), F.lit("unparsed_value_date")))
    return parsed.withColumns({"value_date": normal_day("value_date", day), REJECT_REASON: reason}).drop(_DAY)


def run_fx_ingest(spark: SparkSession, reply_path: str, paths: LakePaths, run_date: str) -> None:
    """One landed reply of the rates service to the rates layer; what is no rate is rejected.

    A reply without any rate is an error, for a day without rates would lose its transactions.
    """
    rates, rejected = split_fx_snapshot(spark, reply_path, run_date)
    write_day(rejected.drop("run_date"), paths.fx_reject, run_date)
    if rates.isEmpty():
        raise ValueError(f"no rates in {reply_path}")
    write_fx(require_unique_rates(rates), paths.fx)


def run_bronze(
    spark: SparkSession,
    paths: LakePaths,
    run_date: str,
    files: int | None = None,
    file_bytes: int | None = None,
) -> str:
    """Raw Parquet of one day to bronze, under the bronze schema.

    Rows with a cell that does not parse are rejected with its column's name as reason, the account
    masked. They are counted during the write, so that days without any cost no second pass.

    By default each task writes the rows it read. `files` asks for so many files, at the cost of a
    shuffle; `file_bytes` for files of as many rows as that many raw bytes hold, where a task begins
    a new file whenever one is full, or reads as much as one file holds.
    """
    raw = read_day(spark, paths.raw, run_date)
    checked, file_rows = checked_rows(raw, run_date), None
    counters = Observation("bronze")
    counted = checked.observe(counters, F.count(F.col(REJECT_REASON)).alias("rejected"))
    good = conform(counted.where(F.col(REJECT_REASON).isNull()), BRONZE)
    if file_bytes is not None:
        stored = stored_bytes(spark, f"{paths.raw}/{INGESTION_DATE}={run_date}")
        sized = partitions_for(stored, file_bytes)
        good, file_rows = good.coalesce(sized), max(1, math.ceil(raw.count() / sized))
    leaf = write_day(good, paths.bronze, run_date, files=files, file_rows=file_rows)
    rejected = checked.where(F.col(REJECT_REASON).isNotNull())
    if counters.get["rejected"] == 0:
        rejected = spark.createDataFrame([], rejected.schema)
    write_day(mask_pii(rejected), paths.reject, run_date)
    return leaf


def run_bronze_from_csv(
    spark: SparkSession,
    csv_path: str,
    paths: LakePaths,
    run_date: str,
    files: int | None = None,
    mask: bool = False,
) -> dict[str, int]:
    """Landed CSV of one day to bronze; malformed lines go to the reject layer.

    Bad lines are counted while the good ones are written, so the text is parsed a second
    time only on days that have bad lines. With `mask` the reject layer has hashes in place of
    account numbers, in the raw lines too. Returns the counters.
    """
    counters = Observation("csv")
    bad = F.col(CORRUPT).isNotNull()
    landed = read_csv(spark, csv_path, TRANSACTIONS)
    counted = landed.observe(
        counters, F.count(F.lit(1)).alias("read"), F.count_if(bad).alias("corrupt")
    )
    rows = bronze_rows(split_corrupt(counted)[0], run_date)
    write_day(rows, paths.bronze, run_date, files=files)
    corrupt = split_corrupt(landed)[1]
    if counters.get["corrupt"] == 0:
        corrupt = spark.createDataFrame([], corrupt.schema)
    write_day(mask_lines(corrupt) if mask else corrupt, paths.reject, run_date)
    return counters.get


def mask_lines(corrupt: DataFrame) -> DataFrame:
    """Malformed lines with a hash for the account: as a column, and in the raw line wherever the
    account or the line's first cell stands."""
    first = F.regexp_extract(CORRUPT, r'^\s*("[^"]*"|[^,]*)', 1)
    cell = F.nullif(F.trim(F.replace(first, F.lit('"'), F.lit(""))), F.lit(""))
    account = F.coalesce(F.nullif(F.trim("account_no"), F.lit("")), cell)
    line = F.col(CORRUPT)
    for own in (account, F.when(~cell.eqNullSafe(account), cell)):
        line = F.coalesce(F.replace(line, own, F.sha2(own, 256)), line)
    return mask_pii(corrupt.withColumns({"account_no": account, CORRUPT: line}))


def _rates_of_day(spark: SparkSession, paths: LakePaths, run_date: str) -> DataFrame:
    """The rates of one day, which may not hold a currency twice."""
    fx = read_fx_data(spark, paths.fx, run_date)
    require_unique_rates(fx.withColumn("run_date", F.lit(run_date)))
    return fx


def _rate_days(txn: DataFrame, run_date: str, max_lag_days: int) -> DataFrame:
    """(day): the value dates of a batch and its own date, and the days before them whose rates may
    serve, as a table."""
    spark = txn.sparkSession
    own = spark.createDataFrame([(date.fromisoformat(run_date),)], "day date")
    # A batch has few different texts here; they are parsed, not those of all rows.
    stated = txn.select("value_date").distinct().select(known_day("value_date").alias("day"))
    asked = stated.where("day IS NOT NULL").unionAll(own).distinct()
    path = scratch_path(spark, "rate-days")
    lag = F.explode(F.sequence(F.lit(0), F.lit(max_lag_days)))
    asked.select("day", lag.alias("lag")).select(F.date_sub("day", F.col("lag")).alias("day")).distinct().write.parquet(path)
    return spark.read.schema("day date").parquet(path)


def run_currency_aggregate(
    spark: SparkSession, paths: LakePaths, run_date: str, rate_mode: str = MULTIPLY
) -> str:
    """One day's bronze and rates to the per-currency silver table."""
    txn = validate_schema(read_transactions(spark, paths.bronze, run_date), BRONZE)
    fx = _rates_of_day(spark, paths, run_date)
    totals = currency_aggregate(txn, fx, run_date, rate_mode)
    return write_day(totals, paths.currency_agg, run_date)


def run_silver_detail(
    spark: SparkSession,
    paths: LakePaths,
    run_date: str,
    files: int | None = None,
    rate_mode: str = MULTIPLY,
) -> str:
    """One day's bronze and rates to the per-transaction silver table."""
    txn = validate_schema(read_transactions(spark, paths.bronze, run_date), BRONZE)
    fx = _rates_of_day(spark, paths, run_date)
    rows = silver_detail(txn, fx, run_date, rate_mode)
    return write_day(rows, paths.detail, run_date, files=files)


def run_gold(
    spark: SparkSession,
    paths: LakePaths,
    run_date: str,
    max_lag_days: int = 1,
    rate_mode: str = DIVIDE,
) -> dict[str, int]:
    """One day to gold and rejects; returns the quality counters.

    Rates are looked up by value date: those of the batch's own dates, and of the days before them
    within the lag, are read, and no others. Both outputs come from one pass and one write, below the day's folder as
    `outcome=valid` and `outcome=reject`, so a rerun replaces both together. The counters are
    observed during that write. The rejected rows are then copied to the reject layer.
    """
    txn = validate_schema(read_transactions(spark, paths.bronze, run_date), BRONZE)
    fx = require_unique_rates(read_fx_of_days(spark, paths.fx, _rate_days(txn, run_date, max_lag_days)))
    counters = Observation("gold")
    rows = gold_rows(txn, fx, max_lag_days, rate_mode).observe(counters, *quality_counters())
    outcome = F.when(F.col(REJECT_REASON).isNull(), F.lit("valid")).otherwise(F.lit("reject"))
    write_day(rows.withColumn("outcome", outcome), paths.gold, run_date, within=("outcome",))
    rejected = read_day(spark, paths.gold, run_date, schema=GOLD).where(F.col("outcome") == "reject")
    write_day(rejected.drop("outcome"), paths.gold_reject, run_date)
    return counters.get


def read_gold(spark: SparkSession, paths: LakePaths, run_date: str) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) rows of one gold day."""
    rows = read_day(spark, paths.gold, run_date, schema=GOLD)
    return tuple(part.drop("outcome") for part in split_by_reason(rows))


def run_backfill(
    spark: SparkSession, paths: LakePaths, since: str, until: str, rate_mode: str = MULTIPLY
) -> None:
    """The per-currency table for all dates [since, until), in one job."""
    txn = read_days(spark, paths.bronze, since, until, schema=BRONZE)
    rates = effective_rates(require_unique_rates(read_fx_days(spark, paths.fx, since, until)))
    totals = currency_aggregate_by_date(txn, rates, rate_mode)
    replace_dates(totals, paths.currency_agg, since, until)


def run_detail_backfill(
    spark: SparkSession, paths: LakePaths, since: str, until: str, rate_mode: str = MULTIPLY
) -> None:
    """The per-transaction silver table for all dates [since, until), in one job."""
    txn = read_days(spark, paths.bronze, since, until)
    valid = validate_transactions(txn).transform(add_currency_column).transform(add_amount_column)
    rates = effective_rates(require_unique_rates(read_fx_days(spark, paths.fx, since, until)))
    rows = enrich_by_date(valid, rates, date_column=INGESTION_DATE)
    rows = rows.transform(_in_sgd, rate_mode)
    replace_dates(rows, paths.detail, since, until)



def period_slices(since: str, until: str, days: int) -> list[tuple[str, str]]:
    """[since, until) in slices of so many days."""
    first, end = date.fromisoformat(since), date.fromisoformat(until)
    cuts = [first + timedelta(days=n) for n in range(0, (end - first).days, days)]
    return [(a.isoformat(), min(a + timedelta(days=days), end).isoformat()) for a in cuts]


def run_sliced_backfill(
    spark: SparkSession,
    paths: LakePaths,
    since: str,
    until: str,
    name: str,
    slice_days: int = 31,
    rate_mode: str = MULTIPLY,
) -> list[tuple[str, str]]:
    """`run_backfill` in slices, one job after the other, that continues where it stopped.

    Each finished slice is an empty file in the ledger of the backfill `name`; a run with the same
    name, period and slices leaves those out. A slice that stopped half way is done again: its dates
    are replaced as a whole. Use a new name to do everything again. Returns the slices of this run.
    """
    ledger, done = f"{paths.currency_agg}_ledger/{name}", []
    finished = set(listed(spark, f"{ledger}/*"))
    for first, end in period_slices(since, until, slice_days):
        entry = f"{first}_{end}_{rate_mode}"
        if entry in finished:
            continue
        txn = read_days(spark, paths.bronze, first, end, schema=BRONZE)
        rates = effective_rates(require_unique_rates(read_fx_days(spark, paths.fx, first, end)))
        replace_period(currency_aggregate_by_date(txn, rates, rate_mode), paths.currency_agg, first, end)
        files, path = filesystem(spark, f"{ledger}/{entry}")
        files.create(path).close()
        done.append((first, end))
    return done
