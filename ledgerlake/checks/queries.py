"""The registered queries. Each reads the tables below `sf_dir` and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.checks import fixtures as fx_in
from ledgerlake.checks.fixtures import BATCH_DATE, ROW_ID, RUN_DATE, plain
from ledgerlake.functions.money import DIVIDE
from ledgerlake.operators import aggregate, asof, changes, enrich, history, joins, project, validate
from ledgerlake.plans import buckets, daily, warehouse
from ledgerlake.plans.layout import LakePaths, WarehousePaths
from ledgerlake.schemas import BRONZE, CHANGES, CHANGES_V1, INGESTION_DATE, RATE, TRANSACTIONS
from ledgerlake.session import scratch_path
from ledgerlake.sinks import lake as sink
from ledgerlake.sources import drift, lake, landing
from ledgerlake.sources.buckets import read_published

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
LANDED_FILES = 16
LANDED_ROWS = 1_000_000  # of a file, at most
V2_SINCE = "2024-01-16"
FIRST_DELIVERY = "2024-01-29"
FIX_DATE = "1998-12-31"
CUSTOMERS = warehouse.Feed(CHANGES, tracked=("segment",))
OLD_CUSTOMERS = warehouse.Feed(CHANGES_V1, tracked=("segment",))


def registered(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(query(spark, sf_dir))

    REGISTRY[query.__name__] = run
    return query


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid trimmed transactions with currency and amount."""
    return (
        validate.validate_transactions(fx_in.trimmed_transactions(spark, sf_dir))
        .transform(project.add_currency_column)
        .transform(project.add_amount_column)
    )


# --- currency aggregate -------------------------------------------------------------------


@registered
def q1_currency_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = fx_in.fx_rates(spark, sf_dir).where(F.col("run_date") == RUN_DATE)
    return daily.currency_aggregate(fx_in.trimmed_transactions(spark, sf_dir), fx, RUN_DATE)


@registered
def q1_untrimmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = fx_in.fx_rates(spark, sf_dir).where(F.col("run_date") == RUN_DATE)
    return daily.currency_aggregate(fx_in.transactions(spark, sf_dir), fx, RUN_DATE)


@registered
def q1_divided(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = fx_in.fx_rates(spark, sf_dir).where(F.col("run_date") == RUN_DATE)
    return daily.currency_aggregate(fx_in.trimmed_transactions(spark, sf_dir), fx, RUN_DATE, DIVIDE)


@registered
def q1_row_by_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = enrich.day_rates(fx_in.fx_rates(spark, sf_dir), RUN_DATE)
    enriched = enrich.enrich_with_fx(_valid(spark, sf_dir), rates)
    return aggregate.aggregate_by_currency(project.convert_to_sgd(enriched), RUN_DATE)


def _land(raw: DataFrame, paths: LakePaths) -> None:
    """`LANDED_FILES` files of raw rows or more, without a shuffle."""
    file_rows = min(LANDED_ROWS, max(1, -(-raw.count() // LANDED_FILES)))
    sink.write_day(raw, paths.raw, RUN_DATE, file_rows=file_rows)


def _land_raw(spark: SparkSession, paths: LakePaths, sf_dir: str) -> None:
    _land(fx_in.transactions(spark, sf_dir), paths)
    reply = scratch_path(spark, "reply")
    fx_in.fx_replies(fx_in.fx_rates(spark, sf_dir).where(F.col("run_date") == RUN_DATE)).write.json(reply)
    daily.run_fx_ingest(spark, reply, paths, RUN_DATE)


@registered
def q1_from_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = LakePaths.under(scratch_path(spark, "q1"))
    _land_raw(spark, paths, sf_dir)
    daily.run_bronze(spark, paths, RUN_DATE)
    daily.run_currency_aggregate(spark, paths, RUN_DATE)
    return lake.read_day(spark, paths.currency_agg, RUN_DATE)


@registered
def silver_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = fx_in.fx_rates(spark, sf_dir).where(F.col("run_date") == RUN_DATE)
    rows = daily.silver_detail(fx_in.trimmed_transactions(spark, sf_dir), fx, RUN_DATE)
    return rows.select(
        *ROW_ID, "account_no", "currency", "amount", "rate_to_sgd", "amount_sgd", INGESTION_DATE
    )


@registered
def silver_from_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = LakePaths.under(scratch_path(spark, "silver"))
    _land_raw(spark, paths, sf_dir)
    daily.run_bronze(spark, paths, RUN_DATE)
    daily.run_silver_detail(spark, paths, RUN_DATE)
    return lake.read_day(spark, paths.detail, RUN_DATE).select(
        "account_no", "value_date", "currency", "amount", "rate_to_sgd", "amount_sgd", INGESTION_DATE
    )


# --- row rules ----------------------------------------------------------------------------

_SIDES = ["withdrawal_amt", "withdrawal_currency", "deposit_amt", "deposit_currency"]


@registered
def validate_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = validate.validate_transactions(fx_in.transactions(spark, sf_dir))
    return valid.select(*ROW_ID, *_SIDES)


@registered
def validate_data_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.validate_data(fx_in.transactions(spark, sf_dir))[0].select(*ROW_ID, *_SIDES)


@registered
def validate_data_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.validate_data(fx_in.transactions(spark, sf_dir))[1].select(*ROW_ID, *_SIDES)


@registered
def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validate.with_reject_reason(fx_in.transactions(spark, sf_dir))
    return validate.split_by_reason(checked)[1].select(*ROW_ID, *_SIDES, validate.REJECT_REASON)


@registered
def unknown_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = enrich.day_rates(fx_in.fx_rates(spark, sf_dir), RUN_DATE)
    unknown = enrich.unknown_currencies(_valid(spark, sf_dir), rates)
    return unknown.select(*ROW_ID, "currency", "amount")


@registered
def quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = daily.gold_rows(fx_in.transactions(spark, sf_dir), fx_in.fx_rates(spark, sf_dir))
    return rows.agg(*aggregate.quality_counters())


# --- projections --------------------------------------------------------------------------


@registered
def two_sided_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    txn, fx = fx_in.transactions(spark, sf_dir), fx_in.fx_rates(spark, sf_dir)
    return enrich.convert_both_sides(txn, fx).select(
        *ROW_ID, "value_date", *_SIDES, "deposit_sgd_amt", "withdrawal_sgd_amt"
    )


@registered
def two_sided_floats(spark: SparkSession, sf_dir: str) -> DataFrame:
    txn, fx = fx_in.transactions(spark, sf_dir), fx_in.fx_rates(spark, sf_dir)
    return enrich.convert_both_sides(txn, fx, in_floats=True).select(
        *ROW_ID, "value_date", "deposit_sgd_amt", "withdrawal_sgd_amt"
    )


@registered
def mask_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    masked = project.mask_pii(fx_in.transactions(spark, sf_dir))
    return masked.select(*ROW_ID, "account_no_hash", "value_date", "balance_amt")


@registered
def long_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project.to_long(fx_in.transactions(spark, sf_dir), ROW_ID)


@registered
def wide_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project.to_wide(project.to_long(fx_in.transactions(spark, sf_dir), ROW_ID))


@registered
def schema_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = fx_in.changes(spark, sf_dir)
    as_text = feed.select(
        F.when(F.col("op") == "D", F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("value"),
        F.col("id").cast("string").alias("id"),
        "seq",
        "op",
        "segment",
    )
    return project.conform(as_text, CHANGES)


# --- rates by date ------------------------------------------------------------------------


@registered
def date_aligned_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = enrich.effective_rates(fx_in.fx_rates(spark, sf_dir))
    rows = enrich.enrich_by_date(_valid(spark, sf_dir), rates).transform(project.convert_to_sgd)
    return rows.select(*ROW_ID, "value_date", "currency", "amount", "rate_to_sgd", "amount_sgd")


@registered
def fx_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = enrich.effective_rates(fx_in.fx_rates(spark, sf_dir), max_lag_days=1)
    rows = enrich.enrich_by_date(_valid(spark, sf_dir), rates).transform(project.convert_to_sgd)
    return rows.select(*ROW_ID, "value_date", "currency", "amount", "rate_to_sgd", "amount_sgd")


@registered
def backfill_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    txn = fx_in.trimmed_transactions(spark, sf_dir)
    rates = enrich.effective_rates(fx_in.fx_rates(spark, sf_dir))
    return daily.currency_aggregate_by_date(
        txn.withColumn(INGESTION_DATE, F.col("value_date")), rates
    )


@registered
def backfill_from_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = LakePaths.under(scratch_path(spark, "backfill"))
    txn = fx_in.yearly_batches(fx_in.trimmed_transactions(spark, sf_dir))
    sink.write_dates(sink.cluster_by_date(txn), paths.bronze)
    sink.write_fx(fx_in.fx_rates(spark, sf_dir), paths.fx)
    daily.run_backfill(spark, paths, "1995-01-01", "2002-01-01")
    return lake.read_days(spark, paths.currency_agg, "1995-01-01", "2002-01-01")


@registered
def backfill_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backfill in slices that stopped after two years and was continued."""
    paths = LakePaths.under(scratch_path(spark, "resumed"))
    txn = fx_in.yearly_batches(fx_in.trimmed_transactions(spark, sf_dir))
    sink.write_dates(sink.cluster_by_date(txn), paths.bronze)
    sink.write_fx(fx_in.fx_rates(spark, sf_dir), paths.fx)
    for until in ("1997-01-01", "2002-01-01"):
        daily.run_sliced_backfill(spark, paths, "1995-01-01", until, "all", 731)
    return lake.read_days(spark, paths.currency_agg, "1995-01-01", "2002-01-01")


@registered
def backfill_detail_from_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = LakePaths.under(scratch_path(spark, "backfill-detail"))
    txn = fx_in.yearly_batches(fx_in.trimmed_transactions(spark, sf_dir))
    sink.write_dates(sink.cluster_by_date(txn), paths.bronze)
    sink.write_fx(fx_in.fx_rates(spark, sf_dir), paths.fx)
    daily.run_detail_backfill(spark, paths, "1995-01-01", "2002-01-01")
    return lake.read_days(spark, paths.detail, "1995-01-01", "2002-01-01").select(
        *ROW_ID, INGESTION_DATE, "value_date", "currency", "amount", "rate_to_sgd", "amount_sgd"
    )


@registered
def duplicate_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates where every day with transactions was delivered once more."""
    rates = fx_in.fx_rates(spark, sf_dir)
    traded = fx_in.transactions(spark, sf_dir).select(F.col("value_date").alias("run_date"))
    again = rates.join(traded, "run_date", "left_semi")
    return enrich.duplicate_rates(rates.unionByName(again))


@registered
def fx_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "fx")
    traded = fx_in.transactions(spark, sf_dir).select(F.col("value_date").alias("run_date")).distinct()
    rates = fx_in.fx_rates(spark, sf_dir).join(traded, "run_date", "left_semi")
    fx_in.fx_replies(rates).write.json(f"{root}/landed")
    return landing.read_fx_snapshot(spark, f"{root}/landed", multi_line=False)


@registered
def fx_ingest_bad_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reply in which some rates are none: the rates of the day, and what was rejected."""
    root = scratch_path(spark, "fx-bad")
    paths = LakePaths.under(root)
    reply = fx_in.fx_replies(fx_in.fx_rates(spark, sf_dir).where(F.col("run_date") == RUN_DATE))
    spoiled = F.transform_values(
        "rates",
        lambda k, v: F.when(k == "C03", "n/a").when(k == "C05", "1500000.5").when(k == "C07", "-1")
        .otherwise(v.cast("string")),
    )
    reply.withColumn("rates", spoiled).write.json(f"{root}/landed")
    daily.run_fx_ingest(spark, f"{root}/landed", paths, RUN_DATE)
    good = lake.read_fx_days(spark, paths.fx, RUN_DATE, "1998-06-16")
    rejected = lake.read_day(spark, paths.fx_reject, RUN_DATE)
    return good.select("target_currency", "rate_to_sgd", F.lit(None).cast("string").alias("rate_text")).unionAll(
        rejected.select("target_currency", F.lit(None).cast(RATE), "rate_text")
    )


# --- hot keys -----------------------------------------------------------------------------


@registered
def salted_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = aggregate.salted_totals(_valid(spark, sf_dir), ["currency"], salts=8)
    return totals.select("currency", F.col("rows").alias("txn_count"), F.col("amount").alias("total"))


@registered
def salted_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = enrich.day_rates(fx_in.fx_rates(spark, sf_dir), RUN_DATE)
    rows = joins.sketched_join(_valid(spark, sf_dir), rates, ["currency"], "left")
    return rows.select(*ROW_ID, "currency", "amount", "rate_to_sgd")


@registered
def salted_join_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = enrich.day_rates(fx_in.fx_rates(spark, sf_dir), RUN_DATE)
    rows = joins.split_join(_valid(spark, sf_dir), rates, ["currency"], "left")
    return rows.select(*ROW_ID, "currency", "amount", "rate_to_sgd")


# --- files --------------------------------------------------------------------------------


@registered
def bronze_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = LakePaths.under(scratch_path(spark, "bronze"))
    _land(fx_in.transactions(spark, sf_dir), paths)
    daily.run_bronze(spark, paths, RUN_DATE, files=8)
    return lake.read_transactions(spark, paths.bronze, RUN_DATE)


@registered
def bronze_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw amounts as text, some with a comma: bronze rows, and what was rejected and why."""
    paths = LakePaths.under(scratch_path(spark, "bronze-rejects"))
    text = F.col("withdrawal_amt").cast("string")
    comma = F.when(F.col("l_orderkey") % 43 == 0, F.replace(text, F.lit("."), F.lit(","))).otherwise(text)
    raw = fx_in.transactions(spark, sf_dir).withColumn("withdrawal_amt", comma)
    _land(raw, paths)
    daily.run_bronze(spark, paths, RUN_DATE)
    good = lake.read_transactions(spark, paths.bronze, RUN_DATE)
    rejected = lake.read_day(spark, paths.reject, RUN_DATE)
    kept = good.select("value_date", F.col("withdrawal_amt").cast("string"), F.lit(None).alias("reject_reason"))
    return kept.unionAll(rejected.select("value_date", "withdrawal_amt", "reject_reason"))


def _land_csv(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Transactions as CSV, where some balances are not numbers."""
    balance = F.when(F.col("l_orderkey") % 43 == 0, F.lit("n/a")).otherwise(
        F.col("balance_amt").cast("string")
    )
    (
        fx_in.transactions(spark, sf_dir)
        .withColumn("balance_amt", balance)
        .select(TRANSACTIONS.names)
        .repartition(LANDED_FILES)
        .write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


@registered
def bronze_by_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze in files of about 64 KB of raw data each."""
    paths = LakePaths.under(scratch_path(spark, "sized"))
    _land(fx_in.transactions(spark, sf_dir), paths)
    daily.run_bronze(spark, paths, RUN_DATE, file_bytes=1 << 16)
    return lake.read_transactions(spark, paths.bronze, RUN_DATE)


@registered
def schema_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the schema check says of bronze, of bronze without a column, and of one with text for
    amounts, beside the rows of each."""
    rows = daily.bronze_rows(fx_in.transactions(spark, sf_dir), RUN_DATE)
    found = []
    for name, table in (
        ("bronze", project.conform(rows, BRONZE)),
        ("no_currency", rows.drop("deposit_currency")),
        ("text", rows.withColumn("balance_amt", F.col("balance_amt").cast("string"))),
    ):
        try:
            validate.validate_schema(table, BRONZE)
            said = "ok"
        except validate.SchemaMismatch as error:
            said = str(error)
        found.append(table.select(F.lit(name).alias("name"), F.lit(said).alias("said")))
    every = found[0].unionAll(found[1]).unionAll(found[2])
    return every.groupBy("name", "said").agg(F.count(F.lit(1)).alias("n"))


def _csv_to_bronze(spark: SparkSession, sf_dir: str) -> LakePaths:
    root = scratch_path(spark, "csv")
    paths = LakePaths.under(root)
    landed = f"{root}/landed/date={RUN_DATE}"
    _land_csv(spark, sf_dir, landed)
    daily.run_bronze_from_csv(spark, f"{landed}/*.csv", paths, RUN_DATE, files=8)
    return paths


@registered
def csv_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake.read_transactions(spark, _csv_to_bronze(spark, sf_dir).bronze, RUN_DATE)


@registered
def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = lake.read_day(spark, _csv_to_bronze(spark, sf_dir).reject, RUN_DATE)
    return rejects.select("account_no", "balance_amt", landing.CORRUPT)


@registered
def partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All dates from untrimmed rows, then one date again from trimmed rows."""
    root = scratch_path(spark, "overwrite")

    def counts(txn: DataFrame) -> DataFrame:
        valid = project.add_amount_column(project.add_currency_column(validate.validate_transactions(txn)))
        return aggregate.currency_totals(valid, INGESTION_DATE, "currency")

    raw = fx_in.yearly_batches(fx_in.transactions(spark, sf_dir))
    sink.write_output(counts(raw), root)
    fixed = fx_in.yearly_batches(fx_in.trimmed_transactions(spark, sf_dir))
    sink.write_output(counts(fixed.where(F.col(INGESTION_DATE) == FIX_DATE)), root)
    return lake.read_days(spark, root, "1995-01-01", "2002-01-01").withColumnRenamed("rows", "txn_count")


@registered
def compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "compaction")
    txn = fx_in.yearly_batches(fx_in.transactions(spark, sf_dir)).drop("chq_no")
    sink.write_dates(txn.repartition(LANDED_FILES), f"{root}/small")
    sink.compact(
        spark, f"{root}/small", f"{root}/compact", "1995-01-01", "2002-01-01", target_bytes=256 * 1024
    )
    return lake.read_days(spark, f"{root}/compact", "1995-01-01", "2002-01-01")


@registered
def hour_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "hours")
    dated = project.add_event_partitions(fx_in.changes(spark, sf_dir), "updated_at", hourly=True)
    sink.write_dates(sink.cluster_by_date(dated, "date", "hour"), root, "date", "hour")
    return spark.read.parquet(root).select("seq", "id", "op", "date", "hour")


def _with_contacts(feed: DataFrame) -> DataFrame:
    return feed.withColumn("email", F.format_string("u%d@example.com", "id")).withColumn(
        "phone", F.lpad(F.col("id").cast("string"), 8, "0")
    )


def _two_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    feed = fx_in.changes(spark, sf_dir)
    is_old = F.to_date("updated_at") < F.lit(V2_SINCE).cast("date")
    return feed.where(is_old), _with_contacts(feed.where(~is_old))


@registered
def schema_versions_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "versions")
    for version in _two_versions(spark, sf_dir):
        dated = project.add_event_partitions(version, "updated_at")
        sink.write_dates(sink.cluster_by_date(dated, "date"), root, "date")
    target = T.StructType([*CHANGES.fields, T.StructField("date", T.StringType())])
    return lake.read_versions(spark, root, target)


def _land_feed(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """Change files of two schema versions, read back under the newer schema."""
    schemas = {"v1": CHANGES_V1, "v2": CHANGES}
    for name, version in zip(schemas, _two_versions(spark, sf_dir), strict=True):
        as_text = version.withColumn("updated_at", F.col("updated_at").cast("string"))
        as_text.repartition(LANDED_FILES).write.option("header", True).csv(f"{root}/landed/{name}")
    return landing.read_change_feed(
        spark, {f"{root}/landed/{name}": schema for name, schema in schemas.items()}, CHANGES
    )


@registered
def change_feed_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _land_feed(spark, sf_dir, scratch_path(spark, "feed"))


@registered
def change_feed_by_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of both schema versions in one folder, told apart by their headers."""
    root = scratch_path(spark, "headers")
    for version in _two_versions(spark, sf_dir):
        as_text = version.withColumn("updated_at", F.col("updated_at").cast("string"))
        as_text.repartition(LANDED_FILES).write.mode("append").option("header", True).csv(root)
    return landing.split_change_files(spark, root, [CHANGES_V1, CHANGES], CHANGES)[0]


@registered
def schema_types_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days whose columns had other types at first: which rows fit today's, and which cells do not."""
    root = scratch_path(spark, "types")
    rows = fx_in.changes(spark, sf_dir).select(
        "seq", "id", F.date_format("updated_at", "yyyy-MM-dd").alias("day"), F.dayofmonth("updated_at").alias("n")
    )
    cents = F.col("seq").cast("decimal(18,2)") / F.lit(4).cast("decimal(1,0)")
    mills = cents + F.when(F.col("seq") % 89 == 0, F.lit("0.000001").cast("decimal(18,6)")).otherwise(F.lit(0))
    text = F.when(F.col("seq") % 97 == 0, "n/a").otherwise(cents.cast("decimal(14,2)").cast("string"))
    eras = [
        ("n <= 8", {"id": F.col("id").cast("string"), "amount": text}),
        ("n BETWEEN 9 AND 16", {"id": F.col("id").cast("int"), "amount": cents.cast("double")}),
        ("n BETWEEN 17 AND 24", {"amount": mills.cast("decimal(18,6)")}),
        ("n > 24", {"amount": cents.cast("decimal(18,2)")}),
    ]
    for when, columns in eras:
        sink.write_dates(sink.cluster_by_date(rows.where(when).withColumns(columns).drop("n"), "day"), root, "day")
    target = T.StructType.fromDDL("seq long, id long, amount decimal(18,4)")
    good, rejected = drift.read_drifted(spark, root, target, "day")
    return good.withColumn("reject_reason", F.lit(None).cast("string")).unionAll(
        rejected.withColumns({c: F.col(c).cast(target[c].dataType) for c in ("seq", "id")}).withColumn(
            "amount", F.lit(None).cast("decimal(18,4)")
        )
    )


@registered
def change_feed_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change files with bad ids: which changes were read and which lines rejected."""
    root = scratch_path(spark, "feed-rejects")
    spoiled = F.when(F.col("seq") % 97 == 0, F.concat(F.lit("x"), F.col("id"))).otherwise(F.col("id").cast("string"))
    as_text = fx_in.changes(spark, sf_dir).withColumn("id", spoiled)
    as_text = as_text.withColumn("updated_at", F.col("updated_at").cast("string"))
    as_text.repartition(LANDED_FILES).write.option("header", True).csv(f"{root}/landed")
    feed, rejected = landing.split_change_feed(spark, {f"{root}/landed": CHANGES_V1}, CHANGES_V1)
    seq = F.split_part(landing.CORRUPT, F.lit(","), F.lit(1)).cast("long").alias("seq")
    return feed.select("seq", F.lit(False).alias("rejected")).unionAll(rejected.select(seq, F.lit(True)))


@registered
def curated_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "curated")
    dated = project.add_event_partitions(fx_in.changes(spark, sf_dir), "updated_at")
    sink.write_dates(sink.cluster_by_date(dated, "date"), root, "date")
    lake.register_table(spark, "curated_changes", root)
    return spark.sql(
        """
        SELECT op, segment, CAST(date AS STRING) AS date,
               count(*) AS changes, count(DISTINCT id) AS ids
        FROM curated_changes GROUP BY op, segment, date
        """
    )


@registered
def curated_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per partition of a catalog table, as its statistics have them."""
    root, name = scratch_path(spark, "stats"), f"curated_{uuid.uuid4().hex[:12]}"
    dated = project.add_event_partitions(fx_in.changes(spark, sf_dir), "updated_at")
    sink.write_dates(sink.cluster_by_date(dated, "date"), root, "date")
    lake.create_external_table(spark, name, root)
    lake.analyze_table(spark, name)
    found = lake.partition_statistics(spark, name).select("partition", "rows")
    spark.sql(f"DROP TABLE {name}")
    return found


# --- gold ---------------------------------------------------------------------------------


@registered
def gold_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = daily.gold_rows(fx_in.transactions(spark, sf_dir), fx_in.fx_rates(spark, sf_dir))
    valid = validate.split_by_reason(rows)[0]
    return valid.select(
        *ROW_ID, "account_no_hash", "value_date", "currency", "amount", "rate_to_sgd", "amount_sgd"
    )


@registered
def gold_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = daily.gold_rows(fx_in.transactions(spark, sf_dir), fx_in.fx_rates(spark, sf_dir))
    return validate.split_by_reason(rows)[1].select(
        *ROW_ID, "account_no_hash", "value_date", *_SIDES, validate.REJECT_REASON
    )


@registered
def gold_odd_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch with sentinel, empty, unpadded and impossible value dates through bronze and gold."""
    paths = LakePaths.under(scratch_path(spark, "odd-dates"))
    key, day = F.col("l_orderkey"), F.col("value_date")
    odd = (
        F.when(key % 19 == 0, "9999-12-31").when(key % 17 == 0, "0001-01-01").when(key % 13 == 0, " ")
        .when(key % 11 == 0, "+12024-01-01").when(key % 7 == 0, F.date_format(day.cast("date"), " y-M-d"))
    )
    raw = fx_in.transactions(spark, sf_dir).withColumn("value_date", F.coalesce(odd, day))
    _land(raw, paths)
    sink.write_fx(fx_in.fx_rates(spark, sf_dir), paths.fx)
    daily.run_bronze(spark, paths, RUN_DATE)
    daily.run_gold(spark, paths, RUN_DATE)
    valid, rejected = daily.read_gold(spark, paths, RUN_DATE)
    columns = ["value_date", validate.REJECT_REASON]
    outcomes = valid.withColumn(validate.REJECT_REASON, F.lit("")).unionByName(rejected).select(columns)
    unread = lake.read_day(spark, paths.reject, RUN_DATE).select(columns)
    return outcomes.unionAll(unread).groupBy(columns).agg(F.count(F.lit(1)).alias("txn_count"))


@registered
def fx_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with the newest rate of their currency so far; 1997 has no rates at all."""
    rates = fx_in.fx_rates(spark, sf_dir).where(~F.col("run_date").startswith("1997"))
    found = asof.asof_rates(_valid(spark, sf_dir), rates)
    return found.select(*ROW_ID, "currency", "value_date", "rate_date", "rate_to_sgd")


@registered
def fact_load_decade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims of ten years with the versions of their days, which last for years themselves."""
    claims = fx_in.claims(spark, sf_dir).withColumn(
        "claim_date", F.add_months("claim_date", (F.col("claim_id") % 120 - 60).cast("int"))
    )
    dimension = history.build_history(fx_in.changes(spark, sf_dir), ["segment"])
    return asof.versions_by_sweep(claims, dimension, "claim_date")


@registered
def csv_rejects_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "masked")
    paths, landed = LakePaths.under(root), f"{root}/landed/date={RUN_DATE}"
    _land_csv(spark, sf_dir, landed)
    daily.run_bronze_from_csv(spark, f"{landed}/*.csv", paths, RUN_DATE, files=8, mask=True)
    rejects = lake.read_day(spark, paths.reject, RUN_DATE)
    return rejects.select("account_no_hash", "balance_amt", landing.CORRUPT)


@registered
def gold_from_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch with all transactions through the gold job; counts per outcome and currency."""
    paths = LakePaths.under(scratch_path(spark, "gold"))
    _land(fx_in.transactions(spark, sf_dir), paths)
    sink.write_fx(fx_in.fx_rates(spark, sf_dir), paths.fx)
    daily.run_bronze(spark, paths, RUN_DATE)
    daily.run_gold(spark, paths, RUN_DATE)
    valid, rejected = daily.read_gold(spark, paths, RUN_DATE)
    outcomes = valid.withColumn(validate.REJECT_REASON, F.lit("")).unionByName(rejected)
    return outcomes.groupBy(validate.REJECT_REASON, "value_date").agg(
        F.count(F.lit(1)).alias("txn_count"), F.sum("amount").alias("amount")
    )


@registered
def gold_reject_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the gold job leaves in the reject layer."""
    paths = LakePaths.under(scratch_path(spark, "gold-rejects"))
    _land(fx_in.transactions(spark, sf_dir), paths)
    sink.write_fx(fx_in.fx_rates(spark, sf_dir), paths.fx)
    daily.run_bronze(spark, paths, RUN_DATE)
    daily.run_gold(spark, paths, RUN_DATE)
    rejected = lake.read_day(spark, paths.gold_reject, RUN_DATE)
    return rejected.select("account_no_hash", "value_date", *_SIDES, validate.REJECT_REASON)


# --- change feed to warehouse -------------------------------------------------------------


@registered
def cdc_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.latest_changes(fx_in.changes(spark, sf_dir))


def _ods_and_batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    before = changes.latest_changes(fx_in.changes_before(spark, sf_dir))
    ods = before.where(F.col("op") != changes.DELETE).select("id", "seq", "segment", "value")
    return ods, changes.latest_changes(fx_in.changes_of_batch(spark, sf_dir))


@registered
def ods_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.merge_changes(*_ods_and_batch(spark, sf_dir))


@registered
def ods_merge_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.merge_changes(*_ods_and_batch(spark, sf_dir), limit=0)


@registered
def ods_merge_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last day's changes first, then all that were before them."""
    late = changes.latest_changes(fx_in.changes_before(spark, sf_dir))
    return changes.merge_in_order(changes.latest_changes(fx_in.changes_of_batch(spark, sf_dir)), late)


@registered
def ods_merge_late_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = changes.latest_changes(fx_in.changes_before(spark, sf_dir))
    state = changes.latest_changes(fx_in.changes_of_batch(spark, sf_dir))
    return changes.merge_in_order(state, late, limit=0)


@registered
def scd2_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole history, and the changes of a day in its middle once more."""
    feed = fx_in.changes(spark, sf_dir)
    day = changes.latest_changes(feed.where(F.to_date("updated_at") == F.lit(V2_SINCE).cast("date")))
    return history.apply_to_history(history.build_history(feed, ["segment"]), day, ["segment"], V2_SINCE)


@registered
def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.build_history(fx_in.changes(spark, sf_dir), ["segment"])


@registered
def scd2_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = history.build_history(fx_in.changes_before(spark, sf_dir), ["segment"])
    batch = changes.latest_changes(fx_in.changes_of_batch(spark, sf_dir))
    return history.apply_to_history(before, batch, ["segment"], BATCH_DATE)


@registered
def cdc_bad_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes without a key or a known operation: which were curated, and which rejected and why."""
    paths = WarehousePaths.under(scratch_path(spark, "bad-ops"))
    feed = fx_in.changes(spark, sf_dir)
    op = F.when(F.col("seq") % 101 == 0, "X").when(F.col("seq") % 89 != 0, F.col("op"))
    feed = feed.withColumn("op", op).withColumn("id", F.when(F.col("seq") % 103 != 0, F.col("id")))
    warehouse.run_curation(feed, OLD_CUSTOMERS, paths, BATCH_DATE)
    good = warehouse.read_curated(spark, OLD_CUSTOMERS, paths, BATCH_DATE)
    rejected = lake.read_day(spark, paths.change_reject, BATCH_DATE, warehouse.DELIVERY)
    return good.select("seq", F.lit(None).cast("string").alias("reject_reason")).unionAll(
        rejected.select("seq", "reject_reason")
    )


@registered
def cdc_schema_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first delivery without contacts, then a batch with them: the latest state."""
    paths = WarehousePaths.under(scratch_path(spark, "schema-change"))
    warehouse.run_curation(fx_in.changes_before(spark, sf_dir), OLD_CUSTOMERS, paths, FIRST_DELIVERY)
    warehouse.run_initial_load(spark, OLD_CUSTOMERS, paths, FIRST_DELIVERY)
    tracked = warehouse.Feed(CHANGES, tracked=("segment", "email"))
    warehouse.run_curation(_with_contacts(fx_in.changes_of_batch(spark, sf_dir)), tracked, paths, BATCH_DATE)
    warehouse.run_batch(spark, tracked, paths, BATCH_DATE, FIRST_DELIVERY)
    emails = warehouse.read_dimension(spark, tracked, paths, BATCH_DATE).where("end_date IS NULL")
    state = warehouse.read_state(spark, tracked, paths, BATCH_DATE)
    versions = emails.select("id", F.col("email").alias("version_email"))
    return joins.lookup_join(state, versions, ["id"], "left").select(
        "id", "seq", "segment", "email", "phone", "version_email"
    )


@registered
def fact_load_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims that come twice, or without an id or a date, loaded twice: rows per day and reason."""
    paths = WarehousePaths.under(scratch_path(spark, "doubled"))
    warehouse.run_curation(fx_in.changes(spark, sf_dir), OLD_CUSTOMERS, paths, BATCH_DATE)
    warehouse.run_initial_load(spark, OLD_CUSTOMERS, paths, BATCH_DATE)
    claims = fx_in.claims(spark, sf_dir)
    nothing = F.lit(None)
    delivered = (
        claims.unionAll(claims.where("claim_id % 3 = 0"))
        .unionAll(claims.where("claim_id % 5 = 0").withColumn("claim_id", nothing.cast("long")))
        .unionAll(claims.where("claim_id % 7 = 0").withColumn("claim_date", nothing.cast("date")))
    )
    for _ in range(2):
        warehouse.run_fact_load(
            spark, OLD_CUSTOMERS, delivered, paths, BATCH_DATE, "2024-01-01", "2025-01-01", "claim_id", "claim_date"
        )
    per_day = spark.read.parquet(paths.fact).groupBy(F.col("claim_date").cast("string").alias("label"))
    rejected = lake.read_day(spark, paths.fact_reject, BATCH_DATE, warehouse.VERSION)
    per_reason = rejected.groupBy(F.col("reject_reason").alias("label"))
    return per_day.agg(F.count(F.lit(1)).alias("n")).unionAll(per_reason.agg(F.count(F.lit(1)).alias("n")))


def _fact_load(spark: SparkSession, sf_dir: str, limit: int) -> DataFrame:
    claims = fx_in.claims(spark, sf_dir)
    loaded = claims.where(F.col("claim_date") < F.lit(V2_SINCE).cast("date"))
    dimension = history.build_history(fx_in.changes(spark, sf_dir), ["segment"])
    return history.load_facts(
        claims, loaded, dimension, "claim_id", "claim_date", "2024-01-01", "2024-02-01", limit=limit
    )


@registered
def fact_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact_load(spark, sf_dir, joins.BROADCAST_BYTES)


@registered
def fact_load_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact_load(spark, sf_dir, 0)


@registered
def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _valid(spark, sf_dir)
    rates = enrich.day_rates(fx_in.fx_rates(spark, sf_dir), RUN_DATE)
    return aggregate.reconcile(
        source, enrich.enrich_with_fx(source, rates), ["currency"], ["amount"]
    )


@registered
def reconcile_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims against a copy that lacks some, has others, and differs in the amount of a few."""
    claims = fx_in.claims(spark, sf_dir)
    number = F.col("claim_id")
    copy = claims.where(number % 211 != 0).withColumn(
        "amount", F.when(number % 197 == 0, F.col("amount") + 1).otherwise(F.col("amount")).cast(claims.schema["amount"].dataType)
    )
    extra = claims.where(number % 199 == 0).withColumn("claim_id", number + 1_000_000)
    twice = claims.where(number % 193 == 0)
    return aggregate.reconcile_rows(claims, copy.unionAll(extra).unionAll(twice), ["claim_id"], ["id", "claim_date", "amount"])


def _deliver(spark: SparkSession, sf_dir: str, root: str) -> WarehousePaths:
    """Two deliveries of changes: everything before the last day, then the last day."""
    paths = WarehousePaths.under(root)
    feed = _land_feed(spark, sf_dir, root)
    in_batch = F.to_date("updated_at") >= F.lit(BATCH_DATE).cast("date")
    warehouse.run_curation(feed.where(~in_batch), CUSTOMERS, paths, FIRST_DELIVERY)
    warehouse.run_curation(feed.where(in_batch), CUSTOMERS, paths, BATCH_DATE)
    return paths


@registered
def cdc_to_ods(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = _deliver(spark, sf_dir, scratch_path(spark, "ods"))
    warehouse.run_initial_load(spark, CUSTOMERS, paths, FIRST_DELIVERY)
    warehouse.run_batch(spark, CUSTOMERS, paths, BATCH_DATE, FIRST_DELIVERY)
    return warehouse.read_state(spark, CUSTOMERS, paths, BATCH_DATE)


@registered
def cdc_to_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = _deliver(spark, sf_dir, scratch_path(spark, "dimension"))
    warehouse.run_initial_load(spark, CUSTOMERS, paths, FIRST_DELIVERY)
    warehouse.run_batch(spark, CUSTOMERS, paths, BATCH_DATE, FIRST_DELIVERY)
    return warehouse.read_dimension(spark, CUSTOMERS, paths, BATCH_DATE)


@registered
def cdc_to_warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of both loads with the version of the dimension they refer to."""
    paths = _deliver(spark, sf_dir, scratch_path(spark, "warehouse"))
    claims = fx_in.claims(spark, sf_dir)
    keys = ("claim_id", "claim_date")
    warehouse.run_initial_load(spark, CUSTOMERS, paths, FIRST_DELIVERY)
    warehouse.run_fact_load(spark, CUSTOMERS, claims, paths, FIRST_DELIVERY, "2024-01-01", BATCH_DATE, *keys)
    warehouse.run_batch(spark, CUSTOMERS, paths, BATCH_DATE, FIRST_DELIVERY)
    warehouse.run_fact_load(spark, CUSTOMERS, claims, paths, BATCH_DATE, BATCH_DATE, "2024-02-01", *keys)
    facts = spark.read.parquet(paths.fact)
    dimension = warehouse.read_dimension(spark, CUSTOMERS, paths, BATCH_DATE)
    versions = dimension.select("sk", "segment", "start_date", "end_date")
    return joins.lookup_join(facts, versions, ["sk"], "left").select(
        "claim_id", "id", "claim_date", "amount", "sk", "segment", "start_date", "end_date"
    )


@registered
def reconcile_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered claims against a fact table that has only the first half of the month."""
    paths = WarehousePaths.under(scratch_path(spark, "reconcile"))
    changes_so_far = fx_in.changes(spark, sf_dir)
    warehouse.run_curation(changes_so_far, CUSTOMERS, paths, BATCH_DATE)
    warehouse.run_initial_load(spark, CUSTOMERS, paths, BATCH_DATE)
    claims = fx_in.claims(spark, sf_dir)
    warehouse.run_fact_load(
        spark, CUSTOMERS, claims, paths, BATCH_DATE, "2024-01-01", V2_SINCE, "claim_id", "claim_date"
    )
    return warehouse.fact_report(spark, claims, paths, "claim_date", ["amount"], "2024-01-01", "2025-01-01")


def _bucketed(spark: SparkSession, sf_dir: str) -> WarehousePaths:
    """Two deliveries of changes in buckets, published one after the other."""
    paths = _deliver(spark, sf_dir, scratch_path(spark, "bucketed"))
    for delivery in (FIRST_DELIVERY, BATCH_DATE):
        buckets.run_bucketed_batch(spark, CUSTOMERS, paths, delivery, buckets=64)
    return paths


@registered
def ods_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return buckets.read_bucketed_state(spark, CUSTOMERS, _bucketed(spark, sf_dir))


@registered
def ods_bucketed_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state as of the first version, after the second one was published."""
    return buckets.read_bucketed_state(spark, CUSTOMERS, _bucketed(spark, sf_dir), FIRST_DELIVERY)


@registered
def published_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = _bucketed(spark, sf_dir)
    rows = []
    for version in (FIRST_DELIVERY, BATCH_DATE):
        found = read_published(spark, paths.published, version)
        rows += [(version, name, found.counters[name]) for name in ("changed_keys", "changed_days")]
    return spark.createDataFrame(rows, "version string, counter string, value long")


@registered
def scd2_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries, each with changes of all days, of which the first holds the latest ones."""
    paths = WarehousePaths.under(scratch_path(spark, "late"))
    changes_so_far = fx_in.changes(spark, sf_dir)
    for n in (2, 0, 1):
        warehouse.run_curation(changes_so_far.where(F.col("seq") % 3 == n), OLD_CUSTOMERS, paths, f"part-{n}")
    for version, n in enumerate((2, 0, 1)):
        buckets.run_bucketed_batch(spark, OLD_CUSTOMERS, paths, f"part-{n}", f"v{version}", buckets=16)
    return buckets.read_bucketed_dimension(spark, OLD_CUSTOMERS, paths)
