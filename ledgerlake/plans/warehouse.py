"""Change feed to curated files, latest state, dimension history, facts and reconciliation.

Every step writes a table and the next one reads it, so a lost executor or a failed step costs
only that step. Latest state and open dimension rows are written as a new version beside the old
one: a table cannot be read and replaced in the same job, and the old version allows a rerun.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.aggregate import reconcile
from ledgerlake.operators.changes import DELETE, latest_changes, merge_in_order, split_changes
from ledgerlake.operators.history import apply_to_history, build_history, load_facts, split_facts
from ledgerlake.operators.project import add_event_partitions, conform
from ledgerlake.plans.layout import WarehousePaths
from ledgerlake.sinks.lake import cluster_by_date, write_day
from ledgerlake.sources.lake import find, read_day, read_days

DELIVERY = "delivery"
VERSION = "version"
BATCH = "batch"
EVENT_DATE = "date"
STATE, OPEN, CLOSED = "state", "open", "closed"


@dataclass(frozen=True)
class Feed:
    """What the steps need to know about one source table's changes."""

    schema: T.StructType
    tracked: tuple[str, ...]
    key: str = "id"
    op: str = "op"
    updated_at: str = "updated_at"
    sequence: str = "seq"

    @property
    def order(self) -> tuple[str, str]:
        return (self.updated_at, self.sequence)

    @property
    def state_columns(self) -> list[str]:
        return [name for name in self.schema.names if name not in (self.op, self.updated_at)]

    @property
    def version_schema(self) -> T.StructType:
        """The dimension's rows; a column that older files lack is null."""
        types = {field.name: field for field in self.schema.fields}
        return T.StructType(
            [
                T.StructField("sk", T.StringType()),
                types[self.key],
                *(types[name] for name in self.tracked),
                T.StructField("start_date", T.DateType()),
                T.StructField("end_date", T.DateType()),
                T.StructField(VERSION, T.StringType()),
                T.StructField(STATE, T.StringType()),
            ]
        )

    @property
    def curated_schema(self) -> T.StructType:
        folders = [T.StructField(name, T.StringType()) for name in (EVENT_DATE, DELIVERY)]
        return T.StructType([*self.schema.fields, *folders])


def run_curation(changes: DataFrame, feed: Feed, paths: WarehousePaths, delivery: str) -> None:
    """One delivery of changes to Parquet under the target schema, by event date.

    A delivery may hold late events of earlier dates; they do not touch what other deliveries
    brought for those dates. Changes without a key, a time or a known operation are rejected.
    """
    good, rejected = split_changes(conform(changes, feed.schema), feed.key, feed.op, feed.updated_at)
    write_day(rejected, paths.change_reject, delivery, DELIVERY)
    dated = add_event_partitions(good, feed.updated_at)
    write_day(
        cluster_by_date(dated, EVENT_DATE), paths.curated, delivery, DELIVERY, within=(EVENT_DATE,)
    )


def read_curated(spark: SparkSession, feed: Feed, paths: WarehousePaths, delivery: str) -> DataFrame:
    """The changes of one delivery; columns that its files lack are null."""
    return read_day(spark, paths.curated, delivery, DELIVERY, feed.curated_schema).select(
        feed.schema.names
    )


def _read_last_changes(spark: SparkSession, feed: Feed, paths: WarehousePaths, version: str) -> DataFrame:
    """The last change of each key as of `version`, tombstones included; columns that are new to
    the feed are null."""
    return read_day(spark, paths.ods, version, VERSION, feed.schema).select(feed.schema.names)


def read_state(spark: SparkSession, feed: Feed, paths: WarehousePaths, version: str) -> DataFrame:
    """The latest state as of `version`."""
    last = _read_last_changes(spark, feed, paths, version)
    return last.where(F.col(feed.op) != DELETE).select(feed.state_columns)


def read_open_versions(spark: SparkSession, feed: Feed, paths: WarehousePaths, version: str) -> DataFrame:
    """The dimension rows that are open as of `version`."""
    rows = read_day(spark, paths.dimension, version, VERSION, feed.version_schema)
    return rows.where(F.col(STATE) == OPEN).drop(VERSION, STATE)


def read_dimension(spark: SparkSession, feed: Feed, paths: WarehousePaths, version: str) -> DataFrame:
    """The dimension as of `version`: its open rows, and all rows closed up to then."""
    rows = spark.read.schema(feed.version_schema).parquet(paths.dimension)
    written = F.col(VERSION).cast("string")
    is_open = F.col(STATE) == OPEN
    valid = (is_open & (written == version)) | (~is_open & (written <= version))
    return rows.where(valid).drop(VERSION, STATE)


def _write_dimension(rows: DataFrame, paths: WarehousePaths, version: str) -> None:
    """Write what a batch changed: all open rows, and the rows that it closed.

    A closed row never changes, so it is written once, by the batch that closed it.
    """
    state = F.when(F.col("end_date").isNull(), F.lit(OPEN)).otherwise(F.lit(CLOSED))
    write_day(rows.withColumn(STATE, state), paths.dimension, version, VERSION, within=(STATE,))


def run_initial_load(spark: SparkSession, feed: Feed, paths: WarehousePaths, delivery: str) -> None:
    """Latest state and dimension history from a first delivery with all changes so far."""
    changes = read_curated(spark, feed, paths, delivery)
    write_day(latest_changes(changes, feed.key, feed.order), paths.ods, delivery, VERSION)
    dimension = build_history(changes, feed.tracked, feed.key, feed.updated_at, feed.order, feed.op)
    _write_dimension(dimension, paths, delivery)


def run_batch(
    spark: SparkSession, feed: Feed, paths: WarehousePaths, run_date: str, previous: str
) -> None:
    """The delivery of `run_date` into latest state and dimension.

    `previous` names the version to start from; names sort by date. The last change per key
    is staged once as a table; both merges read it. A change that is older than the one that is
    known of its key is in neither. Both tables are made under the feed's schema, so that a new
    column fails, if it does, before anything is written.
    """
    latest = latest_changes(read_curated(spark, feed, paths, run_date), feed.key, feed.order)
    write_day(latest, paths.staging, run_date, BATCH)
    staged = read_day(spark, paths.staging, run_date, BATCH)
    known = _read_last_changes(spark, feed, paths, previous)
    merged = merge_in_order(known, staged, feed.key, feed.order)
    order = [F.col(name) for name in feed.order]
    before = known.select(feed.key, F.struct(*order).alias("before"))
    newer = staged.join(before, feed.key, "left").where(
        F.col("before").isNull() | (F.struct(*order) >= F.col("before"))
    )
    current = read_open_versions(spark, feed, paths, previous)
    versions = apply_to_history(
        current, newer.select(staged.columns), feed.tracked, run_date, feed.key, feed.op
    )
    write_day(merged, paths.ods, run_date, VERSION)
    _write_dimension(versions, paths, run_date)


def run_fact_load(
    spark: SparkSession,
    feed: Feed,
    facts: DataFrame,
    paths: WarehousePaths,
    version: str,
    since: str,
    until: str,
    fact_id: str,
    fact_date: str,
    key: str = "id",
) -> None:
    """Append the facts of [since, until) that are not loaded yet, with dimension keys.

    Facts that arrive late join those of their day that are there already; running the same
    load again appends nothing. A fact that is delivered twice is loaded once. Facts without an id
    or a date are rejected.
    """
    facts, rejected = split_facts(facts, fact_id, fact_date)
    write_day(rejected, paths.fact_reject, version, VERSION)
    loaded = find(spark, paths.fact, lambda: read_days(spark, paths.fact, since, until, EVENT_DATE))
    if loaded is None:
        loaded = facts.limit(0)
    dimension = read_dimension(spark, feed, paths, version)
    rows = load_facts(facts, loaded, dimension, fact_id, fact_date, since, until, key)
    dated = rows.withColumn(EVENT_DATE, F.col(fact_date).cast("string"))
    cluster_by_date(dated, EVENT_DATE).write.mode("append").partitionBy(EVENT_DATE).parquet(paths.fact)


def fact_report(
    spark: SparkSession,
    facts: DataFrame,
    paths: WarehousePaths,
    fact_date: str,
    measures: list[str],
    since: str,
    until: str,
) -> DataFrame:
    """Counts and sums per day of [since, until) of the delivered facts and of the fact table."""
    table = read_days(spark, paths.fact, since, until, EVENT_DATE).select(fact_date, *measures)
    day = F.col(fact_date)
    delivered = facts.where((day >= F.lit(since).cast("date")) & (day < F.lit(until).cast("date")))
    return reconcile(delivered.select(fact_date, *measures), table, [fact_date], measures)
