"""Readers of date-partitioned Parquet layers."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.dates import EARLIEST, LATEST
from ledgerlake.schemas import FX_RATES, INGESTION_DATE

# Folder names in one glob; longer periods are listed by month, then by year.
MOST_FOLDERS = 100


def exists(spark: SparkSession, pattern: str) -> bool:
    """Whether a path, or any path that fits a glob, is there."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(files.globStatus(path))


def find(spark: SparkSession, pattern: str, read: Callable[[], DataFrame]) -> DataFrame | None:
    """What `read` returns, or None where `pattern` has no files yet."""
    if not exists(spark, pattern):
        return None
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def _reader(spark: SparkSession, schema: T.StructType | None):
    return spark.read if schema is None else spark.read.schema(schema)


def _days(since: str, until: str) -> list[date]:
    first, end = date.fromisoformat(since), date.fromisoformat(until)
    return [first + timedelta(days=n) for n in range((end - first).days)]


def period_folders(root: str, since: str, until: str, layout: tuple[str, str, str]) -> str:
    """A glob of the folders below `root` that days of [since, until) can be in.

    `layout` has the folder of a day, of a month's days and of a year's days as patterns for
    `date.strftime`. The finest one that needs at most `MOST_FOLDERS` names is used, so that the
    listing follows the period and not the layer.
    """
    days = _days(since, until)
    for pattern in layout:
        names = list(dict.fromkeys(day.strftime(pattern) for day in days))
        if len(names) <= MOST_FOLDERS:
            break
    return f"{root}/{{{','.join(names)}}}"


def read_day(
    spark: SparkSession,
    root: str,
    run_date: str,
    partition: str = INGESTION_DATE,
    schema: T.StructType | None = None,
) -> DataFrame:
    """One day of a layer, with its partition column.

    Only that day's folder is listed, however many days the layer holds.
    """
    day = _reader(spark, schema).option("basePath", root).parquet(f"{root}/{partition}={run_date}")
    return day.withColumn(partition, F.col(partition).cast("string"))


def read_days(
    spark: SparkSession,
    root: str,
    since: str,
    until: str,
    partition: str = INGESTION_DATE,
    schema: T.StructType | None = None,
) -> DataFrame:
    """The days [since, until) of a layer. Other days are neither read nor, beyond their month or
    year, listed. Without any folder in the period, the layer without rows."""
    layout = tuple(f"{partition}={part}" for part in ("%Y-%m-%d", "%Y-%m-*", "%Y-*"))
    folders = period_folders(root, since, until, layout)
    days = find(spark, folders, lambda: _reader(spark, schema).option("basePath", root).parquet(folders))
    if days is None:
        days = _reader(spark, schema).parquet(root).limit(0)
    day = F.col(partition)
    return days.where((day >= since) & (day < until)).withColumn(partition, day.cast("string"))


def read_transactions(
    spark: SparkSession, root: str, run_date: str, schema: T.StructType | None = None
) -> DataFrame:
    return read_day(spark, root, run_date, INGESTION_DATE, schema)


def read_fx_data(
    spark: SparkSession, root: str, run_date: str, partition: str | None = None
) -> DataFrame:
    """The rates of one day from the `year=/month=/day=` layout, or from `<partition>=` folders."""
    if partition is not None:
        return read_day(spark, root, run_date, partition).drop(partition)
    year, month, day = run_date.split("-")
    leaf = f"{root}/year={year}/month={month}/day={day}"
    return spark.read.option("basePath", root).parquet(leaf).drop("year", "month", "day")


def read_fx_days(spark: SparkSession, root: str, since: str, until: str) -> DataFrame:
    """The rates of [since, until) from the `year=/month=/day=` layout, with their `run_date`.

    The condition uses partition columns only, so other days are pruned; see `period_folders` for
    what is listed. Without any folder in the period there are no rows.
    """
    day = F.make_date("year", "month", "day")
    folders = period_folders(root, since, until, ("year=%Y/month=%m/day=%d", "year=%Y/month=%m", "year=%Y"))
    stored = T.StructType([f for f in FX_RATES.fields if f.name != "run_date"])
    dated = T.StructType([*stored.fields, *(T.StructField(c, T.IntegerType()) for c in ("year", "month", "day"))])
    rates = find(spark, folders, lambda: spark.read.option("basePath", root).schema(stored).parquet(folders))
    if rates is None:
        rates = spark.createDataFrame([], dated)
    return (
        rates
        .where((day >= F.lit(since).cast("date")) & (day < F.lit(until).cast("date")))
        .withColumn("run_date", day.cast("string"))
        .drop("year", "month", "day")
    )


def read_fx_of_days(spark: SparkSession, root: str, days: DataFrame) -> DataFrame:
    """The rates of the days in `days` (day: date), with their `run_date`.

    `days` has one row per day that some batch asks for, within `EARLIEST` and `LATEST`, and is
    broadcast: there are no more of them than days in that time. The layer's scan gets them as a
    pruning expression at run time, so folders of other days are not read, however far the first and
    the last day are apart.
    """
    layout = T.StructType(
        [f for f in FX_RATES.fields if f.name != "run_date"]
        + [T.StructField(c, T.IntegerType()) for c in ("year", "month", "day")]
    )
    rates = find(spark, f"{root}/year=*", lambda: spark.read.schema(layout).parquet(root))
    if rates is None:
        rates = spark.createDataFrame([], layout)
    within = days.where(F.col("day").between(F.lit(EARLIEST).cast("date"), F.lit(LATEST).cast("date")))
    asked = within.select(F.year("day").alias("year"), F.month("day").alias("month"), F.dayofmonth("day").alias("day"))
    found = rates.join(F.broadcast(asked.distinct()), ["year", "month", "day"], "left_semi")
    return found.withColumn("run_date", F.make_date("year", "month", "day").cast("string")).drop("year", "month", "day")


def read_versions(spark: SparkSession, root: str, target: T.StructType) -> DataFrame:
    """All partitions under the target schema; columns a file lacks are null."""
    return spark.read.schema(target).parquet(root)


def register_table(
    spark: SparkSession, name: str, root: str, schema: T.StructType | None = None
) -> DataFrame:
    """Make a layer available to SQL under `name`; partition filters prune as usual."""
    table = _reader(spark, schema).parquet(root)
    table.createOrReplaceTempView(name)
    return table


def create_external_table(
    spark: SparkSession, name: str, root: str, schema: T.StructType | None = None
) -> DataFrame:
    """A catalog table over a layer, with the partitions that exist now.

    Queries list only the partitions they need. Call `spark.catalog.recoverPartitions(name)`
    after new dates arrive. Dropping the table leaves the files.
    """
    spark.catalog.createTable(name, path=root, source="parquet", schema=schema)
    if any(column.isPartition for column in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


def analyze_table(spark: SparkSession, name: str) -> None:
    """Statistics of a catalog table: rows of each partition, rows and longest cells of the whole.

    Lookup joins then decide about a broadcast without a job, see `operators.joins.stated_bytes`.
    """
    partitions = [column.name for column in spark.catalog.listColumns(name) if column.isPartition]
    if partitions:
        named = ", ".join(f"`{p}`" for p in partitions)
        spark.sql(f"ANALYZE TABLE {name} PARTITION ({named}) COMPUTE STATISTICS")
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")


def partition_statistics(spark: SparkSession, name: str) -> DataFrame:
    """(partition, rows, bytes) of the analyzed partitions of a table, from the catalog alone."""
    catalog = spark._jsparkSession.sessionState().catalog()
    identifier = spark._jsparkSession.sessionState().sqlParser().parseTableIdentifier(name)
    found = catalog.listPartitions(identifier, spark._jvm.scala.Option.empty())
    rows = []
    for n in range(found.size()):
        part = found.apply(n)
        if part.stats().isDefined() and part.stats().get().rowCount().isDefined():
            stats, spec = part.stats().get(), part.spec()
            label = "/".join(f"{k}={spec.apply(k)}" for k in sorted(_keys(spec)))
            rows.append((label, int(str(stats.rowCount().get())), int(str(stats.sizeInBytes()))))
    return spark.createDataFrame(rows, "partition string, rows long, bytes long")


def _keys(scala_map) -> list[str]:
    keys = scala_map.keys().toSeq()
    return [keys.apply(n) for n in range(keys.size())]
