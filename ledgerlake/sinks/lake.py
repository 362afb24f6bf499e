"""Writers of date-partitioned Parquet layers. Reruns replace the dates they write, no others."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.keys import row_hash
from ledgerlake.operators.joins import lookup_join
from ledgerlake.schemas import INGESTION_DATE
from ledgerlake.sources.buckets import filesystem, listed_within
from ledgerlake.sources.lake import find, period_folders, read_day, read_days

FILE_BYTES = 128 * 1024 * 1024
# Files that one job of a compaction writes.
MOST_REDUCERS = 10_000


def write_day(
    df: DataFrame,
    root: str,
    run_date: str,
    partition: str = INGESTION_DATE,
    files: int | None = None,
    within: tuple[str, ...] = (),
    file_rows: int | None = None,
) -> str:
    """Replace one day of a layer, also when `df` is empty. Returns the day's path.

    Writing into the day's folder needs no sort by partition and leaves no rows of an
    earlier run, in none of the folders `within` the day. Without `files` the rows are
    written where they are, one file per task; a number costs a round-robin shuffle. With
    `file_rows` no file has more rows than that; a task goes on in another, which costs none.
    """
    leaf = f"{root}/{partition}={run_date}"
    laid_out = df.drop(partition) if files is None else df.drop(partition).repartition(files)
    writer = laid_out.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if file_rows is not None:
        writer = writer.option("maxRecordsPerFile", file_rows)
    (writer.partitionBy(*within) if within else writer).parquet(leaf)
    return leaf


def write_output(df: DataFrame, root: str, partition: str = INGESTION_DATE) -> None:
    """Write an aggregate, one file per date unless a date is large.

    The rebalance keeps small dates whole and lets adaptive execution cut a large one, so
    neither one task nor one file has to take everything.
    """
    write_dates(df.hint("rebalance", F.col(partition)), root, partition)


def write_dates(df: DataFrame, root: str, *partitions: str, compression: str = "snappy") -> None:
    """Replace the partitions that `df` has rows for; all others stay.

    The mode is an option of this write, so no session setting can turn it into an overwrite
    of the whole layer.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .partitionBy(*(partitions or (INGESTION_DATE,)))
        .parquet(root)
    )


def replace_dates(
    df: DataFrame, root: str, since: str, until: str, partition: str = INGESTION_DATE
) -> None:
    """Replace all dates of [since, until), also those that `df` has no rows for any more.

    A dynamic overwrite leaves a date alone when it gets no rows. Such a date still has the
    files it had before; its folder is then overwritten with no rows.
    """
    spark = df.sparkSession
    listed_before = find(spark, root, lambda: stored_files(spark, root))
    write_output(df, root, partition)
    if listed_before is None or partition not in listed_before.columns:
        return
    # The list was made before the write: what is still found was not replaced.
    day = F.col(partition)
    stale = listed_before.where((day >= since) & (day < until))
    for row in stale.select(day.cast("string").alias("day")).distinct().collect():  # days of the period
        write_day(df.limit(0), root, row["day"], partition)


def replace_period(
    df: DataFrame, root: str, since: str, until: str, partition: str = INGESTION_DATE
) -> list[str]:
    """`replace_dates` that lists the folders of the period only and runs one job.

    The write gives a date with rows new files; dates of the period that still have the same files
    lost all their rows, and their folders are deleted. Returns these days.
    """
    spark = df.sparkSession
    layout = tuple(f"{partition}={part}" for part in ("%Y-%m-%d", "%Y-%m-*", "%Y-*"))
    pattern = f"{period_folders(root, since, until, layout)}/*.parquet"

    def stored() -> dict[str, set[str]]:
        found: dict[str, set[str]] = {}
        for folder, name in listed_within(spark, pattern):
            day = folder.removeprefix(f"{partition}=")
            if since <= day < until:
                found.setdefault(day, set()).add(name)
        return found

    before = stored()
    write_output(df, root, partition)
    after = stored()
    stale = sorted(day for day, names in before.items() if after.get(day) == names)
    for day in stale:
        files, path = filesystem(spark, f"{root}/{partition}={day}")
        files.delete(path, True)
    return stale


def cluster_by_date(df: DataFrame, *partitions: str) -> DataFrame:
    """Bring the rows of a date together before `write_dates`.

    Without it every task writes a file for every date it meets. A date with most of the rows
    is cut into several tasks by adaptive execution.
    """
    return df.hint("rebalance", *[F.col(p) for p in partitions or (INGESTION_DATE,)])


def partitions_for(total_bytes: int, target_bytes: int = FILE_BYTES) -> int:
    """How many partitions of `target_bytes` hold `total_bytes`."""
    return max(1, math.ceil(total_bytes / target_bytes))


def stored_files(
    spark: SparkSession, root: str, names: str = "*.parquet", base: str | None = None
) -> DataFrame:
    """(path, length, partition columns) of the files below `root`, which are listed, not read.

    `root` may be a glob of folders below `base`.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", names).option("ignoreMissingFiles", True)
    if base is not None:
        files = files.option("basePath", base)
    return files.load(root).drop("content", "modificationTime")


def stored_bytes(spark: SparkSession, root: str, names: str = "*.parquet") -> int:
    total = F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
    return stored_files(spark, root, names).agg(total).first()["bytes"]


def write_fx(rates: DataFrame, root: str) -> None:
    """Replace the days of `rates` in the `year=/month=/day=` layout.

    A day is one small file, so it is their number that takes time: they are dealt out by day over
    the shuffle partitions, and not brought together by size.
    """
    day = F.col("run_date").cast("date")
    dated = rates.select(
        "base_currency",
        "target_currency",
        "rate_to_sgd",
        F.date_format(day, "yyyy").alias("year"),
        F.date_format(day, "MM").alias("month"),
        F.date_format(day, "dd").alias("day"),
    )
    layout = ("year", "month", "day")
    partitions = int(rates.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    write_dates(dated.repartition(partitions, *layout), root, *layout)


def compact_day(
    spark: SparkSession,
    source: str,
    destination: str,
    run_date: str,
    partition: str = INGESTION_DATE,
    target_bytes: int = FILE_BYTES,
) -> str:
    """Rewrite one day to a new place with files of about `target_bytes`, without a shuffle.

    Each task reads as many of the small files as one large file holds.
    """
    stored = stored_bytes(spark, f"{source}/{partition}={run_date}")
    day = read_day(spark, source, run_date, partition)
    return write_day(
        day.coalesce(partitions_for(stored, target_bytes)), destination, run_date, partition
    )


def compact(
    spark: SparkSession,
    source: str,
    destination: str,
    since: str,
    until: str,
    partition: str = INGESTION_DATE,
    target_bytes: int = FILE_BYTES,
) -> None:
    """Rewrite the days [since, until) to a new place with files of about `target_bytes`.

    Only folders of the period are listed. The stored bytes of each date give its number of files;
    the rows of a date are spread over that many shuffle keys, so one large date is not rewritten
    by one task. A long period is done in slices of days with at most `MOST_REDUCERS` files
    together, so that the shuffle of a slice does not grow with the period; use `compact_day` where
    a single day has more.
    """
    day = F.col(partition)
    layout = tuple(f"{partition}={part}" for part in ("%Y-%m-%d", "%Y-%m-*", "%Y-*"))
    folders = period_folders(source, since, until, layout)
    stored = find(spark, folders, lambda: stored_files(spark, folders, base=source))
    if stored is None:
        return
    sizes = (
        stored.where((day >= since) & (day < until))
        .groupBy(day.cast("string").alias(partition))
        .agg(F.sum("length").alias("bytes"))
        .select(partition, F.ceil(F.col("bytes") / target_bytes).cast("int").alias("__files"))
    )
    first, total = None, 0
    for row in [*sizes.orderBy(partition).collect(), None]:  # one row for each day of the period
        if total and (row is None or total + row["__files"] > MOST_REDUCERS):
            end = until if row is None else row[partition]
            _compact_slice(spark, source, destination, first, end, partition, sizes, total)
            first, total = None, 0
        if row is not None:
            first, total = first or row[partition], total + row["__files"]


def _compact_slice(
    spark: SparkSession,
    source: str,
    destination: str,
    since: str,
    until: str,
    partition: str,
    sizes: DataFrame,
    files: int,
) -> None:
    layer = read_days(spark, source, since, until, partition)
    spread = (
        lookup_join(layer.withColumn("__file", row_hash(layer.columns)), sizes, [partition])
        .withColumn("__file", F.pmod("__file", "__files").cast("int"))
        .drop("__files")
        .repartition(files, partition, "__file")
        .drop("__file")
    )
    write_dates(spread.select(layer.columns), destination, partition)
