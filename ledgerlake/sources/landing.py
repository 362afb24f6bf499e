"""Readers of landed files: transaction CSV, rate snapshots, change feeds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.project import conform
from ledgerlake.schemas import FX_RATES, FX_SNAPSHOT, RATE, TRANSACTIONS

CORRUPT = "_corrupt_record"


def read_csv(
    spark: SparkSession, path: str | tuple[str, ...], schema: T.StructType = TRANSACTIONS
) -> DataFrame:
    """Typed rows of the CSV files at `path` (a folder, a glob or several files), with the raw line of
    bad ones.

    A line with unparsable cells or a wrong number of cells keeps its text in
    `_corrupt_record`; all other lines have null there. Column pruning is off in the parser, and
    `split_corrupt` refers to all columns, because a pruned read would not see that a line is bad.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(with_corrupt)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("columnPruning", False)
        .csv(list(path) if isinstance(path, tuple) else path)
    )


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(well-formed rows, the others with their raw text and the cells that did parse).

    The parser only sees that a line is bad if it converts the bad cell, so the condition refers to
    every column, whichever of them the caller selects afterwards.
    """
    cells = [F.col(c).cast("string") for c in df.columns if c != CORRUPT]
    never = F.length(F.concat_ws("", *cells)) < 0
    bad = F.col(CORRUPT).isNotNull() | never
    return df.where(~bad).drop(CORRUPT), df.where(bad)


def split_fx_snapshot(
    spark: SparkSession, path: str, run_date: str | None = None, multi_line: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Landed replies of the rates service: rows of the rates table, and the rates that are none.

    The date is the one that was asked for, or else the UTC day of the reply's timestamp. A rate is
    none if it is null, no number, not above zero, or beyond the type's range; it keeps its text as
    `rate_text`.
    """
    replies = spark.read.schema(FX_SNAPSHOT).option("multiLine", multi_line).json(path)
    epoch_day = F.floor(F.col("timestamp") / 86400).cast("int")
    replied = F.date_add(F.lit("1970-01-01").cast("date"), epoch_day).cast("string")
    replies = replies.withColumn("run_date", replied if run_date is None else F.lit(run_date))
    rates = replies.select(
        "run_date",
        F.col("base").alias("base_currency"),
        F.explode("rates").alias("target_currency", "rate_text"),
    ).withColumn("rate_to_sgd", F.trim("rate_text").try_cast(RATE))
    good = F.coalesce(F.col("rate_to_sgd") > 0, F.lit(False))
    rejected = ["run_date", "base_currency", "target_currency", "rate_text"]
    return rates.where(good).select(FX_RATES.names), rates.where(~good).select(rejected)


def read_fx_snapshot(
    spark: SparkSession, path: str, run_date: str | None = None, multi_line: bool = True
) -> DataFrame:
    """The good rows of `split_fx_snapshot`."""
    return split_fx_snapshot(spark, path, run_date, multi_line)[0]


def read_change_feed(
    spark: SparkSession, versions: Mapping[str, T.StructType], target: T.StructType
) -> DataFrame:
    """The good rows of `split_change_feed`."""
    return split_change_feed(spark, versions, target)[0]


def split_change_feed(
    spark: SparkSession, versions: Mapping[str | tuple[str, ...], T.StructType], target: T.StructType
) -> tuple[DataFrame, DataFrame]:
    """Change files of several schema versions: rows under one target schema, and lines with cells
    that do not parse, with the cells that do and their raw text (see `read_csv`).

    `versions` maps a folder or glob to the schema of the files in it. Spark packs small
    files into splits, so the task count follows the bytes and not the files.
    """
    with_line = T.StructType([*target.fields, T.StructField(CORRUPT, T.StringType())])
    feed = rejects = None
    for path, schema in versions.items():
        good, bad = split_corrupt(read_csv(spark, path, schema))
        good, bad = conform(good, target), conform(bad, with_line)
        feed = good if feed is None else feed.unionAll(good)
        rejects = bad if rejects is None else rejects.unionAll(bad)
    return feed, rejects


def files_by_header(
    spark: SparkSession, path: str, known: Sequence[T.StructType]
) -> tuple[dict[tuple[str, ...], T.StructType], tuple[str, ...]]:
    """(files of each known schema, files with another header or none).

    One pass over the lines finds the headers, whichever order and number the files have; the driver
    gets one name per file.
    """
    headers = {",".join(schema.names): schema for schema in known}
    uri = F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B")
    lines = spark.read.text(path).select(F.url_decode(uri).alias("file"), F.trim("value").alias("header"))
    first = lines.where(F.col("header").isin(list(headers))).distinct()
    every = lines.select("file").distinct()
    found: dict[str, list[str]] = {}
    for row in every.join(first, "file", "left").collect():
        found.setdefault(row["header"], []).append(row["file"])
    unknown = tuple(sorted(found.pop(None, [])))
    return {tuple(sorted(files)): headers[header] for header, files in found.items()}, unknown


def split_change_files(
    spark: SparkSession, path: str, known: Sequence[T.StructType], target: T.StructType
) -> tuple[DataFrame, DataFrame]:
    """`split_change_feed` of files that tell their schema version by their header.

    All lines of a file with another header are rejected with their raw text.
    """
    versions, unknown = files_by_header(spark, path, known)
    with_line = T.StructType([*target.fields, T.StructField(CORRUPT, T.StringType())])
    rejected = spark.createDataFrame([], with_line)
    if unknown:
        lines = spark.read.text(list(unknown)).withColumnRenamed("value", CORRUPT)
        rejected = conform(lines, with_line)
    if not versions:
        return spark.createDataFrame([], target), rejected
    feed, bad = split_change_feed(spark, versions, target)
    return feed, bad.unionAll(rejected)
