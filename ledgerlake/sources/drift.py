"""Reads of layers whose files do not agree on types: grouped by what the footers say."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.project import conform, trim_strings
from ledgerlake.operators.validate import REJECT_REASON
from ledgerlake.sources.buckets import listed

# What Spark says of footers that cannot be one schema, on the driver and from a task.
_CONFLICTS = ("CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE", "CANNOT_MERGE_DECIMAL_TYPES_WITH_INCOMPATIBLE_SCALE")


def _merged(spark: SparkSession, paths: list[str]) -> T.StructType | None:
    """The columns of all files below `paths`, or None if some column has two types. The footers are
    read by tasks."""
    try:
        read = spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(*paths)
    except (PySparkException, Py4JJavaError) as error:
        if any(name in str(error) for name in _CONFLICTS):
            return None
        raise
    return read.schema


def _types(schema: T.StructType) -> dict[str, T.DataType]:
    return {field.name: field.dataType for field in schema.fields}


def physical_groups(spark: SparkSession, paths: list[str]) -> list[tuple[T.StructType, list[str]]]:
    """`paths` (folders or files) in groups that agree on the type of each column they share.

    A list that agrees takes one job over its footers. One that does not is halved, so that a change
    of types on some day costs about twice the logarithm of the number of folders in jobs. A
    folder that does not agree with itself is taken file by file.
    """
    schema = _merged(spark, paths)
    if schema is not None:
        return [(schema, paths)]
    if len(paths) > 1:
        half = len(paths) // 2
        groups = physical_groups(spark, paths[:half]) + physical_groups(spark, paths[half:])
    else:
        files = [f"{paths[0]}/{name}" for name in listed(spark, f"{paths[0]}/*.parquet")]
        if len(files) < 2:
            raise ValueError(f"the columns of {paths[0]} cannot be read as one schema")
        groups = physical_groups(spark, files)
    joined: list[tuple[T.StructType, list[str]]] = []
    for schema, own in groups:
        for n, (known, others) in enumerate(joined):
            types = _types(known)
            if all(types.get(f.name, f.dataType) == f.dataType for f in schema.fields):
                new = [f for f in schema.fields if f.name not in types]
                joined[n] = (T.StructType([*known.fields, *new]), others + own)
                break
        else:
            joined.append((schema, own))
    return joined


def inexact(column: str, source: T.DataType, target: T.DataType) -> Column:
    """Whether a cell is lost or changed as the target's type.

    Text has to parse; blank text is no value. Numbers, times and dates have to come back as they
    were, so that a fraction, a digit or an hour is not dropped silently.
    """
    cell = F.col(column)
    if source == target:
        return F.lit(False)
    taken = cell.try_cast(target)
    if isinstance(source, T.StringType):
        return cell.isNotNull() & (F.trim(cell) != "") & taken.isNull()
    return cell.isNotNull() & ~taken.try_cast(source).eqNullSafe(cell)


def split_drifted(rows: DataFrame, target: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows under the target schema, rows with a cell that is not exact there, as text, with the
    first such column as `unparsed_<name>`)."""
    types = _types(rows.schema)
    rows = trim_strings(rows)
    lost = [
        F.when(inexact(f.name, types[f.name], f.dataType), F.lit(f"unparsed_{f.name}"))
        for f in target.fields
        if f.name in types
    ]
    judged = rows.withColumn(REJECT_REASON, F.coalesce(*lost, F.lit(None).cast("string")))
    good = conform(judged.where(F.col(REJECT_REASON).isNull()), target)
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in target.fields] + [T.StructField(REJECT_REASON, T.StringType())])
    return good, conform(judged.where(F.col(REJECT_REASON).isNotNull()), text)


def read_drifted(
    spark: SparkSession,
    root: str,
    target: T.StructType,
    partition: str,
    since: str | None = None,
    until: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The folders `partition=...` of a layer under one schema, whichever types their files have, and
    the rows that do not fit it; see `split_drifted`. Both have the partition's value as text.

    Files of one physical schema are one scan. With `since` and `until`, only the folders whose name
    is in [since, until) are touched. Columns that files lack are null, others are not read.
    """
    prefix = f"{partition}="
    names = [name.removeprefix(prefix) for name in listed(spark, f"{root}/{prefix}*")]
    chosen = [n for n in names if (since is None or n >= since) and (until is None or n < until)]
    paths = [f"{root}/{prefix}{n}" for n in chosen if listed(spark, f"{root}/{prefix}{n}/*.parquet")]
    dated = T.StructType([f for f in target.fields if f.name != partition] + [T.StructField(partition, T.StringType())])
    good, rejected = split_drifted(spark.createDataFrame([], dated), dated)
    for schema, own in physical_groups(spark, paths) if paths else []:
        wanted = T.StructType([f for f in schema.fields if f.name in dated.names and f.name != partition])
        rows = spark.read.schema(wanted).parquet(*own)
        value = F.regexp_extract(F.col("_metadata.file_path"), rf"/{partition}=([^/]*)/", 1)
        fits, other = split_drifted(rows.withColumn(partition, F.url_decode(value)), dated)
        good, rejected = good.unionAll(fits), rejected.unionAll(other)
    return good, rejected
