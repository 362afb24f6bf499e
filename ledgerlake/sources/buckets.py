"""Readers of bucketed tables, whose current files a published version names.

A row belongs to the bucket of its key's hash. A table's folder has one folder for each run that wrote
to it, and below it one for each bucket that the run rewrote. A published version is one small
file that says, for each table, in which run's folder each bucket is, so readers see either
everything that a job has written or nothing.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET, RUN = "bucket", "run"


@dataclass
class Published:
    """A version of some tables: for each the run that has a bucket's rows; buckets without rows are
    not named."""

    version: str
    buckets: int
    tables: dict[str, dict[str, str]] = field(default_factory=dict)
    counters: dict[str, int] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)


def filesystem(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def listed(spark: SparkSession, pattern: str) -> list[str]:
    """Names of the paths that fit a glob."""
    files, path = filesystem(spark, pattern)
    return sorted(status.getPath().getName() for status in files.globStatus(path) or [])


def listed_within(spark: SparkSession, pattern: str) -> list[tuple[str, str]]:
    """(folder, name) of the paths that fit a glob."""
    files, path = filesystem(spark, pattern)
    found = [status.getPath() for status in files.globStatus(path) or []]
    return sorted((own.getParent().getName(), own.getName()) for own in found)


def published_files(spark: SparkSession, root: str) -> list[tuple[str, str]]:
    """(version, file) of all published versions, the last publication of a version last."""
    names = listed(spark, f"{root}/*.json")
    return sorted((name.rsplit("~", 1)[0], name) for name in names)


def read_publication(spark: SparkSession, path: str) -> Published:
    return Published(**json.loads(spark.read.text(path, wholetext=True).first()[0]))


def read_published(spark: SparkSession, root: str, version: str | None = None) -> Published | None:
    """The newest published version, or the newest that is not after `version`; None without any."""
    found = [name for own, name in published_files(spark, root) if version is None or own <= version]
    if not found:
        return None
    return read_publication(spark, f"{root}/{found[-1]}")


def bucket_of(key: str | Column, buckets: int) -> Column:
    own = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.xxhash64(own.cast("string")), F.lit(buckets)).cast("int")


def read_buckets(
    spark: SparkSession,
    root: str,
    parts: dict[str, str],
    schema: T.StructType,
    only: list[int] | None = None,
) -> DataFrame:
    """The rows of a table's buckets, or of some of them; no other folder is listed or read."""
    chosen = {b: run for b, run in parts.items() if only is None or int(b) in set(only)}
    if not chosen:
        return spark.createDataFrame([], schema)
    folders = [f"{root}/{RUN}={run}/{BUCKET}={b}" for b, run in sorted(chosen.items())]
    rows = spark.read.schema(schema).option("basePath", root).parquet(*folders)
    return rows.select(schema.names)
