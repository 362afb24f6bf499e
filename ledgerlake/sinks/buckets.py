"""Writers of bucketed tables: copy on write of the buckets that a batch touches, audit, publication."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.sinks.lake import cluster_by_date
from ledgerlake.sources.buckets import (
    BUCKET,
    RUN,
    Published,
    bucket_of,
    filesystem,
    listed,
    published_files,
    read_publication,
)


class AuditError(ValueError):
    """What was written is not right; nothing was published."""


def new_run(version: str) -> str:
    """A folder name for one attempt, so that a rerun does not write where readers read."""
    return f"{version}~{uuid.uuid4().hex[:12]}"


def touched_buckets(rows: DataFrame, key: str, buckets: int) -> list[int]:
    """The buckets that have keys of `rows`: at most `buckets` numbers."""
    return sorted(r[0] for r in rows.select(bucket_of(key, buckets)).distinct().collect())


def write_buckets(rows: DataFrame, root: str, run: str, key: str, buckets: int) -> None:
    """All rows of the touched buckets as files of a new run. A bucket with most of the rows is cut
    into several files by adaptive execution."""
    placed = rows.withColumn(BUCKET, bucket_of(key, buckets))
    cluster_by_date(placed, BUCKET).write.partitionBy(BUCKET).parquet(f"{root}/{RUN}={run}")


def replaced_parts(
    spark: SparkSession, root: str, run: str, touched: list[int], before: dict[str, str]
) -> dict[str, str]:
    """Where each bucket is after a run: the touched ones in its folder, if they have rows left."""
    written = {name.split("=")[1] for name in listed(spark, f"{root}/{RUN}={run}/{BUCKET}=*")}
    kept = {b: r for b, r in before.items() if int(b) not in set(touched)}
    return kept | {b: run for b in written}


def publish(spark: SparkSession, root: str, found: Published) -> None:
    """Make a version visible, as one new file. A version that is published again counts from then
    on; its earlier files stay until they are removed. One writer at a time."""
    again = sum(version == found.version for version, _ in published_files(spark, root))
    files, path = filesystem(spark, f"{root}/{found.version}~{again:06d}.json")
    _, hidden = filesystem(spark, f"{root}/.{uuid.uuid4().hex}")
    out = files.create(hidden)
    try:
        out.write(bytearray(found.to_json().encode()))
    finally:
        out.close()
    if not files.rename(hidden, path):
        raise OSError(f"cannot publish {path}")


def remove_old(spark: SparkSession, root: str, tables: dict[str, str], keep: int) -> list[str]:
    """Remove all but the last `keep` publications, and the buckets that only those needed; returns
    the removed folders.

    `tables` maps the names in a publication to the tables' folders. Buckets of runs that never
    were published go too, so no other job may be writing.
    """
    if keep < 1:
        raise ValueError("at least one version has to stay")
    names = [name for _, name in published_files(spark, root)]
    needed = {name: set() for name in tables}
    for file in names[-keep:]:
        found = read_publication(spark, f"{root}/{file}")
        for name in tables:
            needed[name] |= {f"{RUN}={run}/{BUCKET}={b}" for b, run in found.tables.get(name, {}).items()}
    removed = []
    for file in names[:-keep]:
        files, path = filesystem(spark, f"{root}/{file}")
        files.delete(path, False)
    for name, folder in tables.items():
        for run in listed(spark, f"{folder}/{RUN}=*"):
            buckets = [f"{run}/{b}" for b in listed(spark, f"{folder}/{run}/{BUCKET}=*")]
            stale = [b for b in buckets if b not in needed[name]]
            # A run that nothing needs goes as a whole.
            for own in [run] if len(stale) == len(buckets) else stale:
                files, path = filesystem(spark, f"{folder}/{own}")
                files.delete(path, True)
                removed.append(f"{folder}/{own}")
    return removed


def require(checks: dict[str, DataFrame]) -> None:
    """An error that names the first check that finds rows."""
    for name, rows in checks.items():
        found = rows.limit(3).collect()
        if found:
            raise AuditError(f"{name}: {found}")


def counted(rows: DataFrame) -> int:
    return rows.agg(F.count(F.lit(1))).first()[0]
