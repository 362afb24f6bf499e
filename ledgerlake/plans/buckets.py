"""Latest state and history by key bucket: a batch rewrites the buckets it touches and no others.

Both tables are written, checked, and then published together with the batch's counters as one
version. A job that fails in between leaves readers on the version before. History is by the day of
the change, not of its delivery, so late changes land where they belong (see
`operators/timeline.py`), whichever order the deliveries come in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.changes import DELETE, latest_changes
from ledgerlake.operators.timeline import as_dimension, broken_rows, day_states, splice
from ledgerlake.plans.layout import WarehousePaths
from ledgerlake.plans.warehouse import BATCH, Feed, read_curated
from ledgerlake.sinks.buckets import (
    counted,
    new_run,
    publish,
    remove_old,
    replaced_parts,
    require,
    touched_buckets,
    write_buckets,
)
from ledgerlake.sinks.lake import write_day
from ledgerlake.sources.buckets import Published, published_files, read_buckets, read_published
from ledgerlake.sources.lake import read_day

STATE, TIMELINE = "state", "timeline"
BUCKETS = 256


def timeline_schema(feed: Feed) -> T.StructType:
    types = {field.name: field for field in feed.schema.fields}
    mark = T.StructType([types[name] for name in feed.order])
    marks = T.ArrayType(T.StructType([T.StructField("day", T.DateType()), T.StructField("mark", mark)]))
    return T.StructType(
        [
            types[feed.key],
            T.StructField("gone", T.BooleanType()),
            *(types[name] for name in feed.tracked),
            T.StructField("start_date", T.DateType()),
            T.StructField("end_date", T.DateType()),
            T.StructField("marks", marks),
        ]
    )


def folders(paths: WarehousePaths) -> dict[str, str]:
    return {STATE: paths.state_buckets, TIMELINE: paths.timeline_buckets}


def run_bucketed_batch(
    spark: SparkSession,
    feed: Feed,
    paths: WarehousePaths,
    delivery: str,
    version: str | None = None,
    buckets: int = BUCKETS,
) -> Published:
    """One curated delivery into latest state and timeline, published as `version`.

    It starts from the newest version before that one, or from nothing; `buckets` counts for the
    first version only. What the delivery has of each key, and of each key and day, is staged
    once. Versions sort by name, default to the delivery's name, and have to rise: a delivery that
    is older than the newest version needs a version of its own.
    """
    version = version or delivery
    newer = [own for own, _ in published_files(spark, paths.published) if own > version]
    if newer:
        raise ValueError(f"{newer[-1]} is published already and would lack {version}; name a later version")
    before = _before(spark, paths, version) or Published(version, buckets, {STATE: {}, TIMELINE: {}})
    changes = read_curated(spark, feed, paths, delivery)
    write_day(latest_changes(changes, feed.key, feed.order), paths.staging, version, BATCH)
    latest = read_day(spark, paths.staging, version, BATCH, feed.schema).select(feed.schema.names)
    write_day(
        day_states(changes, feed.tracked, feed.key, feed.updated_at, feed.order, feed.op),
        paths.staged_days, version, BATCH,
    )
    days = read_day(spark, paths.staged_days, version, BATCH).drop(BATCH)

    touched = touched_buckets(latest, feed.key, before.buckets)
    run = new_run(version)
    known = read_buckets(spark, paths.state_buckets, before.tables[STATE], feed.schema, touched)
    state = latest_changes(known.unionAll(latest), feed.key, feed.order).select(feed.schema.names)
    write_buckets(state, paths.state_buckets, run, feed.key, before.buckets)
    schema = timeline_schema(feed)
    rows = read_buckets(spark, paths.timeline_buckets, before.tables[TIMELINE], schema, touched)
    spliced = splice(rows, days, feed.tracked, feed.key)
    write_buckets(spliced, paths.timeline_buckets, run, feed.key, before.buckets)

    found = Published(version, before.buckets)
    for name, folder in folders(paths).items():
        found.tables[name] = replaced_parts(spark, folder, run, touched, before.tables[name])
    found.counters = _audit(spark, feed, paths, found, latest, days, touched)
    publish(spark, paths.published, found)
    return found


def _before(spark: SparkSession, paths: WarehousePaths, version: str) -> Published | None:
    """The newest version before `version`, which a rerun of it starts from, too."""
    earlier = [own for own, _ in published_files(spark, paths.published) if own < version]
    return read_published(spark, paths.published, earlier[-1]) if earlier else None


def _audit(
    spark: SparkSession, feed: Feed, paths: WarehousePaths, found: Published, latest: DataFrame, days: DataFrame, touched: list[int]
) -> dict[str, int]:
    """Counters of what was written, or an error. Only the touched buckets are read."""
    state = read_buckets(spark, paths.state_buckets, found.tables[STATE], feed.schema, touched)
    rows = read_buckets(spark, paths.timeline_buckets, found.tables[TIMELINE], timeline_schema(feed), touched)
    order = F.struct(*feed.order)
    there = state.select(feed.key, order.alias("there"))
    missing = latest.join(there, feed.key, "left").where(F.col("there").isNull() | (F.col("there") < order))
    last = rows.where("end_date IS NULL").select(feed.key, F.col("gone").alias("closed"))
    ends = state.select(feed.key, (F.col(feed.op) == DELETE).alias("deleted")).join(last, feed.key, "full_outer")
    require(
        {
            "keys that are in the state twice": state.groupBy(feed.key).count().where("count > 1"),
            "changes that are not in the state": missing,
            "broken timelines": broken_rows(rows, feed.key),
            "state and timeline differ": ends.where(~F.col("deleted").eqNullSafe(F.col("closed"))),
        }
    )
    return {
        "touched_buckets": len(touched),
        "changed_keys": counted(latest),
        "changed_days": counted(days),
        "state_rows": counted(state),
        "timeline_rows": counted(rows),
    }


def read_bucketed_state(spark: SparkSession, feed: Feed, paths: WarehousePaths, version: str | None = None) -> DataFrame:
    """The latest state as of a published version, the newest by default."""
    found = _published(spark, paths, version)
    rows = read_buckets(spark, paths.state_buckets, found.tables[STATE], feed.schema)
    return rows.where(F.col(feed.op) != DELETE).select(feed.state_columns)


def read_bucketed_dimension(spark: SparkSession, feed: Feed, paths: WarehousePaths, version: str | None = None) -> DataFrame:
    """All versions of all keys as of a published version, the newest by default."""
    found = _published(spark, paths, version)
    rows = read_buckets(spark, paths.timeline_buckets, found.tables[TIMELINE], timeline_schema(feed))
    return as_dimension(rows, feed.tracked, feed.key)


def _published(spark: SparkSession, paths: WarehousePaths, version: str | None) -> Published:
    found = read_published(spark, paths.published, version)
    if found is None:
        raise ValueError(f"nothing is published in {paths.published}")
    return found


def run_cleanup(spark: SparkSession, paths: WarehousePaths, keep: int) -> list[str]:
    """Remove all but the last `keep` published versions."""
    return remove_old(spark, paths.published, folders(paths), keep)
