"""Dimensions with history (type 2), and facts that refer to them.

A version is valid in [start_date, end_date); an open version has no end date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.keys import surrogate_key
from ledgerlake.operators.changes import DELETE
from ledgerlake.operators.joins import BROADCAST_BYTES, fits_broadcast, split_join


def _differs(left: list[Column], right: list[Column]) -> Column:
    out = F.lit(False)
    for a, b in zip(left, right, strict=True):
        out = out | ~a.eqNullSafe(b)
    return out


def build_history(
    changes: DataFrame,
    attributes: Sequence[str],
    key: str = "id",
    updated_at: str = "updated_at",
    order: tuple[str, ...] = ("updated_at", "seq"),
    op: str = "op",
) -> DataFrame:
    """All versions of every key from a full change feed: (sk, key, attributes, start, end).

    The last change of a day decides that day's state. Collapsing days first is an aggregate
    with a map side; the windows after it see at most one row per key and calendar day,
    however many changes a key has.
    """
    daily = (
        changes.withColumn("start_date", F.to_date(updated_at))
        .groupBy(key, "start_date")
        .agg(F.max_by(F.struct(op, *attributes), F.struct(*order)).alias("state"))
        .select(
            key,
            "start_date",
            (F.col(f"state.{op}") == DELETE).alias("gone"),
            *[F.col(f"state.{a}").alias(a) for a in attributes],
        )
    )
    by_day = Window.partitionBy(key).orderBy("start_date")
    # A deleted key has no attributes to compare.
    state = F.struct("gone", *[F.when(~F.col("gone"), F.col(a)).alias(a) for a in attributes])
    changed = (
        daily.withColumn("state", state)
        .withColumn("before", F.lag("state").over(by_day))
        .where(~F.col("state").eqNullSafe(F.col("before")))
    )
    return (
        changed.withColumn("end_date", F.lead("start_date").over(by_day))
        .where(~F.col("gone"))
        .select(
            surrogate_key(key, "start_date").alias("sk"), key, *attributes, "start_date", "end_date"
        )
    )


def apply_to_history(
    dimension: DataFrame,
    latest: DataFrame,
    attributes: Sequence[str],
    run_date: str,
    key: str = "id",
    op: str = "op",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """The dimension after one batch with one change per key.

    Only keys whose attributes changed are closed, at `run_date`, and get a new version.
    Closed versions are passed through without a shuffle, and so are the open versions of
    untouched keys while the batch's keys are small enough to broadcast. The others meet the
    batch in one join. Applying the same batch again changes nothing. A key whose open version
    began after `run_date`, or whose last version ended after it, is left as it is: a batch that
    comes late neither destroys nor overlaps a version.
    """
    start = F.lit(run_date).cast("date")
    columns = ["sk", key, *attributes, "start_date", "end_date"]
    dimension = dimension.select(columns)
    passed = dimension.where(F.col("end_date").isNotNull())
    current = dimension.where(F.col("end_date").isNull())
    touched = latest.select(key)
    if fits_broadcast(touched, limit):
        passed = passed.unionAll(
            current.join(F.broadcast(touched), key, "left_anti").select(columns)
        )
        current = current.join(F.broadcast(touched), key, "left_semi")
    # The last ends of the batch's keys: at most one row for each of them.
    ended = dimension.where(F.col("end_date") > start).select(key).distinct()
    timely = latest.join(ended, key, "left_anti")
    met = current.select(key, F.struct(*columns).alias("now")).join(
        timely.select(key, F.struct(op, *attributes).alias("change")), key, "full_outer"
    )
    is_open = F.col("now").isNotNull()
    late = is_open & (F.col("now.start_date") > start)
    applies = F.col("change").isNotNull() & ~late
    arrives = applies & (F.col(f"change.{op}") != DELETE)
    leaves = applies & (F.col(f"change.{op}") == DELETE)
    differs = _differs(
        [F.col(f"now.{a}") for a in attributes], [F.col(f"change.{a}") for a in attributes]
    )
    closes = is_open & (leaves | (arrives & differs))
    opens = arrives & (~is_open | differs)

    def version(source: str, sk: Column, start_date: Column, end_date: Column) -> Column:
        return F.struct(
            sk.alias("sk"),
            F.col(key),
            *[F.col(f"{source}.{a}").alias(a) for a in attributes],
            start_date.alias("start_date"),
            end_date.alias("end_date"),
        )

    no_end = F.lit(None).cast("date")
    # A version that would close on the day it began was never valid.
    kept = F.when(
        is_open & ~(closes & (F.col("now.start_date") == start)),
        version("now", F.col("now.sk"), F.col("now.start_date"), F.when(closes, start)),
    )
    added = F.when(
        opens,
        version("change", F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(run_date))), start, no_end),
    )
    versions = met.select(F.explode(F.array_compact(F.array(kept, added))).alias("v")).select("v.*")
    return passed.unionAll(versions.select(columns))


def lookup_version(
    facts: DataFrame,
    dimension: DataFrame,
    fact_date: str,
    since: str,
    until: str,
    key: str = "id",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Facts of [since, until) with the `sk` of the version valid on `fact_date`, or null.

    Versions are offered once per month they cover within the period. The join is then an
    equality on (key, month) and compares a fact with at most 31 versions, not with the whole
    history of its key.
    """
    first, last = F.lit(since).cast("date"), F.date_sub(F.lit(until).cast("date"), 1)
    begins = F.greatest(F.col("start_date"), first)
    ends = F.least(F.coalesce(F.date_sub("end_date", 1), last), last)
    month = F.expr("INTERVAL 1 MONTH")
    versions = dimension.where(begins <= ends).select(
        key,
        "sk",
        F.col("start_date").alias("__start"),
        F.col("end_date").alias("__end"),
        F.explode(F.sequence(F.trunc(begins, "month"), F.trunc(ends, "month"), month)).alias("__month"),
    )
    # One row per (key, month), with the at most 31 versions that begin or last in it.
    monthly = versions.groupBy(key, "__month").agg(
        F.collect_list(F.struct("__start", "__end", "sk")).alias("__versions")
    )
    dated = facts.withColumn("__month", F.trunc(fact_date, "month"))
    if fits_broadcast(versions, limit):
        joined = dated.join(F.broadcast(monthly), [key, "__month"], "left")
    else:
        joined = split_join(dated, monthly, [key, "__month"], "left")
    day = F.col(fact_date)
    valid = F.filter(
        "__versions", lambda v: (day >= v["__start"]) & (v["__end"].isNull() | (day < v["__end"]))
    )
    return joined.select(*facts.columns, F.get(valid, F.lit(0))["sk"].alias("sk"))


def split_facts(facts: DataFrame, fact_id: str, fact_date: str) -> tuple[DataFrame, DataFrame]:
    """(facts with an id and a date, the others with their reason)."""
    reason = F.when(F.col(fact_id).isNull(), F.lit("no_id")).when(F.col(fact_date).isNull(), F.lit("no_date"))
    judged = facts.withColumn("reject_reason", reason)
    good = F.col("reject_reason").isNull()
    return judged.where(good).drop("reject_reason"), judged.where(~good)


def unique_facts(facts: DataFrame, fact_id: str) -> DataFrame:
    """One row for each id: the smallest of those that were delivered."""
    rows = facts.groupBy(fact_id).agg(F.min(F.struct(*facts.columns)).alias("fact"))
    return rows.select("fact.*")


def new_facts(
    facts: DataFrame, loaded: DataFrame, fact_id: str, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Facts that are not in the loaded table yet. Ids are unique, so no key is hot."""
    ids = loaded.select(fact_id)
    ids = F.broadcast(ids) if fits_broadcast(ids, limit) else ids.hint("merge")
    return facts.join(ids, fact_id, "left_anti").select(facts.columns)


def load_facts(
    facts: DataFrame,
    loaded: DataFrame,
    dimension: DataFrame,
    fact_id: str,
    fact_date: str,
    since: str,
    until: str,
    key: str = "id",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """The rows to append to the fact table for [since, until): each fact with an id once.

    Facts without an id or a date are in no period; see `split_facts`.
    """
    period = (F.col(fact_date) >= F.lit(since).cast("date")) & (
        F.col(fact_date) < F.lit(until).cast("date")
    )
    known = facts.where(period & F.col(fact_id).isNotNull())
    fresh = new_facts(unique_facts(known, fact_id), loaded.where(period), fact_id, limit)
    return lookup_version(fresh, dimension, fact_date, since, until, key, limit)
