"""Change feeds: the last change per key and its merge into the latest-state table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.joins import BROADCAST_BYTES, fits_broadcast

DELETE = "D"
OPERATIONS = ("I", "U", DELETE)
REASON = "reject_reason"


def split_changes(
    changes: DataFrame, key: str = "id", op: str = "op", updated_at: str = "updated_at"
) -> tuple[DataFrame, DataFrame]:
    """(changes that can be applied, the others with their reason)."""
    known = F.coalesce(F.col(op).isin(*OPERATIONS), F.lit(False))
    reason = (
        F.when(F.col(key).isNull(), F.lit("no_key"))
        .when(~known, F.lit("unknown_operation"))
        .when(F.col(updated_at).isNull(), F.lit("no_time"))
    )
    judged = changes.withColumn(REASON, reason)
    return judged.where(F.col(REASON).isNull()).drop(REASON), judged.where(F.col(REASON).isNotNull())


def latest_changes(
    changes: DataFrame, key: str = "id", order: tuple[str, ...] = ("updated_at", "seq")
) -> DataFrame:
    """The row with the greatest `order` per key; later columns of `order` break ties.

    An aggregate rather than a ranked window: each map task keeps one row per key, so a key
    with most of the changes does not meet in one task.
    """
    newest = F.max_by(F.struct(*changes.columns), F.struct(*order)).alias("row")
    return changes.groupBy(key).agg(newest).select("row.*")


def merge_changes(
    target: DataFrame,
    latest: DataFrame,
    key: str = "id",
    op: str = "op",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """The latest-state table after one batch: insert, update, or delete by `op`.

    `target` and `latest` hold one row per key. A small batch leaves the target's rows where
    they are; otherwise both sides are shuffled once.
    """
    touched = latest.select(key)
    if fits_broadcast(touched, limit):
        # A join by column name puts the key first.
        untouched = target.join(F.broadcast(touched), key, "left_anti").select(target.columns)
        applied = latest.where(F.col(op) != DELETE).select(target.columns)
        return untouched.unionAll(applied)
    batch = latest.select(key, F.struct(*latest.columns).alias("change"))
    merged = target.select(key, F.struct(*target.columns).alias("kept")).join(batch, key, "full_outer")
    unchanged = F.col("change").isNull()
    applied = F.struct(*[F.col(f"change.{c}").alias(c) for c in target.columns])
    return (
        merged.where(unchanged | (F.col(f"change.{op}") != DELETE))
        .select(F.when(unchanged, F.col("kept")).otherwise(applied).alias("row"))
        .select("row.*")
    )


def merge_in_order(
    state: DataFrame,
    latest: DataFrame,
    key: str = "id",
    order: tuple[str, ...] = ("updated_at", "seq"),
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """The last change of each key after one batch, in whichever order batches arrive.

    `state` and `latest` hold one change per key, deletions included: a deleted key keeps its last
    change as a tombstone, so that an older change does not bring it back. A batch applied again
    changes nothing. A small batch leaves the state of other keys where it is.
    """
    latest = latest.select(state.columns)
    touched = latest.select(key)
    if not fits_broadcast(touched, limit):
        return latest_changes(state.unionAll(latest), key, order).select(state.columns)
    untouched = state.join(F.broadcast(touched), key, "left_anti").select(state.columns)
    met = state.join(F.broadcast(touched), key, "left_semi").select(state.columns)
    return untouched.unionAll(latest_changes(met.unionAll(latest), key, order).select(state.columns))
