"""Expressions that make keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*columns: str) -> Column:
    """A key that is the same whenever it is computed again from the same columns."""
    return F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in columns]))


def row_hash(columns: list[str]) -> Column:
    """A non-negative number that spreads rows, including copies of one row.

    The partition number separates copies that were read by different tasks. The value does
    not depend on the order of rows within a partition, so a rerun task computes it again.
    """
    return F.xxhash64(F.spark_partition_id(), *columns).bitwiseAND(F.lit((1 << 62) - 1))
