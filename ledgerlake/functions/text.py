"""Expressions on text cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trimmed(column: str | Column, blank_as_null: bool = False) -> Column:
    cell = F.trim(F.col(column) if isinstance(column, str) else column)
    return F.nullif(cell, F.lit("")) if blank_as_null else cell


def hashed(column: str, salt: str | None = None) -> Column:
    """SHA-256 in hex. A null stays null, with or without salt."""
    cell = F.col(column)
    return F.sha2(cell if salt is None else F.concat(F.lit(salt), cell), 256)
