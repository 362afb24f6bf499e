"""Days that come as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Days that a transaction can be of. Beyond them are sentinels and slips of the pen.
EARLIEST, LATEST = "1900-01-01", "2199-12-31"
_DAY = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"


def parsed_day(column: str) -> Column:
    """The day that a text names as year-month-day, padded or not; null for all other text."""
    text = F.trim(F.col(column).cast("string"))
    return F.when(text.rlike(_DAY), text.try_cast("date"))


def _possible(day: Column) -> Column:
    return day.between(F.lit(EARLIEST).cast("date"), F.lit(LATEST).cast("date"))


def known_day(column: str, parsed: Column | None = None) -> Column:
    """`parsed_day` within the days that a transaction can be of.

    Here and below, `parsed` is a column that has `parsed_day` already: text is parsed again wherever
    an expression is repeated, so rows are cheaper with the day beside them.
    """
    day = parsed_day(column) if parsed is None else parsed
    return F.when(_possible(day), day)


def normal_day(column: str, parsed: Column | None = None) -> Column:
    """The day as yyyy-mm-dd, and text that names no day as it is."""
    day = parsed_day(column) if parsed is None else parsed
    return F.coalesce(day.cast("string"), F.col(column).cast("string"))


def names_no_day(column: str, parsed: Column | None = None) -> Column:
    """Whether a cell holds text, but not of a day. Never null."""
    day = parsed_day(column) if parsed is None else parsed
    return day.isNull() & (F.coalesce(F.trim(F.col(column).cast("string")), F.lit("")) != "")


def day_reason(column: str, parsed: Column | None = None) -> Column:
    """Why a row's day cannot be used, or null."""
    day = parsed_day(column) if parsed is None else parsed
    text = F.trim(F.col(column).cast("string"))
    return (
        F.when(F.coalesce(text, F.lit("")) == "", F.lit("no_date"))
        .when(day.isNull(), F.lit("bad_date"))
        .when(~_possible(day), F.lit("date_out_of_range"))
    )
