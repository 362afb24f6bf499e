"""History that late changes can still be spliced into.

A timeline has one row per key and run of equal states, deletions included, so that the rows of a
key cover all days from its first change on. Each row keeps its `marks`: the days on which a
change confirmed its state, with the order of that change. A change of any earlier day then cuts just
the row it falls into, and the result is that of all changes in one feed, however they are batched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.keys import surrogate_key
from ledgerlake.operators.changes import DELETE


def day_states(
    changes: DataFrame,
    attributes: Sequence[str],
    key: str = "id",
    updated_at: str = "updated_at",
    order: tuple[str, ...] = ("updated_at", "seq"),
    op: str = "op",
) -> DataFrame:
    """(key, day, gone, attributes, mark): the last change of each key and day. `mark` is its order."""
    last = F.max_by(F.struct(op, *attributes), F.struct(*order)).alias("state")
    days = changes.withColumn("day", F.to_date(updated_at)).groupBy(key, "day")
    gone = F.col(f"state.{op}") == DELETE
    return days.agg(last, F.max(F.struct(*order)).alias("mark")).select(
        key, "day", gone.alias("gone"), *(F.when(~gone, F.col(f"state.{a}")).alias(a) for a in attributes), "mark"
    )


def build_timeline(days: DataFrame, attributes: Sequence[str], key: str = "id") -> DataFrame:
    """(key, gone, attributes, start_date, end_date, marks) from one state per key and day.

    The windows see at most one row per key and calendar day.
    """
    by_day = Window.partitionBy(key).orderBy("day")
    state = F.struct("gone", *attributes)
    begins = ~F.lag(state).over(by_day).eqNullSafe(state)
    runs = days.withColumn("begins", begins.cast("int")).withColumn("run", F.sum("begins").over(by_day))
    rows = runs.groupBy(key, "run").agg(
        F.first("gone").alias("gone"),
        *(F.first(a).alias(a) for a in attributes),
        F.min("day").alias("start_date"),
        F.sort_array(F.collect_list(F.struct("day", "mark"))).alias("marks"),
    )
    ends = F.lead("start_date").over(Window.partitionBy(key).orderBy("run"))
    return rows.select(key, "gone", *attributes, "start_date", ends.alias("end_date"), "marks")


def splice(timeline: DataFrame, days: DataFrame, attributes: Sequence[str], key: str = "id") -> DataFrame:
    """`timeline` with further states `days`, see `day_states`, of whichever days.

    Rows of other keys pass, and so do rows of the same key beyond the neighbours of the days that
    arrive. The rows in between become their marks again, meet the arrivals and are cut anew. Of a day
    that is already there the change with the greater order counts, so a batch that comes twice
    changes nothing.
    """
    columns = [key, "gone", *attributes, "start_date", "end_date", "marks"]
    timeline = timeline.select(columns)
    spans = days.groupBy(key).agg(F.min("day").alias("first"), F.max("day").alias("last"))
    untouched = timeline.join(spans, key, "left_anti").select(columns)
    before = F.lag("start_date").over(Window.partitionBy(key).orderBy("start_date"))
    met = timeline.join(spans, key).withColumn("before", before)
    open_ended = F.col("end_date").isNull()
    # A new state may equal that of the row that ends where it begins, or of the row after it.
    near = (open_ended | (F.col("end_date") >= F.col("first"))) & (
        F.col("before").isNull() | (F.col("before") <= F.col("last"))
    )
    met = met.withColumn("near", near)
    far = met.where(~F.col("near")).select(columns)
    cut = met.where("near")
    marks = cut.select(key, F.explode("marks").alias("m"), "gone", *attributes)
    names = [key, "day", "gone", *attributes, "mark"]
    points = marks.select(key, "m.day", "gone", *attributes, "m.mark").unionAll(days.select(names))
    latest = points.groupBy(key, "day").agg(F.max_by(F.struct("gone", *attributes, "mark"), "mark").alias("s"))
    rebuilt = build_timeline(latest.select(key, "day", "s.*"), attributes, key)
    # The cut rows of a key are neighbours; what comes of them ends where the last of them ended.
    limits = cut.groupBy(key).agg(F.max(F.struct(open_ended.alias("open"), "end_date")).alias("until"))
    ended = rebuilt.join(limits, key, "left").withColumn("end_date", F.coalesce("end_date", "until.end_date"))
    return untouched.unionAll(far).unionAll(ended.select(columns))


def as_dimension(timeline: DataFrame, attributes: Sequence[str], key: str = "id") -> DataFrame:
    """(sk, key, attributes, start_date, end_date): the versions that a key had."""
    sk = surrogate_key(key, "start_date").alias("sk")
    return timeline.where(~F.col("gone")).select(sk, key, *attributes, "start_date", "end_date")


def broken_rows(timeline: DataFrame, key: str = "id") -> DataFrame:
    """Rows that do not end where the next one of their key begins, or are equal to it."""
    by_start = Window.partitionBy(key).orderBy("start_date")
    state = F.struct(*(c for c in timeline.columns if c not in (key, "start_date", "end_date", "marks", "bucket")))
    joined = timeline.withColumn("next", F.lead("start_date").over(by_start)).withColumn(
        "same", F.coalesce(F.lead(state).over(by_start).eqNullSafe(state) & F.col("next").isNotNull(), F.lit(False))
    )
    return joined.where(~F.col("end_date").eqNullSafe(F.col("next")) | F.col("same")).drop("next", "same")
