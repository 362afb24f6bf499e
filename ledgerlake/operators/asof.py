"""As-of join: each row with the newest lookup row of its key that is not after it, however old."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.keys import row_hash
from ledgerlake.operators.enrich import prepare_fx
from ledgerlake.operators.joins import BROADCAST_BYTES, lookup_join
from ledgerlake.session import scratch_path

_PART, _KIND, _SALT, _ROW, _FOUND, _AT = "__part", "__kind", "__salt", "__row", "__found", "__at"


def asof_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    fact_time: str,
    lookup_time: str,
    values: Sequence[str],
) -> DataFrame:
    """`facts` with `values` of the lookup row of equal `keys` and the greatest `lookup_time` that is
    not after `fact_time`; nulls where there is none.

    Both sides are sorted together by key and time, in as many ranges as there are shuffle
    partitions, and written. A sweep over each range finds the last lookup row before each fact; a
    fact at the head of a range gets it from the ranges before, of which only the last lookup row per
    key and range matters. So neither a key with most of the rows nor a single moment of it
    has to fit a task, and no lookup row is repeated. Of lookup rows of one key and time
    the greatest counts. Facts without a key or a time match nothing.
    """
    spark = facts.sparkSession
    found = F.struct(*(F.col(v).alias(v) for v in values))
    named = [F.col(k).alias(f"__k{n}") for n, k in enumerate(keys)]
    ks = [f"__k{n}" for n in range(len(keys))]
    row = F.struct(*(F.col(c) for c in facts.columns))
    usable = F.col(fact_time).isNotNull()
    for k in keys:
        usable = usable & F.col(k).isNotNull()
    kind = lookup.schema[lookup_time].dataType
    known = lookup.where(F.col(lookup_time).isNotNull()).groupBy(*named, F.col(lookup_time).alias(_AT)).agg(
        F.max(found).alias(_FOUND)
    )
    swept = facts.where(usable).select(
        *named, F.col(fact_time).cast(kind).alias(_AT), F.lit(1).alias(_KIND), row_hash(facts.columns).alias(_SALT), row.alias(_ROW)
    )
    both = swept.unionByName(
        known.select(*ks, _AT, F.lit(0).alias(_KIND), F.lit(0).cast("long").alias(_SALT), _FOUND), allowMissingColumns=True
    )
    path = scratch_path(spark, "as-of")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The salt spreads facts of one moment; a lookup row stands before all of them.
    ranges = both.repartitionByRange(partitions, *ks, _AT, _KIND, _SALT).withColumn(_PART, F.spark_partition_id())
    ranges.write.parquet(path)
    ranges = spark.read.parquet(path)

    order = [_AT, _KIND]
    own = Window.partitionBy(_PART, *ks).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    running = ranges.withColumn(_FOUND, F.last(_FOUND, ignorenulls=True).over(own)).where(F.col(_KIND) == 1)
    # One row per key and range that has lookup rows: no more than ranges and keys together.
    ends = ranges.where(F.col(_KIND) == 0).groupBy(*ks, _PART).agg(F.max_by(_FOUND, _AT).alias("__last"))
    places = ranges.where(F.col(_KIND) == 1).select(*ks, _PART).distinct()
    earlier = Window.partitionBy(*ks).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    heads = (
        places.join(ends, [*ks, _PART], "full_outer")
        .withColumn("__handed", F.last("__last", ignorenulls=True).over(earlier))
        .select(*ks, _PART, "__handed")
        .where(F.col("__handed").isNotNull())
    )
    joined = running.join(heads, [*ks, _PART], "left").withColumn(_FOUND, F.coalesce(_FOUND, "__handed"))
    names = [F.col(f"{_ROW}.`{c}`").alias(c) for c in facts.columns]
    matched = joined.select(*names, *(F.col(f"{_FOUND}.`{v}`").alias(v) for v in values))
    others = facts.where(~F.coalesce(usable, F.lit(False)))
    nothing = [F.lit(None).cast(lookup.schema[v].dataType).alias(v) for v in values]
    return matched.unionAll(others.select(*facts.columns, *nothing))


def asof_rates(
    txn: DataFrame, fx: DataFrame, date_column: str = "value_date", limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Transactions with `rate_to_sgd` and `rate_date` of the newest rate of their currency that is
    not after their date, nulls where there is none.

    Only different currencies and dates are looked up, so the transactions themselves are not
    sorted. Dates are compared as days.
    """
    known = prepare_fx(fx).where(F.col("rate_to_sgd").isNotNull())
    known = known.select("currency", F.col("run_date").cast("date").alias("rate_date"), "rate_to_sgd")
    asked = txn.select("currency", date_column).distinct()
    asked = asked.withColumn("__day", F.col(date_column).try_cast("date")).where("currency IS NOT NULL AND __day IS NOT NULL")
    again = known.withColumn("__since", F.col("rate_date"))
    found = asof_join(asked, again, ["currency"], "__day", "__since", ["rate_to_sgd", "rate_date"])
    return lookup_join(txn, _kept(found.drop("__day"), "rates"), ["currency", date_column], "left", limit)


def versions_by_sweep(
    facts: DataFrame, dimension: DataFrame, fact_date: str, key: str = "id"
) -> DataFrame:
    """Facts with the `sk` of the version valid on `fact_date`, or null.

    A fact's version is the last one of its key that began by then, if it has not ended. The sweep
    takes one row per version, for however many years it lasts.
    """
    versions = dimension.select(key, "start_date", "sk", F.col("end_date").alias("__end"))
    found = asof_join(facts, versions, [key], fact_date, "start_date", ["sk", "__end"])
    valid: Column = F.col("__end").isNull() | (F.col(fact_date) < F.col("__end"))
    return found.withColumn("sk", F.when(valid, F.col("sk"))).drop("__end")


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
