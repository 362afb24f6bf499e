"""Lookup joins: broadcast behind a measured size, otherwise a shuffle that splits hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.keys import row_hash
from ledgerlake.session import scratch_path

BROADCAST_BYTES = 64 * 1024 * 1024
# What a row costs in a hashed relation besides its cells.
ROW_OVERHEAD = 64
_SALT = "__salt"
_SALTS = "__salts"
_HASH = "__hash"
# Bounds of the sketch of frequent keys, which Spark has too.
MOST_KEYS, MOST_TRACKED = 10_000, 1_000_000


def measured_bytes(df: DataFrame) -> int:
    """Size of `df` as rows in memory, from one distributed aggregate."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    nested = [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))
    ]
    if nested:
        raise TypeError(f"cannot measure nested columns {nested}")
    row = F.lit(ROW_OVERHEAD + 16 * (len(df.columns) - len(text)))
    for name in text:
        row = row + F.coalesce(F.octet_length(name), F.lit(0)) + F.lit(16)
    return df.agg(F.coalesce(F.sum(row.cast("long")), F.lit(0)).alias("bytes")).first()["bytes"]


def stated_bytes(df: DataFrame) -> int | None:
    """An upper bound of `measured_bytes` from the catalog's statistics, without a job; None where
    `df` is more than a filter and a choice of columns of one analyzed table.

    See `sources.lake.analyze_table`. Statistics hold until files change.
    """
    node = df._jdf.queryExecution().optimizedPlan()
    stored = {name: name for name in df.columns}  # the table's names of the columns
    while node.nodeName() in ("Project", "Filter"):
        if node.nodeName() == "Project":
            names = _plain_columns(node.projectList())
            if names is None:
                return None
            stored = {name: names[own] for name, own in stored.items()}
        node = node.child()
    if node.getClass().getSimpleName() != "LogicalRelation" or node.catalogTable().isEmpty():
        return None
    # Partition pruning leaves the plan's own copy without rows and columns.
    catalog = df.sparkSession._jsparkSession.sessionState().catalog()
    stats = catalog.getTableMetadata(node.catalogTable().get().identifier()).stats()
    if stats.isEmpty() or stats.get().rowCount().isEmpty():
        return None
    row, columns = ROW_OVERHEAD, stats.get().colStats()
    for field in df.schema.fields:
        row += 16
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            own = stored[field.name]
            if not columns.contains(own) or columns.apply(own).maxLen().isEmpty():
                return None
            row += int(str(columns.apply(own).maxLen().get()))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return None
    return row * int(str(stats.get().rowCount().get()))


def _plain_columns(expressions) -> dict[str, str] | None:
    """New name -> old name of a projection that only picks and renames columns."""
    names = {}
    for n in range(expressions.size()):
        expression = expressions.apply(n)
        own = expression.child() if expression.nodeName() == "Alias" else expression
        if own.nodeName() != "AttributeReference":
            return None
        names[expression.name()] = own.name()
    return names


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether `df` is small enough, by the catalog's statistics or else by measuring."""
    stated = stated_bytes(df)
    return (measured_bytes(df) if stated is None else stated) <= limit


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "inner",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """`facts` joined to `lookup` without moving the facts while the lookup is small.

    `how` is one of inner, left, left_semi, left_anti. A lookup over `limit` bytes goes
    through `split_join`.
    """
    if fits_broadcast(lookup, limit):
        return facts.join(F.broadcast(lookup), on, how)
    return split_join(facts, lookup, on, how)


def hot_keys(df: DataFrame, on: list[str]) -> DataFrame:
    """Keys with more rows than one shuffle partition's fair share, with their split count.

    There are fewer of them than shuffle partitions, whatever the size of `df`. The counts are
    written once, so `df` is evaluated once.
    """
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "rows-per-key")
    df.groupBy(*on).agg(F.count(F.lit(1)).alias("rows")).write.parquet(path)
    rows_per_key = spark.read.parquet(path)
    total = rows_per_key.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()["rows"]
    fair_share = max(1, total // partitions)
    return rows_per_key.where(F.col("rows") > fair_share).select(
        *on, F.ceil(F.col("rows") / fair_share).cast("int").alias(_SALTS)
    )


def sketched_join(facts: DataFrame, lookup: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """`split_join` that evaluates the facts once and counts no key exactly.

    The facts are written, and while they are, a sketch of bounded size finds the keys that may have
    more rows than one partition's fair share; sketches of tasks are merged. It works on a hash of
    the key, so any types can be keys; keys that share a hash are split together. The sketch decides
    how rows are spread, never which rows match.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot split a {how} join: it returns unmatched lookup rows")
    spark = facts.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    no_key = F.lit(False)
    for key in on:
        no_key = no_key | F.col(key).isNull()
    hashed = F.xxhash64(*on)
    most, tracked = min(partitions, MOST_KEYS), min(max(1000, 8 * partitions), MOST_TRACKED)
    sketch = F.call_function("approx_top_k", F.when(~no_key, hashed), F.lit(most), F.lit(tracked))
    path, counters = scratch_path(spark, "facts"), Observation("keys")
    facts.observe(counters, F.count(F.lit(1)).alias("rows"), sketch.alias("top")).write.parquet(path)
    staged = spark.read.schema(facts.schema).parquet(path)
    fair_share = max(1, counters.get["rows"] // partitions)
    hot = [
        (top["item"], -(-top["count"] // fair_share))
        for top in counters.get["top"] or []
        if top["item"] is not None and top["count"] > fair_share
    ]
    # Fewer rows than shuffle partitions.
    splits = F.broadcast(spark.createDataFrame(hot, f"{_HASH} long, {_SALTS} int"))
    fan = F.when(no_key, F.lit(partitions)).otherwise(F.coalesce(F.col(_SALTS), F.lit(1)))
    spread = (
        staged.withColumn(_SALT, row_hash(staged.columns))
        .withColumn(_HASH, hashed)
        .join(splits, _HASH, "left")
        .withColumn(_SALT, F.pmod(F.col(_SALT), fan).cast("int"))
        .drop(_SALTS, _HASH)
    )
    copies = (
        lookup.withColumn(_HASH, hashed)
        .join(splits, _HASH, "left")
        .withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_SALTS), F.lit(1)) - 1)))
        .drop(_SALTS, _HASH)
    )
    return spread.join(copies.hint("merge"), [*on, _SALT], how).drop(_SALT)


def split_join(facts: DataFrame, lookup: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """A shuffle join that spreads each hot key of `facts` over several partitions.

    The lookup rows of a hot key are repeated once per split; all other keys are shuffled as
    in a plain join. Facts with a null key match nothing and are spread over all partitions.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot split a {how} join: it returns unmatched lookup rows")
    partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    splits = F.broadcast(hot_keys(facts, on))  # fewer rows than shuffle partitions
    no_key = F.lit(False)
    for key in on:
        no_key = no_key | F.col(key).isNull()
    fan = F.when(no_key, F.lit(partitions)).otherwise(F.coalesce(F.col(_SALTS), F.lit(1)))
    # The salt is cut before the join to the splits: it has to see the facts as they were read.
    spread = (
        facts.withColumn(_SALT, row_hash(facts.columns))
        .join(splits, on, "left")
        .withColumn(_SALT, F.pmod(F.col(_SALT), fan).cast("int"))
        .drop(_SALTS)
    )
    copies = (
        lookup.join(splits, on, "left")
        .withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_SALTS), F.lit(1)) - 1)))
        .drop(_SALTS)
    )
    # Without the hint Spark may broadcast a lookup that was found too large for it.
    return spread.join(copies.hint("merge"), [*on, _SALT], how).drop(_SALT)
