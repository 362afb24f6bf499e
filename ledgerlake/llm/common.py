"""Helpers the operators of this package share."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import combinations
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import scratch_path

# Runs of anything but the ASCII blank, tab, newline, vertical tab, form feed and return. In
# Python, bytes.split() cuts at the same six.
WORD = r"[^\x20\x09-\x0D]+"
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
DECODED_ROWS = "spark.sql.parquet.columnarReaderBatchSize"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def importable(spark: SparkSession) -> None:
    """Lets the Python workers of this machine import the package from where the driver has it."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *known]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """`df` as a table in the shared folder, so that a lost executor costs no earlier step. `options`
    are the writer's, with `__` for the dots.

    The shuffle files of the write go with it: what follows reads the table.
    """
    spark = df.sparkSession
    path, before = scratch_path(spark, name), spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.options(**{key.replace("__", "."): value for key, value in options.items()}).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def at_once(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within it, actions hand Python at most so many rows at a time: for rows of some megabytes."""
    before = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


@contextmanager
def decoded_at_once(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within it, actions decode at most so many rows of Parquet at a time: Spark's 4,096 can be a whole
    file where rows have some megabytes."""
    before = spark.conf.get(DECODED_ROWS)
    spark.conf.set(DECODED_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(DECODED_ROWS, before)


def block_masks(distance: int, extra: int, bits: int = 64) -> list[list[tuple[int, int]]]:
    """Bit ranges of each pigeonhole key: the ways to keep `extra` of `distance + extra` blocks.

    Two words that differ in at most `distance` bits agree on all bits of one key at least.
    """
    blocks = distance + extra
    cuts = [round(bits * i / blocks) for i in range(blocks + 1)]
    ranges = [(cuts[i], cuts[i + 1]) for i in range(blocks)]
    return [list(chosen) for chosen in combinations(ranges, extra)]


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of `edges` (a, b: long): one row (node, root) for each linked node.

    The root is the smallest node of the component. Alternates two star rewrites until nothing
    changes; every round is a written table. Each round keeps one row per edge end, whatever the
    degree of a node, and finds minima with a map side.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges, before = written(edges.distinct(), name), None
    while True:
        state = edges.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h"),
        ).first()
        if state["n"] == 0 or state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        ).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .where("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b")))
        )
        edges = written(small.distinct(), name)


def texts(column) -> Iterator[bytes | None]:
    """The cells of an Arrow string column as bytes, without decoding them."""
    import pyarrow as pa

    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    for cell in column.cast(kind):
        yield cell.as_py()
