"""Exact top-k search by inner product, in the three phases of a uniform threshold.

A vector is cut into `BLOCKS` parts, and a score is the sum of the parts' scores. The parts of some
vectors form a node. Phase one gathers from each node its highest partial scores of each query;
the k-th best exact total among the vectors so found is the cutoff. A vector at or over the cutoff
has at least one partial score at or over cutoff / parts, so in phase two each node sends those.
Phase three drops what cannot reach the cutoff even with the most that the unseen parts may add,
and resolves the remaining scores exactly.

Equal vectors are one class, of which the k + 1 smallest ids matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import written

K = 10
BLOCKS = 2
SHARD = 1024  # vectors of a node
QUERY_BLOCK = 1024  # queries a node meets at a time
LOWEST = -(1 << 63)


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of the rows of two integer matrices, exact up to 64 bits."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T if most < 2**62 else _saturated(a.astype(object) @ b.astype(object).T)


def inner_rows(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The inner product of each row of one matrix with that of the other."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    return np.einsum("ij,ij->i", a, b) if most < 2**62 else _saturated((a.astype(object) * b.astype(object)).sum(axis=1))


def _saturated(scores: np.ndarray) -> np.ndarray:
    """`search` refuses vectors that could come here."""
    return np.clip(scores, -(1 << 62), 1 << 62).astype(np.int64)


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v, dim): floor(scale * x) for each component, without rows that take no part. An error
    if two such vectors may have a score beyond 64 bits."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    taken = rows.where(F.col(id_col).isNotNull() & x.isNotNull() & finite)
    largest = F.max(F.array_max(F.transform(x, lambda e: F.abs(e * float(scale))))).alias("largest")
    bounds = taken.agg(largest, F.max(F.size(x)).alias("dim")).first()
    if bounds["largest"] is not None and (bounds["largest"] + 1) ** 2 * bounds["dim"] >= 2.0**62:
        raise ValueError(f"scores of components up to {bounds['largest'] / scale:g} do not fit 64 bits")
    vectors = taken.select(
        F.col(id_col).cast("long").alias("id"), F.transform(x, lambda e: F.floor(e * float(scale))).alias("v")
    )
    return vectors.withColumn("dim", F.size("v"))


def classes_of(vectors: DataFrame, k: int) -> DataFrame:
    """(class, v, dim, ids, lone, shard): one row for each distinct vector, with its k + 1 smallest ids,
    and each of these up to k times where rows repeat an id. `lone` says that there is no other id.

    Numbers of classes rise with their smallest id; where all ids differ, they are these ids.
    """
    by_id = Window.partitionBy("v").orderBy("id")
    again = F.row_number().over(Window.partitionBy("v", "id").orderBy("id"))
    few = vectors.withColumn("place", F.dense_rank().over(by_id)).where(F.col("place") <= k + 1)
    repeated = not vectors.groupBy("id").count().where("count > 1").isEmpty()
    if repeated:
        few = few.withColumn("again", again).where(F.col("again") <= k)
    rows = few.groupBy("v", "dim").agg(
        F.sort_array(F.collect_list("id")).alias("ids"), (F.max("place") == 1).cast("int").alias("lone")
    )
    number = F.col("ids")[0]
    if repeated:
        rows = rows.withColumn("least", number).repartitionByRange("least", "v").sortWithinPartitions("least", "v").drop("least")
        number = F.monotonically_increasing_id()
    rows = written(rows.withColumn("class", number), "classes")
    shards = -(-rows.count() // SHARD)
    return rows.withColumn("shard", F.pmod(F.xxhash64("class"), F.lit(max(1, shards))).cast("int"))


def _cut(block: int, blocks: int) -> Column:
    """The part of `v` that belongs to a block."""
    lo = F.floor(F.col("dim") * block / blocks).cast("int")
    hi = F.floor(F.col("dim") * (block + 1) / blocks).cast("int")
    return F.slice("v", lo + 1, hi - lo)


def _parts(rows: DataFrame, by: list[str], name: str, blocks: int) -> DataFrame:
    """One row for each of `by` and block: the ids `name` and their parts, one after the other."""
    cut = [rows.withColumn("block", F.lit(b)).withColumn("part", _cut(b, blocks)) for b in range(blocks)]
    every = cut[0]
    for other in cut[1:]:
        every = every.union(other)
    held = F.collect_list(F.struct(*(F.col(c) for c in name.split()), "part"))
    return every.groupBy(*by, "block").agg(held.alias("held")).select(
        *by, "block", *(F.col(f"held.{c}").alias(c) for c in name.split()), F.flatten("held.part").alias("parts")
    )


def _meetings(nodes: DataFrame, queries: DataFrame) -> DataFrame:
    """Each node with each block of queries of its dimension; a query block goes to each shard."""
    shards = nodes.select("dim", "shard").distinct()
    return nodes.join(queries.join(shards, "dim"), ["dim", "shard", "block"])


def _scores(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Block, queries, classes, their scores, and whether the class is more than the query itself."""
    columns = dict(zip(batch.schema.names, batch.columns, strict=True))
    flat = lambda cell: cell.values.to_numpy(zero_copy_only=False)
    for i in range(batch.num_rows):
        query, cls, owner, lone = (flat(columns[c][i]) for c in ("query", "class", "owner", "lone"))
        a, b = (flat(columns[c][i]) for c in ("query_parts", "parts"))
        scores = inner(a.reshape(len(query), -1), b.reshape(len(cls), -1))
        other = ~((query[:, None] == owner[None, :]) & lone.astype(bool)[None, :])
        yield columns["block"][i].as_py(), query, cls, scores, other, columns["cutoff"][i] if "cutoff" in columns else None


_ENTRY = "query long, class long, block int, score long"


def _entries(found: list[tuple]) -> pa.RecordBatch:
    query, cls, block, score = (np.concatenate(c) if c else np.empty(0, np.int64) for c in (zip(*found, strict=True) if found else [()] * 4))
    arrays = [pa.array(query, pa.int64()), pa.array(cls, pa.int64()), pa.array(block.astype(np.int32)), pa.array(score, pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, ["query", "class", "block", "score"])


def highest(meetings: DataFrame, k: int) -> DataFrame:
    """Phase one: each node's k highest partial scores of each query."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for block, query, cls, scores, other, _ in _scores(batch):
                scores = np.where(other, scores, LOWEST)
                n = min(k, len(cls))
                best = np.argpartition(-scores.astype(np.float64), n - 1, axis=1)[:, :n]
                value = np.take_along_axis(scores, best, 1).ravel()
                own = value > LOWEST
                yield _entries([(np.repeat(query, n)[own], cls[best.ravel()][own], np.full(own.sum(), block), value[own])])

    return meetings.mapInArrow(batches, _ENTRY)


def over_cutoff(meetings: DataFrame, blocks: int) -> DataFrame:
    """Phase two: all partial scores at or over cutoff / blocks. A null cutoff takes all."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for block, query, cls, scores, other, cutoff in _scores(batch):
                cut = cutoff.values.fill_null(LOWEST).to_numpy(zero_copy_only=False)
                # Whole numbers: blocks * score >= cutoff.
                least = np.where(cut == LOWEST, LOWEST, -(-cut // blocks))
                i, j = np.nonzero(other & (scores >= least[:, None]))
                for at in range(0, max(1, len(i)), 200_000):
                    own = slice(at, at + 200_000)
                    yield _entries([(query[i[own]], cls[j[own]], np.full(len(i[own]), block), scores[i[own], j[own]])])

    return meetings.mapInArrow(batches, _ENTRY)


def resolved(pairs: DataFrame, classes: DataFrame, queries: DataFrame) -> DataFrame:
    """(query, class, score): the exact scores of pairs (query, class)."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            a, b = (batch.column(c).flatten().to_numpy() for c in (2, 3))
            dims = batch.column(4).to_numpy()
            score, ends = np.zeros(batch.num_rows, np.int64), np.cumsum(dims)
            for dim in np.unique(dims):
                own = dims == dim
                at = (ends[own] - dim)[:, None] + np.arange(dim)
                score[own] = inner_rows(a[at], b[at]) if dim else 0
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score)], ["query", "class", "score"])

    with_vectors = pairs.join(classes.select("class", "v", "dim"), "class").join(
        queries.select(F.col("id").alias("query"), F.col("v").alias("query_v")), "query"
    )
    return with_vectors.select("query", "class", "query_v", "v", "dim").mapInArrow(
        batches, "query long, class long, score long"
    )


def search(
    rows: DataFrame,
    wanted: Column,
    k: int = K,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 1024,
    blocks: int = BLOCKS,
) -> DataFrame:
    """(query, rank, id, score): for each row where `wanted` (a condition on `id`) holds the k rows
    of the highest inner product but itself, all if there are fewer; ties go to the smaller id.

    Components are floor(scale * x). Rows without an id or a vector, or with a null, infinite or
    not-a-number component, take no part; components so large that a score might not fit 64 bits
    are an error. Every other row is a candidate, also if it repeats an id, with the same vector or
    another; a query does not meet rows of its own id. Of different vectors of a query's id the
    smallest asks. Vectors of different dimensions do not meet. Empty vectors score 0 with each other.
    Very long vectors are cut into the same parts as others. An empty table gives no rows. Other
    columns are not read.
    """
    vectors = written(integer_vectors(rows, id_col, vector_col, scale), "vectors")
    classes = classes_of(vectors, k)
    asking = vectors.where(wanted).groupBy("id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))
    queries = written(asking, "queries")
    blocks_of_queries = max(1, -(-queries.count() // QUERY_BLOCK))
    nodes = classes.withColumn("owner", F.col("ids")[0])
    nodes = written(_parts(nodes, ["dim", "shard"], "class owner lone", blocks), "nodes")
    group = F.pmod(F.xxhash64("id"), F.lit(blocks_of_queries)).cast("int")
    asked = queries.withColumn("query", F.col("id")).withColumn("group", group)

    def meetings(with_cutoff: DataFrame | None = None) -> DataFrame:
        named, extra = asked, "query"
        if with_cutoff is not None:
            named, extra = asked.join(with_cutoff, "query", "left"), "query cutoff"
        parts = _parts(named, ["dim", "group"], extra, blocks).withColumnRenamed("parts", "query_parts")
        return _meetings(nodes, parts)

    per_list = Window.partitionBy("query", "block").orderBy(F.desc("score"), "class")
    lists = highest(meetings(), k).withColumn("place", F.row_number().over(per_list)).where(F.col("place") <= k)
    first = written(resolved(lists.select("query", "class").distinct(), classes, queries), "first")
    per_query = Window.partitionBy("query").orderBy(F.desc("score"), "class")
    cutoffs = first.withColumn("place", F.row_number().over(per_query)).where(F.col("place") == k)
    cutoffs = written(cutoffs.select("query", F.col("score").alias("cutoff")), "cutoffs")
    seen = over_cutoff(meetings(cutoffs), blocks).groupBy("query", "class").agg(
        F.sum("score").alias("seen"), F.count(F.lit(1)).alias("n")
    )
    unseen = F.floor((F.col("cutoff") - 1) / blocks)  # the most a part that was not sent can be
    able = F.col("cutoff").isNull() | (F.col("seen") + (blocks - F.col("n")) * unseen >= F.col("cutoff"))
    left = written(seen.join(cutoffs, "query", "left").where(able).select("query", "class", "seen", "n"), "left")
    exact = left.where(F.col("n") == blocks).select("query", "class", F.col("seen").alias("score"))
    exact = exact.union(resolved(left.where(F.col("n") < blocks).select("query", "class"), classes, queries))
    # One more class, as the query's own may owe its place to the query.
    best = exact.withColumn("place", F.row_number().over(per_query)).where(F.col("place") <= k + 1)
    named = best.join(classes.select("class", "ids"), "class").select("query", "score", F.explode("ids").alias("id"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    return named.where("id <> query").withColumn("rank", rank).where(F.col("rank") <= k).select("query", "rank", "id", "score")
