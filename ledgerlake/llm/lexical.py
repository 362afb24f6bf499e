"""Ranked lexical search over a length-stratified index.

The index is cut into nodes of some thousand documents. In a node the documents are grouped into strata
of equal normaliser m, and a term's postings are grouped by stratum and, within it, by tf. All
documents of such a group get the same share of a term's weight, so impacts are computed once for
each group. The groups of the highest tf of a term and stratum add up to the most that a document
of the stratum can score: an item visits strata in the order of that bound and stops where it is
below the k-th best score that the task has seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import at_once, decoded_at_once, texts, written
from ledgerlake.operators.joins import BROADCAST_BYTES, lookup_join, measured_bytes

K = 20
UNIT = 1_000_000_000  # a posting's impact is below that
NODE_DOCS = 512
NODE_TERMS = 100_000  # of all documents of a node, repeats counted, unless one document has more
BLOCK_ITEMS = 256
NODES_AT_ONCE = 8  # that a task decodes, and gets in one batch
TEXTS_AT_ONCE = 1000  # that a task gets in one batch; the JVM and the worker have each batch in memory

_KEPT = bytes(range(0x30, 0x3A)) + bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_TERMS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _KEPT else 0x20 for c in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of all characters beyond ASCII; only A-Z are lower-cased."""
    return text.translate(_TERMS).split() if text else []


class Index(NamedTuple):
    """Nodes, the number of documents with a term, and the number of all their terms."""

    nodes: DataFrame
    documents: int
    length: int


# Else Parquet looks at the size of its pages and row groups, which are in memory whole, every hundred rows.
STORED = {"parquet__page__size__row__check__min": "1", "parquet__block__size__row__check__min": "1", "parquet__block__size": str(16 << 20)}

# The lists that are as long as the vocabulary or the postings are packed; only the lexicon needs df.
NODE = (
    "ids array<long>, strata array<long>, stratum_ends array<int>, terms array<binary>, df array<int>, "
    "term_groups binary, group_stratum binary, group_tf binary, group_docs binary, doc binary"
)


def _packed(values: np.ndarray) -> pa.Array:
    """One cell with numbers from 0 in as few bytes as the largest of them needs."""
    return pa.array([values.astype(np.min_scalar_type(values.max())).tobytes()], pa.binary())


def _unpacked(cell: pa.BinaryScalar, number: int) -> np.ndarray:
    """The numbers of a cell, of which there are so many."""
    data = cell.as_buffer()
    return np.frombuffer(data, f"u{data.size // number}").astype(np.int64)


def corpus_size(docs: DataFrame, text_col: str) -> tuple[int, int]:
    """How many texts have a term, and how many terms all of them have."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, length = 0, 0
        for batch in rows:
            sizes = [len(terms(text)) for text in texts(batch.column(0))]
            held, length = held + sum(map(bool, sizes)), length + sum(sizes)
        yield pa.RecordBatch.from_pydict({"documents": pa.array([held], pa.int64()), "length": pa.array([length], pa.int64())})

    counted = docs.select(F.col(text_col).cast("string")).mapInArrow(batches, "documents long, length long")
    total = counted.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("documents", "length"))).first()
    return total["documents"], total["length"]


def _node(ids: list[int | None], words: list[list[bytes]], documents: int, length: int) -> pa.RecordBatch:
    """One node of documents that have at least one term."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    m = 100 - 25 + (25 * sizes * documents) // length
    order = np.argsort(m, kind="stable")  # documents of a stratum are neighbours
    strata, stratum, per_stratum = np.unique(m[order], return_inverse=True, return_counts=True)
    found = pa.array(chain.from_iterable(words[i] for i in order), pa.binary()).dictionary_encode()
    vocabulary = len(found.dictionary)
    doc = np.repeat(np.arange(len(order)), sizes[order])
    pairs, tf = np.unique(doc * vocabulary + found.indices.to_numpy(), return_counts=True)
    doc, term = pairs // vocabulary, pairs % vocabulary
    by = np.lexsort((tf, stratum[doc], term))
    doc, term, tf = doc[by], term[by], tf[by]
    own = stratum[doc]
    new = np.flatnonzero(np.diff(term, prepend=-1) | np.diff(own, prepend=-1) | np.diff(tf, prepend=-1))
    per_term = np.bincount(term, minlength=vocabulary)
    groups_of_term = np.bincount(term[new], minlength=vocabulary)

    def cell(values, kind) -> pa.Array:
        values = values if isinstance(values, pa.Array) else pa.array(values, kind)
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    cells = {
        "ids": cell([ids[i] for i in order], pa.int64()),
        "strata": cell(strata, pa.int64()),
        "stratum_ends": cell(np.cumsum(per_stratum).astype(np.int32), pa.int32()),
        "terms": cell(found.dictionary, None),
        "df": cell(per_term.astype(np.int32), pa.int32()),
        "term_groups": _packed(groups_of_term),
        "group_stratum": _packed(own[new]),
        "group_tf": _packed(tf[new]),
        "group_docs": _packed(np.diff(new, append=len(doc))),
        "doc": _packed(doc),
    }
    return pa.RecordBatch.from_arrays(list(cells.values()), list(cells))


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """The index of all texts that have a term, as a written table. Tasks index the rows they read,
    so no text is shuffled; what is stored has about the size of the texts."""
    with at_once(docs.sparkSession, TEXTS_AT_ONCE):
        documents, length = corpus_size(docs, text_col)

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, words, size = [], [], 0
        for batch in rows:
            for key, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
                found = terms(text)
                if not found:
                    continue
                if ids and (len(ids) >= NODE_DOCS or size + len(found) > NODE_TERMS):
                    yield _node(ids, words, documents, length)
                    ids, words, size = [], [], 0
                ids.append(key)
                words.append(found)
                size += len(found)
        if ids:
            yield _node(ids, words, documents, length)

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    with at_once(docs.sparkSession, TEXTS_AT_ONCE):
        return Index(written(rows.mapInArrow(batches, NODE), "index", **STORED), documents, length)


def weighted_items(index: Index, items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, item, term, weight) for each row of `items` and each of its terms that the index has;
    weight is w times the term's occurrences in the item. Every row has a key of its own."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = [terms(text) for text in texts(batch.column(2))]
            at = np.repeat(np.arange(len(found)), list(map(len, found)))
            flat = pa.array(chain.from_iterable(found), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), flat], ["key", "item", "term"])

    rows = items.select(
        F.monotonically_increasing_id().alias("key"), F.col(id_col).cast("long").alias("item"), F.col(text_col).cast("string")
    )
    asked = rows.mapInArrow(batches, "key long, item long, term binary")
    asked = written(asked.groupBy("key", "item", "term").agg(F.count(F.lit(1)).alias("n")), "asked")
    # Of the vocabulary only the asked terms are counted.
    held = index.nodes.select(F.explode(F.arrays_zip("terms", "df")).alias("t")).select("t.terms", "t.df")
    with decoded_at_once(items.sparkSession, NODES_AT_ONCE):
        held = lookup_join(held.withColumnRenamed("terms", "term"), asked.select("term").distinct(), ["term"])
        lexicon = written(held.groupBy("term").agg(F.sum("df").alias("df")), "lexicon")
    ratio = F.lit(2.0 * index.documents + 2) / (2 * F.col("df") + 1).cast("double")
    weight = F.floor(F.lit(1000.0) * F.log(ratio)) * F.col("n")
    return asked.join(lexicon, "term").select("key", "item", "term", weight.cast("long").alias("weight"))


class _Node:
    """A node's arrays, with the impact of each group."""

    def __init__(self, row: dict[str, pa.Scalar]):
        self.ids, self.terms = row["ids"].values, row["terms"].values
        strata, self.stratum_ends = (row[c].values.to_numpy(zero_copy_only=False) for c in ("strata", "stratum_ends"))
        self.term_ends = np.cumsum(_unpacked(row["term_groups"], len(self.terms)))
        groups = self.term_ends[-1]
        self.group_ends = np.cumsum(_unpacked(row["group_docs"], groups))
        self.doc = _unpacked(row["doc"], self.group_ends[-1])
        self.term_starts = np.concatenate([[0], self.term_ends[:-1]])
        self.group_starts = np.concatenate([[0], self.group_ends[:-1]])
        self.stratum, tf = _unpacked(row["group_stratum"], groups), _unpacked(row["group_tf"], groups)
        self.impact = (UNIT * tf) // (1000 * tf + 12 * strata[self.stratum])
        # The last group of a term and stratum has the highest tf.
        self.top = np.append(np.diff(self.stratum) != 0, True)
        self.top[self.term_ends - 1] = True

    def scores(self, item: np.ndarray, term: pa.Array, weight: np.ndarray, cutoff: np.ndarray, k: int) -> np.ndarray:
        """(items, documents): exact scores of the visited documents, zero elsewhere. `cutoff` has the
        k-th best score of each item so far and is raised."""
        place = pc.index_in(term, value_set=self.terms)
        known = place.is_valid().to_numpy(zero_copy_only=False)
        place = place.drop_null().to_numpy()
        item, weight = item[known], weight[known]
        number = self.term_ends[place] - self.term_starts[place]
        group = _ranges(self.term_starts[place], number)
        item, gain = np.repeat(item, number), np.repeat(weight, number) * self.impact[group]
        items, strata, docs = len(cutoff), len(self.stratum_ends), len(self.ids)
        stratum = self.stratum[group]
        bound = np.zeros((items, strata), np.int64)
        top = self.top[group]
        np.add.at(bound, (item[top], stratum[top]), gain[top])
        order = np.argsort(-bound, axis=1, kind="stable")
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(strata)[None, :], 1)
        ends = np.cumsum(np.diff(self.stratum_ends, prepend=0)[order], axis=1)
        limit = (ends < k).sum(axis=1) + 1  # the first strata that have k documents
        found = np.zeros((items, docs), np.int64)
        todo = bound > 0
        while todo.any():
            visit = todo & (rank < limit[:, None]) & (bound >= cutoff[:, None])
            todo &= ~visit & (bound >= cutoff[:, None])
            chosen = np.flatnonzero(visit[item, stratum])
            own = group[chosen]
            size = self.group_ends[own] - self.group_starts[own]
            doc = self.doc[_ranges(self.group_starts[own], size)]
            np.add.at(found, (np.repeat(item[chosen], size), doc), np.repeat(gain[chosen], size))
            if docs >= k:
                np.maximum(cutoff, np.partition(found, docs - k, axis=1)[:, docs - k], out=cutoff)
            limit = limit * 2
        return found


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... of the given lengths, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _best(found: np.ndarray, ids: pa.Array, cutoff: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Item, document and score of what can be among an item's k best, the node's k best at most."""
    item, doc = np.nonzero(found >= np.maximum(cutoff, 1)[:, None])
    score = found[item, doc]
    by_id = pc.fill_null(ids, np.iinfo(np.int64).max).to_numpy()
    order = np.lexsort((by_id[doc], -score, item))
    item, doc, score = item[order], doc[order], score[order]
    starts = np.searchsorted(item, np.arange(len(cutoff)))
    kept = np.arange(len(item)) - starts[item] < k
    return item[kept], doc[kept], score[kept]


def _found(meetings: DataFrame, k: int) -> DataFrame:
    """(key, id, score) of the candidates of each node for each block of items."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutoffs: dict[int, np.ndarray] = {}  # by block: one number for each item
        for batch in rows:
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            for i in range(batch.num_rows):
                row = {name: column[i] for name, column in columns.items()}
                keys, item = np.unique(row.pop("key").values.to_numpy(), return_inverse=True)
                term, weight = row.pop("term").values, row.pop("weight").values.to_numpy()
                cutoff = cutoffs.setdefault(row.pop("block").as_py(), np.zeros(len(keys), np.int64))
                node = _Node(row)
                scores = node.scores(item, term, weight, cutoff, k)
                at, doc, score = _best(scores, node.ids, cutoff, k)
                cells = [pa.array(keys[at]), node.ids.take(pa.array(doc)), pa.array(score)]
                yield pa.RecordBatch.from_arrays(cells, ["key", "id", "score"])

    return meetings.mapInArrow(batches, "key long, id long, score long")


def search(
    index: Index,
    items: DataFrame,
    k: int = K,
    id_col: str = "item_id",
    text_col: str = "text",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """(item, rank, id, score): the k highest-scoring documents of each row of `items`, of scores
    above 0; equal scores by ascending id, null ids last.

    Items meet the nodes in blocks. Blocks are broadcast in rounds of at most `limit` bytes (a
    single larger block alone), and each round reads the index once.

    Null and empty texts, as items and as documents, have no terms and no rank. Very long texts are
    taken whole; a document of more than `NODE_TERMS` terms is a node of its own. Each row of `items`
    is ranked for itself, also if it repeats an id, and each document row is a document of its
    own, also if it repeats another. Null ids stay null. An empty table gives no rows. Other
    columns are not read.
    """
    weighted = written(weighted_items(index, items, id_col, text_col), "weighted")
    size = weighted.agg(F.count_distinct("key").alias("n")).first()["n"]
    blocks = max(1, -(-size // BLOCK_ITEMS))
    entry = F.struct("key", "term", "weight")
    grouped = weighted.groupBy(F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int").alias("block")).agg(
        F.sort_array(F.collect_list(entry)).alias("e")
    )
    grouped = written(grouped.select("block", "e.key", "e.term", "e.weight"), "blocks")
    rounds = -(-measured_bytes(weighted) // limit)
    spark, found = grouped.sparkSession, None
    for n in range(rounds):
        own = grouped.where(F.pmod("block", F.lit(rounds)) == n)
        with at_once(spark, NODES_AT_ONCE), decoded_at_once(spark, NODES_AT_ONCE):
            part = written(_found(index.nodes.drop("df").crossJoin(F.broadcast(own)), k), "found")
        found = part if found is None else found.unionAll(part)
    if found is None:
        found = spark.createDataFrame([], "key long, id long, score long")
    order = Window.partitionBy("key").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    named = weighted.select("key", "item").distinct()
    return best.join(named, "key").select("item", "rank", "id", "score")
