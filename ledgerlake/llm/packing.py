"""Pack token sequences into bins: Martello-Toth dominance reduction, then best fit.

The lengths are at most the capacity, so all pieces are one histogram of at most that many
counts, whatever the size of the corpus. The driver packs the histogram: it decides for runs of
equal pieces. Spark cuts, counts and places the pieces.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import written
from ledgerlake.llm.tokens import default_path, encoder

CAPACITY = 4096
END_ID = 1


class Histogram:
    """Counts of the lengths that are left, with the lengths in order."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {length: n for length, n in counts.items() if n > 0}
        self.lengths = sorted(self.counts)

    def take(self, length: int, n: int) -> None:
        self.counts[length] -= n
        if not self.counts[length]:
            del self.counts[length]
            self.lengths.pop(bisect_left(self.lengths, length))

    def others(self, length: int) -> "Histogram":
        """A view without one piece of `length`."""
        rest = Histogram({})
        rest.counts, rest.lengths = dict(self.counts), list(self.lengths)
        rest.take(length, 1)
        return rest

    def smallest(self, n: int) -> list[int]:
        found: list[int] = []
        for length in self.lengths:
            found += [length] * min(n - len(found), self.counts[length])
            if len(found) == n:
                break
        return found

    def largest_upto(self, most: int) -> int | None:
        at = bisect_right(self.lengths, most)
        return self.lengths[at - 1] if at else None


def _best_pair(rest: Histogram, room: int) -> tuple[int, int] | None:
    """The two pieces of greatest sum that fit together, the larger first."""
    best, lo, hi = None, 0, len(rest.lengths) - 1
    while lo <= hi:
        a, b = rest.lengths[hi], rest.lengths[lo]
        if a + b > room or (lo == hi and rest.counts[a] < 2):
            hi -= 1
            continue
        if best is None or a + b > sum(best):
            best = (a, b)
        lo += 1
    return best


def _largest_second(rest: Histogram, room: int) -> int:
    """The largest possible smaller piece of two that fit together; 0 if none do."""
    for at in range(bisect_right(rest.lengths, room // 2) - 1, -1, -1):
        second = rest.lengths[at]
        first = second if rest.counts[second] > 1 else next(iter(rest.lengths[at + 1 : at + 2]), room + 1)
        if first + second <= room:
            return second
    return 0


def dominating(left: Histogram, length: int, capacity: int) -> tuple[int, ...] | None:
    """The set of at most three pieces with one of `length` that dominates all sets with it.

    A set dominates another if the other's pieces can be parted so that each part is no longer
    than a piece of its own; some best packing then has the set as a bin.
    """
    room, rest = capacity - length, left.others(length)
    partner = rest.largest_upto(room)
    if partner is None:
        return (length,)
    if partner == room:
        return (length, partner)
    few = rest.smallest(3)
    if sum(few[:2]) > room or len(few) < 2:
        return (length, partner)
    if len(few) == 3 and sum(few) <= room:
        return None
    pair = _best_pair(rest, room)
    if partner >= sum(pair):
        return (length, partner)
    if pair[0] == partner and _largest_second(rest, room) <= pair[1]:
        return (length, *pair)
    return None


def reduce(left: Histogram, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Takes out of `left` all dominating sets, until no length has one: (pieces, how often)."""
    fixed, changed = [], True
    while changed:
        changed = False
        for length in sorted(left.lengths, reverse=True):
            while length in left.counts and (chosen := dominating(left, length, capacity)):
                need = {x: chosen.count(x) for x in chosen}
                n = min(left.counts[x] // k for x, k in need.items())
                for x, k in need.items():
                    left.take(x, n * k)
                fixed.append((chosen, n))
                changed = True
    return fixed


def pack(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Runs (length, rank, n, bin, offset): the pieces of `length` with ranks rank, rank + 1, ...
    go to the bins bin, bin + 1, ... at `offset`. Every piece is in one run; no bin overflows.

    The number of runs depends on the capacity, hardly on the counts.
    """
    left, rank, runs, bins = Histogram(counts), dict.fromkeys(counts, 0), [], 0

    def place(length: int, n: int, at: int, offset: int) -> None:
        runs.append((length, rank[length], n, at, offset))
        rank[length] += n

    for chosen, n in reduce(left, capacity):
        for i, length in enumerate(chosen):
            place(length, n, bins, sum(chosen[:i]))
        bins += n
    open_: dict[int, list[tuple[int, int]]] = {}  # room left -> runs of bins
    rooms: list[int] = []

    def add(room: int, at: int, n: int) -> None:
        if room not in open_:
            open_[room] = []
            insort(rooms, room)
        open_[room].append((at, n))

    for length in reversed(left.lengths):
        n = left.counts[length]
        while n:
            fits = bisect_left(rooms, length)
            if fits == len(rooms):
                each = capacity // length
                if n >= each:
                    full = n // each
                    for i in range(each):
                        place(length, full, bins, i * length)
                    add(capacity - each * length, bins, full)
                    bins, n = bins + full, n - full * each
                else:
                    for i in range(n):
                        place(length, 1, bins, i * length)
                    add(capacity - n * length, bins, 1)
                    bins, n = bins + 1, 0
                continue
            room = rooms[fits]
            at, there = open_[room].pop()
            if not open_[room]:
                del open_[room], rooms[fits]
            used = min(n, there)
            place(length, used, at, capacity - room)
            if there > used:
                add(room, at + used, there - used)
            add(room - length, at, used)
            n -= used
    return np.array(sorted(runs), np.int64).reshape(-1, 5)


def tokenized(docs: DataFrame, path: str, capacity: int, id_col: str, text_col: str, with_ids: bool) -> DataFrame:
    """One row for each piece, with its rank among the pieces of its length in its task."""
    names = ["id", "piece", "start", "length", "crc", "part", "rank"] + ["ids"] * with_ids

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        encode = encoder(path).stream
        for batch in rows:
            found = []
            doc_ids = batch.column(0).to_pylist()
            for doc_id, ids in zip(doc_ids, encode(batch.column(1)), strict=True):
                ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    own = ids[start : start + capacity]
                    found.append((doc_id, piece, start, len(own), zlib.crc32(own), part, seen[len(own)]))
                    found[-1] += (own.tolist(),) * with_ids
                    seen[len(own)] += 1
            columns = list(zip(*found, strict=True)) or [()] * len(names)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=False)], names)

    schema = "id long, piece int, start long, length int, crc long, part int, rank long" + ", ids array<long>" * with_ids
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(batches, schema)


def pack_documents(
    docs: DataFrame,
    path: str | None = None,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """(id, piece, start, length, crc, sequence, offset) for each piece, `ids` if asked for.

    A document is its tokens and an end token; only documents longer than `capacity` are cut,
    into full pieces and a last one. A null or empty text is the end token alone. Rows without an
    id and repeated rows are packed like any other. An empty table gives no rows.

    The ranks of equal lengths are counted in each task and kept in the written table; sums over
    the tasks before make them ranks in the whole corpus, which the runs of `pack` place.
    """
    pieces = written(tokenized(docs, path or default_path(), capacity, id_col, text_col, with_ids), "pieces")
    groups = written(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    counts = {r["length"]: r["n"] for r in groups.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = pack(counts, capacity)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = groups.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("base")).drop("base", "part")
    # A length and a rank as one number: a corpus has fewer than 2**48 pieces.
    firsts = (runs[:, 0] << 48) + runs[:, 1]

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            lengths, ranks = (batch.column(batch.schema.names.index(c)).to_numpy().astype(np.int64) for c in ("length", "rank"))
            run = runs[np.searchsorted(firsts, (lengths << 48) + ranks, "right") - 1]
            placed = {"sequence": run[:, 3] + ranks - run[:, 1], "offset": run[:, 4]}
            columns = {c: batch.column(i) for i, c in enumerate(batch.schema.names) if c != "rank"}
            yield pa.RecordBatch.from_pydict(columns | {k: pa.array(v) for k, v in placed.items()})

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")
    return ranked.mapInArrow(batches, f"{kept}, sequence long, offset long")
