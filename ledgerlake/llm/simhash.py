"""Near duplicates by SimHash: pigeonhole blocks find the pairs, Hamming distance verifies them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import block_masks, components, texts, written

SEED = 42
SHINGLE = 3
DISTANCE = 3
# Pairs share two of five blocks, so a key has 25 or 26 bits and unrelated texts rarely meet.
SHARED_BLOCKS = 2
# Fingerprints that are compared with each other in one step; larger blocks are cut into tiles.
TILE = 1024
_CHUNK = 1 << 16


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The 64 bits of a text, as a signed number. No words: zero."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        pieces = [joined]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate([[0], ends[:-shingle]])
        pieces = [joined[s:e] for s, e in zip(starts.tolist(), (ends[shingle - 1 :] - 1).tolist(), strict=True)]
    digest = xxhash.xxh64_digest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(pieces), _CHUNK):
        hashes = b"".join([digest(piece, SEED) for piece in pieces[at : at + _CHUNK]])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(pieces)).tobytes(), "big", signed=True)


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """(id, fp: long) for each row; a null or wordless text has the fingerprint zero."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = pa.array([fingerprint(t, shingle) for t in texts(batch.column(1))], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), found], ["id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(batches, "id long, fp long")


def close_groups(values: np.ndarray, distance: int) -> np.ndarray:
    """For each value the smallest one that is reached by steps of at most `distance` bits."""
    order = np.sort(values)
    bits = order.view(np.uint64)
    root = np.full(len(order), -1)
    left = np.arange(len(order))
    while len(left):
        first = left[0]
        root[first], left, front = first, left[1:], [first]
        while front and len(left):
            near = np.bitwise_count(bits[left] ^ bits[front.pop()]) <= distance
            front.extend(left[near].tolist())
            root[left[near]], left = first, left[~near]
    return np.stack([order, order[root]])


def _links(rows: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        pairs = [np.empty((2, 0), np.int64)]
        for cell in batch.column(0):
            found = close_groups(cell.values.to_numpy(zero_copy_only=False), distance)
            pairs.append(found[:, found[0] != found[1]])
        a, b = np.concatenate(pairs, axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def links(values: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of `values` (fp: long, distinct)
    that differ in at most `distance` bits.

    Values meet where they share a key. Keys of many values are cut into tiles of about `TILE`,
    and each tile also meets each other tile of its key; a step returns at most one edge per value.
    """
    keys = [
        F.lit(k << 58).bitwiseOR(_key(ranges)) for k, ranges in enumerate(block_masks(distance, SHARED_BLOCKS))
    ]
    keyed = values.select("fp", F.explode(F.array(*keys)).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    tiled = (
        keyed.join(sizes, "key")
        .withColumn("tiles", F.ceil(F.col("n") / TILE))
        .withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("tiles")))
    )
    tiles = written(
        tiled.groupBy("key", "tile").agg(F.collect_list("fp").alias("fps"), F.first("tiles").alias("tiles")),
        "tiles",
    )
    a, b = tiles.where("tiles > 1").alias("a"), tiles.where("tiles > 1").alias("b")
    across = a.join(b, F.expr("a.key = b.key AND a.tile < b.tile")).select(F.concat("a.fps", "b.fps").alias("fps"))
    within = tiles.where("size(fps) > 1").select("fps")
    return within.union(across).mapInArrow(lambda rows: _links(rows, distance), "a long, b long")


def _key(ranges: list[tuple[int, int]]) -> Column:
    """The bits of some ranges of a fingerprint, side by side."""
    key, shift = F.lit(0).cast("long"), 0
    for lo, hi in ranges:
        bits = F.shiftrightunsigned("fp", 64 - hi).bitwiseAND(F.lit((1 << (hi - lo)) - 1).cast("long"))
        key, shift = key.bitwiseOR(F.shiftleft(bits, shift)), shift + hi - lo
    return key


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    with_root: bool = False,
) -> DataFrame:
    """(id, fp, component) for each row of `docs`: the smallest id reachable over links; also
    `root`, the smallest fingerprint reachable, if asked for. Where ids repeat, two components may
    have the same smallest id, but not the same root.

    Rows whose fingerprints differ in at most `distance` bits are linked. Rows of equal text have
    equal fingerprints, so copies are one value in all steps before the last. Texts without words
    are linked with each other. Rows without an id take part; a component without any id has the
    component null. Repeated rows stay. Very long texts are taken whole. Other columns are not read,
    so their names may be those of the result. An empty table gives no rows.
    """
    rows = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    values = rows.groupBy("fp").agg(F.min("id").alias("least"))
    linked = components(links(values.select("fp"), distance))
    rooted = values.join(linked, values.fp == linked.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component"))
    found = rows.join(rooted.join(named, "root").select("fp", "component", "root"), "fp")
    return found.select("id", "fp", "component", *["root"] * with_root)
