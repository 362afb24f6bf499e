"""Exact removal of repeated passages: suffix arrays over all texts, sorted shard by shard.

A string of `LENGTH` bytes that repeats has the same least hash of its inner strings of `GRAM`
bytes wherever it stands. So the strings of a text fall into stretches by that hash, equal strings
fall into stretches of equal hash, and stretches of one hash form a group that can be sorted apart
from all others. A hash that occurs once needs no sorting, and equal stretches count once. What is
left goes to shards, whose suffixes are sorted with their common prefixes (see `induced`).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import written
from ledgerlake.llm.induced import repeats

LENGTH = 100
GRAM = 32
# Text a task hashes at a time, stretches it compares with each other, text of one shard.
PIECE_BYTES = 4 << 20
BLOCK = 1_000_000
SHARD_BYTES = 6 << 20
# Different stretches of one hash in a block from which on strings are grouped one by one.
HOT = 64
# From so many on in the whole corpus, too.
GROUP = 4096
# Kinds of rows: a stretch of strings, bytes to remove, a string of its own, stretches of a group
# that is sorted, or whose strings are grouped one by one, and a stretch that may repeat itself.
STRETCH, COVER, SINGLE, SORT, HOT, LOOP = range(6)
_rng = np.random.default_rng(20)
_TABLE = _rng.integers(0, 1 << 63, 256, np.uint64)
_FACTORS = _rng.integers(0, 1 << 63, 7, np.uint64) * np.uint64(2) + np.uint64(1)
# A row's place, size and kind in one number.
AT, N = 24, 4
MOST = (1 << AT - N) - 1
_ROW = "key long, hash long, doc long, span long"


def _sliding(values: np.ndarray, wanted: int, pick: np.ufunc) -> np.ndarray:
    width = 1
    while width < wanted:
        step = min(width, wanted - width)
        values = pick(values[:-step], values[step:])
        width += step
    return values


def least_hashes(raw: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For each string of `length` bytes of `raw` the least hash of its strings of `gram` bytes,
    and the hashes that are the least one at two places of one stretch."""
    hashes, width = _TABLE[raw], 1
    for factor in _FACTORS[:-1]:
        step = min(width, gram - width)
        hashes = hashes[:-step] * factor + hashes[step:] if step else hashes
        width += step
    hashes ^= hashes >> np.uint64(29)
    hashes *= _FACTORS[-1]
    hashes ^= hashes >> np.uint64(32)
    wanted = length - gram + 1
    least = _sliding(hashes, wanted, np.minimum)
    zeros = np.zeros(wanted - 1, np.uint64)
    places = np.flatnonzero(hashes == _sliding(np.concatenate([zeros, least, zeros]), wanted, np.maximum))
    value = hashes[places]
    return least, np.unique(value[1:][value[1:] == value[:-1]])


def _rows(kind: int, key, hash_, doc, at, n) -> Iterator[pa.RecordBatch]:
    names = ["key", "hash", "doc", "span"]
    for i in range(0, len(doc), 100_000):
        key_, hash__, doc_, at_, n_ = (np.asarray(c)[i : i + 100_000].view(np.int64) for c in (key, hash_, doc, at, n))
        yield pa.RecordBatch.from_arrays([*map(pa.array, (key_, hash__, doc_, at_ << AT | n_ << N | kind))], names)


def _split(at: np.ndarray, n: np.ndarray, *others: np.ndarray) -> list[np.ndarray]:
    """Parts of at most `MOST` from each place on."""
    times = -(-n // MOST)
    rank = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    return [
        np.repeat(at, times) + rank * MOST,
        np.minimum(np.repeat(n, times) - rank * MOST, MOST),
        *(np.repeat(c, times) for c in others),
    ]


def _covers(doc: np.ndarray, at: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows for the bytes [at, at + n) of documents, overlaps joined."""
    order = np.lexsort((at, doc))
    doc, at, end = doc[order], at[order], (at + n)[order]
    new = np.ones(len(doc), bool)
    new[1:] = doc[1:] != doc[:-1]
    rank = np.cumsum(new) if len(doc) else new
    # Ends only grow within a document once the documents lie behind each other.
    far = int(end.max(initial=0)) + 1
    reach = np.maximum.accumulate(end + rank * far) - rank * far
    new[1:] |= at[1:] > reach[:-1]
    starts = np.flatnonzero(new)
    ends = reach[np.append(starts[1:], len(doc)) - 1] if len(starts) else reach
    at, n, doc = _split(at[starts], ends - at[starts], doc[starts])
    yield from _rows(COVER, doc, np.zeros_like(doc), doc, at, n)


def _first(key: np.ndarray, hash_: np.ndarray, doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Marks the earliest of the entries of equal key and hash."""
    order = np.lexsort((at, doc, hash_, key))
    first = np.ones(len(key), bool)
    same = (key[order[1:]] == key[order[:-1]]) & (hash_[order[1:]] == hash_[order[:-1]])
    first[order[1:]] = ~same
    return first


def _singles(data: bytes, src: np.ndarray, n: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of hash for each string of the stretches."""
    strings = [data[i : i + length] for a, k in zip(src.tolist(), n.tolist(), strict=True) for i in range(a, a + k)]
    key = np.fromiter((xxhash.xxh3_64_intdigest(s, 1) for s in strings), np.uint64, len(strings))
    return key, np.fromiter((xxhash.xxh3_64_intdigest(s, 2) for s in strings), np.uint64, len(strings))


class Block:
    """The stretches of some documents of a task."""

    def __init__(self, length: int, gram: int):
        self.length, self.gram = length, gram
        self.clear()

    def clear(self) -> None:
        self.size, self.bytes, self.data, self.parts = 0, 0, [], []

    def add(self, raw: np.ndarray, starts: np.ndarray, docs: np.ndarray, shift: int = 0) -> None:
        """The texts that begin at `starts` in `raw` and end where the next one begins; `shift` is
        the place in its document where the first one begins."""
        if len(raw) < self.length:
            return
        least, twice = least_hashes(raw, self.length, self.gram)
        ends = np.append(starts[1:], len(raw))
        last = ends - self.length + 1
        fits = last > starts
        step = np.zeros(len(least) + 1, np.int8)
        step[starts[fits]] += 1
        np.add.at(step, last[fits], -1)
        inside = np.cumsum(step[:-1], dtype=np.int8).astype(bool)
        cut = np.ones(len(least), bool)
        cut[1:] = (least[1:] != least[:-1]) | (inside[1:] != inside[:-1])
        cut[starts[fits]] = True
        src = np.flatnonzero(cut)
        n = np.diff(np.append(src, len(least)))
        src, n = _split(src[inside[src]], n[inside[src]])
        owner = np.flatnonzero(fits)[np.searchsorted(starts[fits], src, "right") - 1]
        data, digest, more = raw.tobytes(), xxhash.xxh3_64_intdigest, self.length - 1
        spans = zip(src.tolist(), (src + n + more).tolist(), strict=True)
        hashes = np.fromiter((digest(data[a:b]) for a, b in spans), np.uint64, len(src))
        place = src - starts[owner] + shift
        self.parts.append((least[src], hashes, docs[owner], place, n, src + self.bytes, np.isin(least[src], twice)))
        self.data.append(data)
        self.bytes += len(data)
        self.size += len(src)

    def rows(self) -> Iterator[pa.RecordBatch]:
        """What the block tells the others: equal stretches and strings once, the rest to remove."""
        if not self.size:
            return
        key, hash_, doc, at, n, src, loop = map(np.concatenate, zip(*self.parts, strict=True))
        data, more = b"".join(self.data), self.length - 1
        self.clear()
        keep = _first(key, hash_, doc, at)
        yield from _covers(doc[~keep], at[~keep], n[~keep] + more)
        key, hash_, doc, at, n, src, loop = (c[keep] for c in (key, hash_, doc, at, n, src, loop))
        names, group, sizes = np.unique(key, return_inverse=True, return_counts=True)
        hot = (sizes > HOT)[group]
        for kind, chosen in ((STRETCH, ~hot & ~loop), (LOOP, ~hot & loop)):
            yield from _rows(kind, *(c[chosen] for c in (key, hash_, doc, at, n)))
        names, zeros = names[sizes > HOT], np.zeros((sizes > HOT).sum(), np.int64)
        yield from _rows(STRETCH, names, zeros, zeros, zeros, zeros)
        if hot.any():
            key, hash_ = _singles(data, src[hot], n[hot], self.length)
            doc, start, n = np.repeat(doc[hot], n[hot]), np.repeat(at[hot] - np.cumsum(n[hot]) + n[hot], n[hot]), n[hot]
            at = start + np.arange(len(key))
            keep = _first(key, hash_, doc, at)
            yield from _covers(doc[~keep], at[~keep], np.full((~keep).sum(), self.length))
            yield from _rows(SINGLE, *(c[keep] for c in (key, hash_, doc, at)), np.ones(keep.sum(), np.int64))


def stretches(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """Rows of kinds STRETCH, LOOP, COVER and SINGLE for docs (doc, text). Of a group that is hot in a
    block, the block gives the strings one by one, and an empty stretch that tells the others."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(length, gram)
        for batch in rows:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            text = batch.column(1).cast(pa.large_binary()).fill_null(b"")
            _, offsets, data = text.buffers()
            offsets = np.frombuffer(offsets, np.int64)[text.offset : text.offset + len(text) + 1]
            data = np.frombuffer(data or b"", np.uint8)
            i = 0
            while i < len(ids):
                j = int(np.searchsorted(offsets, offsets[i] + PIECE_BYTES, "right")) - 1
                if j > i:
                    block.add(data[offsets[i] : offsets[j]], offsets[i:j] - offsets[i], ids[i:j])
                else:
                    j, end = i + 1, int(offsets[i + 1])
                    for a in range(int(offsets[i]), end - length + 1, PIECE_BYTES):
                        raw = data[a : min(end, a + PIECE_BYTES + length - 1)]
                        block.add(raw, np.zeros(1, np.int64), ids[i:j], a - int(offsets[i]))
                i = j
                if block.size >= BLOCK:
                    yield from block.rows()
        yield from block.rows()

    return docs.select("doc", "text").mapInArrow(batches, _ROW)


def sift(rows: DataFrame, length: int) -> DataFrame:
    """(kind, key, hash, doc, at, n): what is known once all blocks meet. Equal stretches and
    strings become one, with the bytes of the others to remove; stretches that are alone under
    their hash go, unless they may repeat themselves; the others get the kind SORT, or HOT where
    the group is."""
    span = F.col("span")
    kind, n = span.bitwiseAND(F.lit((1 << N) - 1).cast("long")), F.shiftright(span, N).bitwiseAND(F.lit(MOST).cast("long"))
    place, empty = F.struct("doc", "span"), F.shiftright(span, N) == 0
    same = Window.partitionBy("family", "key", "hash")
    group = Window.partitionBy("family", "key")
    real = F.when(~empty, F.col("hash"))
    known = (
        rows.withColumn("family", F.when(kind == LOOP, F.lit(STRETCH)).otherwise(kind))
        .repartition("family", "key")  # once for both windows
        .withColumn("first", place == F.min(place).over(same))
        .withColumn("mixed", F.min(real).over(group) < F.max(real).over(group))
        .withColumn("hot", F.max(empty).over(group) | (F.count(F.lit(1)).over(group) > GROUP))
    )
    cover = kind.isin(COVER) | ~F.col("first")
    become = (
        F.when(empty, F.lit(None))
        .when(cover, F.lit(COVER))
        .when(kind == SINGLE, F.lit(SINGLE))
        .when(F.col("hot"), F.lit(HOT))
        .when(F.col("mixed") | (kind == LOOP), F.lit(SORT))
    )
    size = F.when(cover & (kind != COVER), n + (length - 1)).otherwise(n)
    found = known.select(become.alias("kind"), "key", "hash", "doc", F.shiftright(span, AT).alias("at"), size.alias("n"))
    return found.where("kind is not null")


_PARTS = pa.schema(
    [("kind", pa.int32()), *((c, pa.int64()) for c in ("key", "hash", "doc", "at", "n")), ("bytes", pa.binary())]
)
_PARTS_DDL = "kind int, key long, hash long, doc long, at long, n long, bytes binary"


def fetch(docs: DataFrame, found: DataFrame, length: int) -> DataFrame:
    """The stretches to sort with their bytes, and the strings of hot groups with two hashes."""
    wanted = found.where(F.col("kind").isin(SORT, HOT)).groupBy("doc")
    wanted = wanted.agg(F.collect_list(F.struct("kind", "key", "at", "n")).alias("parts"))

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            out: list[tuple] = []
            size = 0
            for doc, text, parts in zip(columns["doc"], columns["text"], columns["parts"], strict=True):
                data, doc = text.cast(pa.binary()).as_py(), doc.as_py()
                kind, key, at, n = (parts.values.field(i).to_numpy(zero_copy_only=False) for i in range(4))
                for k, a, m in zip(*(c[kind == SORT].tolist() for c in (key, at, n)), strict=True):
                    out.append((SORT, k, 0, doc, a, m, data[a : a + m + length - 1]))
                    size += m + length
                hot = kind == HOT
                if hot.any():
                    keys, hashes = (c.view(np.int64).tolist() for c in _singles(data, at[hot], n[hot], length))
                    spans = zip(at[hot].tolist(), n[hot].tolist(), strict=True)
                    places = (i for a, m in spans for i in range(a, a + m))
                    out += [(SINGLE, k, h, doc, i, 1, None) for k, h, i in zip(keys, hashes, places, strict=True)]
                if len(out) > 50_000 or size > PIECE_BYTES:
                    yield _batch(out)
                    out, size = [], 0
            yield _batch(out)

    return docs.join(wanted, "doc").mapInArrow(batches, _PARTS_DDL)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(_PARTS)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, _PARTS, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=_PARTS)


def sort_shards(parts: DataFrame, length: int) -> DataFrame:
    """(doc, at, n): the bytes of what starts earlier too. All rows of a key come to one task,
    which sorts shards of whole groups and compares single strings by their hashes."""

    def shard(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        doc, at, n, data = zip(*rows, strict=True)
        doc, at, n = np.array(doc), np.array(at), np.array(n)
        order = np.lexsort((at, doc))
        doc, at, n = doc[order], at[order], n[order]
        segment, offset = repeats([data[i] for i in order], n, length)
        yield from placed(doc[segment], at[segment] + offset, np.full(len(segment), length))

    def placed(doc: np.ndarray, at: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for batch in _covers(doc, at, n):
            span = batch.column(3).to_numpy()
            arrays = [batch.column(2), pa.array(span >> AT), pa.array(span >> N & MOST)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc", "at", "n"])

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last, single = [], 0, None, None
        for batch in rows:
            later = []
            for kind, key, hash_, *part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind == SINGLE:
                    if single == (key, hash_):
                        later.append(part[:2])
                    single = (key, hash_)
                    continue
                if size > SHARD_BYTES and key != last:
                    yield from shard(held)
                    held, size = [], 0
                last = key
                held.append(part)
                size += len(part[3])
            if later:
                doc, at = np.array(later).T
                yield from placed(doc, at, np.full(len(doc), length))
        if held:
            yield from shard(held)

    dealt = parts.repartition("key").sortWithinPartitions("key", "kind", "hash", "doc", "at")
    return dealt.mapInArrow(batches, "doc long, at long, n long")


def covers(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc, at, n): bytes of docs (doc: unique, text, ...) that a string of `length` bytes covers
    which starts earlier too; the parts may overlap."""
    found = written(sift(stretches(docs, length, gram), length), "stretches")
    singles = found.where(F.col("kind") == SINGLE).withColumn("bytes", F.lit(None).cast("binary"))
    parts = sort_shards(fetch(docs, found, length).unionByName(singles), length)
    return found.where(F.col("kind") == COVER).select("doc", "at", "n").union(parts)


def numbered(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """docs (id, text, ...) with `doc`, a number in the order of the ids, and one row of each doc.

    Ids that are there once are the numbers. Else rows are numbered in the order of (id, hash of
    the text), null ids last; rows equal in both have one number.
    """
    odd = docs.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("id is null or n > 1")
    if odd.isEmpty():
        named = docs.where("id is not null").select(F.col("id").alias("doc"), "text", "row")
        return named, named
    docs = docs.withColumn("hash", F.xxhash64("text"))
    order = [F.asc_nulls_last("id"), F.asc("hash")]
    keys = docs.select("id", "hash").distinct().repartitionByRange(*order).sortWithinPartitions(*order)
    keys = written(keys.withColumn("doc", F.monotonically_increasing_id()), "numbers")
    keys = keys.select(F.col("id").alias("key_id"), F.col("hash").alias("key_hash"), "doc")
    named = docs.join(keys, F.col("id").eqNullSafe(F.col("key_id")) & (F.col("hash") == F.col("key_hash")))
    named = named.select("doc", "text", "row")
    return named, named.dropDuplicates(["doc"])


def remove_repeats(
    docs: DataFrame,
    keep: list[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
) -> DataFrame:
    """Each row without the bytes that a string of `length` bytes covers which starts earlier too,
    in a row of smaller id or earlier in the same row: the columns `keep` as a struct `row`,
    `n_bytes`, `spans` (array of start and end of the removed runs), `kept_sha256` of what is left,
    and `kept`, the characters of which no byte is removed.

    All strings are judged on the whole input. A null text is empty, and `kept` is then null.
    Rows without an id come after all others. Rows equal in id and text are judged as one row and
    get the same result; of rows with one id and different texts, one counts as the earlier by the
    hash of its text. Texts shorter than `length` stay, very long ones are judged whole. `keep` may name
    any column. An empty table gives no rows.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(text_col).cast("string").alias("text"),
        F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row"),
    )
    named, unique = numbered(rows)
    parts = covers(unique, length, gram).groupBy("doc").agg(F.collect_list(F.struct("at", "n")).alias("parts"))
    joined = named.join(parts, "doc", "left")

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            found = [cut_out(text, parts) for text, parts in zip(columns["text"], columns["parts"], strict=True)]
            n_bytes, spans, digests, kept = zip(*found, strict=True) if found else ((), (), (), ())
            arrays = [
                columns["row"],
                pa.array(n_bytes, pa.int64()),
                pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                pa.array(digests, pa.string()),
                pa.array(kept, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["row", "n_bytes", "spans", "kept_sha256", "kept"])

    row = joined.schema["row"].dataType.simpleString()
    return joined.mapInArrow(
        batches, f"row {row}, n_bytes long, spans array<array<long>>, kept_sha256 string, kept string"
    )


def cut_out(text: pa.Scalar, parts: pa.Scalar) -> tuple[int, list[list[int]], str, str | None]:
    """Size, removed runs, digest of the rest, and the rest in whole characters."""
    data = b"" if text.as_py() is None else text.as_py().encode()
    if parts.values is None:
        return len(data), [], hashlib.sha256(data).hexdigest(), text.as_py()
    at, n = (parts.values.field(i).to_numpy(zero_copy_only=False) for i in range(2))
    order = np.argsort(at, kind="stable")
    at, reach = at[order], np.maximum.accumulate((at + n)[order])
    new = np.flatnonzero(np.append(True, at[1:] > reach[:-1]))
    spans = np.stack([at[new], reach[np.append(new[1:], len(at)) - 1]], axis=1).tolist()
    digest, kept, end = hashlib.sha256(), [], 0
    inner = lambda i: i < len(data) and data[i] & 0xC0 == 0x80
    for a, b in [*spans, [len(data), len(data)]]:
        digest.update(data[end:a])
        while inner(end):
            end += 1
        while inner(a):
            a -= 1
        kept.append(data[end:a] if end < a else b"")
        end = b
    return len(data), spans, digest.hexdigest(), b"".join(kept).decode()
