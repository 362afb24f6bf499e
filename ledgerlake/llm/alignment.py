"""Alignment of two tokenizers' tokens by the bytes they cover, as columns of Arrow.

Token lists are flattened with the index of their document beside each token, a running sum of
token bytes within the document gives where each token ends, and a hash join on (document, end)
finds the places where both tokenizers cut. `Table.group_by` counts the linked pairs of a batch;
Spark adds up the counts.

Linked tokens end at the same byte, so the bytes of the shorter one are the last bytes of the other.
A token therefore has at most one possible partner for each of its lengths, and the different pairs of
any corpus are no more than the bytes of both vocabularies together: their table may be broadcast.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import texts, written

FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
PIECE_BYTES = 2 << 20  # of text that a task aligns at a time
ENCODED_BYTES = 1 << 15  # of text that a tokenizer gets as one
SHIFT = 32  # a pair is the first id times 2**SHIFT, plus the second one
END = 40  # a document's number times 2**END, plus where a token ends
_UNIT = re.compile(r"\s*\S+|\s+", re.ASCII)
# Texts that are not cut into units: those that end in white space, or have white space beyond
# ASCII or the second tokenizer's own sign for the space.
_WIDE = "".join(map(chr, [*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0x2581]))
_WHOLE = re.compile(rf"\s\Z|[{_WIDE}]")


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(FILE_A), public_tokenizers.path(FILE_B)


class ByteLevel:
    """A byte-level vocabulary; special tokens' strings are plain text to it."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # The alphabet: printable Latin-1 stands for itself, other bytes for signs from U+0100 on.
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = sorted(set(range(256)).difference(printable))
        byte_of = {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}
        vocabulary = self.tokenizer.get_vocab()
        found = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            found[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self.bytes = pa.array(found, pa.large_binary())

    def encode(self, spaced: list[str]) -> list[list[int]]:
        """The ids of texts that begin with a space."""
        return [x.ids for x in self.tokenizer.encode_batch_fast(spaced, add_special_tokens=False)]


class Pieces:
    """A vocabulary of pieces, with single bytes for what they lack; it adds the first space itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        found = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            found.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode())
        self.bytes = pa.array(found, pa.large_binary())

    def encode(self, spaced: list[str]) -> list[list[int]]:
        return self.model.encode([s[1:] for s in spaced], num_threads=1)


Coder = ByteLevel | Pieces
_coders: dict[tuple[str, str], tuple[ByteLevel, Pieces]] = {}


def coders(paths: tuple[str, str]) -> tuple[ByteLevel, Pieces]:
    """Both tokenizers, once for each worker process."""
    if paths not in _coders:
        _coders[paths] = ByteLevel(paths[0]), Pieces(paths[1])
    return _coders[paths]


class Tokens(NamedTuple):
    """The ids of some documents one after the other, and where those of each document end."""

    ids: np.ndarray
    ends: np.ndarray

    def without(self, dropped: np.ndarray) -> Tokens:
        sizes = np.diff(self.ends, prepend=0)
        return Tokens(self.ids[np.repeat(~dropped, sizes)], np.cumsum(np.where(dropped, 0, sizes)))


def _flat(lists: list) -> Tokens:
    ends = np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)))
    return Tokens(np.concatenate([np.empty(0, np.int32), *(np.asarray(x, np.int32) for x in lists)]), ends)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _units(coder: Coder, distinct: list[str], cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """The ids of different units one after the other, and how many come before each unit's end;
    None if some unit does not end with a token."""
    together, size = [[]], 0
    for unit in distinct:
        if size > ENCODED_BYTES and unit[0] == " ":
            together.append([])
            size = 0
        together[-1].append(unit)
        size += len(unit)
    ids = _flat(coder.encode(["".join(own) for own in together])).ids
    ends = np.cumsum(pc.binary_length(coder.bytes.take(pa.array(ids))).to_numpy())
    number = np.searchsorted(ends, cuts, "right")
    return (ids, number) if np.array_equal(np.append(0, ends)[number], cuts) else None


def tokenized(both: tuple[Coder, ...], spaced: list[str]) -> list[Tokens]:
    """The tokens of texts that begin with a space, by each of the tokenizers.

    No token goes from a sign over the white space behind it: the first tokenizer cuts there and the
    second one has no such piece. So texts are cut there into units, and each different unit is
    encoded once. Texts for which that is not so simple (`_WHOLE`) are encoded whole.
    """
    whole = [i for i, s in enumerate(spaced) if _WHOLE.search(s)]
    cut = list(map(_UNIT.findall, spaced))
    for i in whole:
        cut[i] = []
    sizes = np.fromiter(map(len, cut), np.int64, len(cut))
    flat = pa.array(chain.from_iterable(cut), pa.large_string()).dictionary_encode()
    place, distinct = flat.indices.to_numpy(), flat.dictionary.to_pylist()
    cuts = np.cumsum(pc.binary_length(flat.dictionary).to_numpy())
    found = []
    for coder in both:
        units = _units(coder, distinct, cuts) if distinct else (np.empty(0, np.int32), cuts)
        if units is None:
            found.append(_flat(coder.encode(spaced)))
            continue
        ids, number = units
        first = np.append(0, number)[:-1] if len(number) else number
        lengths = (number - first)[place]
        total = np.append(0, np.cumsum(lengths))
        tokens = Tokens(ids[_ranges(first[place], lengths)], total[np.cumsum(sizes)])
        if whole:
            lists = np.split(tokens.ids, tokens.ends[:-1])
            for i, own in zip(whole, coder.encode([spaced[i] for i in whole]), strict=True):
                lists[i] = own
            tokens = _flat(lists)
        found.append(tokens)
    return found


def _same_bytes(coder: Coder, tokens: Tokens, spaced: list[bytes]) -> np.ndarray:
    """Whether the joined bytes of each document's tokens are its text."""
    joined = coder.bytes.take(pa.array(tokens.ids))
    offsets, data = (np.frombuffer(b, kind) for b, kind in zip(joined.buffers()[1:], (np.int64, np.uint8), strict=True))
    at = offsets[np.append(0, tokens.ends)]
    data = memoryview(data)
    return np.array([data[a:b] == s for a, b, s in zip(at[:-1].tolist(), at[1:].tolist(), spaced, strict=True)], bool)


class Sides(NamedTuple):
    """Where the tokens of one tokenizer end, as columns of Arrow."""

    key: pa.Array  # the token's document and the byte behind it
    doc: pa.Array


def _ends(coder: Coder, tokens: Tokens) -> Sides:
    lists = pa.LargeListArray.from_arrays(pa.array(np.append(0, tokens.ends)), pa.array(tokens.ids))
    flat, doc = pc.list_flatten(lists), pc.list_parent_indices(lists)
    total = pc.cumulative_sum(pc.cast(pc.binary_length(coder.bytes.take(flat)), pa.int64()))
    before = pa.array(np.append(0, total.to_numpy())[np.append(0, tokens.ends[:-1])])  # of the document's first token
    end = pc.subtract(total, before.take(doc))
    return Sides(pc.add(pc.shift_left(doc, pa.scalar(END, pa.int64())), end), doc)


class Aligned(NamedTuple):
    """Links as positions of tokens in `a` and `b`, in order, with their document."""

    a: Tokens
    b: Tokens
    left: np.ndarray
    right: np.ndarray
    doc: np.ndarray


def align(both: tuple[Coder, Coder], spaced: list[str]) -> Aligned:
    """Links of texts that begin with a space. Texts whose tokens do not have their bytes get no
    tokens."""
    a, b = tokenized(both, spaced)
    raw = [s.encode() for s in spaced]
    same = np.logical_and(*(_same_bytes(c, t, raw) for c, t in zip(both, (a, b), strict=True)))
    if not same.all():
        a, b = a.without(~same), b.without(~same)
    one, other = (_ends(c, t) for c, t in zip(both, (a, b), strict=True))
    left = pa.table({"key": one.key, "left": pa.array(np.arange(len(a.ids))), "doc": one.doc})
    right = pa.table({"key": other.key, "right": pa.array(np.arange(len(b.ids)))})
    links = left.join(right, "key", join_type="inner", use_threads=False).sort_by("left")
    return Aligned(a, b, *(links[c].to_numpy() for c in ("left", "right", "doc")))


class _Digests:
    """Writes groups as `a1,a2|b1;a3|b2,b3`: each id has a string for each sign that may follow it."""

    def __init__(self, both: tuple[Coder, Coder]):
        n, m = (len(c.bytes) for c in both)
        self.second = 2 * n
        self.size = m
        strings = [f"{i}{sign}" for sign in ",|" for i in range(n)] + [f"{i}{sign}" for sign in (",", ";", "") for i in range(m)]
        self.strings = pa.array(strings, pa.large_binary())

    def of(self, found: Aligned) -> list[str]:
        """The hash of each document's groups; nothing for those without tokens."""
        a, b = found.a, found.b
        last_a, last_b = np.zeros(len(a.ids), np.int64), np.zeros(len(b.ids), np.int64)
        last_a[found.left], last_b[found.right] = 1, 1
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        code = np.empty(len(a.ids) + len(b.ids), np.int64)
        before_b = np.append(0, found.right + 1)[group_a]
        code[np.arange(len(a.ids)) + before_b] = a.ids + last_a * (self.second // 2)
        final = np.zeros(len(b.ids), np.int64)
        final[b.ends[np.diff(b.ends, prepend=0) > 0] - 1] = 1
        code[np.arange(len(b.ids)) + found.left[group_b] + 1] = self.second + b.ids + (last_b + final) * self.size
        written_out = self.strings.take(pa.array(code))
        offsets = np.frombuffer(written_out.buffers()[1], np.int64)
        data = memoryview(written_out.buffers()[2]) if len(code) else b""
        at = offsets[np.append(0, a.ends + b.ends)].tolist()
        return [hashlib.sha256(data[x:y]).hexdigest() if x < y else "" for x, y in zip(at[:-1], at[1:], strict=True)]


def _counted(columns: dict[str, pa.Array]) -> pa.Table:
    return pa.table(columns).group_by(list(columns), use_threads=False).aggregate([([], "count_all")])


ROW = "key long, id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"


def _rows(keys: np.ndarray, ids: pa.Array, found: Aligned, digests: list[str]) -> Iterator[pa.RecordBatch]:
    """A row for each document with its different pairs, and one without a key with those of all."""
    n = len(keys)
    pair = (found.a.ids[found.left].astype(np.int64) << SHIFT) + found.b.ids[found.right]
    per_doc = _counted({"doc": pa.array(found.doc), "pair": pa.array(pair)}).sort_by("doc")
    ends = pa.array(np.searchsorted(per_doc["doc"].to_numpy(), np.arange(n + 1)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(ends, per_doc[c].combine_chunks()) for c in ("pair", "count_all")]
    links = pa.array(np.bincount(found.doc, minlength=n).astype(np.int64))
    sizes = [pa.array(np.diff(t.ends, prepend=0)) for t in (found.a, found.b)]
    names = ["key", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
    # Every place where both cut ends one group, and one token of each.
    yield pa.RecordBatch.from_arrays([pa.array(keys), ids, *sizes, links, links, pa.array(digests, pa.string()), *lists], names)
    every = _counted({"pair": pa.array(pair)})
    ends = pa.array([0, every.num_rows], pa.int32())
    lists = [pa.ListArray.from_arrays(ends, every[c].combine_chunks()) for c in ("pair", "count_all")]
    none = [pa.nulls(1, kind) for kind in [pa.int64()] * 6 + [pa.string()]]
    yield pa.RecordBatch.from_arrays([*none, *lists], names)


def aligned_texts(docs: DataFrame, paths: tuple[str, str], id_col: str, text_col: str) -> DataFrame:
    """One row for each document, and rows without a key with the counts of a part of them."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = coders(paths)
        digests, key = _Digests(both), TaskContext.get().partitionId() << 40
        for batch in rows:
            # A null or empty text has no tokens, not even that of the space.
            cells = [b" " + t if t else b"" for t in texts(batch.column(1))]
            ends = np.cumsum([len(t) for t in cells])
            at = 0
            while at < len(cells):
                stop = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PIECE_BYTES, "right"))
                stop = max(at + 1, stop)
                found = align(both, [t.decode(errors="replace") for t in cells[at:stop]])
                keys = np.arange(key, key + stop - at)
                yield from _rows(keys, batch.column(0)[at:stop], found, digests.of(found))
                key, at = key + stop - at, stop

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return rows.mapInArrow(batches, ROW)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, count, best): how many links of the corpus hold a pair, and whether no pair of its
    second id is in more."""
    parts = aligned.where("key IS NULL").select(F.inline(F.arrays_zip("pairs", "times")))
    counts = written(parts.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("count")), "pairs")
    second = F.col("pair").bitwiseAND(F.lit((1 << SHIFT) - 1).cast("long"))
    counts = counts.withColumn("second", second)
    highest = counts.groupBy("second").agg(F.max("count").alias("highest"))
    found = counts.join(highest, "second").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    return written(found, "pairs")


def link_texts(
    docs: DataFrame, paths: tuple[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for each row of `docs`.

    `paths` names a byte-level vocabulary and one of pieces. Links join the tokens of both that end
    at the same byte of the text with a space before it. n_best counts the links whose pair no pair
    with the same second token exceeds in the corpus; count_sum adds up the counts of the links'
    pairs. The digest is that of the ids by groups.

    Null and empty texts, and texts that either vocabulary does not give back byte by byte (such as
    those with U+2581), have no tokens, zeros and an empty digest. Very long texts are aligned whole.
    Every row is a document of its own, also with a repeated or null id. An empty table gives no
    rows. Other columns are not read.
    """
    aligned = written(aligned_texts(docs, paths or default_paths(), id_col, text_col), "aligned")
    links = aligned.where("key IS NOT NULL").select("key", F.inline(F.arrays_zip("pairs", "times")))
    # No more pairs than bytes in both vocabularies, see above.
    counted = links.withColumnRenamed("pairs", "pair").join(F.broadcast(pair_counts(aligned)), "pair")
    sums = counted.groupBy("key").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(F.lit(0))).alias("n_best"),
        F.sum(F.col("times") * F.col("count")).alias("count_sum"),
    )
    rows = aligned.where("key IS NOT NULL").join(sums, "key", "left")
    zero = F.lit(0).cast("long")
    return rows.select(
        "id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )
