"""A hidden Markov language model over words, trained by Baum-Welch on all texts.

Texts are kept in chunks of some million tokens with a vocabulary of their own. A round of Baum-Welch
joins each different word of a chunk with the word's row of the model, runs the scaled forward and
backward recursions over the chunk, and adds up the expected counts of words and transitions over
all chunks. A word is in a chunk's vocabulary once, so no word is hot in these joins and sums, and no
task or driver sees the whole vocabulary: what is gathered grows with the corpus, in rows by word.

Of a state's words, each gives up `discount` of its occurrences, and what is left over is spread over
all known words and one unknown word. Words of fewer than `MIN_COUNT` occurrences are too
rare for states of their own: they share the states of all such words, by their counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import at_once, texts, written

STATES = 8
ROUNDS = 3
MIN_COUNT = 50
STAY = 0.9  # probability of staying in a state before the first round
CHUNK_TOKENS = 1_500_000  # a longer text has a chunk of its own
ENCODED_TOKENS = 200_000  # that are kept as words at a time
WINDOW = 256  # tokens of a sequence in training; scoring takes texts whole
WINDOWS = 512  # that are trained on at a time
SEED = 17
LANES, FULL = 4, (1 << 15) - 1  # shares of a word's states in one number, and what stands for all of it
UNIT = 1024  # expected counts are added up as whole numbers of 1 / UNIT, in any order
END = b""  # no word is empty
CHUNKS_AT_ONCE = 1  # that a task gets in one batch
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))

# `texts` has the rest of a chunk as one cell, which rows of words can stand beside, see `_met`.
CHUNK = "chunk long, words array<binary>, texts binary"


class Texts(NamedTuple):
    """The texts of a chunk: by word how often it is learnt from; ids, whether held out, and where
    each ends; and all tokens as places in the chunk's words."""

    counts: pa.Array
    ids: pa.Array
    held: pa.Array
    ends: pa.Array
    tokens: pa.Array

    def packed(self) -> bytes:
        lists = [pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a) for a in self]
        batch = pa.RecordBatch.from_arrays(lists, list(self._fields))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(batch)
        return sink.getvalue().to_pybytes()

    @classmethod
    def unpacked(cls, cell: pa.Scalar) -> Texts:
        batch = pa.ipc.open_stream(cell.as_buffer()).read_next_batch()
        return cls(*(c[0].values for c in batch.columns))

    def learnt(self, emission: np.ndarray, moves: np.ndarray, first: np.ndarray) -> Counts:
        """Expected counts of the texts that are not held out, in windows."""
        tokens, ends = self.tokens.to_numpy(), self.ends.to_numpy()
        starts, sizes = _windows(self.held.to_numpy(zero_copy_only=False), ends)
        order = np.argsort(-sizes, kind="stable")  # sequences of like sizes together
        total = Counts.zeros(len(emission), len(first))
        single = [x.astype(np.float32, copy=False) for x in (emission, moves, first)]
        for at in range(0, len(order), WINDOWS):
            own = order[at : at + WINDOWS]
            add_expected(total, tokens, starts[own], sizes[own], *single)
        return total


def tokens_of(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space with A-Z lower-cased, then one end."""
    found = text.translate(_LOWER).split() if text else []
    found.append(END)
    return found


def held_out(key: Column) -> Column:
    """Rows that are not learnt from: the checksum of the id as text leaves 2 when divided by 7."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _encoded(split: list[list[bytes]]) -> pa.DictionaryArray:
    return pa.array(chain.from_iterable(split), pa.binary()).dictionary_encode()


def _chunk(key: int, ids: list[int | None], held: list[bool], sizes: list[int], parts: list[pa.DictionaryArray]) -> pa.RecordBatch:
    found = pa.chunked_array(parts).unify_dictionaries().combine_chunks()
    tokens = found.indices.to_numpy()
    learnt = np.repeat(~np.array(held, bool), sizes)
    counts = np.bincount(tokens[learnt], minlength=len(found.dictionary)).astype(np.int64)
    held = pa.array(held, pa.bool_())
    rest = Texts(pa.array(counts), pa.array(ids, pa.int64()), held, pa.array(np.cumsum(sizes)), found.indices)
    words = pa.ListArray.from_arrays(pa.array([0, len(counts)], pa.int32()), found.dictionary)
    cells = [pa.array([key]), words, pa.array([rest.packed()], pa.binary())]
    return pa.RecordBatch.from_arrays(cells, ["chunk", "words", "texts"])


def chunked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """All texts as a written table of chunks; tasks cut the rows they read."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = TaskContext.get().partitionId() << 32
        ids, held, sizes, split, parts, size, fresh = [], [], [], [], [], 0, 0
        for batch in rows:
            for i, own, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch.column(2)), strict=True):
                found = tokens_of(text)
                if ids and size + len(found) > CHUNK_TOKENS:
                    yield _chunk(key, ids, held, sizes, [*parts, _encoded(split)])
                    ids, held, sizes, split, parts, size, fresh, key = [], [], [], [], [], 0, 0, key + 1
                ids.append(i)
                held.append(own)
                sizes.append(len(found))
                split.append(found)
                size, fresh = size + len(found), fresh + len(found)
                if fresh > ENCODED_TOKENS:
                    parts.append(_encoded(split))
                    split, fresh = [], 0
        if ids:
            yield _chunk(key, ids, held, sizes, [*parts, _encoded(split)])

    key = F.col(id_col).cast("long")
    rows = docs.select(key.alias("id"), held_out(key).alias("held"), F.col(text_col).cast("string").alias("text"))
    return written(rows.mapInArrow(batches, CHUNK), "chunks")


class Counts(NamedTuple):
    """Expected counts of some sequences: by word and state, of transitions, of first states."""

    words: np.ndarray
    moves: np.ndarray
    first: np.ndarray

    @classmethod
    def zeros(cls, words: int, states: int) -> Counts:
        return cls(np.zeros((states, words)).T, np.zeros((states, states)), np.zeros(states))


def add_expected(
    total: Counts, tokens: np.ndarray, starts: np.ndarray, sizes: np.ndarray, emission: np.ndarray, moves: np.ndarray, first: np.ndarray
) -> None:
    """Scaled forward and backward recursions over sequences `tokens[start : start + size]`.

    `emission` has a row for each word; a row's scale does not matter. The sequences are worked on
    side by side, from the longest, so that those that go on at a step are the first ones.
    """
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    longest, states = int(sizes[0]), len(first)
    going = np.searchsorted(-sizes, -np.arange(longest), "left")  # sequences of more than t tokens
    place = np.append(0, np.cumsum(going))
    word = tokens[np.concatenate([starts[:n] + t for t, n in enumerate(going)])]
    seen = emission[word]
    forward, scale = np.empty((len(word), states), seen.dtype), np.empty((len(word), 1), seen.dtype)
    for t, n in enumerate(going):
        own = slice(place[t], place[t + 1])
        before = first if t == 0 else forward[place[t - 1] : place[t - 1] + n] @ moves
        now = before * seen[own]
        scale[own] = now.sum(1, keepdims=True)
        forward[own] = now / scale[own]
    backward = np.ones((going[-1], states), seen.dtype)
    pairs = np.zeros((states, states))
    for t in range(longest - 2, -1, -1):
        n, own = going[t + 1], slice(place[t + 1], place[t + 2])
        ahead = seen[own] * backward / scale[own]
        forward[own] *= backward  # from here on the probability of the states
        pairs += forward[place[t] : place[t] + n].T @ ahead
        backward = np.ones((going[t], states), seen.dtype)
        backward[:n] = ahead @ moves.T
    forward[: going[0]] *= backward
    for s in range(states):
        total.words[:, s] += np.bincount(word, forward[:, s], minlength=len(emission))
    total.moves[:] += pairs * moves
    total.first[:] += forward[: going[0]].sum(0, dtype=np.float64)


def _windows(held: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the sequences that are learnt from."""
    starts = np.append(0, ends[:-1])[~held]
    sizes = ends[~held] - starts
    number = -(-sizes // WINDOW)
    nth = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
    starts = np.repeat(starts, number) + nth * WINDOW
    return starts, np.minimum(WINDOW, np.repeat(sizes, number) - nth * WINDOW)


def _random_emission(words: list[bytes], states: int) -> np.ndarray:
    """A seeded share of each state in each word, the same in all chunks."""
    import xxhash

    own = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in words), np.uint64, len(words))
    found = np.empty((states, len(words)), np.float32).T
    for s in range(states):
        mixed = own ^ np.uint64((s + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
        mixed ^= mixed >> np.uint64(31)
        found[:, s] = -np.log(((mixed >> np.uint64(11)).astype(np.float64) + 1) / (1 << 53))
    return np.ascontiguousarray(found)


def _state_columns(states: int) -> list[str]:
    return [f"s{s}" for s in range(states)]


def _count_schema(states: int) -> str:
    return "word binary, n long, " + ", ".join(f"{c} long" for c in _state_columns(states))


# Rows beside those of words, which hold no blanks: rare words together, transitions, first states.
_RARE, _FIRST = b" rare", b" first"


def _move(state: int) -> bytes:
    return b" from %d" % state


def _count_rows(words: pa.Array, n: np.ndarray, counts: np.ndarray, found: Counts, rare: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The expected counts of a chunk: a row for each of `words`, and the others."""
    states = len(found.first)
    names = ["word", "n", *_state_columns(states)]
    whole = lambda x: pa.array(np.rint(x * UNIT).astype(np.int64))
    for at in range(0, len(words), 50_000):
        own = slice(at, at + 50_000)
        yield pa.RecordBatch.from_arrays([words[own], pa.array(n[own]), *(whole(counts[own, s]) for s in range(states))], names)
    other = np.vstack([rare, found.first, found.moves])
    keys = pa.array([_RARE, _FIRST, *map(_move, range(states))], pa.binary())
    zeros = pa.array(np.zeros(len(keys), np.int64))
    yield pa.RecordBatch.from_arrays([keys, zeros, *(whole(other[:, s]) for s in range(states))], names)


def _added(rows: DataFrame, states: int) -> DataFrame:
    """(word, n, s0, s1, ...): the counts of all chunks."""
    return written(rows.groupBy("word").agg(F.sum("n").alias("n"), *(F.sum(c).alias(c) for c in _state_columns(states))), "counts")


def first_round(chunks: DataFrame, states: int) -> DataFrame:
    """Counts after a round from random emissions. It needs no model, as the scale of a word's
    emissions does not matter; n is how often each word is in the texts that are learnt from."""
    moves = np.full((states, states), (1 - STAY) / max(1, states - 1))
    np.fill_diagonal(moves, STAY if states > 1 else 1.0)
    first = np.full(states, 1 / states)

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for i in range(batch.num_rows):
                words, own = batch.column(0)[i].values, Texts.unpacked(batch.column(1)[i])
                found = own.learnt(_random_emission(words.to_pylist(), states), moves, first)
                n = own.counts.to_numpy()
                known = np.flatnonzero(n)
                yield from _count_rows(words.take(pa.array(known)), n[known], found.words[known], found, np.zeros(states))

    with at_once(chunks.sparkSession, CHUNKS_AT_ONCE):
        return _added(chunks.select("words", "texts").mapInArrow(batches, _count_schema(states)), states)


def _share_columns(states: int) -> list[str]:
    return [f"p{i}" for i in range(-(-states // LANES))]


def _shared(counts: DataFrame, states: int) -> DataFrame:
    """(word, n, p0, ...): how the occurrences of frequent words are shared among the states, in units
    of 1 / FULL, LANES of them in a number."""
    total = sum((F.col(c) for c in _state_columns(states)), F.lit(0))
    lanes = [F.round(F.col(c) / total * FULL).cast("long") for c in _state_columns(states)]
    packed = []
    for i, name in enumerate(_share_columns(states)):
        number = F.lit(0).cast("long")
        for j, lane in enumerate(lanes[i * LANES : (i + 1) * LANES]):
            number = number.bitwiseOR(F.shiftleft(lane, 16 * j))
        packed.append(number.alias(name))
    often = ~F.col("word").startswith(F.lit(b" ")) & (F.col("n") >= MIN_COUNT)
    return counts.where(often).select("word", "n", *packed)


def _lane(state: int) -> Column:
    packed = F.shiftright(F.col(f"p{state // LANES}"), 16 * (state % LANES))
    return packed.bitwiseAND(F.lit(0xFFFF).cast("long")) / F.lit(float(FULL))


class Model(NamedTuple):
    """What all words have in common; the words' own rows are in the table `rows`, see `_shared`."""

    rows: DataFrame
    tokens: int  # N
    words: int  # V
    discount: float
    totals: np.ndarray  # expected tokens of each state
    spare: np.ndarray  # share of each state that goes to all words and the unknown one
    rare: np.ndarray  # share of each state in a rare word's occurrence
    moves: np.ndarray
    first: np.ndarray

    def shares(self, n: np.ndarray, own: np.ndarray) -> np.ndarray:
        """P(word | state) of words of the given counts; `own` has the expected counts, a row
        without any for the rare and the unknown."""
        tied = own.sum(1) == 0
        own = np.where(tied[:, None], n[:, None] * self.rare[None, :], own)
        kept = np.where(n > 0, 1 - self.discount / np.maximum(n, 1), 0.0)
        totals = np.where(self.totals > 0, self.totals, 1.0)
        return own * kept[:, None] / totals + self.spare / (self.words + 1)


def _normal(rows: np.ndarray) -> np.ndarray:
    """Rows that add up to one, with a little for what was not seen."""
    rows = np.maximum(rows, 0) + 1e-3
    return rows / rows.sum(-1, keepdims=True)


def estimated(lexicon: DataFrame, counts: DataFrame, states: int) -> Model:
    """The model from the counts of a round. `lexicon` has all words with their number; `counts`
    has rows for words, of which the frequent ones are used, and the others."""
    columns = _state_columns(states)
    word = ~F.col("word").startswith(F.lit(b" "))
    often = F.col("n") >= MIN_COUNT
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    sizes = lexicon.where(word).agg(
        total("n").alias("tokens"), F.count(F.lit(1)).alias("words"),
        total((F.col("n") == 1).cast("long")).alias("once"), total((F.col("n") == 2).cast("long")).alias("twice"),
        total((~often).cast("long")).alias("rare_words"), total(F.when(~often, F.col("n"))).alias("rare_tokens"),
    ).first()
    rows = written(_shared(counts, states), "shares")
    sums = rows.agg(
        *(total(F.col("n") * _lane(s)).alias(f"often_{c}") for s, c in enumerate(columns)),
        *(total(_lane(s)).alias(f"each_{c}") for s, c in enumerate(columns)),
    ).first()
    # The first round counts rare words one by one, later ones together.
    ones = counts.where(word & ~often).agg(*(total(c).alias(c) for c in columns)).first()
    others = {bytes(r["word"]): np.array([r[c] for c in columns]) / UNIT for r in counts.where(~word).collect()}  # states + 2 rows
    vector = lambda name: np.array([float(sums[f"{name}_{c}"]) for c in columns])
    zero = np.zeros(states)
    rare = np.array([float(ones[c]) for c in columns]) / UNIT + others.get(_RARE, zero)
    rare = rare * (sizes["rare_tokens"] / rare.sum() if rare.sum() else 0.0)
    totals = vector("often") + rare
    discount = sizes["once"] / max(1, sizes["once"] + 2 * sizes["twice"])
    discount = min(0.95, max(0.05, discount))
    per_token = rare / max(1, sizes["rare_tokens"])
    spare = discount * (vector("each") + per_token * sizes["rare_words"])
    spare = np.where(totals > 0, spare / np.where(totals > 0, totals, 1.0), 1.0)
    moves = np.stack([others.get(_move(s), zero) for s in range(states)])
    return Model(
        rows, sizes["tokens"], sizes["words"], discount, totals, spare, per_token,
        _normal(moves), _normal(others.get(_FIRST, zero)),
    )


def _met(chunks: DataFrame, rows: DataFrame, columns: list[str]) -> DataFrame:
    """All that a chunk needs, one row after the other within a partition: its texts, and `columns`
    of each of its words that `rows` has, with the word's place in the chunk."""
    asked = chunks.select("chunk", F.posexplode("words").alias("place", "word"))
    # A partition's rows of the model are fewer than the words asked for, and need no order.
    words = asked.join(rows.hint("shuffle_hash"), "word").select("chunk", "place", *columns)
    both = words.unionByName(chunks.select("chunk", "texts"), allowMissingColumns=True)
    return both.repartition("chunk").sortWithinPartitions("chunk")


def _chunks_of(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[Texts, pa.Table]]:
    """The texts of each chunk and the rows of its words."""
    held: list[pa.RecordBatch] = []

    def done() -> tuple[Texts, pa.Table]:
        table = pa.Table.from_batches(held)
        own = table["texts"].is_valid()
        return Texts.unpacked(table["texts"].filter(own)[0]), table.filter(pc.invert(own))

    for batch in rows:
        key = batch.column("chunk").to_numpy()
        cuts = np.flatnonzero(np.diff(key)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(key)], strict=True):
            if a < b:
                if held and held[0].column("chunk")[0].as_py() != key[a]:
                    yield done()
                    held.clear()
                held.append(batch.slice(a, b - a))
    if held:
        yield done()


def _by_place(rows: pa.Table, size: int, states: int) -> tuple[np.ndarray, np.ndarray]:
    """Count and expected counts of a chunk's words; zeros for those without a row."""
    n, own, place = np.zeros(size, np.int64), np.zeros((size, states)), rows["place"].to_numpy()
    n[place] = rows["n"].to_numpy()
    for i, name in enumerate(_share_columns(states)):
        packed = rows[name].to_numpy()
        for s in range(i * LANES, min(states, (i + 1) * LANES)):
            own[place, s] = (packed >> 16 * (s % LANES)) & 0xFFFF
    own *= (n / FULL)[:, None]
    return n, own


def next_round(chunks: DataFrame, model: Model) -> DataFrame:
    """Counts after a round from a model, of frequent words and of the others together."""
    states = len(model.first)
    fixed = model._replace(rows=None)

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts_of, words in _chunks_of(rows):
            n, own = _by_place(words, len(texts_of.counts), states)
            # Only the ratio of a word's states matters here, so rare words have one row.
            tied = fixed.shares(np.full(1, MIN_COUNT - 1), np.zeros((1, states)))
            emission = np.where((n > 0)[:, None], fixed.shares(n, own), tied)
            found = texts_of.learnt(emission, fixed.moves, fixed.first)
            place = words["place"].to_numpy()
            yield from _count_rows(
                words["word"].combine_chunks(), words["n"].to_numpy(), found.words[place], found, found.words[n == 0].sum(0)
            )

    columns = _state_columns(states)
    rows = _met(chunks, model.rows, ["word", "n", *_share_columns(states)]).mapInArrow(batches, _count_schema(states))
    return written(rows.groupBy("word").agg(F.max("n").alias("n"), *(F.sum(c).alias(c) for c in columns)), "counts")


def train(chunks: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """The model after some rounds of Baum-Welch over all texts that are not held out."""
    lexicon = first_round(chunks, states)
    model = estimated(lexicon, lexicon, states)
    for _ in range(rounds - 1):
        model = estimated(lexicon, next_round(chunks, model), states)
    # Every known word with its number; rare words have no states of their own.
    numbers = lexicon.where(~F.col("word").startswith(F.lit(b" "))).select("word", "n")
    columns = _share_columns(states)
    joined = numbers.join(model.rows.drop("n").hint("shuffle_hash"), "word", "left")
    zero = F.lit(0).cast("long")
    return model._replace(rows=joined.select("word", "n", *(F.coalesce(c, zero).alias(c) for c in columns)))


def log_likelihood(tokens: np.ndarray, ends: np.ndarray, emission: np.ndarray, moves: np.ndarray, first: np.ndarray) -> np.ndarray:
    """log10 of the probability of each sequence, by the scaled forward recursion over all of it."""
    starts = np.append(0, ends[:-1])
    order = np.argsort(starts - ends, kind="stable")
    starts, sizes = starts[order], (ends - starts)[order]
    total = np.zeros(len(order))
    if not len(order):
        return total
    going = np.searchsorted(-sizes, -np.arange(int(sizes[0])), "left")
    before = np.broadcast_to(first, (len(order), len(first)))
    for t, n in enumerate(going.tolist()):
        now = before[:n] * emission[tokens[starts[:n] + t]]
        scale = now.sum(1)
        total[:n] += np.log10(scale)
        before = (now / scale[:, None]) @ moves
    found = np.empty(len(order))
    found[order] = total
    return found


SCORED = "id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def score(chunks: DataFrame, model: Model) -> DataFrame:
    """A row for each text; base_score is that of single words with one added to each count."""
    states = len(model.first)
    fixed = model._replace(rows=None)

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts_of, words in _chunks_of(rows):
            n, own = _by_place(words, len(texts_of.counts), states)
            tokens, ends = texts_of.tokens.to_numpy(), texts_of.ends.to_numpy()
            sizes = np.diff(ends, prepend=0)
            base = np.log10((n + 1) / (fixed.tokens + fixed.words + 1))
            known, base = (np.add.reduceat(x[tokens], ends - sizes) for x in ((n > 0).astype(np.int64), base))
            scores = log_likelihood(tokens, ends, fixed.shares(n, own), fixed.moves, fixed.first)
            columns = [texts_of.ids, texts_of.held, *map(pa.array, (sizes, known, base, scores))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    return _met(chunks, model.rows, ["n", *_share_columns(states)]).mapInArrow(batches, SCORED)


def score_texts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", states: int = STATES, rounds: int = ROUNDS
) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of `docs`,
    learnt from the rows that are not held out.

    Null and empty texts are one token, the end. Very long texts are scored whole, by one task each;
    in training they are cut into windows. Rows without an id are learnt from; every row is a
    text of its own, also if it repeats another. An empty table gives no rows. Other columns are
    not read. Reruns over the same files agree.
    """
    chunks = chunked(docs, id_col, text_col)
    model = train(chunks, states, rounds)
    tokens = F.lit(model.tokens).cast("long").alias("train_tokens")
    return score(chunks, model).select("id", "held_out", "n_tokens", "n_known", tokens, "base_score", "score")
