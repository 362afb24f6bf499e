"""Quality rules: counts over words and lines, and the perplexity under a character n-gram model.

The model is modified Kneser-Ney over `ORDER` characters, one for each language, counted over all
texts by Spark. Every string that occurs is stored as itself, in sorted arrays with the logarithms
beside them; the arrays are cut into parts by language and by the symbols in the middle of a string,
so that more strings make more parts, not larger ones. A text's perplexity is taken per word, leaving
out words of nothing but signs, which sets apart texts whose words carry or alternate with signs that
words do not have. Bands around the median of the language reject what is far above (noise, tables)
or far below (monotony).
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import at_once, texts, written
from ledgerlake.operators.joins import lookup_join

ORDER = 4
# A symbol is a UTF-16 unit, so that four of them are a long and no two characters are the same.
CHAR_BITS = 16
# Strings of a part of the model, and bytes of text that a task holds while it goes through parts.
PART_ROWS = 1 << 23
HELD_BYTES = 32 << 20
# Half the width of a band, in robust standard deviations and at least in bits per word.
WIDTH = 8.0
LEAST_SPREAD = 0.45
MIN_WORDS = 50
MAX_REPEATED = 50  # percent
PIECE_CHARS = 1 << 20
# Texts that a task gets in one batch; the JVM and the worker have each batch in memory, twice with `keep`.
ROWS_AT_ONCE = 1000
_SYMBOLS = b"#*$%&|<>"
_SIGNS = string.punctuation.encode()
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Metrics(NamedTuple):
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int


def metrics(text: bytes, words: list[bytes]) -> Metrics:
    """The counts of one text; `words` are its words."""
    chars = sum(map(len, words)) - sum(map(_more_bytes, words)) if not text.isascii() else sum(map(len, words))
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    seen: set[bytes] = set()
    repeated_lines = 0
    for line in text.split(b"\n"):
        if line in seen:
            repeated_lines += 1
        elif line.strip():
            seen.add(line)
    triples = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if len(set(triples)) < len(triples):
        often, marks = Counter(triples), bytearray(len(words))
        for i, triple in enumerate(triples):
            if often[triple] > 1:
                marks[i] = marks[i + 1] = marks[i + 2] = 1
        repeated = sum(marks)
    return Metrics(len(words), chars, symbols, repeated_lines, repeated)


_CONTINUED = bytes(range(0x80, 0xC0))


def _more_bytes(word: bytes) -> int:
    """Bytes of a word that do not begin a character."""
    return 0 if word.isascii() else len(word) - len(word.translate(None, _CONTINUED))


class Symbols:
    """Texts of one language as one row of symbols: three line feeds begin a text, words and the
    end are marked by blanks. `before` has the symbols that stand there in place of the line feeds
    where the first text is the rest of one."""

    def __init__(self, split: list[list[bytes]], order: int, before: np.ndarray | None = None):
        start = b"\n" * (order - 1)
        joined = "".join((start + b" ".join(words) + b" ").decode() for words in split if words)
        points = np.frombuffer(joined.encode("utf-16-le"), np.uint16).astype(np.int64)
        if before is not None and len(points):
            points[: order - 1] = before
        self.last = points[len(points) - order + 1 :]
        grams = np.zeros(max(0, len(points) - order + 1), np.int64)
        for i in range(order):
            grams = grams << CHAR_BITS | points[i : i + len(grams)]
        inside = points[order - 1 :] != 10
        self.grams = grams[inside]
        # A text's first string of symbols follows a place outside, or stands first.
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        self.starts = np.flatnonzero(begins[inside])


def _pieces(
    langs: list, rows: list[bytes | None], wanted: list[str | None] | None = None
) -> Iterator[tuple[str | None, list[int], list[list[bytes]]]]:
    """Rows of one of the `wanted` languages, split into words, some `PIECE_CHARS` bytes at a time."""
    for lang in dict.fromkeys(langs) if wanted is None else wanted:
        held, split, size = [], [], 0
        for i, (own, text) in enumerate(zip(langs, rows, strict=True)):
            if own != lang:
                continue
            held.append(i)
            split.append((text or b"").split())
            size += len(text or b"")
            if size > PIECE_CHARS:
                yield lang, held, split
                held, split, size = [], [], 0
        if held:
            yield lang, held, split


def _parts(split: list[list[bytes]], order: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Index of the first text, strings of symbols, and where each text's begin. A text of more than
    four `PIECE_CHARS` comes in parts that end at a word; a part begins with the last symbols of the
    part before it, so its strings are those of the whole text, whatever stands beside it."""
    sizes = [sum(map(len, w)) for w in split]
    if max(sizes, default=0) <= 4 * PIECE_CHARS:
        symbols = Symbols(split, order)
        yield -1, symbols.grams, symbols.starts
        return
    for i, (words, size) in enumerate(zip(split, sizes, strict=True)):
        step = PIECE_CHARS // 8 if size > 4 * PIECE_CHARS else max(1, len(words))
        before = None
        for at in range(0, len(words), step):
            symbols = Symbols([words[at : at + step]], order, before)
            before = symbols.last
            yield i, symbols.grams, symbols.starts


def gram_counts(docs: DataFrame, text_col: str, lang_col: str, order: int = ORDER) -> DataFrame:
    """(lang, gram, n) over all texts; a task adds up what it has read."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, list[tuple[np.ndarray, np.ndarray]]] = {}

        def added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            grams, back = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
            return grams, np.bincount(back, np.concatenate([n for _, n in parts])).astype(np.int64)

        def emitted() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                grams, n = added(parts)
                for i in range(0, len(grams), 100_000):
                    own = slice(i, i + 100_000)
                    langs = pa.array([lang] * len(grams[own]), pa.string())
                    yield pa.RecordBatch.from_arrays([langs, pa.array(grams[own]), pa.array(n[own])], ["lang", "gram", "n"])
            held.clear()

        for batch in rows:
            for lang, _, split in _pieces(batch.column(1).to_pylist(), list(texts(batch.column(0)))):
                parts = held.setdefault(lang, [])
                for _, grams, _ in _parts(split, order):
                    parts.append(np.unique(grams, return_counts=True))
                if len(parts) > 16:
                    parts[:] = [added(parts)]
            if sum(len(g) for parts in held.values() for g, _ in parts) > 4_000_000:
                yield from emitted()
        yield from emitted()

    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    counts = rows.mapInArrow(batches, "lang string, gram long, n long")
    return counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _key(lang: Column) -> Column:
    return F.coalesce(F.concat(F.lit("l"), lang), F.lit("n"))


def _discounts(counts: DataFrame) -> DataFrame:
    """d1, d2, d3 for each language, from how many strings occur once, twice, ..."""
    often = [F.sum((F.col("n") == k).cast("long")) for k in (1, 2, 3, 4)]
    rows = counts.groupBy("lang").agg(*(c.alias(f"n{k}") for k, c in enumerate(often, 1)))
    base = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))

    def discount(k: int) -> Column:
        value = k - (k + 1) * base * F.col(f"n{k + 1}") / F.col(f"n{k}")
        known = (F.col(f"n{k}") > 0) & (F.col(f"n{k + 1}") > 0) & (F.col("n1") > 0)
        return F.greatest(F.when(known, value).otherwise(F.lit(k / 2.0)), F.lit(0.05 * k))

    return rows.select("lang", *(discount(k).alias(f"d{k}") for k in (1, 2, 3)))


def train(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """Modified Kneser-Ney from (lang, gram, n): rows (lang, order, gram, n, p, gamma).

    The highest order uses counts, the lower ones in how many contexts a string occurs. p is
    interpolated down to the uniform distribution over the language's symbols; gamma is what the
    string leaves, as a context, to the next lower order.
    """
    levels = [written(counts.withColumn("lang", _key(F.col("lang"))), "grams")]
    for k in range(order - 1, 0, -1):
        shorter = F.col("gram").bitwiseAND(F.lit((1 << CHAR_BITS * k) - 1).cast("long"))
        shorter = levels[-1].select("lang", shorter.alias("gram"))
        levels.append(written(shorter.groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("n")), "grams"))
    lower = None
    done = []
    for k, level in enumerate(reversed(levels), 1):
        context = Window.partitionBy("lang", "context")
        d = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        rows = (
            lookup_join(level, written(_discounts(level), "discounts"), ["lang"])
            .withColumn("context", F.shiftrightunsigned("gram", CHAR_BITS))
            .withColumn("d", F.least(d, F.col("n")))
            .withColumn("total", F.sum("n").over(context))
            .withColumn("left", F.sum("d").over(context) / F.col("total"))
        )
        if lower is None:
            sizes = written(level.groupBy("lang").agg((1 / F.count(F.lit(1))).alias("below")), "sizes")
            rows = lookup_join(rows, sizes, ["lang"])
        else:
            rows = rows.withColumn("suffix", F.col("gram").bitwiseAND(F.lit((1 << CHAR_BITS * (k - 1)) - 1).cast("long")))
            below = lower.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("below"))
            rows = rows.join(below, ["lang", "suffix"])
        p = (F.col("n") - F.col("d")) / F.col("total") + F.col("left") * F.col("below")
        lower = written(rows.select("lang", "gram", "context", "n", p.alias("p"), "left"), "level")
        done.append(lower)
    rows = []
    for k, level in enumerate(done, 1):
        own = level.select("lang", F.lit(k).alias("order"), "gram", "n", "p")
        if k < order:
            gamma = done[k].groupBy("lang", F.col("context").alias("gram")).agg(F.first("left").alias("gamma"))
            own = own.join(gamma, ["lang", "gram"], "left")
        else:
            own = own.withColumn("gamma", F.lit(None).cast("double"))
        rows.append(own.select("lang", "order", "gram", "n", "p", F.coalesce("gamma", F.lit(1.0)).alias("gamma")))
    every = rows[0]
    for own in rows[1:]:
        every = every.union(own)
    return every


Table = dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]]


class Model(NamedTuple):
    """Parts of the model and where each language is: `shares` parts from `first` on. A part has, by
    language and length, the sorted strings with log2 of p, and of gamma, beside them.

    Of a language in several parts, one has all that the strings with its middles (see `share_of`)
    need, down to the shortest string.
    """

    order: int
    langs: np.ndarray
    first: np.ndarray
    shares: np.ndarray
    parts: list[Broadcast]
    unknown: float

    def place(self, lang: np.uint64) -> tuple[int, int]:
        at = int(np.searchsorted(self.langs, lang))
        if at == len(self.langs) or self.langs[at] != lang:
            return -1, 1
        return int(self.first[at]), int(self.shares[at])

    def wanted(self, langs: list[str | None]) -> Iterator[tuple[int, list[str | None], Table]]:
        """Each part that has one of the languages, and which; -1 for those that none has. Only one
        of several parts is in memory."""
        found: dict[int, list[str | None]] = {}
        for lang in dict.fromkeys(langs):
            first, shares = self.place(language(lang))
            for number in range(first, first + shares):
                found.setdefault(number, []).append(lang)
        for number, own in sorted(found.items()):
            yield number, own, self.parts[number].value if number >= 0 else {}
            if number >= 0 and len(self.parts) > 1 and getattr(self.parts[number], "_path", None):
                self.parts[number].__dict__.pop("_value", None)

    def log2(self, table: Table, number: int, lang: str | None, grams: np.ndarray) -> np.ndarray:
        """log2 of the probability of the last symbol of each string, given the others; zero for
        strings that another part has."""
        key, grams = language(lang), grams.view(np.uint64)
        first, shares = self.place(key)
        if shares == 1:
            return self._log2(table, int(key), grams)
        result = np.zeros(len(grams))
        own = share_of(middles(self.order, self.order, grams)[0], shares) == number - first
        result[own] = self._log2(table, int(key), grams[own])
        return result

    def _log2(self, table: Table, lang: int, grams: np.ndarray) -> np.ndarray:
        result = np.empty(len(grams))
        left, discount = np.arange(len(grams)), np.zeros(len(grams))
        for k in range(self.order, 0, -1):
            own = grams[left] & _mask(k)
            known, p, _ = _find(table, lang, k, own)
            result[left[known]] = p[known] + discount[left[known]]
            left, own = left[~known], own[~known]
            if not len(left):
                return result
            if k > 1:
                known, _, gamma = _find(table, lang, k - 1, own >> np.uint64(CHAR_BITS))
                discount[left] += np.where(known, gamma, 0)
        result[left] = self.unknown + discount[left]
        return result


def _find(table: Table, lang: int, k: int, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether each string occurs, and if so its log2 of p and gamma."""
    if (lang, k) not in table or not len(grams):
        return np.zeros(len(grams), bool), np.zeros(len(grams)), np.zeros(len(grams))
    strings, p, gamma = table[lang, k]
    at = np.minimum(np.searchsorted(strings, grams), len(strings) - 1)
    return strings[at] == grams, p[at], gamma[at]


def language(lang: str | None) -> np.uint64:
    return _hashed("n" if lang is None else "l" + lang)


def _hashed(key: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(key.encode()))


def _mask(k: int) -> np.uint64:
    return np.uint64((1 << CHAR_BITS * max(0, k)) - 1)


def middles(order: int, k: int, grams: np.ndarray) -> list[np.ndarray]:
    """The middles, without first and last symbol, of the longest strings that need strings of `k`
    symbols as themselves, as a context, or to fall back on; none if that may be all of them."""
    inner = _mask(order - 2)
    if k == order:
        return [grams >> np.uint64(CHAR_BITS) & inner]
    return [grams >> np.uint64(CHAR_BITS), grams & inner] if k == order - 1 else []


def share_of(middle: np.ndarray, shares: int) -> np.ndarray:
    mixed = middle * _MIX
    mixed ^= mixed >> np.uint64(31)
    return (mixed * _MIX >> np.uint64(33)).astype(np.int64) % shares


def _dealt(model: Model, lang: np.uint64, k: int, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in `grams`, part) for each part that a string of `k` symbols belongs to."""
    (first, shares), every = model.place(lang), np.arange(len(grams))
    if shares == 1:
        return every, np.full(len(grams), first)
    own = [share_of(middle, shares) for middle in middles(model.order, k, grams)]
    if not own:
        return np.repeat(every, shares), first + np.tile(np.arange(shares), len(grams))
    at, share = [every], [own[0]]
    if len(own) > 1:
        at, share = [every, every[own[0] != own[1]]], [own[0], own[1][own[0] != own[1]]]
    return np.concatenate(at), first + np.concatenate(share)


def stored(trained: DataFrame, order: int = ORDER, part_rows: int = PART_ROWS) -> Model:
    """The model in parts of about `part_rows` strings, one after the other in the driver."""
    trained = written(trained, "model")
    sizes = trained.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("p").alias("least")).toArrow()
    keys = np.array([_hashed(lang) for lang in sizes["lang"].to_pylist()], np.uint64)
    by_key = np.argsort(keys)
    first, shares, parts, room = [], [], 0, 0
    for n in sizes["n"].to_numpy()[by_key].tolist():
        shares.append(-(-n // part_rows))
        if n > room:
            parts, room = parts + shares[-1], part_rows if shares[-1] == 1 else 0
        first.append(parts - shares[-1])
        room -= n if shares[-1] == 1 else 0
    least = min([-20.0, *np.log2(sizes["least"].to_numpy())])
    model = Model(order, keys[by_key], np.array(first, int), np.array(shares, int), [], float(least))

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            names = batch.column(0).dictionary_encode()
            codes, langs = names.indices.to_numpy(), [_hashed(lang) for lang in names.dictionary.to_pylist()]
            orders, grams = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            p, gamma = (np.log2(batch.column(i).to_numpy()).astype(np.float32) for i in (4, 5))
            for code, k in {*zip(codes.tolist(), orders.tolist(), strict=True)}:
                own = np.flatnonzero((codes == code) & (orders == k))
                at, part = _dealt(model, langs[code], k, grams[own].view(np.uint64))
                own = own[at]
                lang = np.full(len(own), langs[code], np.uint64).view(np.int64)
                cells = (part.astype(np.int32), lang, np.full(len(own), k, np.int8), grams[own], p[own], gamma[own])
                yield pa.RecordBatch.from_arrays([*map(pa.array, cells)], ["part", "lang", "order", "gram", "p", "gamma"])

    rows = trained.mapInArrow(batches, "part int, lang long, order byte, gram long, p float, gamma float")
    if parts > 1:
        rows = written(rows.repartitionByRange(parts, "part"), "parts")
    for number in range(parts):
        own = rows.where(F.col("part") == number) if parts > 1 else rows
        model.parts.append(trained.sparkSession.sparkContext.broadcast(_table(own.drop("part").toArrow())))
    return model


def _table(rows: pa.Table) -> Table:
    lang, k, grams, p, gamma = (rows[c].to_numpy() for c in ("lang", "order", "gram", "p", "gamma"))
    lang, grams = lang.view(np.uint64), grams.view(np.uint64)
    by_gram = np.lexsort((grams, k, lang))
    lang, k, grams, p, gamma = (c[by_gram] for c in (lang, k, grams, p, gamma))
    cuts = np.flatnonzero((lang[1:] != lang[:-1]) | (k[1:] != k[:-1])) + 1
    edges = zip([0, *cuts.tolist()], [*cuts.tolist(), len(lang)], strict=True)
    return {(int(lang[a]), int(k[a])): (grams[a:b].copy(), p[a:b].copy(), gamma[a:b].copy()) for a, b in edges if a < b}


def _held(rows: Iterator[pa.RecordBatch], least: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches of at least so many bytes of text."""
    held, size = [], 0
    for batch in rows:
        held.append(batch)
        size += batch.column(0).nbytes
        if size >= least:
            yield held
            held, size = [], 0
    if held:
        yield held


def score(docs: DataFrame, model: Model, keep: list[str], text_col: str, lang_col: str) -> DataFrame:
    """(row, lang, the metrics, bits): bits is the sum of -log2 of the probabilities, per word that
    is more than ASCII signs."""
    rows = docs.select(
        F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
        F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row"),
    )
    least = HELD_BYTES if len(model.parts) > 1 else 0

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _held(parts, least):
            langs = [lang for batch in group for lang in batch.column(1).to_pylist()]
            cells = [cell for batch in group for cell in texts(batch.column(0))]
            bits, found = np.full(len(langs), np.nan), [None] * len(langs)
            terms = np.ones(len(langs))
            for number, wanted, table in model.wanted(langs):
                for lang, held, split in _pieces(langs, cells, wanted):
                    if model.place(language(lang))[0] == number:
                        for i, words in zip(held, split, strict=True):
                            found[i] = metrics(cells[i] or b"", words)
                            terms[i] = max(1, len(words) - sum(not word.strip(_SIGNS) for word in words))
                    filled = [i for i, words in zip(held, split, strict=True) if words]
                    for first, grams, starts in _parts(split, model.order):
                        if len(starts):
                            sums = np.add.reduceat(model.log2(table, number, lang, grams), starts)
                            own = filled if first < 0 else [held[first]]
                            bits[own] = np.nan_to_num(bits[own]) - sums
            at = 0
            for batch in group:
                own = slice(at, at + batch.num_rows)
                at += batch.num_rows
                columns = [pa.array(c, pa.int64()) for c in zip(*found[own], strict=True)] or [pa.array([], pa.int64())] * 5
                per_word = pa.array(bits[own] / terms[own], from_pandas=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(2), batch.column(1), *columns, per_word], ["row", "lang", *Metrics._fields, "bits"]
                )

    row = rows.schema["row"].dataType.simpleString()
    fields = ", ".join(f"{c} long" for c in Metrics._fields)
    return rows.mapInArrow(batches, f"row {row}, lang string, {fields}, bits double")


def bands(scored: DataFrame, width: float = WIDTH, least_spread: float = LEAST_SPREAD) -> DataFrame:
    """(key, low, high) for each language: the median of the bits of its texts, give or take
    `width` robust standard deviations. Texts of equal bits, such as copies, count once."""
    values = scored.where("bits is not null").select(_key(F.col("lang")).alias("key"), F.round("bits", 6).alias("bits"))
    bins = values.distinct().withColumn("bin", F.floor(F.col("bits") * 100))
    bins = written(bins.groupBy("key", "bin").agg(F.count(F.lit(1)).alias("n")), "bins")
    middle = bins.groupBy("key").agg(F.percentile("bin", F.lit(0.5), F.col("n")).alias("middle"))
    middle = written(middle, "medians")
    away = lookup_join(bins, middle, ["key"]).withColumn("away", F.abs(F.col("bin") - F.col("middle")))
    spread = away.groupBy("key", "middle").agg(F.percentile("away", F.lit(0.5), F.col("n")).alias("away"))
    half = F.greatest(F.col("away") / 100 * 1.4826, F.lit(least_spread)) * width
    centre = (F.col("middle") + 0.5) / 100
    return spread.select("key", (centre - half).alias("low"), (centre + half).alias("high"))


def judge(
    docs: DataFrame,
    keep: list[str],
    text_col: str = "text",
    lang_col: str = "lang",
    order: int = ORDER,
    width: float = WIDTH,
) -> DataFrame:
    """Each row of `docs`: the columns `keep` as a struct `row`, the metrics, `bits`, `perplexity`
    (2 to the bits, per word), `base_failed` and `kept`.

    Fewer than `MIN_WORDS` words, or more than half of the words in repeated triples, fail the
    base rules. A text is kept if it does not, and its bits lie in the band of its language; the
    band comes from the texts that pass the base rules. Null and empty texts have no words and
    fail. Null is a language of its own. Repeated rows are judged each. Very long texts are judged
    whole, whichever rows stand beside them. No rows give no rows.
    """
    with at_once(docs.sparkSession, ROWS_AT_ONCE):
        trained = train(gram_counts(docs, text_col, lang_col, order), order)
    model = stored(trained, order)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    with at_once(docs.sparkSession, ROWS_AT_ONCE):
        scored = written(score(docs, model, keep, text_col, lang_col).withColumn("base_failed", failed), "scored")
    limits = written(bands(scored.where("NOT base_failed"), width), "bands")
    judged = lookup_join(scored.withColumn("key", _key(F.col("lang"))), limits, ["key"], "left")
    inside = F.coalesce(F.col("bits").between(F.col("low"), F.col("high")), F.lit(False))
    return judged.select(
        "row",
        *Metrics._fields,
        "bits",
        F.pow(F.lit(2.0), "bits").alias("perplexity"),
        "base_failed",
        (~F.col("base_failed") & inside).alias("kept"),
    )
