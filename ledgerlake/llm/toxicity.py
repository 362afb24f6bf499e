"""Toxicity by a string-kernel support vector machine over the words of sentences.

The kernel of two words compares the three-letter subsequences they share, letters within `SPAN`
places of each other, each weighted by `DECAY` to the power of its span. The start of a word counts
as a letter. Signs inside a word are gaps, and so are letters put in between, so that spread and
padded insults stay close to the plain ones. A sentence is as toxic as its worst word, so the machine
is trained on sentences as bags of words: in rounds, each labelled sentence is the row of the word
that the machine of the round before finds the worst in it. The label is that of a whole document;
sentences of a toxic one that hold no word that tells are not taken for toxic. Nyström
landmarks make the kernel a linear map, and as the kernel has explicit subsequences, the trained
machine is one weight for each of them. The decisions on a text's worst words, the sum of those on
all its words, and its length make its score, by a logistic fit to labelled texts.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import written


SPAN = 10
DECAY = 0.8
SYMBOLS = 128
LANDMARKS = 128
# An insult needs a landmark of at least this kernel; there are so many of insults at most.
NEAR = 0.6
MOST_MARKS = 512
# Bounds of the training sample: labelled documents of each class, sentences of each class, words
# of a sentence, distinct words taken as clean.
SAMPLE_DOCS = 4000
SAMPLE_SENTENCES = (60_000, 30_000)  # clean, toxic
SENTENCE_WORDS = 40
CLEAN_WORDS = 40_000
# Least logarithm of the likelihood ratio by which a beginning tells.
LEAST_RATIO = 14.0
# Worst words of a text that count one by one, and the decision below which all words are alike.
WORST = 3
FLOOR = -0.5
# Rounds in which labelled sentences choose their worst words.
ROUNDS = 4
# From this score on a text is predicted toxic.
THRESHOLD = 0.7
_CHUNK = 1 << 17
_PAIRS = [(j, k) for k in range(2, SPAN) for j in range(1, k)]


_OTHERS = 60


def _codes() -> np.ndarray:
    """Symbols by code point: 0 is a gap, then a-z, then Latin letters; others share the rest, so that
    the letters of an alphabet differ."""
    table = _OTHERS + np.arange(0x250, dtype=np.int64) % (SYMBOLS - _OTHERS)
    table[:0xC0] = 0
    for i, cp in enumerate(range(ord("a"), ord("z") + 1), 1):
        table[cp] = i
    table[0xDF:0x100] = 27 + np.arange(0x100 - 0xDF)
    table[[0xD7, 0xF7]] = 0
    return table


_TABLE = _codes()
_START = 59  # the symbol of y with dots, which hardly occurs


class Words(NamedTuple):
    """Words as rows of symbols; word i has those from starts[i] to starts[i + 1]."""

    symbols: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, words: pa.Array) -> Words:
        words = words.cast(pa.large_binary())
        _, offsets, data = words.buffers()
        offsets = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
        raw = np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]]
        points = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.int64)
        counts = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        symbols = np.where(points < len(_TABLE), _TABLE[np.minimum(points, len(_TABLE) - 1)], _OTHERS + points % (SYMBOLS - _OTHERS))
        starts = counts[offsets - offsets[0]]
        symbols = np.insert(symbols, starts[:-1], _START)
        return cls(symbols, starts + np.arange(len(starts)))

    def chunks(self) -> Iterator[tuple[int, int]]:
        """Ranges of words of about `_CHUNK` symbols."""
        a, n = 0, len(self.starts) - 1
        while a < n:
            b = max(a + 1, int(np.searchsorted(self.starts, self.starts[a] + _CHUNK, "right")) - 1)
            yield a, b
            a = b

    def features(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, subsequence, weight) for the words a to b: each subsequence of a word once, the
        weights of a word with the norm one."""
        s = self.symbols[self.starts[a] : self.starts[b]]
        word = np.repeat(np.arange(b - a), np.diff(self.starts[a : b + 1]))
        keys, weights = [], []
        for j, k in _PAIRS:
            at = np.flatnonzero((word[k:] == word[: len(word) - k]) & (s[k:] > 0) & (s[: len(s) - k] > 0) & (s[j : len(s) - k + j] > 0)) if len(s) > k else np.empty(0, np.int64)
            keys.append(((word[at] * SYMBOLS + s[at]) * SYMBOLS + s[at + j]) * SYMBOLS + s[at + k])
            weights.append(np.full(len(at), DECAY ** (k + 1)))
        key, weight = np.concatenate(keys), np.concatenate(weights)
        order = np.argsort(key)
        key, weight = key[order], weight[order]
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
        if not len(starts):
            return key, key, weight
        key, weight = key[starts], np.add.reduceat(weight, starts)
        word, part = np.divmod(key, SYMBOLS**3)
        norm = np.sqrt(np.bincount(word, weight * weight, b - a))
        return word, part, weight / norm[word]


class Machine(NamedTuple):
    """The decision on a word is the product with `weights`, plus `bias`. `mix` makes the worst
    decisions of a text and its length a score between 0 and 1."""

    weights: np.ndarray
    bias: float
    mix: np.ndarray

    def decide(self, words: Words) -> np.ndarray:
        parts = []
        for a, b in words.chunks():
            word, part, weight = words.features(a, b)
            parts.append(np.bincount(word, weight * self.weights[part], b - a) + self.bias)
        return np.concatenate(parts) if parts else np.empty(0)

    def evidence(self, texts: pa.Array) -> np.ndarray:
        """For each text its `WORST` worst decisions, none below `FLOOR` or above one, the logarithm of
        the sum of all decisions above zero, that of its words, and a one."""
        names, at, starts = units(texts)
        value = self.decide(Words.of(names))[at]
        result = np.full((len(texts), WORST + 3), FLOOR)
        result[:, -2], result[:, -1] = np.log1p(np.diff(starts)), 1
        place = np.flatnonzero(value > FLOOR)
        doc, value = np.searchsorted(starts, place, "right") - 1, np.minimum(value[place], 1.0)
        result[:, -3] = np.log1p(np.bincount(doc, np.maximum(value, 0.0), len(texts)))
        order = np.lexsort((-value, doc))
        doc, value = doc[order], value[order]
        rank = np.arange(len(doc)) - np.searchsorted(doc, doc)
        own = rank < WORST
        result[doc[own], rank[own]] = value[own]
        return result

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(evidence @ self.mix, -500, 500)))


def never() -> Machine:
    """A machine that finds nothing."""
    return Machine(np.zeros(SYMBOLS**3, np.float32), FLOOR, np.append(np.zeros(WORST + 2), -10.0))


def units(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct lower-case words (one of them empty, where a text is or begins with a blank), the number of the word at each place of all texts, and where
    each text's places begin. Three and more single letters in a row are a word of their own."""
    split = pc.ascii_split_whitespace(pc.utf8_lower(texts.cast(pa.large_string()).fill_null("")))
    found = split.flatten().dictionary_encode()
    at, starts = found.indices.to_numpy().astype(np.int64), split.offsets.to_numpy().astype(np.int64)
    starts = starts - starts[0]
    names = found.dictionary
    short = (pc.utf8_length(names).to_numpy() == 1) & pc.utf8_is_alpha(names).to_numpy(zero_copy_only=False)
    spread = short[at] if len(at) else np.empty(0, bool)
    edges = np.concatenate([[False], spread, [False]])
    inner = starts[(starts > 0) & (starts < len(at))]
    change = edges[1:] != edges[:-1]
    change[inner] |= spread[inner] & spread[inner - 1]
    cuts = np.flatnonzero(change)
    runs = [(a, b) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True) if b - a >= 3 and spread[a]]
    if runs:
        letters = names.to_pylist()
        joined = pa.array(["".join(letters[i] for i in at[a:b]) for a, b in runs], names.type)
        doc = np.searchsorted(starts, [a for a, _ in runs], "right") - 1
        at = np.insert(at, starts[doc + 1], len(names) + np.arange(len(runs)))
        starts = starts + np.searchsorted(doc, np.arange(len(starts)), "left")
        names = pa.concat_arrays([names, joined])
    return names, at, starts


def sentences(text: str) -> Iterator[str]:
    """The sentences of a text in lower case, cut after `SENTENCE_WORDS` words."""
    for sign in "!?\n":
        text = text.replace(sign, ".")
    for sentence in text.lower().split(". "):
        for part in sentence.split(".\n"):
            words = part.split()
            for i in range(0, len(words), SENTENCE_WORDS):
                yield " ".join(words[i : i + SENTENCE_WORDS])


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(toxic, text) of up to `SAMPLE_DOCS` labelled documents of each class, chosen by hash. Of an id
    with several texts the first in order is taken."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    by_hash = [labels.where(F.col("toxic") == x).orderBy(F.xxhash64("id"), "id").limit(SAMPLE_DOCS) for x in (0, 1)]
    chosen = by_hash[0].union(by_hash[1])
    known = texts.join(F.broadcast(chosen), "id").groupBy("id", F.col("toxic").cast("int").alias("toxic"))
    return known.agg(F.min("text").alias("text")).select("toxic", "text")


def labelled_sentences(sample: DataFrame) -> list[tuple[str, int]]:
    """Distinct sentences of sample (toxic, text) with the label of their document: up to
    `SAMPLE_SENTENCES` of each class, chosen by hash, none that has both labels."""

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            texts = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            found = [(x, s) for x, t in texts for s in sentences(t or "")]
            toxic, text = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(toxic, pa.int32()), pa.array(text, pa.string())], ["toxic", "text"])

    rows = sample.mapInArrow(cut, "toxic int, text string").groupBy("text")
    rows = rows.agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).where("toxic = most")
    found = []
    for x, most in enumerate(SAMPLE_SENTENCES):
        own = rows.where(F.col("toxic") == x).orderBy(F.xxhash64("text"), "text").limit(most)
        found += [(r["text"], x) for r in own.collect()]
    return sorted(found)


def witnesses(sample: list[tuple[str, int]]) -> tuple[list[str], list[str]]:
    """Words that make a sentence toxic, and clean words, the most frequent first.

    A sentence has the label of its document, so most toxic ones hold no insult. The beginnings of
    words tell: a word is a witness if it has a beginning that is found in toxic sentences far more
    often than chance has it, by the likelihood ratio, and hardly in clean ones.
    """
    sizes, words = Counter(x for _, x in sample), (Counter(), Counter())
    for sentence, x in sample:
        words[x].update(set(sentence.split()))
    share = sizes[1] / max(1, sizes[0] + sizes[1])
    counts: dict[str, list[int]] = {}
    for x in (0, 1):
        for word, n in words[x].items():
            for start in beginnings(word):
                counts.setdefault(start, [0, 0])[x] += n

    def telling(clean: int, toxic: int) -> bool:
        ratio = toxic * np.log(toxic / ((clean + toxic) * share)) if toxic else 0.0
        ratio += clean * np.log(clean / ((clean + toxic) * (1 - share))) if clean else 0.0
        return clean <= 0.01 * toxic and ratio >= LEAST_RATIO

    good = {start for start, n in counts.items() if telling(*n)}
    insults = [w for w, n in words[1].most_common() if n > 50 * words[0][w] and good.intersection(beginnings(w))]
    clean = [w for w, n in sorted(words[0].items(), key=lambda x: (-x[1], x[0]))]
    return insults, clean


def beginnings(word: str) -> list[str]:
    """The beginnings of a word of three letters and more, without signs."""
    letters = "".join(c for c in word if c.isalpha())
    return [letters[:i] for i in range(3, len(letters) + 1)]


def padded(word: str, seed: int) -> str:
    """A word with a letter or a sign put in, as a rule fixed by the word."""
    h = zlib.crc32(f"{seed}-{word}".encode())
    at = 1 + h % max(1, len(word) - 1)
    return word[:at] + "xz*.-_jq"[h // 64 % 8] + word[at:]


def spread_marks(insults: list[str], least: int) -> list[str]:
    """Landmarks among insults, the most frequent of which come first: the one that is farthest from
    the landmarks so far, until each insult has one near it, and then the most frequent ones."""
    words = Words.of(pa.array(insults, pa.large_string()))
    found = [words.features(a, b) for a, b in words.chunks()]
    word = np.concatenate([w + a for (w, _, _), (a, _) in zip(found, words.chunks(), strict=True)])
    part, weight = (np.concatenate([f[i] for f in found]) for i in (1, 2))
    starts = np.searchsorted(word, np.arange(len(insults) + 1))
    near, chosen = np.zeros(len(insults)), []
    near[np.diff(starts) == 0] = 1  # words of hardly any letter
    mark = np.zeros(SYMBOLS**3)
    while len(chosen) < MOST_MARKS and near.min() < NEAR:
        chosen.append(int(near.argmin()))
        own = slice(starts[chosen[-1]], starts[chosen[-1] + 1])
        mark[part[own]] = weight[own]
        near = np.maximum(near, np.bincount(word, weight * mark[part], len(insults)))
        mark[part[own]] = 0
    chosen += [i for i in range(min(least, len(insults))) if i not in chosen][: max(0, least - len(chosen))]
    return [insults[i] for i in sorted(chosen)]


class Landmarks(NamedTuple):
    """A word's kernels with the landmarks, times `root`, are its row: products of rows are the
    Nyström approximation of the kernel. `basis` has the landmarks' weights on the subsequences
    `known`."""

    known: np.ndarray
    basis: np.ndarray
    root: np.ndarray

    @classmethod
    def of(cls, marks: list[str]) -> Landmarks:
        words = Words.of(pa.array(marks, pa.large_string()))
        word, part, weight = words.features(0, len(marks))
        known, column = np.unique(part, return_inverse=True)
        basis = np.zeros((len(marks), len(known)))
        basis[word, column] = weight
        value, vector = np.linalg.eigh(basis @ basis.T)
        keep = value > 1e-8 * max(value[-1], 1e-300)
        return cls(known, basis, vector[:, keep] / np.sqrt(value[keep]))

    def rows(self, words: list[str]) -> np.ndarray:
        """The rows of words, with a one as their last column."""
        own = Words.of(pa.array(words, pa.large_string()))
        place = np.full(SYMBOLS**3, -1, np.int32)
        place[self.known] = np.arange(len(self.known))
        rows = np.ones((len(words), self.root.shape[1] + 1))
        for a in range(0, len(words), 2000):
            b = min(len(words), a + 2000)
            word, part, weight = own.features(a, b)
            at = place[part] >= 0
            dense = np.zeros((b - a, len(self.known)), np.float32)
            dense[word[at], place[part[at]]] = weight[at]
            rows[a:b, :-1] = dense @ self.basis.T @ self.root
        return rows

    def machine(self, v: np.ndarray) -> Machine:
        """The machine that decides on a word like the product of its row and `v`."""
        weights = np.zeros(SYMBOLS**3, np.float32)
        weights[self.known] = self.basis.T @ (self.root @ v[:-1])
        return Machine(weights, float(v[-1]), np.append(np.ones(1), np.zeros(WORST + 2)))


def worst_words(bags: list[list[int]], value: np.ndarray) -> np.ndarray:
    """For each sentence, numbers of its words, the one of the highest value, the first of equals."""
    starts = np.cumsum([0, *map(len, bags)])
    words = np.fromiter((w for bag in bags for w in bag), np.int64, starts[-1])
    sentence = np.repeat(np.arange(len(bags)), np.diff(starts))
    order = np.lexsort((np.arange(len(words)), -value[words], sentence))
    return words[order[starts[:-1]]]


def train(sample: list[tuple[str, int]], landmarks: int = LANDMARKS) -> Machine:
    """The machine for labelled sentences, without its `mix`; it finds nothing if they tell no insult
    from other words.

    The first machine is one of words: those that tell, spread and padded, against words of clean
    sentences. Then a toxic sentence that holds a word that tells is the row of its worst word, and a
    clean sentence that of its own, with those of earlier rounds; equal rows count as often as there
    are sentences. It ends when all sentences choose as before.
    """
    insults, clean = witnesses(sample)
    if not insults or not clean:
        return never()
    by_hash = sorted(clean, key=lambda w: zlib.crc32(w.encode()))[:CLEAN_WORDS]
    marks = spread_marks(insults, landmarks // 2)
    marks += [w for w in by_hash if len(w) > 3][: max(landmarks // 2, landmarks - len(marks))]
    map_ = Landmarks.of(marks)
    if not len(map_.known):
        return never()
    spread = {w: [padded(w, 1), padded(w, 2), ".".join(w)] for w in insults}
    positive = [*insults, *(x for w in insults for x in spread[w])]
    x = map_.rows(positive + by_hash)
    y = np.where(np.arange(len(x)) < len(positive), 1.0, -1.0)
    machine = map_.machine(squared_hinge(x, y, np.ones(len(x))))
    del x

    names = sorted({w for sentence, _ in sample for w in sentence.split()})
    number = {w: i for i, w in enumerate(names)}
    bags = ([], [])
    for sentence, toxic in sample:
        bag = sorted({number[w] for w in sentence.split()})
        if bag and (not toxic or any(names[w] in spread for w in bag)):
            bags[toxic].append(bag)
    words, before = Words.of(pa.array(names, pa.large_string())), None
    mild = {number[w] for w in by_hash if w in number}
    for _ in range(ROUNDS):
        value = machine.decide(words)
        chosen = [np.bincount(worst_words(bags[label], value), minlength=len(names)) for label in (0, 1)]
        if before is not None and all((a == b).all() for a, b in zip(chosen, before, strict=True)):
            break
        before = chosen
        mild |= set(np.flatnonzero(chosen[0]).tolist())
        bad, good = np.flatnonzero(chosen[1]), np.array(sorted(mild))
        copies = [(x, chosen[1][w]) for w in bad for x in spread.get(names[w], ())]
        rows = [*(names[w] for w in bad), *(x for x, _ in copies), *(names[w] for w in good)]
        count = np.concatenate([chosen[1][bad], [n for _, n in copies], np.maximum(chosen[0][good], 1)])
        y = np.where(np.arange(len(rows)) < len(bad) + len(copies), 1.0, -1.0)
        machine = map_.machine(squared_hinge(map_.rows(rows), y, count))
    return machine


def squared_hinge(x: np.ndarray, y: np.ndarray, count: np.ndarray, penalty: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights of a linear support vector machine with squared hinge loss, by Newton's method, for rows
    that stand for `count` each. Both classes count alike; the last column of x is the constant and is
    not penalised."""
    total = np.array([count[y < 0].sum(), count[y > 0].sum()])
    cost = count * len(y) / (2 * total[(y > 0).astype(int)])
    ridge = np.eye(x.shape[1]) * penalty
    ridge[-1, -1] = 1e-6
    v, before = np.zeros(x.shape[1]), None
    for _ in range(rounds):
        active = y * (x @ v) < 1
        if before is not None and (active == before).all():
            break
        before, own = active, x[active] * cost[active, None]
        v = np.linalg.solve(own.T @ x[active] + ridge, own.T @ y[active])
    return v


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 0.02) -> np.ndarray:
    """Coefficients of a logistic regression; the last column is the constant."""
    ridge = np.eye(x.shape[1]) * penalty
    ridge[-1, -1] = 1e-3
    v = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        slope = weight * np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve((x * slope[:, None]).T @ x + ridge, x.T @ (weight * (y - p)) - ridge @ v)
        v += step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return v


def _pieces(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts, some eight megabytes at a time."""
    size = np.concatenate([[0], np.cumsum(pc.binary_length(texts.fill_null("")).to_numpy().astype(np.int64))])
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(size, size[a] + (8 << 20), "right")) - 1)
        yield texts[a:b]
        a = b


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted) for each row. Labels, languages and ids do not enter the score. A
    null text scores like an empty one; very long texts are scored whole; other columns are not read;
    repeated rows stay; an empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # eight megabytes

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value
        for batch in rows:
            found = [machine.score(machine.evidence(part)) for part in _pieces(batch.column(1))]
            value = np.concatenate(found) if found else np.empty(0)
            predicted = pa.array((value >= THRESHOLD).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(value), predicted], ["id", "score", "predicted"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(batches, "id long, score double, predicted int")


def calibrated(machine: Machine, sample: DataFrame, share: float) -> Machine:
    """`machine` with its `mix`, fitted to sample (toxic, text); `share` of all labels are toxic."""
    shared = sample.sparkSession.sparkContext.broadcast(machine)

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = [shared.value.evidence(part) for part in _pieces(batch.column(1))]
            x = np.concatenate(found) if found else np.empty((0, WORST + 3))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(x), pa.list_(pa.float64()))], ["toxic", "x"])

    rows = sample.select("toxic", "text").mapInArrow(batches, "toxic int, x array<double>").collect()
    y = np.array([r["toxic"] for r in rows], float)
    if not 0 < y.sum() < len(y):
        return never()
    weight = np.where(y > 0, share / y.mean(), (1 - share) / (1 - y.mean()))
    x, use = np.array([r["x"] for r in rows]), np.ones(WORST + 3, bool)
    while True:  # a worse word never makes a text better
        mix = np.zeros(len(use))
        mix[use] = logistic(x[:, use], y, weight)
        if (mix[: WORST + 1] >= 0).all():
            return machine._replace(mix=mix)
        use[np.argmin(mix[: WORST + 1])] = False


def held_out(id_col: str):
    """Rows that are not learnt from: the remainder of the id's checksum by three is one."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Machine:
    """The machine for the labels (id, toxic) of documents that are not held out. Labels without an
    id or a value are left out, and so are ids with both values."""
    known = (
        labels.where(f"`{id_col}` is not null and toxic is not null")
        .where(~held_out(id_col))
        .groupBy(F.col(id_col).cast("long").alias("id"))
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
        .where("toxic = most")
    )
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    sample = written(labelled_sample(docs, known.select("id", "toxic"), id_col, text_col), "sample")
    machine = train(labelled_sentences(sample))
    return calibrated(machine, sample, counts.get(1, 0) / max(1, counts.get(0, 0) + counts.get(1, 0)))
