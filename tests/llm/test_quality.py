import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from ledgerlake.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_metrics(text):
    text = text or ""
    words = WORD.findall(text)
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    marked = {i + j for i, t in enumerate(triples) if triples.count(t) > 1 for j in range(3)}
    lines = text.split("\n")
    dup = sum(bool(WORD.search(line)) and line in lines[:i] for i, line in enumerate(lines))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(marked)


def test_metrics_equal_brute_force():
    samples = ["", "a", "a b c a b c", "é ü é\n\n \né ü é\n#*$ %&|<>", "x y z\nx y z\r\nx y z", "\x1c a\xa0b \x0b c\x0cd", "日本 語 日本 語 日本"]
    for text in samples:
        assert tuple(quality.metrics(text.encode(), text.encode().split())) == slow_metrics(text)


class SlowModel:
    """Interpolated modified Kneser-Ney with dictionaries."""

    def __init__(self, texts, order):
        self.order = order
        level = Counter()
        for text in texts:
            words = WORD.findall(text or "")
            s = "\n" * (order - 1) + " ".join(words) + " "
            if words:
                level.update(s[i : i + order] for i in range(len(s) - order + 1))
        self.levels = [level]
        for _ in range(order - 1):
            level = Counter(g[1:] for g in level)
            self.levels.append(level)
        self.levels.reverse()

    def p(self, gram):
        level = self.levels[len(gram) - 1]
        n1, n2, n3, n4 = (sum(n == k for n in level.values()) for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 else 0
        d = [0]
        for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
            d.append(max(0.05 * k, k - (k + 1) * y * b / a if a and b and n1 else k / 2))
        same = [n for g, n in level.items() if g[:-1] == gram[:-1]]
        discount = lambda n: min(n, d[min(n, 3)])
        below = self.p(gram[1:]) if len(gram) > 1 else 1 / len(level)
        own = level[gram]
        return (own - discount(own)) / sum(same) + sum(map(discount, same)) / sum(same) * below


def test_bits_equal_a_dictionary_model(spark):
    texts = ["the cat sat on the mat", "the dog sat", None, " ", "a cat, a dog | and the mat", "ça va"]
    rows = [(i, t, "en") for i, t in enumerate(texts)] + [(10 + i, t, None) for i, t in enumerate(texts[:2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    found = {r.row.doc_id: r.bits for r in quality.judge(docs, ["doc_id"], order=3).collect()}
    for group in (range(6), (10, 11)):
        model = SlowModel([rows[i][1] if i < 6 else rows[i - 4][1] for i in group], 3)
        for i in group:
            words = WORD.findall((rows[i] if i < 6 else rows[i - 4])[1] or "")
            if not words:
                assert found[i] is None
                continue
            s = "\n\n" + " ".join(words) + " "
            expected = -sum(math.log2(model.p(s[j : j + 3])) for j in range(len(s) - 2)) / sum(w != "|" for w in words)
            assert found[i] == pytest.approx(expected, rel=1e-4)


def test_probabilities_sum_to_one_and_unknown_text_has_bits(spark):
    docs = spark.createDataFrame([("abc abd abe xyz", "en")] * 3, "text string, lang string")
    trained = quality.train(quality.gram_counts(docs, "text", "lang", 3), 3)
    sums = defaultdict(float)
    for r in trained.where("order = 1").collect():
        sums[r.order] += r.p
    assert sums[1] == pytest.approx(1)
    model = quality.stored(trained, 3)
    new = spark.createDataFrame([("qqq www", "en"), ("abc", "xx"), ("abc abd", "en")], "text string, lang string")
    bits = [r.bits for r in quality.score(new, model, ["text"], "text", "lang").collect()]
    assert all(b > 0 for b in bits) and bits[2] < bits[0]


def test_documents_keep_the_clean_and_reject_noise(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = quality.judge(docs, ["doc_id"])
    rows = judged.withColumn("doc_id", F.col("row.doc_id")).join(labels, "doc_id", "left").collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rows[::17]:
        assert tuple(r[f] for f in quality.Metrics._fields) == slow_metrics(texts[r.doc_id])
    assert all(not r.kept for r in rows if r.base_failed)
    clean = [r.kept for r in rows if r.quality == 1 and not r.base_failed]
    noise = [r.kept for r in rows if r.quality == 0]
    assert sum(clean) >= 0.985 * len(clean)
    assert sum(noise) <= 0.02 * len(noise)


def test_texts_come_in_small_batches(spark, monkeypatch):
    """The pipeline's first stage held ten thousand texts at a time, twice, in the JVM and in the worker."""
    seen = []
    for name in ("gram_counts", "score"):
        step = getattr(quality, name)
        monkeypatch.setattr(quality, name, lambda *a, f=step: f(*a).observe(quality_seen(seen, spark), F.count(F.lit(1)).alias("n")))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    docs = spark.range(60).selectExpr("id AS doc_id", "repeat(concat('word', id, ' other '), 40) AS text", "'en' AS lang")
    judged = quality.judge(docs, keep=docs.columns)
    assert judged.count() == 60 and seen == [str(quality.ROWS_AT_ONCE)] * 2 and quality.ROWS_AT_ONCE <= 1000
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def quality_seen(seen, spark):
    seen.append(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    return Observation(f"seen{len(seen)}")


def test_nulls_long_texts_and_clashing_columns(spark):
    schema = "doc_id long, text string, lang string, bits string, kept string"
    rows = [(1, None, None, "b", "k"), (None, "", "en", "b", "k"), (2, "one two " * 30, "en", None, None)]
    rows += [(2, "one two " * 30, "en", None, None), (3, "much more text here " * 100_000, None, "b", "k")]
    found = quality.judge(spark.createDataFrame(rows, schema), ["doc_id", "bits"]).collect()
    assert sorted(r.n_words for r in found) == [0, 0, 60, 60, 400_000]
    assert {r.row.bits for r in found} == {"b", None}
    assert not any(r.kept for r in found)
    assert quality.judge(spark.createDataFrame([], schema), ["doc_id"]).count() == 0


@pytest.mark.parametrize("part_rows", [quality.PART_ROWS, 20_000, 200])
def test_every_string_is_stored_as_itself_in_as_many_parts_as_it_takes(spark, part_rows):
    # Strings that share hashes of 24 bits, characters that share numbers of 12 bits, pairs of units.
    chance, signs = random.Random(7), [chr(0x4E00 + i) for i in range(600)] + [chr(0x1F600 + i) for i in range(40)]
    made = lambda n: " ".join("".join(chance.choices(signs, k=6)) for _ in range(n))
    rows = [(made(3000), "zh"), (made(3000), "zh"), (made(500), None), ("the cat sat on the mat", "en")]
    docs = spark.createDataFrame(rows, "text string, lang string")
    trained = quality.train(quality.gram_counts(docs, "text", "lang"))
    model = quality.stored(trained, part_rows=part_rows)
    assert (len(model.parts) > 1) == (part_rows < quality.PART_ROWS)
    known = {(r.lang, r.order, r.gram & (1 << 64) - 1): (math.log2(r.p), math.log2(r.gamma)) for r in trained.collect()}

    def bits(text, lang):
        total, units = 0.0, [10] * 3 + [int.from_bytes(c) for c in itertools.batched((text + " ").encode("utf-16-be"), 2)]
        for i in range(3, len(units)):
            for k in (4, 3, 2, 1, 0):
                gram = sum(u << 16 * j for j, u in enumerate(reversed(units[i + 1 - k : i + 1])))
                if not k or (lang, k, gram) in known:
                    total += known[lang, k, gram][0] if k else model.unknown
                    break
                total += known.get((lang, k - 1, gram >> 16), (0, 0))[1]
        return -total / len(text.split())

    new = [(made(400), "zh"), (rows[0][0], "zh"), (made(100), None), ("the dog", "en"), ("the cat", "xx")]
    found = quality.score(spark.createDataFrame(new, docs.schema).coalesce(1), model, ["text"], "text", "lang").collect()
    for r in found:
        assert r.bits == pytest.approx(bits(r.row.text, "n" if r.lang is None else "l" + r.lang), rel=1e-5)


def test_a_long_text_gives_the_strings_of_the_whole(monkeypatch):
    rng = np.random.default_rng(3)
    words = [bytes(rng.choice(list(b"abc"), rng.integers(1, 6)).tolist()) for _ in range(900)] + ["\U0001f600é".encode()] * 3
    texts = [words, words[:40], [], words[100:]]
    whole = [quality.Symbols([w], quality.ORDER).grams for w in texts]
    monkeypatch.setattr(quality, "PIECE_CHARS", 200)
    found = [[] for _ in texts]
    for i, grams, starts in quality._parts(texts, quality.ORDER):
        assert i >= 0 and starts.tolist() == ([0] if len(grams) else [])
        found[i].append(grams)
    for own, parts in zip(whole, found, strict=True):
        assert np.array_equal(own, np.concatenate([own[:0], *parts]))
    assert len(found[0]) > 10 and len(found[1]) == 1


def test_bands_equal_medians_and_deviations(spark):
    rng = np.random.default_rng(4)
    rows = [(lang, float(x)) for lang, n in (("a", 401), ("b", 37), (None, 5)) for x in rng.normal(12, 2, n).round(3)]
    rows += [("a", rows[0][1])] * 500 + [("a", None)]
    found = {r.key: (r.low, r.high) for r in quality.bands(spark.createDataFrame(rows, "lang string, bits double")).collect()}
    assert len(found) == 3
    for lang in ("a", "b", None):
        bins = np.floor(np.array(sorted({x for g, x in rows if g == lang and x is not None})) * 100)
        middle = np.median(bins)
        half = max(np.median(np.abs(bins - middle)) / 100 * 1.4826, quality.LEAST_SPREAD) * quality.WIDTH
        key = "n" if lang is None else f"l{lang}"
        assert found[key] == pytest.approx(((middle + 0.5) / 100 - half, (middle + 0.5) / 100 + half))


def test_both_bands_reject(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang = 'en'")
    often = [w for w, _ in Counter(w for r in docs.collect() for w in (r.text or "").lower().split() if w.isalpha()).most_common(12)]
    rng = np.random.default_rng(5)
    monotonous = " ".join(rng.choice(often, 200))
    noise = " ".join("".join(rng.choice(list("qxzvjkw0987"), 14)) for _ in range(200))
    planted = [(-1, monotonous, "en", "s", 0), (-2, noise, "en", "s", 0)]
    rows = docs.unionAll(spark.createDataFrame(planted, docs.schema))
    judged = quality.judge(rows, keep=["doc_id"])
    found = {r.row.doc_id: r for r in judged.where("row.doc_id < 0").collect()}
    middle = judged.where("kept").approxQuantile("bits", [0.5], 0.01)[0]
    assert not any(found[i].base_failed or found[i].kept for i in (-1, -2))
    assert found[-1].bits < middle < found[-2].bits
