import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from ledgerlake.llm import lexical

SCHEMA = "doc_id long, text string, score string, term string, key string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def slow(docs, items, k):
    split = [(i, Counter(words(t)), len(words(t))) for i, t in docs if words(t)]
    n_all, l_all = len(split), sum(n for _, _, n in split)
    df = Counter(t for _, tf, _ in split for t in tf)
    found = []
    for item, text in items:
        scores = []
        for i, tf, n in split:
            m = 100 - 25 + (25 * n * n_all) // l_all
            score = 0
            for t in words(text):
                if tf[t]:
                    w = math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * tf[t]) // (1000 * tf[t] + 12 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0))
        found += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k], 1)]
    return Counter(found)


def run(spark, docs, items, k=4, **options):
    rows = spark.createDataFrame([(i, t, "x", None, "y") for i, t in docs], SCHEMA).repartition(3)
    asked = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, rank string")
    found = lexical.search(lexical.build(rows), asked, k=k, **options)
    assert found.columns == ["item", "rank", "id", "score"]
    return Counter(tuple(r) for r in found.collect())


def corpus(seed, n=150):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["ÄÖ", "é2", "日本"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    text = lambda most: rng.choice(" ,-").join(rng.choices(vocabulary, weights, k=rng.randint(0, most)))
    docs = [(i, text(40)) for i in range(n)] + [(1000 + i, "W1 w2;w2 w7") for i in range(30)] + [(5, "w1 w50 w50")]
    docs += [(2000, " ".join(rng.choices(vocabulary, k=3000))), (None, "w3 w3 w3"), (None, "w3 w3 w3"), (7000, None), (7001, "")]
    items = [(i, text(25)) for i in range(40)] + [(900, "w2 w2 w1"), (900, "w2 w2 w1"), (901, None), (None, "w7"), (902, "none")]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed, monkeypatch):
    docs, items = corpus(seed)
    assert run(spark, docs, items) == slow(docs, items, 4)
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 9)
    assert run(spark, docs, items, k=20, limit=2000) == slow(docs, items, 20)


@pytest.mark.parametrize("docs, terms", [(3, 400_000), (2048, 50)])
def test_small_nodes_give_the_same(spark, monkeypatch, docs, terms):
    rows, items = corpus(3)
    monkeypatch.setattr(lexical, "NODE_DOCS", docs)
    monkeypatch.setattr(lexical, "NODE_TERMS", terms)
    assert run(spark, rows, items) == slow(rows, items, 4)


def test_visits_follow_the_bounds():
    # Documents and strata whose bound is below the k-th best are not scored.
    words_of = [[b"a"] * n + [b"b"] * (50 - n) for n in (50, 40, 30)] + [[b"a"] + [b"x"] * (100 * i) for i in range(1, 30)]
    node = lexical._node(list(range(len(words_of))), words_of, len(words_of), sum(map(len, words_of)))
    row = {name: node.column(name)[0] for name in node.schema.names}
    cutoff = np.zeros(1, np.int64)
    found = lexical._Node(row).scores(np.zeros(1, int), pa.array([b"a"], pa.binary()), np.ones(1, int), cutoff, 2)
    best = sorted(found[0], reverse=True)
    assert cutoff[0] == best[1] and (found[0] > 0).sum() < len(words_of)


def test_texts_and_nodes_come_in_small_batches(spark, monkeypatch):
    """Ten thousand texts were handed over at a time, and the nodes of a whole file decoded at once."""
    names, seen, stored = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize"), {}, lexical.written

    def written(df, name, **options):
        seen[name] = [int(spark.conf.get(x)) for x in names]
        return stored(df, name, **options)

    monkeypatch.setattr(lexical, "written", written)
    before = [spark.conf.get(x) for x in names]
    docs, items = corpus(4)
    assert run(spark, docs, items) == slow(docs, items, 4)
    assert seen["index"][0] <= 1000 and seen["lexicon"][1] <= 8 and max(seen["found"]) <= 8
    assert [spark.conf.get(x) for x in names] == before


def test_nodes_are_packed():
    # Groups and postings had four bytes for each number, and a Parquet level for each when decoded.
    rng = random.Random(5)
    words_of = [[b"%d" % rng.randrange(5000) for _ in range(rng.randint(1, 400))] for _ in range(300)]
    node = lexical._node(list(range(300)), words_of, 300, sum(map(len, words_of)))
    postings = sum(len(set(words)) for words in words_of)
    rest = sum(node.column(name).nbytes for name in node.schema.names if name not in ("ids", "terms", "df"))
    assert rest < 6 * postings
    loaded = lexical._Node({name: node.column(name)[0] for name in node.schema.names})
    assert len(loaded.doc) == postings and loaded.group_ends[-1] == postings


def test_few_large_nodes_are_cut_into_row_groups(spark, monkeypatch):
    # Parquet looked at sizes every hundred rows, so that less than a hundred nodes were one page and row group.
    monkeypatch.setattr(lexical, "NODE_DOCS", 5)
    monkeypatch.setitem(lexical.STORED, "parquet__block__size", "50000")
    rows = spark.range(100).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(1, 500), i -> hex(xxhash64(id, i)))) AS text")
    index = lexical.build(rows.coalesce(1))
    files = [pq.ParquetFile(name.removeprefix("file://")).metadata for name in index.nodes.inputFiles()]
    assert sum(f.num_rows for f in files) == 20 and max(f.num_row_groups for f in files) > 5


@pytest.mark.parametrize("most", [0, 255, 256, 65535, 65536, 2**32])
def test_packed_numbers_come_back(most):
    for values in ([most], [0, 1, most]):
        (cell,) = lexical._packed(np.array(values, np.int64))
        assert lexical._unpacked(cell, len(values)).tolist() == values


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")]) == Counter()
    assert run(spark, [(1, "a")], []) == Counter()
    assert run(spark, [(1, None), (2, " ")], [(1, "a")]) == Counter()
