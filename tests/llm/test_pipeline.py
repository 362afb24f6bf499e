from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlake.llm import mixing, quality
from test_simhash import slow_components, slow_fingerprint
from test_suffix import slow as slow_cut

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, found = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.written(stage(spark, docs, SF_DIR), "stage")
        found.append((before, docs))
    return found


def test_columns_stay(stages):
    for before, after in stages[:-1]:
        assert after.columns == before.columns and after.dtypes == before.dtypes


def test_quality(stages):
    before, after = stages[0]
    judged = quality.judge(before, ["doc_id"]).collect()
    kept = {r.row.doc_id for r in judged if r.kept}
    assert {r.doc_id: r.text for r in after.collect()} == {r.doc_id: r.text for r in before.collect() if r.doc_id in kept}
    assert 0 < after.count() < before.count()


def test_near_duplicates_equal_brute_force(stages):
    before, after = stages[1]
    texts = {r.doc_id: r.text for r in before.collect()}
    least = slow_components({i: slow_fingerprint(t) for i, t in texts.items()})
    assert sorted(r.doc_id for r in after.collect()) == sorted(i for i in texts if least[i] == i)


def test_passages_equal_brute_force(stages):
    before, after = stages[2]
    rows = sorted((r.doc_id, r.text) for r in before.collect())
    cut = dict(zip([i for i, _ in rows], slow_cut(rows, 100), strict=True))
    after = {r.doc_id: r for r in after.collect()}
    for doc_id, text in rows:
        gone = [range(a, b) for a, b in cut[doc_id][1]]
        kept, at = [], 0
        for c in text:
            n = len(c.encode())
            if not any(i in r for r in gone for i in range(at, at + n)):
                kept.append(c)
            at += n
        assert after[doc_id].text == "".join(kept) and after[doc_id].n_chars == len(kept)


def test_mix(stages):
    before, after = stages[3]
    copies = {r.row.doc_id: r.copies for r in mixing.mix(before, ["doc_id"]).collect()}
    assert Counter(r.doc_id for r in after.collect()) == Counter({i: n for i, n in copies.items() if n})


def test_packing(stages):
    before, after = stages[4]
    rows = after.collect()
    assert Counter(r.doc_id for r in rows if r.piece == 0) == Counter(r.doc_id for r in before.collect())
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]
        assert sum(n for _, n in own) <= 4096


def test_odd_rows_pass_through(spark):
    words = " ".join(f"word{i} of line{i % 7}" for i in range(80))
    rows = [(1, words, "en", "a", 5, 1), (1, words, "en", "a", 5, 1), (None, words, None, None, None, 2), (2, None, "en", "b", 0, 3)]
    rows += [(None, "quite other text " + words[::-1], "en", "b", 9, 4)] * 2 + [(3, "", "en", "b", 0, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, near_key int")
    near = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted((str(r.doc_id), r.near_key) for r in near) == [("1", 1), ("2", 3), ("None", 4)]
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, ""), "odd")
    docs.count()
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        empty = corpus_pipeline.written(stage(spark, empty, ""), "empty")
    assert empty.count() == 0


def test_run_is_the_stages(spark, stages):
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert rows.agg(F.count(F.lit(1)), F.sum("length"), F.sum("ids_crc32")).first() == stages[-1][1].agg(
        F.count(F.lit(1)), F.sum("length"), F.sum("ids_crc32")
    ).first()


def test_different_texts_of_one_id_are_groups_of_their_own(spark):
    texts = [" ".join(f"{x}{i * i}" for i in range(60)) for x in ("one", "two", "three")]
    rows = [(5, texts[0], "a"), (5, texts[1], "b"), (5, texts[1], "b"), (1, texts[2], "c"), (7, texts[2], "d"), (7, texts[0], "e")]
    rows += [(9, texts[0] + " nine", "f"), (8, "x " + texts[2][::-1], "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    near = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    found = sorted((r.doc_id, r.source) for r in near if r.source != "f")
    assert found == [(1, "c"), (5, "a"), (5, "b"), (8, "g")]
