import math
import re

import pytest

from ledgerlake.llm import licences

SCHEMA = "doc_id long, text string, labels string, word string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def slow(rows):
    split = [words_of(t) for _, t in rows]
    holding = {w: sum(w in s for s in map(set, split)) for t in licences.TEMPLATES for w in t.text.split()}
    found = []
    for (doc_id, _), words in zip(rows, split, strict=True):
        base, labels, score = [], set(), 0.0
        for t in licences.TEMPLATES:
            text, key = t.text.split(), t.key.split()
            at = next(i for i in range(len(text)) if text[i : i + len(key)] == key)
            idf = [math.log((len(rows) + 1) / (holding[w] + 1)) + 1e-9 for w in text]
            for p in range(len(words)):
                if words[p : p + len(key)] == key:
                    same = [0 <= p - at + i < len(words) and words[p - at + i] == w for i, w in enumerate(text)]
                    score = max(score, sum(x for x, s in zip(idf, same, strict=True) if s) / sum(idf))
                    labels.add(t.label)
                    if t.base:
                        base.append((p, t.label))
        starts = [p for p, _ in base]
        found.append((
            doc_id, len(words), len(base), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({x for _, x in base})), ",".join(sorted(labels)), pytest.approx(score, abs=1e-6),
        ))
    return found


def test_documents_equal_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = sorted(tuple(r) for r in licences.scan(docs).collect())
    expected = sorted(slow(rows), key=lambda r: r[0])
    assert found == expected
    assert {"apache-2.0", "mit", "gpl", "reserved", "cc-by,cc-by-nc"} <= {r[6] for r in found}


def test_odd_texts_equal_brute_force(spark):
    rows = [(i, t.text) for i, t in enumerate(licences.TEMPLATES)]
    rows += [(100, None), (101, ""), (None, "CC-BY cc_by CC BY cc, by ccby ccKby"), (102, "General\nPublic\nLICENSE general public license!")]
    rows += [(102, "all rights reserved"), (102, "all rights reserved"), (103, "All rights. Reserved all rights reserved")]
    rows += [(104, "license " * 60_000), (105, "the gnu " * 3 + "general public license version 3"), (106, "Éall rights reserved"), (107, "mit der lizenz")]
    rows += [(108, "GENERAL PUBLIC LICENſE mit licenſe MIT LICENSE")]
    df = spark.createDataFrame([(i, t, "x", None) for i, t in rows], SCHEMA).repartition(3)
    found = sorted((tuple(r) for r in licences.scan(df).collect()), key=lambda r: (str(r[0]), r[1], r[6]))
    assert found == sorted(slow(rows), key=lambda r: (str(r[0]), r[1], r[6]))
    assert licences.scan(df.limit(0)).count() == 0


def test_plan_has_no_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = licences.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
