import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score string, class string"


def slow(rows, k, every=1):
    whole, asking = [], {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = [math.floor(1024 * float(np.float32(x))) for x in v]
        whole.append((i, v))
        asking[i] = min(asking.get(i, v), v)
    found = []
    for q, a in asking.items():
        if q % every == 0:
            scores = [(-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in whole if i != q and len(a) == len(b)]
            found += [(q, n, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(found)


def run(spark, rows, k=4, every=1, **options):
    df = spark.createDataFrame([(i, v, "x", None) for i, v in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in topk.search(df, F.col("id") % every == 0, k=k, **options).collect())


@pytest.mark.parametrize("blocks", [1, 2, 3])
def test_equals_brute_force_with_copies_and_ties(spark, blocks, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 16)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(blocks)
    rows = [(i, rng.normal(size=6).round(1).tolist()) for i in range(90)]
    rows += [(100 + i, rows[3][1]) for i in range(30)] + [(200 + i, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]) for i in range(9)]
    rows += [(300 + i, [-0.5] * 6) for i in range(3)]
    assert run(spark, rows, every=3, blocks=blocks) == slow(rows, 4, every=3)


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [0.5, 0.5]), (1, [0.4, 9.0]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0])]
    rows += [(5, [float("inf"), 1.0]), (None, [1.0, 1.0]), (6, [1.0, 2.0, 3.0]), (7, [2.0, 2.0, 2.0]), (8, []), (9, []), (10, [1e6, -1e6])]
    assert run(spark, rows) == slow(rows, 4)
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0])]) == []


def test_large_numbers_are_exact():
    a = np.array([[2**40 + 1, 3], [-(2**40), 5]])
    assert topk.inner(a, a[:, ::-1]).tolist() == [[int(x) for x in row] for row in a.astype(object) @ a[:, ::-1].astype(object).T]
    assert topk.inner_rows(a, a).tolist() == [1 << 62, 1 << 62] and topk.inner_rows(a[:, 1:], a[:, 1:]).tolist() == [9, 25]


def test_the_query_takes_no_place_of_a_class_that_ties(spark):
    rows = [(0, [0.0, 0.0]), (100, [0.0, 0.0]), (101, [0.0, 0.0]), *((i, [float(i), 1.0]) for i in range(1, 9))]
    found = run(spark, rows)
    assert found == slow(rows, 4)
    assert [r[2] for r in found if r[0] == 0] == [1, 2, 3, 4]


def test_every_row_of_a_repeated_id_is_a_candidate(spark):
    rows = [(5, [0.0, 0.0]), (5, [9.0, 9.0]), (5, [9.0, 9.0]), (6, [9.0, 9.0]), (4, [1.0, 1.0]), (10, [1.0, 2.0]), (10, [0.5, 0.5])]
    rows += [(20 + i % 3, [3.0, 3.0]) for i in range(40)] + [(1, [0.0, 0.0])] * 20
    for k in (1, 2, 4, 10):
        assert run(spark, rows, k=k) == slow(rows, k)


def test_components_beyond_the_scores_are_an_error(spark):
    rows = [(1, [1e15, 1.0]), (2, [1.0, 1.0])]
    with pytest.raises(ValueError, match="64 bits"):
        run(spark, rows)
    assert run(spark, [(1, [1e6, 1.0]), (2, [float("inf"), 1.0]), (3, [2.0, 3.0])]) == slow([(1, [1e6, 1.0]), (3, [2.0, 3.0])], 4)
