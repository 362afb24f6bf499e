import numpy as np
import xxhash

from ledgerlake.llm import simhash
from ledgerlake.llm.common import components

DOCS = "doc_id long, text string, fp string"


def slow_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\v\f\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fingerprints):
    root = dict(fingerprints)
    ids = sorted(fingerprints)
    least = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for i in ids:
            for j in ids:
                if (root[i] ^ root[j]).bit_count() <= 3 and least[j] < least[i]:
                    least[i], changed = least[j], True
    return least


def test_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    prints = {i: slow_fingerprint(t) for i, t in texts.items()}
    found = {r.id: (r.fp & (1 << 64) - 1, r.component) for r in simhash.near_duplicates(docs).collect()}
    least = slow_components(prints)
    assert found == {i: (prints[i], least[i]) for i in texts}


def test_nulls_ties_and_clashing_columns(spark):
    rows = [(5, None, "x"), (3, "", "x"), (None, " \t", "x"), (7, "One two", "x"), (2, "One two", "x")]
    rows += [(2, "One two", "x"), (None, "only here", "x"), (9, "a b " * 50_000, "x")]
    found = sorted(simhash.near_duplicates(spark.createDataFrame(rows, DOCS)).collect(), key=str)
    got = {(r.id, r.component, r.fp == 0) for r in found}
    assert len(found) == len(rows)
    assert {(5, 3, True), (3, 3, True), (None, 3, True), (7, 7, False), (2, 2, False), (None, None, False)} <= got
    assert simhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_links_cover_every_close_pair(spark):
    rng = np.random.default_rng(1)
    centres = rng.integers(-(2**63), 2**63, 40)
    values = [int(c) ^ int(np.bitwise_or.reduce(np.int64(1) << rng.integers(0, 62, 3))) for c in centres for _ in range(60)]
    values = sorted({*values, *map(int, centres)})
    df = spark.createDataFrame([(v,) for v in values], "fp long").repartition(5)
    old, simhash.TILE = simhash.TILE, 16
    try:
        roots = {r.node: r.root for r in components(simhash.links(df)).collect()}
    finally:
        simhash.TILE = old
    array = np.array(values)
    least, bits = list(range(len(values))), array.view(np.uint64)
    for _ in range(12):
        least = [min(least[j] for j in np.flatnonzero(np.bitwise_count(bits ^ b) <= 3)) for b in bits]
    assert [roots.get(v, v) for v in values] == [values[i] for i in least]


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 30)}
