import hashlib

import numpy as np
import pytest

from ledgerlake.llm import suffix

DOCS = "doc_id long, text string, doc long, key string"


def slow(rows, length):
    """rows: (id, text) in order of position."""
    seen, found = set(), []
    for _, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        strings = [data[i : i + length] for i in range(len(data) - length + 1)]
        for i, s in enumerate(strings):
            if s in seen:
                gone[i : i + length] = True
            seen.add(s)
        edge = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        spans = list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True))
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        found.append((len(data), [list(s) for s in spans], hashlib.sha256(kept).hexdigest()))
    return found




def test_documents_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    found = {r.row.doc_id: (r.n_bytes, r.spans, r.kept_sha256) for r in suffix.remove_repeats(docs.repartition(6), ["doc_id"]).collect()}
    assert found == dict(zip([i for i, _ in rows], slow(rows, 100), strict=True))


def blocks_of(texts, length, block, hot):
    """The whole method on one block after the other, without Spark."""
    import pyarrow as pa

    old = suffix.HOT
    suffix.HOT = hot
    try:
        out = []
        for at in range(0, len(texts), block):
            own = suffix.Block(length, min(8, length))
            data = np.frombuffer(b"".join(texts[at : at + block]), np.uint8)
            sizes = np.array([len(t) for t in texts[at : at + block]])
            own.add(data, np.cumsum(sizes) - sizes, np.arange(at, at + len(sizes)))
            out += list(own.rows())
        return pa.Table.from_batches(out).to_pylist() if out else []
    finally:
        suffix.HOT = old


@pytest.mark.parametrize("hot", [0, 2, 64])
def test_blocks_cover_only_repeats(hot):
    rng = np.random.default_rng(hot)
    texts = [bytes(rng.integers(97, 99, int(k)).astype(np.uint8)) for k in rng.integers(0, 60, 60)]
    expected = slow([(i, t.decode()) for i, t in enumerate(texts)], 10)
    for row in blocks_of(texts, 10, 60, hot):
        at, n, kind = row["span"] >> suffix.AT, row["span"] >> suffix.N & suffix.MOST, row["span"] & 15
        if kind == suffix.COVER:
            assert any(a <= at and at + n <= b for a, b in expected[row["doc"]][1])


def test_long_stretches_are_split():
    at, n, doc = suffix._split(np.array([5, 9]), np.array([2 * suffix.MOST + 1, 3]), np.array([1, 2]))
    assert n.tolist() == [suffix.MOST, suffix.MOST, 1, 3] and doc.tolist() == [1, 1, 1, 2]
    assert at.tolist() == [5, 5 + suffix.MOST, 5 + 2 * suffix.MOST, 9]


def test_hot_groups_and_shards(spark):
    # One passage in very many texts, with different words around it, in several tasks.
    rng = np.random.default_rng(8)
    word = lambda k: "".join(map(chr, rng.integers(97, 123, k)))
    passage = word(150)
    rows = [(i, word(40 + i % 60) + passage[: 100 + i % 51] + word(60)) for i in range(400)]
    rows += [(1000 + i, "ab" * (40 + i)) for i in range(60)] + [(2000, "x" * 500), (2001, "x" * 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r.row.doc_id: (r.n_bytes, r.spans, r.kept_sha256) for r in suffix.remove_repeats(docs, ["doc_id"]).collect()}
    assert found == dict(zip([i for i, _ in rows], slow(rows, 100), strict=True))


def test_nulls_repeated_rows_and_characters(spark):
    long = "Grüße an alle, die dies lesen. " * 2 + "0123456789" * 7
    rows = [(3, long, 1, "k"), (3, long, 1, "k"), (1, "é" + long[1:], 1, "k"), (None, long, 1, "k"), (7, None, 1, "k")]
    rows += [(8, "", 1, "k"), (9, "short", 1, "k"), (2, "q" * 99, 1, "k"), (4, "q" * 99, 1, "k")]
    rows.append((10, ("w" + "y" * 50) * 40_000, 1, "k"))
    found = suffix.remove_repeats(spark.createDataFrame(rows, DOCS), ["doc_id", "key"]).collect()
    got = sorted((str(r.row.doc_id), r.n_bytes, tuple(map(tuple, r.spans)), r.kept) for r in found)
    n = len(long.encode())
    assert len(got) == len(rows)
    by_id = {g[0]: g for g in got}
    assert by_id["1"][2] == () and [g for g in got if g[0] == "3"] == [by_id["3"]] * 2
    assert by_id["3"][2] == ((1, n),) and by_id["3"][3] == "G"
    assert by_id["None"][2] == ((0, n),) and by_id["None"][3] == ""
    assert by_id["7"][1:] == (0, (), None) and by_id["8"][1:] == (0, (), "") and by_id["9"][3] == "short"
    assert by_id["2"][2] == by_id["4"][2] == ()
    assert by_id["10"][2] == ((51, 51 * 40_000),)
    assert suffix.remove_repeats(spark.createDataFrame([], DOCS), ["doc_id"]).count() == 0


def test_whole_characters_are_kept():
    import pyarrow as pa

    kind = pa.list_(pa.struct([("at", pa.int64()), ("n", pa.int64())]))
    cut = lambda text, parts: suffix.cut_out(pa.scalar(text), pa.scalar(parts, kind))
    text = "aéüb"  # bytes: a, two, two, b
    assert cut(text, [{"at": 2, "n": 2}])[3] == "ab"
    assert cut(text, [{"at": 2, "n": 2}])[2] == hashlib.sha256(b"a\xc3\xbcb").hexdigest()
    assert cut(text, [{"at": 0, "n": 6}])[1:] == ([[0, 6]], hashlib.sha256().hexdigest(), "")
    assert cut(text, [{"at": 4, "n": 2}, {"at": 0, "n": 1}, {"at": 0, "n": 2}])[3] == ""
