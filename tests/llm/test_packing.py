import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlake.llm import packing, tokens


def bins_of(counts, capacity):
    bins = defaultdict(list)
    ranks = defaultdict(set)
    for length, rank, n, at, offset in packing.pack(counts, capacity).tolist():
        for i in range(n):
            bins[at + i].append((offset, length))
            assert rank + i not in ranks[length]
            ranks[length].add(rank + i)
    assert {k: len(v) for k, v in ranks.items()} == {k: n for k, n in counts.items() if n}
    assert all(ranks[k] == set(range(n)) for k, n in counts.items() if n)
    for placed in bins.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= capacity
    return bins


def fewest_bins(lengths, capacity):
    lengths = sorted(lengths, reverse=True)
    best = len(lengths)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for k in {r: j for j, r in enumerate(rooms) if r >= lengths[i]}.values():
            go(i + 1, [*rooms[:k], rooms[k] - lengths[i], *rooms[k + 1 :]])
        go(i + 1, [*rooms, capacity - lengths[i]])

    go(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=9))
def test_reduction_keeps_the_optimum(lengths):
    left = packing.Histogram({x: lengths.count(x) for x in lengths})
    fixed = packing.reduce(left, 12)
    rest = [x for x, n in left.counts.items() for _ in range(n)]
    assert sorted([*rest, *(x for c, n in fixed for _ in range(n) for x in c)]) == sorted(lengths)
    assert all(sum(c) <= 12 for c, _ in fixed)
    assert sum(n for _, n in fixed) + (fewest_bins(rest, 12) if rest else 0) == fewest_bins(lengths, 12)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(0, 200), max_size=20))
def test_every_piece_has_its_place(counts):
    bins = bins_of(counts, 64)
    total = sum(k * n for k, n in counts.items())
    assert len(bins) >= -(-total // 64)


def test_near_the_bound_on_many_pieces():
    rng = np.random.default_rng(3)
    lengths, n = np.unique(np.minimum(4096, rng.lognormal(6.5, 1, 200_000).astype(int) + 1), return_counts=True)
    counts = dict(zip(lengths.tolist(), n.tolist(), strict=True))
    bins = packing.pack(counts)
    used = int((bins[:, 3] + bins[:, 2]).max())
    assert used <= 1.001 * -(-sum(k * v for k, v in counts.items()) // 4096) + 1
    assert len(bins) < 60_000


SAMPLES = [
    "",
    "  ",
    "It's  fine,\tI'LL go...\n\nÀ bientôt é, ΣΑΣ, ok.,.",
    "a<|endoftext|>b 12345 x1, y2. <|ENDOFTEXT|>, z \x1c\x1d q",
    "日本語 テスト！ 👍🏽 ﬁ, İstanbul \u0958\u0959, e\u0301, e\u0301. ,. . , .a ,b. x,\u0301 \u212b",
    "long words here, " * 300_000,
    "no-blanks" * 3,
    None,
]


def test_words_give_the_tokenizer_s_ids():
    whole = Tokenizer.from_file(tokens.default_path())
    for samples in (SAMPLES, [s for s in SAMPLES if "<|" not in (s or "")]):
        found = list(tokens.WordEncoder(tokens.default_path()).stream(pa.array(samples, pa.string())))
        assert [x.tolist() for x in found] == [whole.encode(s or "", add_special_tokens=False).ids for s in samples]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=30) | st.text("aB,.'s 1\n", max_size=30), max_size=4))
def test_any_text_gives_the_tokenizer_s_ids(samples):
    encode = tokens.encoder(tokens.default_path())
    expected = [encode.tokenizer.encode(s, add_special_tokens=False).ids for s in samples]
    assert [x.tolist() for x in encode.stream(pa.array(samples, pa.string()))] == expected


def test_a_full_memory_changes_nothing(monkeypatch):
    texts = pa.array([f"word{i % 7}, {'abcdefgh'[i % 8]} end." for i in range(40)])
    expected = [x.tolist() for x in tokens.WordEncoder(tokens.default_path()).stream(texts)]
    monkeypatch.setattr(tokens, "REMEMBERED", 5)
    monkeypatch.setattr(tokens, "PIECE_BYTES", 30)
    assert [x.tolist() for x in tokens.WordEncoder(tokens.default_path()).stream(texts)] == expected


def test_documents_round_trip(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = spark.createDataFrame(
        [(-1, None, "x"), (None, "", "x"), (-2, "w x y " * 5000, "x"), (-2, "w x y " * 5000, "x")],
        "doc_id long, text string, piece string",
    )
    docs = docs.select("doc_id", "text").unionByName(odd, allowMissingColumns=True)
    rows = packing.pack_documents(docs, with_ids=True).collect()
    whole = Tokenizer.from_file(tokens.default_path())
    expected = sorted(
        (str(r.doc_id), [*whole.encode(r.text or "", add_special_tokens=False).ids, 1]) for r in docs.collect()
    )
    by_doc = defaultdict(list)
    for r in rows:
        assert r.length == len(r.ids) and r.start == r.piece * 4096
        assert r.crc == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        by_doc[r.id].append(r)
    got = []
    for doc_id, own in by_doc.items():
        copies = sum(r.piece == 0 for r in own)
        own.sort(key=lambda r: r.piece)
        got += [(str(doc_id), [i for r in own[::copies] for i in r.ids])] * copies
    assert sorted(got) == expected
    placed = defaultdict(list)
    for r in rows:
        placed[r.sequence].append((r.offset, r.length))
    for own in placed.values():
        assert [o for o, _ in sorted(own)] == [sum(n for _, n in sorted(own)[:i]) for i in range(len(own))]
        assert sum(n for _, n in own) <= 4096
    assert packing.pack_documents(docs.limit(0)).count() == 0
