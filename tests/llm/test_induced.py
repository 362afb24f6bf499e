import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlake.llm import induced


def slow_order(segments):
    text = induced.Text(segments)
    body = text.body.tolist()
    order = sorted(range(len(body)), key=lambda i: body[i:])
    common = [0]
    for a, b in zip(order, order[1:]):
        n = 0
        while a + n < len(body) and b + n < len(body) and body[a + n] == body[b + n]:
            n += 1
        common.append(n)
    return order, common


def check(segments, budget):
    order, common = slow_order(segments)
    got = list(induced.sorted_suffixes(induced.Text(segments), 100, budget))
    pos = np.concatenate([p for p, _ in got])[::-1].tolist()
    lcp = np.concatenate([x for _, x in got]).tolist()
    body = induced.Text(segments).body.tolist()
    assert [body[i : i + 100] for i in pos] == [body[i : i + 100] for i in order[len(order) - len(pos) :]]
    assert sorted(pos) == sorted(order[len(order) - len(pos) :])
    assert lcp[1:] == [min(100, n) for n in common[::-1][: len(lcp) - 1]]


def test_long_runs():
    check([b"a" * 250 + b"b" + b"a" * 130 + b"b" * 120, b"b" * 300 + b"ab", b"a" * 101, b"a" * 100], 1 << 20)
    check([b"c" * 250 + b"a" + b"c" * 250 + b"d", b"xc" * 80], 1)


words = st.lists(st.text("ab", max_size=12) | st.text("abc", max_size=40) | st.sampled_from(["aaaaaaaaaaaa", "abababab"]), min_size=1, max_size=6)


@settings(max_examples=300, deadline=None)
@given(words, st.sampled_from([1, 1 << 20]))
def test_order_and_common_prefixes(parts, budget):
    check([p.encode() for p in parts], budget)


def test_many_symbols_and_small_blocks():
    rng = np.random.default_rng(2)
    old, induced.BLOCK = induced.BLOCK, 5
    try:
        check([bytes(range(256)) * 3, rng.integers(0, 256, 900, dtype=np.uint8).tobytes()], 100)
        check([rng.integers(97, 99, 700, dtype=np.uint8).tobytes(), b"b" * 90, b""], 100)
    finally:
        induced.BLOCK = old


def slow_repeats(segments, counts, depth):
    seen, found = set(), []
    for i, (s, n) in enumerate(zip(segments, counts, strict=True)):
        for j in range(n):
            if s[j : j + depth] in seen:
                found.append((i, j))
            seen.add(s[j : j + depth])
    return found


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab", max_size=30), min_size=1, max_size=6), st.integers(1, 6), st.sampled_from([2, 1 << 20]))
def test_repeats_equal_a_set_of_strings(parts, depth, block):
    segments = [p.encode() for p in parts]
    counts = np.array([max(0, len(s) - depth + 1) for s in segments])
    old, induced.BLOCK = induced.BLOCK, block
    try:
        segment, offset = induced.repeats(segments, counts, depth, budget=64)
    finally:
        induced.BLOCK = old
    assert list(zip(segment.tolist(), offset.tolist(), strict=True)) == slow_repeats(segments, counts.tolist(), depth)
