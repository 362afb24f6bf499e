import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerlake.llm import hmm

SCHEMA = "doc_id long, text string, score string, word string, chunk string"


def held(key):
    return key is not None and zlib.crc32(str(key).encode()) % 7 == 2


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w] + [""]


def recursions(sequence, emission, moves, first):
    """Probability, state probabilities at each place and expected transitions, without scaling."""
    e = [emission[w] for w in sequence]
    forward = [first * e[0]]
    for x in e[1:]:
        forward.append((forward[-1] @ moves) * x)
    backward = [np.ones(len(first))]
    for x in reversed(e[1:]):
        backward.insert(0, moves @ (x * backward[0]))
    total = forward[-1].sum()
    states = [f * b / total for f, b in zip(forward, backward, strict=True)]
    pairs = sum((np.outer(f, x * b) * moves / total for f, x, b in zip(forward, e[1:], backward[1:], strict=False)), np.zeros_like(moves))
    return total, states, pairs


def slow(docs, states, rounds):
    split = [(i, words(t)) for i, t in docs]
    learnt = [w for i, w in split if not held(i)]
    c = Counter(x for w in learnt for x in w)
    n_all, v = sum(c.values()), len(c)
    once, twice = (sum(x == k for x in c.values()) for k in (1, 2))
    d = min(0.95, max(0.05, once / max(1, once + 2 * twice)))
    sequences = [w[a : a + hmm.WINDOW] for w in learnt for a in range(0, len(w), hmm.WINDOW)]
    vocabulary = sorted(c)
    noise = hmm._random_emission([w.encode() for w in vocabulary], states)
    emission = dict(zip(vocabulary, noise, strict=True))
    moves = np.full((states, states), 0.1 / (states - 1)) + np.eye(states) * (0.9 - 0.1 / (states - 1))
    first = np.full(states, 1 / states)
    rare_words = [w for w in vocabulary if c[w] < hmm.MIN_COUNT]
    for n in range(rounds):
        counts, pairs, begun = {w: np.zeros(states) for w in vocabulary}, np.zeros((states, states)), np.zeros(states)
        for s in sequences:
            _, gamma, xi = recursions(s, emission, moves, first)
            for w, g in zip(s, gamma, strict=True):
                counts[w] += g
            pairs, begun = pairs + xi, begun + gamma[0]
        rare = sum((counts[w] for w in rare_words), np.zeros(states))
        per_token = rare / max(1, sum(c[w] for w in rare_words))
        tied = {w: c[w] * per_token if c[w] < hmm.MIN_COUNT else counts[w] for w in vocabulary}
        totals = sum(tied.values())
        spare = d * sum(tied[w] / c[w] for w in vocabulary) / totals
        share = lambda k, own: own * ((1 - d / k) if k else 0) / totals + spare / (v + 1)  # noqa: B023, E731
        final = {w: share(c[w], tied[w]) for w in vocabulary}
        unknown = share(0, np.zeros(states))
        k = hmm.MIN_COUNT - 1
        emission = {w: share(k, k * per_token) if c[w] < hmm.MIN_COUNT else final[w] for w in vocabulary}
        moves, first = (pairs + 1e-3) / (pairs + 1e-3).sum(1, keepdims=True), (begun + 1e-3) / (begun + 1e-3).sum()
    assert np.allclose(sum(final.values()) + unknown, 1)
    rows = []
    for i, w in split:
        total = recursions(w, {x: final.get(x, unknown) for x in w}, moves, first)[0]
        base = sum(math.log10((c[x] + 1) / (n_all + v + 1)) for x in w)
        rows.append((i, held(i), len(w), sum(x in c for x in w), n_all, base, math.log10(total)))
    return rows


def run(spark, docs, **options):
    rows = spark.createDataFrame([(i, t, "x", None, "y") for i, t in docs], SCHEMA).repartition(3)
    found = hmm.score_texts(rows, **options)
    assert found.columns == ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return [tuple(r) for r in found.collect()]


def same(found, wanted, tolerance):
    order = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    found, wanted = sorted(found, key=order), sorted(wanted, key=order)
    assert [r[:5] for r in found] == [r[:5] for r in wanted]
    assert np.allclose([r[5] for r in found], [r[5] for r in wanted])
    assert np.allclose([r[6] for r in found], [r[6] for r in wanted], rtol=tolerance, atol=tolerance)


def corpus(seed, n=60):
    rng = random.Random(seed)
    tongues = [[f"{t}{k}" for k in range(12)] for t in "abÉ"]
    docs = []
    for i in range(n):
        tongue = rng.choice(tongues)
        docs.append((i, rng.choice([" ", "\n", " \t"]).join(rng.choices(tongue, range(12, 0, -1), k=rng.randint(0, 30))).upper() if i % 5 else f"{tongue[0]} only{i}"))
    return docs + [(100, None), (101, ""), (None, "a1 a2"), (None, "a1 a2"), (7, "b1"), (7, "b1"), (102, "x y x y")]


@pytest.mark.parametrize("rounds, chunk", [(1, 1_000_000), (2, 40), (3, 200)])
def test_equals_brute_force(spark, monkeypatch, rounds, chunk):
    monkeypatch.setattr(hmm, "CHUNK_TOKENS", chunk)
    monkeypatch.setattr(hmm, "ENCODED_TOKENS", 30)
    monkeypatch.setattr(hmm, "MIN_COUNT", 5)
    docs = corpus(rounds)
    assert any(held(i) for i, _ in docs)
    same(run(spark, docs, states=3, rounds=rounds), slow(docs, 3, rounds), 2e-3)


def test_recursions_equal_those_without_scaling():
    rng = np.random.default_rng(1)
    tokens, ends = rng.integers(0, 9, 200), np.array([1, 1 + 40, 41 + 3, 44 + 3, 47 + 153])
    starts = np.append(0, ends[:-1])
    emission, moves, first = rng.random((9, 4)), rng.dirichlet(np.ones(4), 4), rng.dirichlet(np.ones(4))
    found = hmm.Counts.zeros(9, 4)
    hmm.add_expected(found, tokens, starts, ends - starts, emission, moves, first)
    words, pairs, begun = np.zeros((9, 4)), np.zeros((4, 4)), np.zeros(4)
    logs = []
    for a, b in zip(starts, ends, strict=True):
        total, states, xi = recursions(tokens[a:b], emission, moves, first)
        np.add.at(words, tokens[a:b], np.array(states))
        pairs, begun = pairs + xi, begun + states[0]
        logs.append(math.log10(total))
    assert np.allclose(found.words, words) and np.allclose(found.moves, pairs) and np.allclose(found.first, begun)
    assert np.allclose(hmm.log_likelihood(tokens, ends, emission, moves, first), logs)


def test_very_long_text_does_not_underflow(spark):
    docs = [(1, "word other " * 60_000), (2, "word"), (3, None)]
    found = {r[0]: r for r in run(spark, docs)}
    assert found[1][2] == 120_001 and math.isfinite(found[1][6]) and found[1][6] < -10_000


def test_held_out_texts_are_not_learnt_from(spark):
    docs = corpus(5)
    other = [(i, "quite different words" if held(i) else t) for i, t in docs]
    a, b = ({r[0]: r for r in run(spark, rows, rounds=2) if not r[1]} for rows in (docs, other))
    same(list(a.values()), list(b.values()), 1e-3)


def test_rounds_and_states_fit_held_out_texts_better(spark, monkeypatch):
    monkeypatch.setattr(hmm, "MIN_COUNT", 3)
    docs = [(i, t) for i, t in corpus(6, 400) if i is not None]
    better = []
    for options in ({"states": 1, "rounds": 1}, {"states": 6, "rounds": 4}):
        better.append(sum(r[6] for r in run(spark, docs, **options) if r[1]))
    assert better[1] > better[0] + 30


def test_words_meet_the_model_without_a_sort(spark):
    """Each round sorted the words of all chunks to join them with the model."""
    chunks = spark.createDataFrame([(0, [b"a", b"b"], b"")], hmm.CHUNK)
    rows = spark.createDataFrame([(b"a", 50, 1, 2)], "word binary, n long, p0 long, p1 long")
    plan = hmm._met(chunks, rows, ["n", "p0", "p1"])._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_empty_table(spark):
    assert run(spark, []) == []
