import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import toxicity as tox


def slow_features(word):
    """All triples of letters within the span, with the start of the word before the first."""
    letters = "^" + word
    found = {}
    for i in range(len(letters)):
        for j in range(i + 1, len(letters)):
            for k in range(j + 1, min(len(letters), i + tox.SPAN)):
                triple = letters[i] + letters[j] + letters[k]
                if all(c == "^" or c.isalpha() for c in triple):
                    found[triple] = found.get(triple, 0) + tox.DECAY ** (k - i + 1)
    norm = sum(x * x for x in found.values()) ** 0.5
    return {t: x / norm for t, x in found.items()}


def machine_features(words):
    own = tox.Words.of(pa.array(words, pa.large_string()))
    word, part, weight = own.features(0, len(words))
    return [{p: w for i, p, w in zip(word, part, weight, strict=True) if i == k} for k in range(len(words))]


def test_kernel_equals_sums_over_subsequences():
    words = ["idiot", "i.d.i.o.t", "idxiot", "grüße", "a", "", "...", "abcabcabcabcabc", "trash!!"]
    fast, slow = machine_features(words), [slow_features(w) for w in words if w]
    slow.insert(5, {})
    for i in range(len(words)):
        for j in range(len(words)):
            expected = sum(x * slow[j].get(t, 0) for t, x in slow[i].items())
            assert sum(x * fast[j].get(t, 0) for t, x in fast[i].items()) == pytest.approx(expected)


def test_gaps_and_padding_stay_close():
    plain, spread, padded, other = machine_features(["worthless", "w-o-r-t-h-l-e-s-s", "worthxless", "wonderful"])
    like = lambda a: sum(x * plain.get(p, 0) for p, x in a.items())
    assert like(spread) > 0.75 and like(padded) > 0.6 > 0.4 > like(other)


def test_units_and_spread_letters():
    texts = pa.array(["You are an I D I O T", None, "a b", "", "s c u m\nx", "x y z"])
    names, at, starts = tox.units(texts)
    names = names.to_pylist()
    assert [sorted(filter(None, (names[i] for i in at[a:b]))) for a, b in zip(starts, starts[1:], strict=False)] == [
        sorted(["you", "are", "an", *"idiot", "idiot"]), [], ["a", "b"], [], sorted([*"scumx", "scumx"]), sorted([*"xyz", "xyz"])
    ]


@pytest.fixture(scope="module")
def fitted(spark):
    """Texts of made-up words, of which the toxic ones hold a few bad ones."""
    rng = np.random.default_rng(4)
    parts = ["ta", "ru", "mi", "sol", "ke", "lan", "do", "vi", "ner", "pas"]
    word = lambda: "".join(rng.choice(parts, rng.integers(1, 4)))
    bad = ["grobble", "snarfing", "wexok"]
    docs, labels = [], []
    for i in range(300):
        words = [word() for _ in range(60)]
        if toxic := int(i % 3 == 0):
            for at in rng.integers(0, 60, 4):
                words[at] = rng.choice(bad)
        docs.append((i, " ".join(words[:30]) + ". " + " ".join(words[30:]) + "."))
        labels.append((i, toxic))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    return docs, labels, tox.fit(docs, labels)


def test_held_out_texts(fitted):
    docs, labels, machine = fitted
    rows = tox.score(docs, machine).join(labels.withColumnRenamed("doc_id", "id"), "id")
    rows = rows.where(tox.held_out("id")).collect()
    assert len(rows) > 60 and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.predicted == r.toxic for r in rows) >= 0.97 * len(rows)


def test_hidden_insults_are_found(spark, fitted):
    _, _, machine = fitted
    clean = "ta ru misol kelan do vi nerpas tamiru lando ner sol ke vi do pas "
    texts = ["gro.bble snar-fing wex.ok", "g r o b b l e mi s n a r f i n g do w e x o k", "grobxble snarqfing wexzok", ""]
    rows = spark.createDataFrame([(i, clean + t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert [r.predicted for r in tox.score(rows, machine).orderBy("id").collect()] == [1, 1, 1, 0]


def test_nulls_repeats_and_long_texts(spark, fitted):
    _, _, machine = fitted
    rows = [(1, None, "x"), (None, "", "x"), (2, "ta ru", "x"), (2, "ta ru", "x"), (3, "misol ke " * 200_000, None)]
    rows.append((4, "https://" + "a1b2" * 50_000, "x"))
    found = tox.score(spark.createDataFrame(rows, "doc_id long, text string, score string"), machine).collect()
    assert len(found) == 6 and all(r.predicted == 0 and 0 <= r.score < 0.7 for r in found)
    assert len({r.score for r in found if r.id in (1, None)}) == 1
    empty = spark.createDataFrame([], "doc_id long, text string")
    none = spark.createDataFrame([(1, None), (None, 1), (2, 0), (2, 1)], "doc_id long, toxic int")
    nothing = tox.fit(spark.createDataFrame(rows[:3], "doc_id long, text string, score string"), none)
    assert tox.score(empty, machine).count() == 0
    assert [r.predicted for r in tox.score(spark.createDataFrame([(1, "grobble")], "doc_id long, text string"), nothing).collect()] == [0]


def test_only_rows_that_are_not_held_out_teach(spark, fitted):
    docs, labels, machine = fitted
    wrong = labels.withColumn("toxic", F.when(tox.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = tox.fit(docs, wrong.withColumn("toxic", F.col("toxic").cast("int")))
    assert np.array_equal(again.weights, machine.weights) and np.allclose(again.mix, machine.mix)


def test_letters_of_other_alphabets_differ():
    for word in ("дурак", "βλακας", "حمار", "żółć"):
        own, other = machine_features([word, "".join(chr(ord(c) + 4) for c in word)])
        assert sum(x * other.get(p, 0) for p, x in own.items()) < 0.5


def test_a_rare_insult_is_learnt_beside_many_spellings_of_a_frequent_one():
    rng = np.random.default_rng(5)
    parts = ["ta", "ru", "mi", "sol", "ke", "lan", "do", "vi", "ner", "pas"]
    word = lambda: "".join(rng.choice(parts, rng.integers(2, 5)))
    spellings = ["grobble" + a + b for a in "abcdefghij" for b in "abcdefghij"]
    bad = [w for w in spellings for _ in range(20)] + ["wexyq"] * 15 + ["дурак"] * 15
    clean = [(" ".join(word() for _ in range(8)), 0) for _ in range(4000)]
    toxic = [(" ".join([*(word() for _ in range(6)), w, word()]), 1) for w in bad]
    machine = tox.train(sorted({*clean, *toxic}))
    found = machine.decide(tox.Words.of(pa.array(["grobbleaa", "wexyq", "дурак", "misolke", "лапша"], pa.large_string())))
    assert (found[:3] > 0).all() and (found[3:] < 0).all()


def test_rows_and_decision_equal_the_nystrom_formula_by_brute_force():
    marks = ["idiot", "worthless", "garden", "window", "trash"]
    words = ["idxiot", "worth-less", "gardens", "wonder", "", "trashy", "idiot"]
    slow = lambda a, b: sum(x * slow_features(b).get(t, 0) for t, x in slow_features(a).items())
    among = np.array([[slow(a, b) for b in marks] for a in marks])
    with_marks = np.array([[slow(a, b) if a else 0.0 for b in marks] for a in words])
    expected = with_marks @ np.linalg.pinv(among) @ with_marks.T
    map_ = tox.Landmarks.of(marks)
    rows = map_.rows(words)
    assert np.allclose(rows[:, :-1] @ rows[:, :-1].T, expected, atol=1e-5) and (rows[:, -1] == 1).all()
    v = np.random.default_rng(1).normal(size=rows.shape[1])
    decided = map_.machine(v).decide(tox.Words.of(pa.array(words, pa.large_string())))
    assert np.allclose(decided, rows @ v, atol=1e-5)


def test_squared_hinge_counts_rows_and_is_minimal():
    rng = np.random.default_rng(2)
    x, y = np.column_stack([rng.normal(size=(60, 3)), np.ones(60)]), np.where(rng.random(60) < 0.4, 1.0, -1.0)
    count = rng.integers(1, 5, 60)

    def loss(v):
        cost = count * 60 / (2 * np.where(y > 0, count[y > 0].sum(), count[y < 0].sum()))
        return (cost * np.maximum(0, 1 - y * (x @ v)) ** 2).sum() + (v[:-1] ** 2).sum() + 1e-6 * v[-1] ** 2

    v = tox.squared_hinge(x, y, count)
    for step in rng.normal(size=(40, 4)) * 0.01:
        assert loss(v) <= loss(v + step) + 1e-9
    # A row that counts n times is the same as n rows, but for the penalty's share.
    again = tox.squared_hinge(np.repeat(x, count, 0), y.repeat(count), np.ones(count.sum()), penalty=count.sum() / 60)
    assert np.allclose(v, again, atol=1e-4)


def test_sentences_choose_their_worst_words():
    value = np.array([0.1, 0.9, -1.0, 0.9])
    bags = [[0, 1, 3], [2], [0, 2], [3, 2]]
    expected = [max(bag, key=lambda w: (value[w], -w)) for bag in bags]
    assert tox.worst_words(bags, value).tolist() == expected
    assert tox.worst_words([], value).tolist() == []


def test_an_id_that_repeats_teaches_once(spark):
    docs = spark.createDataFrame([(2, f"text {i:03d}") for i in range(500)] + [(3, "other")], "doc_id long, text string")
    known = spark.createDataFrame([(2, 1), (3, 0)], "id long, toxic int")
    rows = tox.labelled_sample(docs, known, "doc_id", "text").collect()
    assert sorted(map(tuple, rows)) == [(0, "other"), (1, "text 000")]
