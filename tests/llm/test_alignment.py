import hashlib
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
from tokenizers import Tokenizer

from ledgerlake.llm import alignment

SCHEMA = "doc_id long, text string, pairs string, key string, n_a string"
PATHS = alignment.default_paths()


def byte_letters():
    kept = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in kept]
    return {chr(b): b for b in kept} | {chr(256 + n): b for n, b in enumerate(rest)}


LETTERS = byte_letters()


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def piece_bytes(model, i):
    piece = model.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()


def slow(both, docs):
    a, b = both
    linked, rows = Counter(), []
    for i, text in docs:
        one = [(x.id if hasattr(x, "id") else x) for x in (a.encode(" " + text, add_special_tokens=False).ids if text else [])]
        two = b.encode(text) if text else []
        one_bytes = [bytes(LETTERS[c] for c in a.id_to_token(x)) for x in one]
        two_bytes = [piece_bytes(b, x) for x in two]
        if not text or not b"".join(one_bytes) == b"".join(two_bytes) == (" " + text).encode():
            rows.append((i, [], [], []))
            continue
        ends = []
        for pieces in (one_bytes, two_bytes):
            at, own = 0, {}
            for n, piece in enumerate(pieces):
                at += len(piece)
                own[at] = n
            ends.append(own)
        links = [(ends[0][e], ends[1][e]) for e in sorted(ends[0].keys() & ends[1].keys())]
        linked.update((one[x], two[y]) for x, y in links)
        rows.append((i, one, two, links))
    highest = defaultdict(int)
    for (_, y), n in linked.items():
        highest[y] = max(highest[y], n)
    found = []
    for i, one, two, links in rows:
        groups, x0, y0 = [], 0, 0
        for x, y in links:
            groups.append(",".join(map(str, one[x0 : x + 1])) + "|" + ",".join(map(str, two[y0 : y + 1])))
            x0, y0 = x + 1, y + 1
        pairs = [(one[x], two[y]) for x, y in links]
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if one else ""
        best = sum(linked[p] == highest[p[1]] for p in pairs)
        found.append((i, len(one), len(two), len(groups), len(links), best, sum(linked[p] for p in pairs), digest))
    return Counter(found)


def run(spark, docs, parts=3):
    rows = spark.createDataFrame([(i, t, "x", None, "y") for i, t in docs], SCHEMA).repartition(parts)
    found = alignment.link_texts(rows)
    assert found.columns == ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return Counter(tuple(r) for r in found.collect())


def texts(seed, n=200):
    rng = random.Random(seed)
    parts = ["the", "Unbelievable", "ñasquera", "don't", "we'll", " ", "  ", "\n", "\t", "\r\n", ".", "...", "日本語", "й", "😀", "12345", "a", "_",
             "<|endoftext|>", "<s>", "</s>", "<0x41>", "\x00", "\x1f", "\xa0", "　", "▁", "​", "ß", "é", "|", "x" * 60]
    docs = []
    for i in range(n):
        glue = rng.choice(["", " ", " "])
        docs.append((i, glue.join(rng.choices(parts, [8] * 24 + [1] * (len(parts) - 24), k=rng.randint(0, 30)))))
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, both, seed):
    docs = texts(seed) + [(1000 + i, "the very same text") for i in range(40)] + [(None, "no id"), (5, "twice"), (5, "twice")]
    docs += [(2000, None), (2001, ""), (2002, " "), (2003, "\n"), (2004, "ends in a blank "), (2005, "long " * 5000 + "é" * 3000)]
    assert run(spark, docs) == slow(both, docs)


def test_units_give_the_ids_of_whole_texts(both, monkeypatch):
    monkeypatch.setattr(alignment, "ENCODED_BYTES", 30)
    spaced = [" " + t for _, t in texts(3, 3000)]
    found = alignment.tokenized(alignment.coders(PATHS), spaced)
    for tokens, ids in zip(found, ([both[0].encode(s, add_special_tokens=False).ids for s in spaced], both[1].encode([s[1:] for s in spaced])), strict=True):
        at = 0
        for end, own in zip(tokens.ends.tolist(), ids, strict=True):
            assert tokens.ids[at:end].tolist() == own
            at = end


def test_pieces_of_a_batch_give_the_same(spark, both, monkeypatch):
    docs = texts(4, 60)
    monkeypatch.setattr(alignment, "PIECE_BYTES", 200)
    assert run(spark, docs, 1) == slow(both, docs)


def test_pairs_are_ends_of_one_another(spark):
    rows = spark.createDataFrame([(i, t) for i, t in texts(5, 50)], "doc_id long, text string")
    aligned = alignment.aligned_texts(rows, PATHS, "doc_id", "text")
    a, b = alignment.coders(PATHS)
    pairs = [r.pair for r in alignment.pair_counts(alignment.written(aligned, "t")).collect()]
    for pair in pairs:
        one, two = a.bytes[pair >> 32].as_py(), b.bytes[pair & 0xFFFFFFFF].as_py()
        assert one.endswith(two) or two.endswith(one)
    assert pairs


def test_empty_table(spark):
    assert run(spark, []) == Counter()
