import random
import re

from ledgerlake.llm import quotes

SCHEMA = "conv_id long, turn long, role string, text string, position string"
INTRO = re.compile(r"(?i)^[ \t]*(on|am|le|el)\b.*(wrote|writes|schrieb|écrit|escribió)[^:]*:[ \t\r]*$")


def norm(text):
    return re.sub(r"[ \t\n\r\f\v]+", " ", text).strip(" ").lower()


def slow(rows):
    """The definition, message by message."""
    low = -(1 << 63)
    key = lambda r: (low if r[0] is None else r[0], low if r[1] is None else r[1], r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")
    rows = sorted(set(rows), key=key)
    parsed = []
    for _, _, _, text in rows:
        lines = []
        for line in (text or "").split("\n"):
            marks = re.match(r"[ \t]*(?:>[ \t]*)+", line)
            lines.append((marks[0].count(">"), line[marks.end() :]) if marks else (0, line))
        nexts = [*lines[1:], (0, "")]
        lines = [x for x, y in zip(lines, nexts) if not (x[0] == 0 and y[0] > 0 and INTRO.match(x[1]))]
        passages = []
        for level, line in lines:
            if not passages or passages[-1][0] != level:
                passages.append((level, []))
            passages[-1][1].append(line)
        parsed.append((passages, "\n".join(x for n, x in lines if n == 0).strip(" ")))

    def units(lines):
        found = [(1, norm(" ".join(lines)))] + [(0, norm(x)) for x in lines] * (len(lines) > 1)
        return [u for u in found if u[1]]

    own = [{u for n, lines in p if n == 0 for _, u in units(lines)} for p, _ in parsed]
    parent, linked = [], []
    for i, row in enumerate(rows):
        n, first = 0, None
        for level, lines in parsed[i][0]:
            options = []
            for whole, u in units(lines) if level else ():
                here = next((j for j in range(len(rows)) if rows[j][0] == row[0] and u in own[j]), None)
                one = next((j for j in range(len(rows)) if rows[j][0] != row[0] and u in own[j]), None)
                if here is not None and here < i:
                    options.append((1, whole, len(u), here))
                elif one is not None:
                    options.append((0, whole, len(u), one))
            if options:
                n += 1
                best = max(options)
                if level == 1 and best[0] and first is None:
                    first = best[3]
        before = i - 1 if i and rows[i - 1][0] == row[0] else None
        parent.append(before if first is None else first)
        linked.append(n)
    order = {}

    def visit(i, conv):
        order[i] = len([j for j in order if rows[j][0] == conv])
        for j in range(len(rows)):
            if parent[j] == i:
                visit(j, conv)

    for i in range(len(rows)):
        if parent[i] is None:
            visit(i, rows[i][0])
    return sorted(
        (
            (r[0], order[i], r[1], r[2], parsed[i][1], None if parent[i] is None else rows[parent[i]][1],
             sum(n > 0 for n, _ in parsed[i][0]), linked[i])
            for i, r in enumerate(rows)
        ), key=str,
    )


def run(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(parts)
    return sorted((tuple(r) for r in quotes.reply_ordered(df).collect()), key=str)


def test_a_mail_thread(spark):
    rows = [
        (1, 1, "a", "Hello all,\nwho wants tea?"),
        (1, 2, "b", "Me."),
        (1, 3, "c", "> Me.\nMe too."),
        (1, 4, "d", "On Monday A wrote:\n> Hello all,\n>  WHO wants  tea?\nNot me.\nI like coffee."),
        (1, 5, "e", ">> who wants tea?\n> Me too.\nAnd cake?"),
        (1, 6, "f", "> nobody said this\nHm."),
        (2, 1, "a", "> Not me.\nSomebody elsewhere said that."),
    ]
    got = run(spark, rows)
    assert got == slow(rows)
    assert [(r[2], r[5]) for r in sorted(got, key=lambda r: (r[0], r[1])) if r[0] == 1] == [
        (1, None), (2, 1), (3, 2), (5, 3), (6, 5), (4, 1)
    ]
    assert ("Not me.\nI like coffee." in {r[4] for r in got}) and got[-1][-1] == 1


def test_random_threads_equal_brute_force(spark):
    for seed in range(3):
        rng = random.Random(seed)
        lines = ["yes", "No way", "maybe  so", "what is it?", "a longer line of text", "", "ok"]
        rows = []
        for conv in (1, 2, None):
            for turn in range(25):
                parts = [">" * rng.choice([0, 0, 0, 1, 1, 2]) + " " + rng.choice(lines) for _ in range(rng.randint(1, 3))]
                rows.append((conv, turn // 2 if conv == 2 else turn, rng.choice("ab"), "\n".join(parts)))
        assert run(spark, rows, parts=4) == slow(rows)


def test_deep_threads(spark):
    rows = [(1, 0, "a", "m0"), (1, 1, "a", "m1")] + [(1, i, "a", f"> m{i - 2}\nm{i}") for i in range(2, 40)]
    assert run(spark, rows) == slow(rows)


def test_odd_rows(spark):
    rows = [(1, 1, "a", None), (1, 1, "a", None), (1, None, None, ""), (None, 1, "a", "x"), (1, 2, "b", "> > >\n>"), (1, 2, "a", "> x")]
    assert run(spark, rows) == slow(rows)
    assert run(spark, []) == []
    long = [(5, 0, "a", "some line\n" * 30_000), (5, 1, "b", "> some line\n" * 30_000 + "reply")]
    assert [r[1:] for r in run(spark, long)][1] == (1, 1, "b", "reply", 0, 1, 1)


def test_conversations_without_quotes_stay(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    found = sorted((r.conv_id, r.position, r.turn, r.role, r.text) for r in quotes.reply_ordered(df).collect())
    rows = sorted((r.conv_id, r.turn, r.role, r.text) for r in df.distinct().collect())
    assert [(c, t, r, x) for c, _, t, r, x in found] == [(c, t, r, x.strip(" ")) for c, t, r, x in rows]
    plan = quotes.reply_ordered(df)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_the_original_in_another_conversation(spark):
    line = "a line that several conversations have"
    rows = [(1, 0, "a", f"> {line}\nwell"), (1, 1, "b", line), (2, 0, "c", line), (3, 0, "d", line)]
    found = run(spark, rows)
    assert found == slow(rows) and sum(r[-1] for r in found) == 1


def test_deep_replies(spark):
    n = 4000
    rows = [(1, i, f"word{i}" if i < 2 else f"> word{i - 2}\nword{i}") for i in range(n)]
    rows += [(2, 0, "root")] + [(2, i, f"> root\nanswer{i}") for i in range(1, 500)]
    table = spark.createDataFrame([(c, t, "user", x) for c, t, x in rows], "conv_id long, turn long, role string, text string")
    found = quotes.reply_ordered(table).select("conv_id", "position", "turn").collect()
    order = {c: [t for _, t in sorted((r.position, r.turn) for r in found if r.conv_id == c)] for c in (1, 2)}
    assert order[1] == [0, *range(1, n, 2), *range(2, n, 2)]
    assert order[2] == list(range(500))
