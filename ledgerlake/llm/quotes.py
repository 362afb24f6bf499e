"""Quotation linking for chats and mail. DataFrame functions only.

Lines that begin with `>` signs are quotes, as many levels deep as there are signs. Lines of one
level that follow each other are a passage. A quoted passage, or failing that one of its lines, is
looked up by the hash of its normalised text among the passages and lines that messages have
written themselves; its original is the first message that has it, in the same conversation before
the quoting message, or else in any other conversation.

A message answers the original of its first passage of level one, or without such a link the
message before it. Conversations come in the order of replies: a message, the message after it and
all that follows from it, then what quotes the message later on.

Rows are numbered in sorted order over all partitions, so that neither a long conversation nor a
frequent passage has to be in one task. A message's place in its conversation's tree is one number,
however deep the replies are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import written

NOWHERE = -(1 << 63)
_MARKS = r"^[ \t]*(?:>[ \t]*)+"
_INTRO = r"(?i)^[ \t]*(on|am|le|el)\b.*(wrote|writes|schrieb|écrit|escribió)[^:]*:[ \t\r]*$"


def normalised(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def parsed(text: Column) -> Column:
    """The passages of a text: array of (level, lines), lines without their marks. A line that
    introduces a quote, as mail programs write it, belongs to no passage."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    level = lambda line: F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 0), "[^>]", ""))
    marked = F.transform(lines, lambda s: F.struct(level(s).alias("level"), F.regexp_replace(s, _MARKS, "").alias("line")))
    following = F.slice(F.concat(marked, F.array(F.struct(F.lit(0).alias("level"), F.lit("").alias("line")))), 2, F.size(marked))
    paired = F.arrays_zip(marked.alias("own"), following.alias("next"))
    real = F.filter(
        paired, lambda p: ~((p["own"]["level"] == 0) & (p["next"]["level"] > 0) & p["own"]["line"].rlike(_INTRO))
    )
    return F.transform(real, lambda p: p["own"])


def _passages(lines: Column) -> Column:
    """Runs of lines of one level, from an array of (level, line)."""
    places = F.when(F.size(lines) > 0, F.sequence(F.lit(0), F.size(lines) - 1)).otherwise(F.array().cast("array<int>"))
    starts = F.filter(places, lambda i: (i == 0) | (lines[F.greatest(i - 1, F.lit(0))]["level"] != lines[i]["level"]))
    ends = F.concat(F.slice(starts, 2, F.size(lines) + 1), F.array(F.size(lines)))
    return F.transform(
        F.arrays_zip(starts.alias("a"), ends.alias("b")),
        lambda p: F.struct(
            lines[p["a"]]["level"].alias("level"),
            F.transform(F.slice(lines, p["a"] + 1, p["b"] - p["a"]), lambda x: x["line"]).alias("lines"),
        ),
    )


def messages(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Distinct messages in order: seq (a number that grows with conversation and turn), conv, turn,
    the given columns as `given`, `own` text without quotes, passages."""
    text = F.col(text_col).cast("string")
    lines = F.col("parsed")
    own = F.filter(lines, lambda x: x["level"] == 0)
    distinct = rows.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn_id"),
        F.col(role_col).cast("string").alias("role"),
        text.alias("text"),
    ).distinct()
    order = ["conv", "turn", "role", "text"]
    sorted_rows = (
        distinct.withColumn("conv", F.coalesce("conv_id", F.lit(NOWHERE)))
        .withColumn("turn", F.coalesce("turn_id", F.lit(NOWHERE)))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("seq", F.monotonically_increasing_id())
    )
    return (
        sorted_rows.withColumn("parsed", parsed(F.col("text")))
        .withColumn("own", F.trim(F.array_join(F.transform(own, lambda x: x["line"]), "\n")))
        .withColumn("passages", _passages(lines))
        .drop("parsed", "text")
    )


def _units(rows: DataFrame, quoted: bool) -> DataFrame:
    """One row for each passage and each line of several, normalised, of the quotes or the rest."""
    one = rows.select("seq", "conv", F.posexplode("passages").alias("passage", "p"))
    one = one.where((F.col("p.level") > 0) if quoted else (F.col("p.level") == 0))
    whole = F.struct(F.lit(1).alias("whole"), F.array_join("p.lines", " ").alias("text"))
    lines = F.transform("p.lines", lambda x: F.struct(F.lit(0).alias("whole"), x.alias("text")))
    every = F.when(F.size("p.lines") > 1, F.concat(F.array(whole), lines)).otherwise(F.array(whole))
    units = one.select("seq", "conv", "passage", F.col("p.level").alias("level"), F.explode(every).alias("u"))
    units = units.select(
        "seq", "conv", "passage", "level", F.col("u.whole").alias("whole"), normalised(F.col("u.text")).alias("unit")
    )
    return units.where("unit <> ''").withColumn("hash", F.xxhash64("unit"))


def links(rows: DataFrame) -> DataFrame:
    """(seq, passage, level, origin, local) for each quoted passage that is found: origin is the
    seq of the original, local whether it is in the same conversation."""
    quoted = written(_units(rows, True), "quoted")
    wanted = quoted.select("hash", "unit").distinct()
    known = _units(rows, False).join(wanted, ["hash", "unit"], "left_semi")
    first = written(known.groupBy("hash", "unit", "conv").agg(F.min("seq").alias("here")), "originals")
    # The first messages of two conversations, so that one of them is not the quoting one.
    earliest = F.row_number().over(Window.partitionBy("hash", "unit").orderBy("here"))
    two = first.withColumn("place", earliest).where(F.col("place") <= 2)
    at = lambda place: F.max(F.when(F.col("place") == place, F.struct("here", "conv")))
    anywhere = two.groupBy("hash", "unit").agg(at(1).alias("one"), at(2).alias("two"))
    found = quoted.join(first, ["hash", "unit", "conv"], "left").join(anywhere, ["hash", "unit"], "left")
    local = F.coalesce(F.col("here") < F.col("seq"), F.lit(False))
    other = F.when(F.col("one.conv") != F.col("conv"), F.col("one.here")).otherwise(F.col("two.here"))
    foreign = other.isNotNull()
    size = F.length("unit")
    best = F.struct(
        local.cast("int").alias("local"), "whole", size.alias("size"), (-F.col("seq")).alias("back"),
        F.when(local, F.col("here")).otherwise(other).alias("origin"),
    )
    chosen = found.where(local | foreign).groupBy("seq", "passage", "level").agg(F.max(best).alias("best"))
    return chosen.select("seq", "passage", "level", "best.origin", (F.col("best.local") == 1).alias("local"))


def _carried(rows: DataFrame, value: Column, name: str, include: bool) -> DataFrame:
    """`rows` with the last `value` that is not null at or before each row, in the order of seq
    (only before it without `include`). Each partition of seq finds its own; what a partition
    hands on is one row."""
    part = F.shiftright("seq", 33)
    upto = 0 if include else -1
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, upto)
    rows = rows.withColumn("part", part).withColumn("value", value)
    rows = rows.withColumn(name, F.last("value", ignorenulls=True).over(inside))
    ends = rows.groupBy("part").agg(F.max_by("value", F.when(F.col("value").isNotNull(), F.col("seq"))).alias("end"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("part", F.last("end", ignorenulls=True).over(earlier).alias("handed"))
    joined = rows.join(F.broadcast(ends), "part")  # a row for each shuffle partition
    return joined.withColumn(name, F.coalesce(name, "handed")).drop("part", "value", "handed")


def _starts(heads: DataFrame) -> DataFrame:
    """(head, start) from heads (head, up, parent): numbers that order the runs of a conversation, a run
    before those that answer it, of these those of a later message first.

    A run is entered and left; each of these steps knows the step after it, which is the entry of
    the first run below or beside, or else the leaving. Doubling the way that is known tells how
    far each step is from the last one, in as many rounds as the logarithm of a conversation's runs.
    """
    below = heads.where("up is not null").withColumn("back", -F.col("parent"))
    order = ["up", "back", "head"]
    below = below.repartitionByRange(*order).sortWithinPartitions(*order)
    below = written(below.select("up", "head", F.monotonically_increasing_id().alias("seq")), "below")
    beside = _carried(below, F.struct("up", "head"), "before", include=False)
    beside = beside.select("up", "head", F.when(F.col("before.up") == F.col("up"), F.col("before.head")).alias("prior"))
    beside = written(beside, "beside")
    entry = lambda c: F.shiftleft(c, 1)
    leaving = lambda c: F.shiftleft(c, 1) + 1
    answered = beside.where("prior is null").select("up", "head")
    later = beside.where("prior is not null").select("prior", "head")
    roots = heads.where("up is null")
    empty = roots.join(answered, roots["head"] == answered["up"], "left_anti")
    rest = heads.join(empty.select("head"), "head", "left_anti")
    leaves = rest.join(answered.select(F.col("up").alias("head")), "head", "left_anti")
    last = beside.select("up", "head").join(later.select(F.col("prior").alias("head")), "head", "left_anti")
    steps = (
        answered.select(entry("up").alias("step"), entry("head").alias("after"))
        .union(later.select(leaving("prior"), entry("head")))
        .union(leaves.select(entry("head"), leaving("head")))
        .union(last.select(leaving("head"), leaving("up")))
        .union(rest.where("up is null").select(leaving("head"), F.lit(None).cast("long")))
    )
    steps = written(steps.withColumn("far", F.col("after").isNotNull().cast("long")), "steps")
    while not steps.where("after is not null").isEmpty():
        ahead = steps.select(F.col("step").alias("after"), F.col("after").alias("after2"), F.col("far").alias("far2"))
        joined = steps.join(ahead, "after", "left")
        far = F.col("far") + F.coalesce("far2", F.lit(0))
        steps = written(joined.select("step", F.col("after2").alias("after"), far.alias("far")), "steps")
    found = steps.where("step % 2 = 0").select(F.shiftright("step", 1).alias("head"), (-F.col("far")).alias("start"))
    return found.union(empty.select("head", F.lit(0).cast("long").alias("start")))


def reply_ordered(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """(conv_id, position, turn, role, text, parent_turn, n_quotes, n_linked): each distinct message
    with its own text alone and its place in its conversation, from 0; parent_turn is the turn of
    the message it answers, null for a first one. n_quotes counts quoted passages, n_linked those
    whose original is known.

    Equal rows are one message. Messages of one turn come in the order of role and text, null
    first. Null conversations are one conversation, null turns come first. A null text is empty. Very
    long texts are parsed whole. Other columns are not read. An empty table gives no rows.
    """
    given = written(messages(rows, conv_col, turn_col, role_col, text_col), "messages")
    linked = written(links(given), "links")
    counts = linked.groupBy("seq").agg(
        F.count(F.lit(1)).alias("n_linked"),
        F.min(F.when((F.col("level") == 1) & F.col("local"), F.struct("passage", "origin"))).alias("first"),
    )
    counts = counts.select("seq", "n_linked", F.col("first.origin").alias("origin"))
    before = _carried(given.select("seq", "conv"), F.struct("seq", "conv"), "before", include=False)
    before = before.select("seq", F.when(F.col("before.conv") == F.col("conv"), F.col("before.seq")).alias("previous"))
    tied = before.join(counts, "seq", "left").withColumn("parent", F.coalesce("origin", "previous"))
    opens = F.col("previous").isNull() | (F.col("parent") != F.col("previous"))
    tree = written(_carried(tied, F.when(opens, F.col("seq")), "head", include=True), "replies")
    opening = tree.where("seq = head")
    parents = tree.select(F.col("seq").alias("parent"), F.col("head").alias("up"))
    heads = opening.select("head", "parent").join(parents, "parent", "left")
    starts = _starts(written(heads.select("head", "up", "parent"), "heads"))
    keyed = tree.join(starts, "head")
    full = given.join(keyed.select("seq", "start", "parent", "n_linked"), "seq")
    full = full.join(given.select(F.col("seq").alias("parent"), F.col("turn_id").alias("parent_turn")), "parent", "left")
    quotes = F.size(F.filter("passages", lambda p: p["level"] > 0))
    numbered = written(
        full.select(
            "conv",
            "start",
            "seq",
            "conv_id",
            F.col("turn_id").alias("turn"),
            "role",
            F.col("own").alias("text"),
            "parent_turn",
            quotes.cast("long").alias("n_quotes"),
            F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        )
        .repartitionByRange("conv", "start", "seq")
        .sortWithinPartitions("conv", "start", "seq")
        .withColumn("place", F.monotonically_increasing_id()),
        "numbered",
    ).withColumn("part", F.shiftright("place", 33))
    runs = numbered.groupBy("conv", "part").agg(F.min("place").alias("first_place"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = runs.select("conv", "part", "first_place", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    return numbered.join(bases, ["conv", "part"]).select(
        "conv_id",
        (F.col("place") - F.col("first_place") + F.col("base")).cast("long").alias("position"),
        "turn",
        "role",
        "text",
        "parent_turn",
        "n_quotes",
        "n_linked",
    )
