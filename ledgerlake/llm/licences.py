"""Licence scans by a positional index of rare words. DataFrame functions only.

Licence texts are short templates. The words of a template that are rarest in the documents are its
entries in the index, with their positions. A document's words are looked up there; each entry
found proposes a place of its template. At a proposed place all words of the template are compared,
and its key phrase has to stand there word by word.
"""

from __future__ import annotations

import math
import string
from collections import Counter
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import written

# ASCII letters and digits one by one, which Java matches fastest, and all that is not ASCII.
_IN_WORD = string.digits + string.ascii_letters + r"\x80-\x{10FFFF}"
WORD, GAP = f"[{_IN_WORD}]+", f"[^{_IN_WORD}]+"
# Rarest words of a template that are in the index.
RARE = 3


class Template(NamedTuple):
    label: str
    text: str
    key: str
    base: bool = False


# Phrases of well-known licences and notices, and the phrase each has to hold.
TEMPLATES = (
    Template("cc-by", "cc by", "cc by", True),
    Template("gpl", "general public license", "general public license", True),
    Template("reserved", "all rights reserved", "all rights reserved", True),
    Template("agpl", "under the terms of the gnu affero general public license", "affero general public license"),
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             "redistribution and use in source and binary forms"),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license",
             "creative commons attribution"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("cc0", "cc0 1 0 universal public domain dedication", "cc0 1 0 universal"),
    Template("epl", "made available under the terms of the eclipse public license", "eclipse public license"),
    Template("gpl", "licensed under the gnu general public license version 3", "gnu general public license"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose",
             "permission to use copy modify and or distribute this software"),
    Template("lgpl", "under the terms of the gnu lesser general public license", "lesser general public license"),
    Template("mit", "released under the mit license", "mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy",
             "permission is hereby granted free of charge"),
    Template("mpl", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             "free and unencumbered software"),
)


def lowered(text: Column) -> Column:
    """A-Z in lower case, and no other letter changed."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def document_counts(docs: DataFrame, text_col: str, words: list[str]) -> tuple[int, dict[str, int]]:
    """Documents, and how many of them hold each of `words`; one small aggregate over all texts."""
    own = F.array_intersect(F.split(lowered(F.col(text_col)), GAP), F.array(*map(F.lit, words)))
    # The empty word stands for the document itself.
    named = F.concat(F.array(F.lit("")), F.array_remove(F.coalesce(own, F.array().cast("array<string>")), ""))
    counts = docs.select(F.explode(named).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()
    found = {r["word"]: r["n"] for r in counts}
    return found.pop("", 0), found


class Posting(NamedTuple):
    word: str
    template: int
    place: int
    weight: float  # share of the template's idf
    in_key: int
    indexed: bool


def postings(templates: tuple[Template, ...], documents: int, holding: dict[str, int]) -> list[Posting]:
    """All words of all templates with their idf; the rarest ones of each are in the index."""
    rows = []
    for t, template in enumerate(templates):
        words, key = template.text.split(), template.key.split()
        start = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
        idf = [math.log((documents + 1) / (holding.get(w, 0) + 1)) + 1e-9 for w in words]
        inside = range(start, start + len(key))
        rare = sorted(inside, key=lambda i: (-idf[i], i))[:RARE]
        rows += [
            Posting(w, t, i, idf[i] / sum(idf), int(i in inside), i in rare) for i, w in enumerate(words)
        ]
    return rows


def _table(spark: SparkSession, rows: list[Posting]) -> DataFrame:
    """The postings, which are as many as the templates have words."""
    literals = [F.struct(*(F.lit(v).alias(c) for c, v in row._asdict().items())) for row in rows]
    return F.broadcast(spark.range(1).select(F.inline(F.array(*literals))))


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: tuple[Template, ...] = TEMPLATES,
) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) for each row.

    n_base counts the places of the base templates; first_word and last_word are the smallest and
    largest of their starts, null without any. The labels are distinct, sorted and joined by commas,
    empty without any. The score is the largest share of a template's idf found at one place where
    its key phrase stands, 0 without any.

    A null text is empty. Very long texts are scanned whole. Rows without an id and repeated rows are
    scanned like any other. Other columns are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    words = sorted({w for t in templates for w in t.text.split()})
    entries = postings(templates, *document_counts(docs, text_col, words))
    # A text without any of these strings holds no key phrase: each phrase has one of them.
    needed, text = set(), F.lower(F.col(text_col))
    frequency = Counter(p.word for p in entries)
    for t in range(len(templates)):
        rare = [p for p in entries if p.template == t and p.in_key]
        best = max(rare, key=lambda p: (len(p.word) > 3, p.weight if len(p.word) > 3 else frequency[p.word], p.word))
        needed.add(best.word)
    may = F.lit(False)
    for word in sorted(needed):
        may = may | text.contains(word)
    spaced = F.trim(F.regexp_replace(lowered(F.col(text_col)), GAP, " "))
    rows = written(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).cast("long").alias("id"),
            F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("n_words"),
            F.when(may, spaced).alias("spaced"),
        ),
        "scanned",
    )
    places = rows.where("spaced is not null").select("row", F.posexplode(F.split("spaced", " ")).alias("at", "word"))
    hits = written(places.where(F.col("word").isin(words)), "licence-words")
    index = _table(spark, [p for p in entries if p.indexed])
    by = ["row", "template", "start"]
    proposed = (
        hits.join(index, "word").select("row", "template", (F.col("at") - F.col("place")).alias("start")).distinct()
    )
    compared = hits.join(_table(spark, entries), "word").withColumn("start", F.col("at") - F.col("place"))
    compared = compared.join(proposed, by, "left_semi").groupBy(by)
    compared = compared.agg(F.sum("weight").alias("share"), F.sum("in_key").alias("key_words"))
    known = [
        F.struct(
            F.lit(i).alias("template"),
            F.lit(len(t.key.split())).alias("needed"),
            F.lit(t.label).alias("label"),
            F.lit(t.base).alias("base"),
        )
        for i, t in enumerate(templates)
    ]
    named = F.broadcast(spark.range(1).select(F.inline(F.array(*known))))
    verified = compared.join(named, "template").where("key_words = needed")
    base = F.col("base")
    found = verified.groupBy("row").agg(
        F.sum(base.cast("long")).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"),
        F.least(F.max(F.round("share", 9)), F.lit(1.0)).alias("score"),
    )
    return rows.select("row", "id", "n_words").join(found, "row", "left").select(
        "id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
