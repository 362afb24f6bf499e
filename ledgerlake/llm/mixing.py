"""Mix sources to target weights: capped water-filling, then whole and fractional repetitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import WORD, written
from ledgerlake.operators.joins import lookup_join

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 17
# Documents of one source and size class are ordered in groups of about so many.
STRATUM = 256


def word_count(text: Column) -> Column:
    """Words between ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A name for each source that is never null."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def uniform_bits(*parts: Column) -> Column:
    """60 bits that depend on the parts and the seed alone."""
    text = F.concat_ws("-", F.lit(str(SEED)), *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def water_fill(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, words) with one row for each source -> also (cap, target: double).

    Sources weigh `weights` in the order of their names, repeating, null last, and share all
    words. A target over its cap of `max_epochs` times the source stops there, and what it leaves
    goes to the others by weight, until none is above. Filling the sources in the order of
    cap / weight meets the caps in just the order of these rounds, so one running sum finds the
    water level. There is one row per source, so the windows see as many rows as there are sources.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    by_cap = Window.orderBy("ratio", F.asc_nulls_last("source"))
    everything = Window.partitionBy()
    cyclic = F.element_at(
        F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")
    )
    ranked = (
        sources.withColumn("weight", cyclic.cast("long"))
        .withColumn("cap", F.col("words") * max_epochs)
        .withColumn("ratio", F.col("cap").cast("double") / F.col("weight"))
    )
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_cap.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("words").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    level = left.cast("double") / F.sum("weight").over(onward)
    levels = ranked.withColumn("level", level).withColumn("full", F.col("level") * F.col("weight") >= F.col("cap"))
    water = F.min(F.when(~F.col("full"), F.struct("ratio", "level"))).over(everything)
    return levels.withColumn("water", water["level"]).select(
        "source",
        "words",
        "cap",
        F.when(F.col("full"), F.col("cap").cast("double"))
        .otherwise(F.least(F.col("cap").cast("double"), F.col("water") * F.col("weight")))
        .alias("target"),
    )


def mix(
    docs: DataFrame,
    keep: list[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """How often the mix takes each row: the columns `keep` as a struct `row`, and `size`,
    `source_size`, `target`, `copies`, `taken` (long, but for the double `target`).

    A source of target / size epochs takes each document the whole part of that many times; the
    fraction picks documents evenly along the order of their size, starting at a seeded place, so
    that what is taken differs from the target by about one document. Equal sizes come in the
    order of a seeded hash of the id, and rows of one id, or without any, in that of their texts.
    Reruns agree; rows that are equal in both may stand for each other.

    A null text and a text without words have size 0 and are taken 0 words. Null sources are one
    source, the last. Rows without an id and repeated rows take part as rows of their own. An
    empty table gives no rows. `keep` may name any column, also one named like those of the result.
    """
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row"),
        F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("size"),
        uniform_bits(F.col(id_col)).alias("draw"),
        F.xxhash64(F.lit(SEED), F.col(text_col).cast("string")).alias("tie"),
    ).withColumn("class", F.floor(F.sqrt("size")))
    classes = written(
        rows.groupBy("source", "class").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words")), "classes"
    )
    targets = water_fill(classes.groupBy("source").agg(F.sum("words").alias("words")), weights, max_epochs)
    epochs = F.when(F.col("words") > 0, F.col("target") / F.col("words")).otherwise(F.lit(0.0))
    shares = targets.select(
        source_key(F.col("source")).alias("stratum"),
        F.col("words").alias("source_size"),
        "target",
        F.floor(epochs).alias("whole"),
        (epochs - F.floor(epochs)).alias("part"),
        (uniform_bits(F.lit("source"), F.col("source")) / F.lit(float(1 << 60))).alias("start"),
    )
    earlier = Window.partitionBy("source").orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    strata = classes.select(
        source_key(F.col("source")).alias("stratum"),
        "class",
        "n",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"),
        F.ceil(F.col("n") / STRATUM).alias("cuts"),
    ).join(shares, "stratum")
    named = rows.withColumn("stratum", source_key(F.col("source"))).drop("source")
    joined = lookup_join(named, written(strata, "strata"), ["stratum", "class"])
    cut = F.pmod("draw", "cuts")
    along = Window.partitionBy("stratum", "class", "cut").orderBy("size", "draw", "tie")
    place = F.col("start") + F.col("part") * (F.col("base") + F.col("cut") * F.col("n") / F.col("cuts"))
    at = F.row_number().over(along)
    extra = F.floor(place + F.col("part") * at) - F.floor(place + F.col("part") * (at - 1))
    return (
        joined.withColumn("cut", cut)
        .withColumn("copies", (F.col("whole") + extra).cast("long"))
        .select("row", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )
