"""From `documents` to packed sequences: quality rules, near duplicates, repeated passages, source
mixing, packing. Each stage works on what the one before it kept, written as Parquet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import mixing, packing, quality, simhash, suffix
from ledgerlake.llm.common import importable, table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the base rules and lie in the perplexity band of their language."""
    return quality.judge(docs, keep=docs.columns).where("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked texts the row of the smallest id; of several such rows one of the
    smallest fingerprint, and of these one of the text with the smallest hash. Texts of one id that
    are not linked are in groups of their own. A row without an id goes if a row with one is in its
    group, else one of each distinct text may stay."""
    key = "near_key"
    while any(c.startswith(key) for c in docs.columns):
        key += "_"
    by_text = F.lit(1 << 62).bitwiseOR(F.pmod(F.xxhash64("text"), F.lit(1 << 62)))
    keyed = docs.withColumn(key, F.coalesce(F.col("doc_id").cast("long"), by_text))
    found = written(simhash.near_duplicates(keyed, id_col=key, with_root=True), "near")
    kept = found.where("id = component").groupBy("root").agg(F.min(F.struct("id", "fp")).alias("one"))
    kept = written(kept.select(F.col("one.id").alias(key), F.col("one.fp").alias(f"{key}_fp")), "kept")
    rows = keyed.join(kept.select(key).distinct(), key, "left_semi")
    again = written(found.groupBy(F.col("id").alias(key)).count().where("count > 1").select(key), "again")
    if again.isEmpty():
        return rows.select(*docs.columns)
    # Which row an id means is told by the text, for ids of several rows.
    several = rows.join(again, key, "left_semi").withColumn(f"{key}_text", F.xxhash64("text"))
    different = several.groupBy(f"{key}_text").agg(F.first("text").alias("text"))
    prints = simhash.fingerprints(different, id_col=f"{key}_text")
    prints = prints.select(F.col("id").alias(f"{key}_text"), F.col("fp").alias(f"{key}_fp"))
    of_id = several.select(key, f"{key}_text").distinct().join(prints, f"{key}_text").join(kept, [key, f"{key}_fp"])
    chosen = of_id.groupBy(key, f"{key}_fp").agg(F.min(f"{key}_text").alias(f"{key}_text"))
    several = several.join(chosen, [key, f"{key}_text"]).dropDuplicates([key, f"{key}_fp"])
    return rows.join(again, key, "left_anti").select(*docs.columns).union(several.select(*docs.columns))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, their texts without what starts earlier too."""
    others = [c for c in docs.columns if c != "text"]
    cut = suffix.remove_repeats(docs, keep=others)
    values = {c: F.col(f"row.`{c}`") for c in others} | {"text": F.col("kept")}
    if "n_chars" in others:
        values["n_chars"] = F.length("kept").cast(docs.schema["n_chars"].dataType)
    return cut.select(*(values[c].alias(c) for c in docs.columns))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it."""
    mixed = mixing.mix(docs, keep=docs.columns)
    return mixed.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("row.*")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows with their places in sequences."""
    packed = packing.pack_documents(docs)
    return packed.select(
        F.col("id").alias("doc_id"),
        "piece",
        "start",
        F.col("length").cast("long").alias("length"),
        F.col("crc").alias("ids_crc32"),
        F.col("sequence").alias("sequence_id"),
        "offset",
    )


def _stage(work: Stage) -> Stage:
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        importable(spark)
        return work(spark, docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", _stage(quality_rules)),
    ("simhash_near_dedup", _stage(near_duplicates)),
    ("suffix_array_dedup", _stage(repeated_passages)),
    ("source_mixing", _stage(source_mixing)),
    ("best_fit_packing", _stage(best_fit_packing)),
]

# Fingerprints, tokens and the language model are beyond SQL; the tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
