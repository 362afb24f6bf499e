"""The registered queries of this package, thin over its operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import alignment, hmm, html_text, lexical, licences, mixing, packing, quality, quotes, simhash, suffix, topk, toxicity
from ledgerlake.llm.common import importable, table
from ledgerlake.llm.oracle import ORACLE

__all__ = ["ORACLE", "REGISTRY"]
REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def registered(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return query(spark, sf_dir)

    REGISTRY[query.__name__] = run
    return query


@registered
def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@registered
def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return mixed.select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", "taken")


@registered
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"))
    return packed.select(
        F.col("id").alias("doc_id"),
        "piece",
        "start",
        F.col("length").cast("long").alias("length"),
        F.col("crc").alias("ids_crc32"),
        F.col("sequence").alias("sequence_id"),
        "offset",
    )


@registered
def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix.remove_repeats(table(spark, sf_dir, "documents"), keep=["doc_id"])
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return cut.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        "kept_sha256",
    )


@registered
def op2_perplexity_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return judged.select(
        F.col("row.doc_id").alias("doc_id"), *quality.Metrics._fields, "base_failed", "kept", "bits"
    )


@registered
def op7_string_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    machine = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, machine).select(
        F.col("id").alias("doc_id"), toxicity.held_out("id").alias("held_out"), "score", "predicted"
    )


@registered
def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topk.search(table(spark, sf_dir, "embeddings"), wanted=F.col("id") % 100 == 0)
    return found.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")


@registered
def op6_min_cut_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = html_text.extract(pages, keep=["page_id", "url"], weights=html_text.fit(pages))
    return found.select("row.page_id", "row.url", "text", "n_chars")


@registered
def op9_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@registered
def op4_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.reply_ordered(table(spark, sf_dir, "conversations"))


@registered
def op11_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical.build(table(spark, sf_dir, "documents"))
    found = lexical.search(index, table(spark, sf_dir, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


@registered
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.link_texts(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@registered
def op13_hidden_markov_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score_texts(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
