"""Registered queries of the operators: thin, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from obsengine.llm import (
    exact_dedup,
    html_extraction,
    line_dedup,
    periodic_runs,
    pii,
    prefix_trie,
    quality_classifier,
    quality_rules,
    sentencepiece,
    simhash,
    source_mixing,
    topk_search,
    url_filters,
)
from obsengine.llm.common import body, let, table, words


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(table(spark, sf_dir, "documents"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(table(spark, sf_dir, "pages")).select(
        "page_id", "host", "path", "rule", "verdict")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_dedup.dedup(docs.select("doc_id", "text")).select(
        "doc_id", "text", F.length("text").cast("long").alias("n_chars"))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    def held_out(doc_id):
        return F.crc32(doc_id.cast("string")) % 5 == 0

    scored = quality_classifier.classify(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out(F.col("id")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op7_pii_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    counts = [pii.count_of(F.col("base"), kind).alias(f"n_{kind}")
              for kind in ("email", "ip", "card", "phone")]
    return found.select("doc_id", *counts,
                        F.sha2(pii.listing(F.col("base")), 256).alias("base_sha256"),
                        pii.listing(F.col("spans")).alias("spans"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(spark, f"{sf_dir}/documents.parquet").select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.encode_documents(table(spark, sf_dir, "documents"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract_pages(table(spark, sf_dir, "pages"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv_id = F.col("conv_id")
    return prefix_trie.trie(*prefix_trie.rebuilt(
        table(spark, sf_dir, "conversations"), source=conv_id - conv_id % 5,
        head=(F.crc32(conv_id.cast("string").cast("binary")) % 9).cast("int")))


def looped(doc_id, text):
    """The text of the periodic-run contract: with h the CRC-32 of the decimal id and
    h % 10 = 0, the words from a = g % n on repeat the first p of them (g = h div 10)."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def tail(w):
        n = F.size(w).cast("long")
        return let(g % n, lambda a: let(1 + F.floor((n - a) / (3 + g % 8)), lambda p: F.concat_ws(" ", F.transform(
            F.sequence(F.lit(0).cast("long"), n - 1),
            lambda i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))))))

    return F.when((h % 10 == 0) & (body(text) != ""), let(words(text), lambda w: F.when(F.size(w) > 0, tail(w)).otherwise(
        F.lit("")))).otherwise(body(text))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", looped(F.col("doc_id"), F.col("text")).alias("text"))
    longest = F.array_sort("runs", lambda a, b: F.when(a.length != b.length, b.length - a.length)
                           .when(a.start != b.start, a.start - b.start).otherwise(a.period - b.period).cast("int"))
    found = periodic_runs.detect(docs).withColumn("top", F.get(longest, F.lit(0)))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
        F.floor(1000 * F.col("top.length") / F.col("top.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "").cast("binary"), 256)
        .alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op13_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256))
    finite = ~F.exists("embedding", lambda x: F.isnan(x) | (F.abs(x) == float("inf")))
    return topk_search.top_k(rows.where(finite).select("vec_id", scaled.alias("vector")),
                             F.col("vec_id") % 50 == 0)


REGISTRY = {f.__name__: f for f in (
    op1_simhash_near_dedup, op2_url_filters, op3_quality_rules, op4_line_dedup,
    op5_source_mixing, op6_quality_classifier, op7_pii_sanitise, op8_exact_dedup,
    op9_sentencepiece, op10_html_extraction, op11_prefix_trie, op12_periodic_runs, op13_exact_topk)}
REGISTRY["pipeline"] = corpus_pipeline.run
