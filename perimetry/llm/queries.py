"""Registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perimetry.llm import (
    bpe, byte_bpe, conversations, decontaminate, embeddings, html_blocks, licences, lines, quality, reputation, runs,
    simhash, sql, substrings,
)

TOKENIZER = "word_bpe_49k.json"
RANKS = "byte_bpe_50k.tiktoken"
ACCEPTED = 0.3  # score from which a document counts as good


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    outcomes = reputation.page_outcomes(pages, _table(spark, sf_dir, "labels"))
    return reputation.judged(pages, outcomes).drop("bound")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return decontaminate.judged(found)


def op3_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.labelled(licences.scan(_table(spark, sf_dir, "documents")))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return bpe.digests(bpe.encode(docs, public_tokenizers.path(TOKENIZER), decoded=True))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(_table(spark, sf_dir, "pages"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(_table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digests(lines.drop_frequent_lines(_table(spark, sf_dir, "documents")))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = quality.scored(docs, quality.train(docs, _table(spark, sf_dir, "labels")))
    return found.select(
        "doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= ACCEPTED).cast("int").alias("predicted")
    )


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(_table(spark, sf_dir, "documents"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path(RANKS)
    return byte_bpe.digests(byte_bpe.decode(byte_bpe.encode(_table(spark, sf_dir, "documents"), ranks), ranks, hashed=True))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    made = docs.select("doc_id", runs.made_periodic(F.col("doc_id"), F.col("text")).alias("text"))
    return runs.digests(runs.periodic_runs(made, min_length=6, repeats=4))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    return conversations.report(conversations.damaged(turns), turns)


QUERIES = {
    f.__name__: f
    for f in (
        op1_url_filter, op2_decontamination, op3_licence_scan, op4_bpe, op5_html_text, op6_substring_dedup,
        op7_line_dedup, op8_embedding_near_dedup, op9_quality, op10_simhash, op11_byte_bpe, op12_periodic_runs,
        op13_conversation_repair,
    )
}

ORACLES = sql.ORACLES
