"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with the columns of
``documents``; the last returns token digests. Between stages the documents are written as Parquet to
the shared folder and read again. ``n_chars`` follows the text where a stage changes it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perimetry.llm import bpe, decontaminate, lines, quality, simhash
from perimetry.llm.queries import ACCEPTED, TOKENIZER
from perimetry.plans.storage import made, release, scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. It learns from the labels outside the held-out fold.

    Rows are scored where they stand, so rows that repeat a ``doc_id`` are judged one by one.
    """
    network = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.accepted(docs, network, ACCEPTED).select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines found in at least ten of them. A null text stays null."""
    found = lines.drop_frequent_lines(docs)
    changed = F.col("n_dropped") > 0
    return found.select(
        "doc_id", F.when(changed, F.col("kept")).otherwise(F.col("text")).alias("text"), "lang", "source",
        F.when(changed, F.length("kept").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: three-word shingles, at most three differing bits."""
    return simhash.keep_one(docs, shingle=3, radius=3).select(*COLUMNS)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token digests of every document left."""
    return bpe.digests(bpe.encode(docs, public_tokenizers.path(TOKENIZER), decoded=True))


STAGES = [
    ("quality_classifier", quality_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", near_copy_stage),
    ("benchmark_decontamination", benchmark_stage),
    ("bpe_encoding", token_stage),
]

ORACLE_SQL = None  # the classifier, SimHash and the tokenizer are not expressible in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    earlier = made()
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            path = scratch_path(spark, f"pipeline-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
            release(spark, keep=earlier | {path})  # what the stage itself had stored
    return docs
