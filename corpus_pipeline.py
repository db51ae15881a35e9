"""The corpus pipeline: five stages from raw documents to packed training sequences.

Each stage takes what the stage before it kept. The first four return the columns of the documents
they keep; the last returns the pieces of all kept documents with their place in a sequence.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import exact_dedup, language_id, ngram_join, packing, quality
from tidewater.llm.frames import read_documents, staged
from tidewater.plans.registry import query

#: A text in which hardly any n-gram belongs to a language is in none that the filters know.
LEAST_KNOWN = 0.05


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labelled ones among them."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    network = quality.learn_from_documents(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), labels)
    return quality.classify(docs, network).filter("quality_pred = 1").select(*docs.columns)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the filters know; null texts and texts without letters go.

    If no learning row has a language, the filters know none, and only those texts go.
    """
    filters = language_id.learn_from_documents(docs)
    if not filters.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    named = language_id.identify(docs, filters)
    return named.filter((F.col("lang_pred") != "und") & (F.col("lang_known") >= LEAST_KNOWN)).select(*docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the longest original; of repeats of one row, one."""
    kept = exact_dedup.exact_groups(docs).filter("kept").select(
        F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"), F.col("chars").alias("_chars"))
    text = F.coalesce("text", F.lit(""))
    digest = F.sha2(F.regexp_replace(text, "[\\x20\\x09-\\x0D]", ""), 256)
    marked = docs.withColumns({"_sha": digest, "_id": F.col("doc_id"), "_chars": F.length(text).cast("bigint")})
    same = marked["_id"].eqNullSafe(kept["_id"]) & (marked["_sha"] == kept["_sha"]) & (marked["_chars"] == kept["_chars"])
    return marked.join(kept, same, "left_semi").dropDuplicates(["_id", "_sha", "_chars"]).select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of near-duplicates, and of its texts one."""
    first = ngram_join.near_classes(docs).filter("first").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    same = docs["doc_id"].eqNullSafe(first["_id"]) & (ngram_join.text_hashes(docs["text"]) == first["_hash"])
    return docs.join(first, same, "left_semi")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


STAGES = [
    ("quality", good_quality),
    ("language", known_language),
    ("exact_dedup", without_copies),
    ("near_duplicates", without_near_copies),
    ("packing", packed),
]

#: Fitted and hashed stages have no SQL form; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; what a stage keeps is written to the shared scratch folder and read again."""
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


@query("pipeline", ORACLE_SQL)
def pipeline(t):
    return run(t.spark, t.sf_dir)
