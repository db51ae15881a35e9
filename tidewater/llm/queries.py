"""The registered queries of this package: each applies its operator to the whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tidewater.llm import (
    exact_dedup, kd_shards, language_id, line_dedup, maxent, ngram_join, quality, token_alignment, topk, vector_codes)
from tidewater.llm.bpe_automaton import encoding_digests
from tidewater.llm.packing import pack_documents
from tidewater.llm.token_files import read_token_files, write_token_files
from tidewater.plans.registry import query


@query("op3_bpe_automaton")
def op3_bpe_automaton(t):
    return encoding_digests(t.documents, public_tokenizers.path("byte_bpe_50k.json"))


@query("op7_token_files")
def op7_token_files(t):
    return read_token_files(write_token_files(t.documents, public_tokenizers.path("word_bpe_49k.json"), end_id=2))


@query("op9_best_fit_packing")
def op9_best_fit_packing(t):
    return pack_documents(t.documents, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


@query("op5_line_dedup", line_dedup.ORACLE)
def op5_line_dedup(t):
    return line_dedup.dedup_lines(t.documents).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op6_exact_dedup", exact_dedup.ORACLE)
def op6_exact_dedup(t):
    return exact_dedup.exact_groups(t.documents)


@query("op4_quality_classifier")
def op4_quality_classifier(t):
    return quality.quality_of_documents(t.documents, t.labels)


@query("op10_language_id")
def op10_language_id(t):
    return language_id.languages_of_documents(t.documents)


@query("op1_ngram_jaccard_join")
def op1_ngram_jaccard_join(t):
    return ngram_join.near_duplicates(t.documents)


@query("op2_exact_topk", topk.ORACLE)
def op2_exact_topk(t):
    return topk.search_embeddings(t.embeddings)


@query("op8_maxent_scoring")
def op8_maxent_scoring(t):
    return maxent.score_documents(t.documents)


@query("op11_vector_codes", vector_codes.ORACLE)
def op11_vector_codes(t):
    return vector_codes.code_digests(t.embeddings)


@query("op12_token_alignment")
def op12_token_alignment(t):
    return token_alignment.alignment_digests(
        t.documents, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op13_kd_shards")
def op13_kd_shards(t):
    return kd_shards.kd_shards(t.documents, shards=40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
