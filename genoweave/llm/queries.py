"""The registered queries of this subpackage and their oracle SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoweave.llm import (
    block_anchors, bpe_pieces, line_dedup, main_text, oracles, packing, pivot_index, prefix_trie, rules, simhash, suffix_shards, token_orc,
    toxicity, vector_codes,
)
from genoweave.llm.common import keep_in, table
from genoweave.session import scratch_path

LIBRARY_FILE = "byte_bpe_50k.json"
RANKS_FILE = "byte_bpe_multi_50k.tiktoken"


def op1_token_orc(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "tokens.orc")
    token_orc.write_token_orc(table(spark, folder, "documents"), path, public_tokenizers.path(LIBRARY_FILE))
    return token_orc.token_spans(spark, path)


def op2_block_anchors(spark: SparkSession, folder: str) -> DataFrame:
    found = block_anchors.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_pivot_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = keep_in(pivot_index.integer_vectors(table(spark, folder, "embeddings")), "vectors")
    return pivot_index.top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0), 5)


def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), public_tokenizers.path(LIBRARY_FILE))


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    columns = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept".split()
    return rules.judge(table(spark, folder, "documents"), "doc_id").select(*columns)


def op6_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return main_text.extract(table(spark, folder, "pages"))


def op7_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hexadecimal().alias("fingerprint"), "component_id")


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.classify(docs, toxicity.fit(docs, table(spark, folder, "labels")))


def op9_suffix_shards(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_shards.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    digest = F.sha2("kept", 256).alias("kept_sha256")
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), digest)


def op10_bpe_pieces(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return bpe_pieces.round_trip(docs, public_tokenizers.path(RANKS_FILE), public_tokenizers.PATTERN)


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    found = vector_codes.compress(table(spark, folder, "embeddings"))
    return found.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", "codebooks_sha256")


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, folder, "conversations"))


def op13_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.drop_shared_lines(table(spark, folder, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_orc,
        op2_block_anchors,
        op3_pivot_top_k,
        op4_best_fit_packing,
        op5_quality_rules,
        op6_main_text,
        op7_simhash_near_dedup,
        op8_toxicity,
        op9_suffix_shards,
        op10_bpe_pieces,
        op11_vector_codes,
        op12_prefix_trie,
        op13_line_dedup,
    )
}
#: The others need tokenizers, a classifier, XXH64 or byte strings; they are tested against brute force.
ORACLES = {
    "op2_block_anchors": oracles.BLOCK_ANCHORS,
    "op3_pivot_top_k": oracles.PIVOT_TOP_K,
    "op5_quality_rules": oracles.QUALITY_RULES,
    "op11_vector_codes": oracles.VECTOR_CODES,
    "op12_prefix_trie": oracles.PREFIX_TRIE,
    "op13_line_dedup": oracles.LINE_DEDUP,
}
