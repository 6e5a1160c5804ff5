"""The registered queries of the training-data operators: (spark, sf_dir) -> DataFrame.

Each applies its operator with production parameters to its whole table and
derives the contracted columns.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commerce_marts.llm import (collocations, katz, mixing, ngram_join, packing, prefix_trie,
                                secret_scan, substring_dedup, surrogates, topk, toxicity, warc,
                                winnowing)
from commerce_marts.llm.common import table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Vocabulary files are found by name; LLM_TOKENIZER_DIR overrides their folder."""
    folder = os.environ.get("LLM_TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_budget_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = surrogates.checked(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.size("_entities").alias("n_entities"),
                       F.transform("_entities", lambda e: e["kind"]).alias("kinds"),
                       F.transform("_entities", lambda e: e["start"]).alias("starts"),
                       F.transform("_entities", lambda e: e["surrogate"]).alias("surrogates"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "links")


def op5_string_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_block_max_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_winnowing_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.fingerprints(table(spark, sf_dir, "documents"))


def op9_warc_boundary_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), min_bytes=0)


def op10_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(table(spark, sf_dir, "documents"))


def op11_collocation_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda s: s["kind"] < 3)

    def count(kind: int) -> F.Column:
        # a second parameter of the lambda, even a defaulted one, would be the element's index
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(secret_scan.joined(base), 256).alias("base_sha256"),
                        secret_scan.joined("found").alias("spans"))


def op13_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))
