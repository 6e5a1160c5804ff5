"""Corpus pipeline: toxicity, near duplicates, PII, source mixing, packing.

Each stage is (spark, docs, sf_dir) -> DataFrame, written as Parquet and read again
as the next one's ``docs``; all but the last return the columns of documents.
Nulls, empty texts and repeated rows pass as the operators define: rejected are
only toxic documents, near copies beyond the first, and what the mix takes no
copy of.  A document that the mix takes several times is as many rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commerce_marts.llm import mixing, ngram_join, packing, surrogates, toxicity
from commerce_marts.llm.common import ship, table, written
from commerce_marts.llm.queries import tokenizer_path

#: SQL can express neither the machine nor the knapsack nor the tokenizer.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't call toxic."""
    ship(spark)
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ship(spark)
    return ngram_join.deduplicated(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with surrogates; n_chars counts the new text."""
    ship(spark)
    new = surrogates.replaced_documents(docs)
    return new.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)
                          ) if "n_chars" in docs.columns else new


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it."""
    ship(spark)
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in sequences."""
    ship(spark)
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("pii_surrogates", replace_personal_data),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
