"""Corpus pipeline: quality rules, quality classifier, near-duplicates, decontamination, mixing.

Each stage takes the documents that the one before kept and returns documents; the last one returns
them as often as the mix takes them, with the number of the copy in a further column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import decontaminate, mixing, quality_cnn, quality_rules, simhash
from tickloom.llm.common import free_name, stored
from tickloom.llm.queries import quality_model, table


def keep_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no rule of the strict policy."""
    book = free_name(docs, "ledger")
    ledger = quality_rules.ledger(docs, out=book)
    return quality_rules.apply_policy(ledger, quality_rules.STRICT, out=book).select(docs.columns)


def keep_by_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network calls good; it learns from all labelled documents, rejected ones too."""
    out = free_name(docs, "quality_score")
    return quality_cnn.score(docs, quality_model(spark, sf_dir), out=out).where(F.col(out) >= 0.5).select(docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.deduplicate(docs).select(docs.columns)


def keep_clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    out = free_name(docs, "hits")
    marked = decontaminate.mark(docs, table(spark, sf_dir, "benchmark"), out=out)
    return marked.where(F.size(out) == 0).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mix(docs)


STAGES = [
    ("quality_rules", keep_by_rules),
    ("quality_classifier", keep_by_classifier),
    ("simhash_dedup", keep_one_of_each),
    ("decontamination", keep_clean_of_benchmark),
    ("mixing", mix_sources),
]

# The classifier and the latent space are beyond SQL; tests compare the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's documents are a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
