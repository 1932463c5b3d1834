"""Corpus pipeline: five stages over the documents table, each on what the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet in the
shared folder and reads it again as the next stage's documents. Empty tables pass through, null
texts count as empty, and columns of ``documents`` beyond doc_id and text are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskgraph.llm import decontaminate, ngram_join, queries, secret_scan, toxicity
from riskgraph.sources.staging import stage

SECRETS = "__found_secrets"


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not call toxic."""
    model = toxicity.fit_toxicity(docs, queries.table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of smallest doc_id."""
    return ngram_join.one_of_each(docs).select(*docs.columns)


def reject_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    kept = decontaminate.decontaminate(docs, queries.table(spark, sf_dir, "benchmark"))
    return kept.select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret."""
    found = secret_scan.find_secrets(docs, column=SECRETS)
    return secret_scan.redact(found, column=SECRETS).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in training sequences. Workers that went through
    the other stages remember fewer pieces of text than those of the packing query."""
    return queries.packed_pieces(docs, cache=150_000)


STAGES = [
    ("toxicity", reject_toxic),
    ("ngram_join", keep_one_of_each),
    ("decontamination", reject_leaked),
    ("secrets", redact_secrets),
    ("packing", pack),
]

# Tokenizers and a fitted model are beyond SQL; the stages are tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
