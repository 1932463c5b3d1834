"""Registered queries of the operators for training data."""

from __future__ import annotations

from collections.abc import Callable
from zlib import crc32

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskgraph.llm import (
    conversation_repair, decontaminate, embedding_dedup, license_scan, ngram_join, oracle, packing,
    pii, secret_scan, spelling_groups, suffix_dedup, token_files, toxicity, warc,
)
from riskgraph.sources.staging import new_path, tidied

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model).select(
        "doc_id", (~toxicity.may_learn()).alias("held_out"), "score", "predicted")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"),
                               table(spark, sf_dir, "benchmark"))


def packed_pieces(docs: DataFrame, cache: int = packing.CACHE_PIECES) -> DataFrame:
    """Rows of the packing query; the ids themselves stay behind."""
    cut = packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, cache=cache)
    digests = cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(digests).select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                        "sequence_id", "offset")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_pieces(table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.find_secrets(docs)
    kinds = [k for k, *_ in secret_scan.BASE_KINDS]
    spans = F.col("secrets")
    base = F.filter(spans, lambda s: s["rank"] < len(kinds))

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    counts = [count(kind).alias(f"n_{kind}") for kind in kinds]
    return found.select("doc_id", *counts,
                        F.sha2(secret_scan.span_text(base), 256).alias("base_sha256"),
                        secret_scan.span_text(spans).alias("spans"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = warc.round_trip(table(spark, sf_dir, "pages"), new_path(spark, "warc"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans",
                       F.sha2("kept", 256).alias("kept_sha256"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path,
                                  public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    rows = token_files.read_token_files(
        spark, path, lambda ids: crc32(token_files.little_endian(ids)), "long")
    return token_files.with_global_start(rows).select(
        "doc_id", "start", "n_tokens", F.col("value").alias("ids_crc32"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"),
                                      license_scan.templates(spark))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_pii(docs, pii.fit_pii(docs))
    spans = F.col("pii")
    base = F.filter(spans, lambda s: s["rank"] < len(pii.KINDS))

    def count(rank: int) -> Column:
        return F.size(F.filter(spans, lambda s: s["rank"] == rank)).cast("long")

    counts = [count(rank).alias(f"n_{kind}") for rank, kind in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts,
                        F.sha2(secret_scan.span_text(base), 256).alias("base_sha256"),
                        secret_scan.span_text(spans).alias("spans"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling_groups.count_words(table(spark, sf_dir, "documents"), slip=199)
    return spelling_groups.group_variants(words)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, dropped = conversation_repair.damaged(table(spark, sf_dir, "conversations"))
    return conversation_repair.audit_conversations(turns, dropped)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {name: tidied(query) for name, query in {
    "op1_toxicity": op1_toxicity,
    "op2_decontamination": op2_decontamination,
    "op3_packing": op3_packing,
    "op4_secret_scan": op4_secret_scan,
    "op5_ngram_join": op5_ngram_join,
    "op6_warc": op6_warc,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_token_files": op9_token_files,
    "op10_license_scan": op10_license_scan,
    "op11_pii": op11_pii,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_conversation_repair": op13_conversation_repair,
    "pipeline": pipeline,
}.items()}

ORACLES: dict[str, str] = dict(oracle.STATEMENTS)
