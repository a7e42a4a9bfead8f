"""Corpus pipeline: documents -> clean, distinct, masked, mixed, encoded documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes it as Parquet in the shared folder and reads it back as the next
stage's documents. All but the last stage return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabforge.llm import bpe_codec, jaccard_join, mixing, quality_rules, secrets
from tabforge.llm.common import prepare, table
from tabforge.llm.queries import WORD_BPE, tokenizer
from tabforge.session import cut_lineage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality policy keeps."""
    prepare(spark)
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    prepare(spark)
    return jaccard_join.keep_one(docs)


def secret_masks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked."""
    prepare(spark)
    return secrets.mask_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them (repeats are rows)."""
    prepare(spark)
    return mixing.take_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, input_ids, decoded_sha256 of every document."""
    prepare(spark)
    return bpe_codec.encode(docs, tokenizer(WORD_BPE))


STAGES = [("quality_rules", quality), ("jaccard_join", near_duplicates), ("secret_scans", secret_masks),
          ("mix_sources", mix), ("bpe_codec", encode)]

# Masks come from a fitted forest and the mix from hashes: no SQL for run()'s rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
