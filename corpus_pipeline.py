"""A training corpus from the documents table, stage by stage.

quality classifier -> SimHash near-dedup -> secret scan -> mixing -> BPE.  Every
stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as
Parquet and reads it again for the next stage.  All but the last return the columns of
``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, mixing, quality, secrets, simhash
from tidemark.llm.common import table
from tidemark.llm.queries import held_out, tokenizer_path
from tidemark.session import ensure_checkpoint_dir


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line quality classifier accepts (null, empty and blank texts go)."""
    field = quality.fit(docs, table(spark, sf_dir, "labels").filter(~held_out(1, 3)))
    return quality.keep(docs, field)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of every near-duplicate group."""
    return simhash.one_per_group(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret span masked."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row."""
    return bpe.digests(docs, tokenizer_path())


STAGES = [("quality", keep_good), ("near_duplicates", drop_copies), ("secrets", mask_secrets),
          ("mixing", mix_sources), ("bpe", encode)]

#: SQL can express none of the stages whole; tests hold ``run`` against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, applied to ``documents``."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
