"""Corpus pipeline: the stages a training corpus goes through, in order.

Each stage takes (spark, docs, sf_dir), works on all documents its
predecessor kept, and is written as Parquet and reread before the next.  All
but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.llm import decontam, jaccard_join, langid, mixing, token_store
from kiln.session import scratch_path
from kiln.sources.tables import table

#: Languages may be mixed; a text that no language covers to this share goes.
LEAST_LANGUAGE_SHARE = 1 / 3
END_ID = 2


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without letters and hopeless mixtures go; the model learns from
    all documents that name their language."""
    return langid.keep_identified(docs, langid.fit(docs), LEAST_LANGUAGE_SHARE)


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard_join.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a copy of a benchmark item go."""
    return decontam.remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often and as far as the mix takes them."""
    return mixing.mixed_documents(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids as shard files; their records, read back."""
    return token_store.encode_and_read(docs, public_tokenizers.path("byte_bpe_50k.json"), END_ID)


STAGES = [
    ("language", identify_language),
    ("near_copies", join_near_copies),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("tokens", write_tokens),
]

#: The stages can't be expressed in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
