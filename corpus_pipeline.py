"""Corpus pipeline: language ID, near-duplicate removal, decontamination, secret
masking, BPE encoding.  Each stage is written as Parquet and read again as the
next one's documents, so a lost executor costs at most one stage's tasks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.llm import bpe_codec, decontaminate, langid, secret_scan, simhash
from milepost.llm.common import read_table
from milepost.session import ensure_checkpoint_dir, remove_folder


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no language is found for go; null or letterless texts are such."""
    return langid.keep_recognised(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest id."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; the documents stay, n_chars is the new length."""
    out = secret_scan.mask(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) \
        if "n_chars" in docs.columns else out


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns, with the token ids, packed, their count and the round trip's digests."""
    return bpe_codec.with_tokens(docs)


STAGES = [
    ("language_id", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secrets),
    ("bpe_encoding", tokens),
]

# Language models, fingerprints and merges have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result lies in the run's folder under the checkpoint folder; what a stage read
    is removed once it has written."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, last = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if last:
            remove_folder(spark, f"{folder}/{last}")
        last = name
    return docs
