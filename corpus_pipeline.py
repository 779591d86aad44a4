"""A corpus pipeline of four stages. Each takes (spark, docs, sf_dir) and returns
a DataFrame that is written as Parquet and read again as the next one's docs."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelens.llm import bpe, decontam, simhash, toxicity
from tradelens.llm._shared import free_name, materialize, table


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays under 0.3."""
    net = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    out = free_name(docs, "_toxicity")
    return toxicity.score(docs, net, out=out).where(F.col(out) < 0.3).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (three-word shingles, two bits)."""
    return simhash.deduplicate(docs, k=3, r=2)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of ids and decoded text."""
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.json"), keep_ids=True)


STAGES = [
    ("toxicity", keep_civil),
    ("simhash_near_dedup", keep_one_of_each),
    ("benchmark_decontamination", keep_uncontaminated),
    ("bpe_encoding_and_decoding", tokenize),
]

#: SQL cannot express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
