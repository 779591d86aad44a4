"""Registered queries of the dealt operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import align, bpe, chat, counts, decontam, licenses, repair, simhash, token_files, topk, toxicity, urls, warc
from ._shared import table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), k=3, r=2)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op7_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), every=20, k=20)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digests(table(spark, sf_dir, "conversations"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.digests(table(spark, sf_dir, "conversations"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.verdicts(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_bpe": op2_bpe,
    "op3_warc": op3_warc,
    "op4_simhash": op4_simhash,
    "op5_toxicity": op5_toxicity,
    "op6_license_scan": op6_license_scan,
    "op7_threshold_topk": op7_threshold_topk,
    "op8_token_counts": op8_token_counts,
    "op9_token_files": op9_token_files,
    "op10_chat_format": op10_chat_format,
    "op11_token_alignment": op11_token_alignment,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_url_filter": op13_url_filter,
}

ORACLE: dict[str, str] = {
    "op7_threshold_topk": """
        WITH rows AS (
            SELECT row_number() OVER () AS rid, vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        scored AS (
            SELECT q.rid, q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)]) AS BIGINT) AS score
            FROM rows q JOIN rows c ON q.vec_id % 20 = 0 AND c.rid <> q.rid AND len(q.v) = len(c.v)),
        ranked AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
}
