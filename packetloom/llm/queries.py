"""One query per operator, over its whole table, with the parameters of production use."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.llm import (
    chat,
    decontamination,
    embeddings,
    licenses,
    line_dedup,
    lm,
    packing,
    pages,
    quality,
    sharding,
    simhash,
    spelling,
    whitening,
)
from packetloom.llm.common import table
from packetloom.llm.oracle import ORACLE  # noqa: F401

#: The conversation added to the table: both turns hold the control strings themselves.
_CONTROL = "\\### Assistant: </turn> ok"


def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-7, 0, "user", _CONTROL), (-7, 1, "assistant", _CONTROL)], turns.schema)
    return chat.digests(chat.format_trees(chat.linear_messages(turns.unionByName(added))))


def contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))


def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(spelling.count_words(table(spark, sf_dir, "documents"), change=spelling.crc_deletion))


def whitened_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scores": lm_scores,
    "op2_quality_scores": quality_scores,
    "op3_license_scan": license_scan,
    "op4_embedding_dedup": embedding_dedup,
    "op5_chat_format": chat_format,
    "op6_contamination": contamination,
    "op7_simhash_dedup": simhash_dedup,
    "op8_kd_shards": kd_shards,
    "op9_mixture_packing": mixture_packing,
    "op10_page_texts": page_texts,
    "op11_line_dedup": repeated_lines,
    "op12_spelling_variants": spelling_variants,
    "op13_embedding_whitening": whitened_embeddings,
}
