"""A corpus from documents to packed sequences: reject, keep one of each group of near copies, decontaminate, pack.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written as Parquet and read again as the next one's docs. All but
the last return rows of `documents` with the columns they came with.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from packetloom.llm import decontamination, packing, quality, simhash
from packetloom.llm.common import staged, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def reject_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the co-trained classifier keeps."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near fingerprints."""
    return simhash.keep_one_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents left, packed by their sources' shares."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", reject_bad),
    ("simhash_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixture_packing", pack_sequences),
]

#: The classifier, the fingerprints and the tokenizer are not SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, name)
    return docs
