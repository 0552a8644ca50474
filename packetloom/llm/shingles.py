"""Runs of consecutive words of documents, by Spark functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.llm.common import words

KEY = ["doc", "text_hash"]
#: A word before A-Z become lower case (fixed by the contracts).
WORD = "[0-9A-Za-z\\x{80}-\\x{10FFFF}]+"


def key_of(doc_id: Column, text: Column) -> tuple[Column, Column]:
    """A row's key, never NULL. Rows that agree in id and text share it, and with it their result."""
    return F.coalesce(doc_id.cast("string"), F.lit("")), F.xxhash64(text, doc_id.isNull())


def keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumns(dict(zip(KEY, key_of(F.col("doc_id"), F.col("text")))))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def gram_hash(*parts: Column) -> Column:
    return F.xxhash64(F.lit(len(parts)), *parts)


def grams(docs: DataFrame, size: int) -> DataFrame:
    """`doc, text_hash, n_words, pos, gram, h`: one row per run of `size` words of `docs` (as made by `keyed`).

    `gram` holds the words of its run only: a generator copies what stands beside it into each of its rows.
    """
    listed = docs.select(*KEY, words(F.col("text")).alias("words")).withColumn("n_words", F.size("words")).filter(F.col("n_words") >= size)
    runs = F.arrays_zip(*[F.slice("words", j + 1, F.col("n_words") - (size - 1)).alias(f"w{j}") for j in range(size)])
    rows = listed.select(*KEY, "n_words", F.posexplode(runs).alias("pos", "gram"))
    return rows.withColumn("h", gram_hash(*[F.col("gram")[f"w{j}"] for j in range(size)]))


def gram_text(size: int) -> Column:
    return F.concat_ws(" ", *[F.col("gram")[f"w{j}"] for j in range(size)])
