"""The language model reads a text once for the counts and once for training and scoring; lanes of documents end together."""

import numpy as np
from pyspark.sql import functions as F

from packetloom.llm import gru, lm


def test_texts_are_read_for_counts_and_for_token_numbers_only(spark):
    reads = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def text(i):
        reads.add(1)
        return "a b c " * (i % 7)

    docs = spark.range(400).select(F.col("id").alias("doc_id"), text("id").alias("text"))
    rows = lm.score_documents(docs).collect()
    training = sum(not r.held_out for r in rows)
    assert len(rows) == 400 and reads.value == 400 + training


def test_lanes_are_balanced_and_keep_the_order_of_documents():
    docs = [np.full(n, i, dtype=np.int32) for i, n in enumerate((3, 3, 3, 9))]
    lanes = gru.Lanes(docs, 2, 99)
    assert lanes.sizes.tolist() == [9, 9]
    assert lanes.targets.tolist() in ([3] * 9 + [0] * 3 + [1] * 3 + [2] * 3, [0] * 3 + [1] * 3 + [2] * 3 + [3] * 9)
