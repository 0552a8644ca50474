"""Packet loss and reordering from the 8-bit sequence numbers of every (stream, code)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.operators.ordered import GROUP_LIMIT, before, find_hot_keys

KEY = ["sid", "code"]
# From this many on a gap counts as reordering; a wrap adds 255, not 256.
REORDER_FROM = 253
WRAP = 255


def judge(pseq: Column, last_pseq: Column) -> dict[str, Column]:
    """Expected number, packets missed, and whether the gap is so large that it must be reordering."""
    expected = F.when(last_pseq.isNull(), pseq).otherwise((last_pseq + 1) % 256)
    gap = F.when(pseq < expected, pseq + WRAP - expected).otherwise(pseq - expected)
    off = pseq != expected
    return {
        "expected": expected,
        "missing": F.when(off & (gap < REORDER_FROM), gap).otherwise(0).cast("bigint"),
        "reordered": F.when(off & (gap >= REORDER_FROM), 1).otherwise(0).cast("bigint"),
    }


def sequence_gaps(framed: DataFrame, group_limit: int | None = GROUP_LIMIT, last: DataFrame | None = None) -> DataFrame:
    """Per packet: is it the first of its stream and code, what was expected, what is missing.

    `last` (as of `last_numbers`) has the numbers that earlier parts of the feed ended with.
    """
    headers = framed.select(*KEY, "addr", "arrival_seq", "pseq")
    if last is not None:
        headers = headers.withColumn("carried", F.lit(False)).unionByName(last.withColumn("carried", F.lit(True)), allowMissingColumns=True)
    hot = find_hot_keys(headers.select(*KEY, "arrival_seq"), KEY, "arrival_seq", group_limit)
    linked = before(headers, KEY, ["arrival_seq"], last={"last_pseq": F.col("pseq")}, hot=hot)
    if last is not None:
        linked = linked.filter("NOT carried").drop("carried")
    return linked.withColumns(
        {"is_first": F.col("last_pseq").isNull(), **judge(F.col("pseq"), F.col("last_pseq"))}
    ).drop("last_pseq")


def last_numbers(framed: DataFrame, last: DataFrame | None = None) -> DataFrame:
    """The latest packet's number per stream and code; one row per key, combined before the shuffle."""
    headers = framed.select(*KEY, "arrival_seq", "pseq")
    headers = headers if last is None else headers.unionByName(last)
    latest = headers.groupBy(*KEY).agg(F.max_by(F.struct("arrival_seq", "pseq"), "arrival_seq").alias("last"))
    return latest.select(*KEY, "last.*")
