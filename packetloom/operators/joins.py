"""Joins with small dimensions: broadcast only after the size was checked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """`df` with a broadcast hint if its text and 16 bytes per column fit `max_bytes`, else `df` as it is.

    Without the hint Spark joins by shuffle, and adaptive execution splits skewed partitions of the large side.
    """
    size = F.lit(16 * len(df.columns))
    for name, kind in df.dtypes:
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(name), F.lit(0))
        elif kind.startswith(("array", "struct", "map")):
            size = size + F.coalesce(F.length(F.to_json(F.struct(name))), F.lit(0))
    total = df.agg(F.sum(size.cast("bigint")).alias("bytes")).first().bytes or 0
    return F.broadcast(df) if total <= max_bytes else df
