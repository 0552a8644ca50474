"""Counters and state sizes as one long table: metric, label, value."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.functions.paths import MISSING_DIRECTORY
from packetloom.operators.gstream import CACHE, COPY
from packetloom.operators.transfers import TTL_SECONDS, pending_opens


def _total(rows: DataFrame, metrics: dict[str, Column], label: Column | None = None) -> DataFrame:
    """Sum every metric per label in one pass and turn the sums into rows."""
    grouped = rows.groupBy((F.lit("") if label is None else label).alias("label"))
    sums = grouped.agg(*[F.coalesce(F.sum(v.cast("bigint")), F.lit(0)).alias(n) for n, v in metrics.items()])
    return sums.unpivot(["label"], list(metrics), "metric", "value").select("metric", "label", "value")


def packet_metrics(packets: DataFrame) -> DataFrame:
    return _total(packets, {"packets": F.lit(1)})


def pushed_metrics(pushed: DataFrame) -> DataFrame:
    return _total(pushed, {"pushed_messages": F.lit(1)})


def sequence_metrics(gaps: DataFrame) -> DataFrame:
    """Missing and reordered packets per host; `gaps` has a `server_hostname`."""
    counted = _total(
        gaps,
        {"missing_packets": F.col("missing"), "reordered_packets": F.col("reordered")},
        F.col("server_hostname"),
    )
    return counted.filter("value > 0")


def gstream_metrics(lines: DataFrame) -> DataFrame:
    """Packets are counted by their first line."""
    return _total(
        lines,
        {
            "gstream_message": F.col("line_idx") == 0,
            "gstream_event_cache": F.col("stream") == CACHE,
            "gstream_message_tpc": F.col("stream") == COPY,
        },
    )


def transfer_metrics(records: DataFrame) -> DataFrame:
    failures = _total(
        records,
        {"failed_user": F.col("user").isNull(), "failed_filename": F.col("filename") == MISSING_DIRECTORY},
    )
    kind = F.when(F.col("is_wlcg"), "wlcg").otherwise("stashcache")
    return failures.unionByName(_total(records, {"messages_sent": F.lit(1)}, kind))


def metrics(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def state_sizes(
    records: DataFrame, entries: DataFrame, leases: DataFrame, as_of: int, ttl_seconds: int = TTL_SECONDS
) -> DataFrame:
    """Live dictionary entries, users and transfers at `as_of`. `leases` are the lives of users up to `as_of`."""
    now = F.timestamp_seconds(F.lit(as_of))
    ttl = ttl_seconds * 1_000_000
    written = entries.filter(F.col("arrival_ts") <= now).groupBy("sid", "dict_id").agg(F.max("arrival_ts").alias("at"))
    live_entries = written.filter(F.unix_micros(now) - F.unix_micros("at") <= ttl)
    newest = leases.filter(F.col("t") <= F.unix_micros(now)).groupBy("sid", "ident").agg(F.max("t").alias("t"))
    live_users = newest.filter(F.unix_micros(now) - F.col("t") <= ttl)
    young = pending_opens(records, as_of).filter(F.lit(as_of) - F.col("t_beg") <= ttl_seconds)
    sizes = {"dictid": live_entries, "users": live_users, "transfers": young}
    counted = [df.agg(F.count("*").alias("value")).withColumn("label", F.lit(n)) for n, df in sizes.items()]
    return reduce(DataFrame.unionByName, counted).select(F.lit("hash_size").alias("metric"), "label", "value")
