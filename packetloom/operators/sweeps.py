"""Transfers given up by sweeps: now and then a collector drops what is too old, when a packet comes long enough after the last sweep.

`transfers.given_up_transfers` ends a transfer exactly at its TTL. Here it ends with the first sweep after that, as in a running collector: until
then its progress counts and a close still belongs to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packetloom.operators.fstream import CLOSE, OPEN, PROGRESS
from packetloom.operators.joins import broadcast_if_small
from packetloom.operators.ordered import GROUP_LIMIT, before, find_hot_keys
from packetloom.operators.spacing import TIMES_LIMIT, hot_times, times_apart
from packetloom.operators.transfers import COLUMNS, FILE_KEY, OPEN_FIELDS, ORDER, TTL_SECONDS
from packetloom.sources.stage import write_stage

# Fixed value: a sweep comes with the first packet later than this after the last one.
SWEEP_SECONDS = 300


def sweep_times(arrivals: DataFrame, sweep_seconds: int = SWEEP_SECONDS, limit: int | None = TIMES_LIMIT) -> DataFrame:
    """`t` (microseconds), `seq` of the packet that brings it, and `since`, the time of the sweep before, for every sweep of a feed.

    `arrivals` has the `arrival_ts` and `arrival_seq` of all packets. The clock starts with the first packet, which sweeps nothing.
    """
    times = arrivals.groupBy(F.unix_micros("arrival_ts").alias("t")).agg(F.min("arrival_seq").alias("seq"))
    times = write_stage(times.withColumn("feed", F.lit(0)), "arrival-times")
    chain = times_apart(times, ["feed"], sweep_seconds * 1_000_000, hot_times(times, ["feed"], limit))
    # No more rows than the feed's length holds sweeps.
    earlier = Window.partitionBy("feed").orderBy("t")
    marked = chain.join(times, ["feed", "t"]).withColumn("since", F.lag("t").over(earlier))
    return marked.filter("since IS NOT NULL").select("t", "seq", "since")


def with_sweep(opens: DataFrame, sweeps: DataFrame, ttl_seconds: int, sweep_seconds: int) -> DataFrame:
    """Opens with `swept_t` (microseconds) and `swept_seq` of the first sweep that finds them too old, NULL if the feed ends before.

    Every moment lies between two sweeps. These spans are cut at whole multiples of `sweep_seconds` for an equi-join; a span meets
    few of them, and an open exactly one.
    """
    step = sweep_seconds * 1_000_000
    later = Window.partitionBy(F.lit(0)).orderBy("t")
    first = sweeps.agg(F.min("since").alias("t")).first().t
    if first is None:
        return opens.withColumns({"swept_t": F.lit(None).cast("bigint"), "swept_seq": F.lit(None).cast("bigint")})
    spans = sweeps.withColumns({"next_t": F.lead("t").over(later), "next_seq": F.lead("seq").over(later)})
    cuts = F.sequence(F.floor(F.col("since") / step), F.floor((F.col("t") - 1) / step))
    spans = broadcast_if_small(write_stage(spans.withColumn("cut", F.explode(cuts)), "sweep-spans"))
    # Old enough, and arrived: of sweeps at the open's own moment the next one is taken if their packet came before it.
    moment = F.greatest((F.col("t_beg") + ttl_seconds) * 1_000_000, F.unix_micros("arrival_ts") - 1, F.lit(first))
    asked = opens.withColumn("_moment", moment).withColumn("_cut", F.floor(F.col("_moment") / step))
    inside = (asked["_cut"] == spans["cut"]) & (asked["_moment"] >= spans["since"]) & (asked["_moment"] < spans["t"])
    found = asked.join(spans, inside, "left")
    missed = F.col("seq") < F.col("arrival_seq")
    return found.withColumns(
        {
            "swept_t": F.when(missed, F.col("next_t")).otherwise(F.col("t")),
            "swept_seq": F.when(missed, F.col("next_seq")).otherwise(F.col("seq")),
        }
    ).drop("_moment", "_cut", *spans.columns)


def swept_transfers(
    records: DataFrame,
    arrivals: DataFrame,
    ttl_seconds: int = TTL_SECONDS,
    sweep_seconds: int = SWEEP_SECONDS,
    group_limit: int | None = GROUP_LIMIT,
) -> DataFrame:
    """One row per close and per transfer given up with progress to report, as `stitch_transfers` and `given_up_transfers` give them.

    Opens, closes and progress are looked at in one order, so the file key is shuffled once. A sweep comes after all records of its packet.
    """
    sweeps = write_stage(sweep_times(arrivals, sweep_seconds), "sweeps")
    kept = records.filter(F.col("rec_type").isin(OPEN, CLOSE, PROGRESS))
    opens = with_sweep(kept.filter(F.col("rec_type") == OPEN), sweeps, ttl_seconds, sweep_seconds)
    rows = opens.unionByName(kept.filter(F.col("rec_type") != OPEN), allowMissingColumns=True)
    hot = find_hot_keys(kept.select(*FILE_KEY, *ORDER), FILE_KEY, ORDER, group_limit)
    is_open, is_progress = F.col("rec_type") == OPEN, F.col("rec_type") == PROGRESS
    position = F.struct(*ORDER)
    shown = [F.when(is_open, F.col(c)).alias(c) for c in ("addr", *OPEN_FIELDS, "swept_t", "swept_seq")]
    event = F.struct("rec_type", *shown, position.alias("position"))
    seen = before(rows, FILE_KEY, ORDER, last={"opened": F.when(~is_progress, event)}, hot=hot)
    pending = F.coalesce(F.col("opened.rec_type") == OPEN, F.lit(False))
    in_time = pending & F.coalesce(F.col("arrival_seq") <= F.col("opened.swept_seq"), F.lit(True))
    progress = F.struct("read", "readv", "write", F.col("opened.position").alias("of"))
    linked = before(seen, FILE_KEY, ORDER, last={"moved": F.when(is_progress & in_time, progress)}, hot=hot)
    closed = linked.filter(F.col("rec_type") == CLOSE).withColumn("is_open_known", in_time)
    opened = {c: F.when(F.col("is_open_known"), F.col(f"opened.{c}")) for c in OPEN_FIELDS}
    closes = closed.withColumns(
        {
            "has_close": F.col("is_open_known"),
            "user_id": F.coalesce(opened["user_id"], F.lit(0)),
            "open_time": F.coalesce(opened["t_beg"], F.col("t_beg")),
            "close_time": F.col("t_beg"),
            "open_name": opened["file_name"],
            "file_size": opened["file_size"],
            "open_seq": F.lit(None).cast("bigint"),
            "open_idx": F.lit(None).cast("int"),
        }
    ).select(*COLUMNS)
    # What a later event of the file finds given up, and what is still there at the end of the feed.
    overtaken = linked.filter(~is_progress & pending & ~in_time).select(*FILE_KEY, "opened", "moved")
    last = linked.groupBy(*FILE_KEY).agg(
        F.max_by(event, F.when(~is_progress, position)).alias("opened"),
        F.max_by(progress, F.when(is_progress & in_time, position)).alias("moved"),
    )
    left = last.filter((F.col("opened.rec_type") == OPEN) & F.col("opened.swept_t").isNotNull())
    return closes.unionByName(_given_up(overtaken.unionByName(left), records.schema["ops"].dataType))


def _given_up(ended: DataFrame, ops) -> DataFrame:
    """Rows of `ended` (file, opened, moved) whose progress belongs to their open; each ends with its sweep and comes after that packet."""
    end: Column = F.col("opened.swept_t")
    return ended.filter(F.col("moved.of") == F.col("opened.position")).select(
        "sid",
        "opened.addr",
        F.timestamp_micros(end).alias("arrival_ts"),
        F.col("opened.swept_seq").alias("arrival_seq"),
        F.lit(2147483647).alias("rec_idx"),
        "file_id",
        F.lit(True).alias("has_close"),
        F.lit(True).alias("is_open_known"),
        "opened.user_id",
        F.col("opened.t_beg").alias("open_time"),
        F.floor(end / 1_000_000).alias("close_time"),
        F.col("opened.file_name").alias("open_name"),
        "opened.file_size",
        "moved.read",
        "moved.readv",
        "moved.write",
        F.lit(None).cast(ops).alias("ops"),
        F.col("opened.position.arrival_seq").alias("open_seq"),
        F.col("opened.position.rec_idx").alias("open_idx"),
    )
