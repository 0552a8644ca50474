"""From open, progress and close records to transfers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from packetloom.operators.fstream import CLOSE, OPEN, PROGRESS
from packetloom.operators.ordered import GROUP_LIMIT, before, find_hot_keys, rows_of

# Fixed value: the lifetime of pending opens and of dictionary and user entries.
TTL_SECONDS = 3600
END_OF_TIME = 9223372036854775807
FILE_KEY = ["sid", "file_id"]
ORDER = ["arrival_seq", "rec_idx"]
OPEN_FIELDS = ["user_id", "t_beg", "file_size", "file_name"]
COLUMNS = [
    "sid", "addr", "arrival_ts", "arrival_seq", "rec_idx", "file_id", "has_close", "is_open_known", "user_id",
    "open_time", "close_time", "open_name", "file_size", "read", "readv", "write", "ops", "open_seq", "open_idx",
]


def stitch_transfers(
    records: DataFrame, ttl_seconds: int | None = None, group_limit: int | None = GROUP_LIMIT
) -> DataFrame:
    """One row per close. It belongs to an open exactly when the previous open or close of its file is an open.

    With `ttl_seconds`, an open older than that at the close no longer counts.
    """
    events = records.filter(F.col("rec_type").isin(OPEN, CLOSE))
    rows = rows_of(events, group_limit)
    hot = find_hot_keys(events.select(*FILE_KEY, *ORDER), FILE_KEY, ORDER, group_limit, rows)
    # A close only has to say that it was there, so it carries no fields.
    state = F.struct("rec_type", *[F.when(F.col("rec_type") == OPEN, F.col(c)).alias(c) for c in OPEN_FIELDS])
    linked = before(events, FILE_KEY, ORDER, last={"opened": state}, hot=hot, rows=rows)
    known = F.coalesce(F.col("opened.rec_type") == OPEN, F.lit(False))
    if ttl_seconds is not None:
        known = known & (F.col("t_beg") - F.col("opened.t_beg") <= ttl_seconds)
    closed = linked.filter(F.col("rec_type") == CLOSE).withColumn("is_open_known", known)
    opened = {c: F.when(F.col("is_open_known"), F.col(f"opened.{c}")) for c in OPEN_FIELDS}
    return closed.withColumns(
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


def given_up_transfers(
    records: DataFrame, ttl_seconds: int = TTL_SECONDS, group_limit: int | None = GROUP_LIMIT
) -> DataFrame:
    """Opens followed by a close or another open of their file only after the TTL: given up at its end, if they moved anything.

    A row ends at open + TTL with the progress of that time, takes its place in the feed from the record that came too late (so lookups see what
    was known before it), and keeps the position of its open, which tells it apart from any other.
    """
    events = records.filter(F.col("rec_type").isin(OPEN, CLOSE))
    rows = rows_of(events, group_limit)
    hot = find_hot_keys(events.select(*FILE_KEY, *ORDER), FILE_KEY, ORDER, group_limit, rows)
    fields = [F.when(F.col("rec_type") == OPEN, F.col(c)).alias(c) for c in ("addr", *OPEN_FIELDS)]
    state = F.struct("rec_type", *fields, F.col("arrival_seq").alias("open_seq"), F.col("rec_idx").alias("open_idx"))
    shown = events.select(*FILE_KEY, *ORDER, "rec_type", "addr", *OPEN_FIELDS)
    linked = before(shown, FILE_KEY, ORDER, last={"opened": state}, hot=hot, rows=rows)
    late = linked.filter((F.col("opened.rec_type") == OPEN) & (F.col("t_beg") - F.col("opened.t_beg") > ttl_seconds))
    moved = attach_progress(records, group_limit, ttl_seconds)
    return _ended_at_ttl(late.select(*FILE_KEY, *ORDER, "opened.*"), moved, records.schema["ops"].dataType, ttl_seconds)


def ended_transfers(
    records: DataFrame, ttl_seconds: int = TTL_SECONDS, group_limit: int | None = GROUP_LIMIT
) -> DataFrame:
    """What `stitch_transfers` with a TTL and `given_up_transfers` give together, with opens, closes and progress looked at in one order, so
    that the file key is shuffled once."""
    kept = records.filter(F.col("rec_type").isin(OPEN, CLOSE, PROGRESS))
    total = rows_of(kept, group_limit)
    hot = find_hot_keys(kept.select(*FILE_KEY, *ORDER), FILE_KEY, ORDER, group_limit, total)
    is_open, is_progress = F.col("rec_type") == OPEN, F.col("rec_type") == PROGRESS
    shown = [F.when(is_open, F.col(c)).alias(c) for c in ("addr", *OPEN_FIELDS)]
    event = F.struct("rec_type", *shown, F.col("arrival_seq").alias("open_seq"), F.col("rec_idx").alias("open_idx"))
    seen = before(kept, FILE_KEY, ORDER, last={"opened": F.when(~is_progress, event)}, hot=hot, rows=total)
    pending = F.coalesce(F.col("opened.rec_type") == OPEN, F.lit(False))
    in_time = pending & (F.col("t_beg") - F.col("opened.t_beg") <= ttl_seconds)
    progress = F.struct("read", "readv", "write", F.struct("opened.open_seq", "opened.open_idx").alias("of"))
    # Without hot keys the rows are dealt and sorted by then.
    linked = before(seen, FILE_KEY, ORDER, last={"moved": F.when(is_progress & in_time, progress)}, hot=hot, rows=total if hot is not None else None)
    # A close belongs to its open or to none; what comes too late ends the open before it, if that moved anything.
    own = F.col("moved.of") == F.struct("opened.open_seq", "opened.open_idx")
    late = ~is_progress & pending & ~in_time & F.coalesce(own, F.lit(False))
    known = F.col("rec_type").isin(CLOSE) & in_time
    opened = {c: F.when(known, F.col(f"opened.{c}")) for c in OPEN_FIELDS}
    none = {"open_seq": F.lit(None).cast("bigint"), "open_idx": F.lit(None).cast("int")}
    close = F.struct(
        F.col("addr"), F.col("arrival_ts"), known.alias("known"), F.coalesce(opened["user_id"], F.lit(0)).alias("user_id"),
        F.coalesce(opened["t_beg"], F.col("t_beg")).alias("open_time"), F.col("t_beg").alias("close_time"),
        opened["file_name"].alias("open_name"), opened["file_size"].alias("file_size"), F.col("read"), F.col("readv"), F.col("write"), F.col("ops"),
        *[v.alias(n) for n, v in none.items()],
    )
    end = F.col("opened.t_beg") + ttl_seconds
    gone = F.struct(
        F.col("opened.addr").alias("addr"), F.timestamp_seconds(end).alias("arrival_ts"), F.lit(True).alias("known"),
        F.col("opened.user_id").alias("user_id"), F.col("opened.t_beg").alias("open_time"), end.alias("close_time"),
        F.col("opened.file_name").alias("open_name"), F.col("opened.file_size").alias("file_size"), F.col("moved.read").alias("read"),
        F.col("moved.readv").alias("readv"), F.col("moved.write").alias("write"), F.lit(None).cast(records.schema["ops"].dataType).alias("ops"),
        F.col("opened.open_seq").alias("open_seq"), F.col("opened.open_idx").alias("open_idx"),
    )
    rows = F.array_compact(F.array(F.when(F.col("rec_type") == CLOSE, close), F.when(late, gone)))
    spread = linked.filter((F.col("rec_type") == CLOSE) | late).select(*FILE_KEY, *ORDER, F.inline(rows))
    return spread.withColumns({"has_close": F.col("known"), "is_open_known": F.col("known")}).select(*COLUMNS)


def overdue_transfers(records: DataFrame, clock: int, ttl_seconds: int = TTL_SECONDS) -> DataFrame:
    """Opens that nothing followed, and older than the TTL at `clock` (epoch seconds): given up as `given_up_transfers` does, but they come
    after everything that has arrived."""
    old = pending_opens(records, clock).filter(F.lit(clock) - F.col("t_beg") > ttl_seconds).drop("progress")
    placed = old.withColumns({"arrival_seq": F.lit(END_OF_TIME), "rec_idx": F.lit(0)})
    return _ended_at_ttl(placed, _late_progress(old, records, ttl_seconds), records.schema["ops"].dataType, ttl_seconds)


def _late_progress(last_opens: DataFrame, records: DataFrame, ttl_seconds: int) -> DataFrame:
    """Per open that nothing followed its latest progress within the TTL: all progress after it is its own, so nothing has to be ordered."""
    opened = last_opens.select(*FILE_KEY, "open_seq", "open_idx", F.col("t_beg").alias("since"))
    moved = records.filter(F.col("rec_type") == PROGRESS).select(*FILE_KEY, *ORDER, "t_beg", "read", "readv", "write")
    own = moved.join(opened, FILE_KEY).filter(
        (F.struct(*ORDER) > F.struct("open_seq", "open_idx")) & (F.col("t_beg") - F.col("since") <= ttl_seconds)
    )
    latest = F.max_by(F.struct("arrival_seq", "t_beg", "read", "readv", "write"), F.struct(*ORDER))
    return own.groupBy(*FILE_KEY, "open_seq", "open_idx").agg(latest.alias("progress"))


def _ended_at_ttl(opens: DataFrame, moved: DataFrame, ops: DataType, ttl_seconds: int) -> DataFrame:
    rows = opens.join(moved, [*FILE_KEY, "open_seq", "open_idx"])
    end = F.col("t_beg") + ttl_seconds
    return rows.withColumns(
        {
            "arrival_ts": F.timestamp_seconds(end),
            "has_close": F.lit(True),
            "is_open_known": F.lit(True),
            "open_time": F.col("t_beg"),
            "close_time": end,
            "open_name": F.col("file_name"),
            "read": F.col("progress.read"),
            "readv": F.col("progress.readv"),
            "write": F.col("progress.write"),
            "ops": F.lit(None).cast(ops),
        }
    ).select(*COLUMNS)


def attach_progress(
    records: DataFrame, group_limit: int | None = GROUP_LIMIT, within_seconds: int | None = None
) -> DataFrame:
    """Per open the latest progress record that came while it was pending; progress without an open is ignored, and so is, with
    `within_seconds`, progress that came later than that."""
    kept = records.filter(F.col("rec_type").isin(OPEN, CLOSE, PROGRESS))
    rows = rows_of(kept, group_limit)
    hot = find_hot_keys(kept.select(*FILE_KEY, *ORDER), FILE_KEY, ORDER, group_limit, rows)
    event = F.struct("rec_type", "t_beg", F.col("arrival_seq").alias("open_seq"), F.col("rec_idx").alias("open_idx"))
    linked = before(
        kept,
        FILE_KEY,
        ORDER,
        last={"event": F.when(F.col("rec_type").isin(OPEN, CLOSE), event)},
        hot=hot,
        rows=rows,
    )
    moved = linked.filter((F.col("rec_type") == PROGRESS) & (F.col("event.rec_type") == OPEN))
    if within_seconds is not None:
        moved = moved.filter(F.col("t_beg") - F.col("event.t_beg") <= within_seconds)
    return moved.groupBy(*FILE_KEY, "event.open_seq", "event.open_idx").agg(
        F.max_by(F.struct("arrival_seq", "t_beg", "read", "readv", "write"), F.struct(*ORDER)).alias("progress"),
        F.count("*").alias("n_progress"),
    )


def pending_opens(records: DataFrame, as_of: int) -> DataFrame:
    """Opens without a close at `as_of` (epoch seconds), each with its latest progress.

    Plain aggregates: every map task reduces its records to one row per file before anything is shuffled.
    """
    seen = records.filter(F.col("arrival_ts") <= F.timestamp_seconds(F.lit(as_of)))
    position = F.struct(*ORDER)
    is_event, is_progress = F.col("rec_type").isin(OPEN, CLOSE), F.col("rec_type") == PROGRESS
    event = F.struct("rec_type", "addr", *OPEN_FIELDS, position.alias("position"))
    progress = F.struct("read", "readv", "write", position.alias("position"))
    latest = seen.filter(is_event | is_progress).groupBy(*FILE_KEY).agg(
        F.max_by(event, F.when(is_event, position)).alias("opened"),
        F.max_by(progress, F.when(is_progress, position)).alias("moved"),
    )
    still_open = latest.filter(F.col("opened.rec_type") == OPEN)
    moved = F.when(F.col("moved.position") > F.col("opened.position"), F.col("moved"))
    return still_open.select(
        *FILE_KEY,
        "opened.addr",
        *[f"opened.{c}" for c in OPEN_FIELDS],
        F.col("opened.position.arrival_seq").alias("open_seq"),
        F.col("opened.position.rec_idx").alias("open_idx"),
        moved.alias("progress"),
    )


def pending_records(records: DataFrame, since: int | None = None) -> DataFrame:
    """The records of opens that nothing has followed, and of each one's latest progress: all a later part of a feed needs of this
    one. With `since` (epoch seconds), opens from before are left out."""
    position = F.struct(*ORDER)
    whole = F.struct(*records.columns)
    is_event, is_progress = F.col("rec_type").isin(OPEN, CLOSE), F.col("rec_type") == PROGRESS
    latest = records.filter(is_event | is_progress).groupBy(*FILE_KEY).agg(
        F.max_by(whole, F.when(is_event, position)).alias("opened"), F.max_by(whole, F.when(is_progress, position)).alias("moved")
    )
    pending = latest.filter(F.col("opened.rec_type") == OPEN)
    if since is not None:
        pending = pending.filter(F.col("opened.t_beg") >= since)
    place = {n: F.struct(f"{n}.arrival_seq", f"{n}.rec_idx") for n in ("opened", "moved")}
    both = F.when(place["moved"] > place["opened"], F.array("opened", "moved")).otherwise(F.array("opened"))
    return pending.select(F.inline(both))


def expire_transfers(records: DataFrame, as_of: int, ttl_seconds: int = TTL_SECONDS) -> DataFrame:
    """Transfers given up at `as_of`: pending for longer than the TTL and with progress to report.

    They count as closed and come after everything that has arrived. Those without progress vanish.
    """
    old = pending_opens(records, as_of).filter(F.lit(as_of) - F.col("t_beg") > ttl_seconds)
    return old.filter("progress IS NOT NULL").withColumns(
        {
            "arrival_ts": F.timestamp_seconds(F.lit(as_of)),
            "arrival_seq": F.lit(END_OF_TIME),
            "rec_idx": F.lit(0),
            "has_close": F.lit(True),
            "is_open_known": F.lit(True),
            "open_time": F.col("t_beg"),
            "close_time": F.lit(as_of).cast("bigint"),
            "open_name": F.col("file_name"),
            "read": F.col("progress.read"),
            "readv": F.col("progress.readv"),
            "write": F.col("progress.write"),
            "ops": F.lit(None).cast(records.schema["ops"].dataType),
        }
    ).select(*COLUMNS)
