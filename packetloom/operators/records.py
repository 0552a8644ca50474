"""Published transfer records: the plain form and the WLCG form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.functions import fields as rules

TRANSFER_STATS = [name for name in rules.WLCG_STATS if name not in rules.NEVER_MEASURED]
POSITION = ["sid", "file_id", "arrival_seq", "rec_idx"]
#: Position of the open, for transfers that were given up.
OPEN_POSITION = ["open_seq", "open_idx"]
TRANSFER_COLUMNS = [
    "timestamp", "start_time", "end_time", "HasFileCloseMsg", "operation_time", "server_hostname", "server_ip",
    "serverID", "server", "site", "user", "host", "user_domain", "protocol", "ipv6", "user_dn", "vo", "appinfo",
    "filename", "filesize", "dirname1", "dirname2", "logical_dirname", "read", "readv", "write", *TRANSFER_STATS,
]


def transfer_records(enriched: DataFrame) -> DataFrame:
    """All published fields of an enriched transfer, its position in the feed, and where it is to be sent."""
    c = F.col
    base = enriched.select(
        *POSITION,
        *OPEN_POSITION,
        "arrival_ts",
        c("addr").alias("server_ip"),
        c("server_hostname"),
        c("server_id").alias("serverID"),
        "server",
        "site",
        "appinfo",
        c("has_close").cast("int").alias("HasFileCloseMsg"),
        *[v.alias(n) for n, v in rules.user_fields(c("user")).items()],
        *[v.alias(n) for n, v in rules.auth_fields(c("auth")).items()],
        *[
            v.alias(n)
            for n, v in rules.filename_fields(
                c("is_open_known"), c("open_name"), c("path"), c("file_size")
            ).items()
        ],
        "read",
        "readv",
        "write",
        *[v.alias(n) for n, v in rules.io_stats(c("read"), c("readv"), c("write"), c("ops")).items()],
        *[v.alias(n) for n, v in rules.times(c("open_time"), c("close_time")).items()],
    )
    return base.withColumn("is_wlcg", rules.is_wlcg_transfer(c("vo"), c("filename"))).select(
        *POSITION, *OPEN_POSITION, "arrival_ts", "is_wlcg", *TRANSFER_COLUMNS
    )


def record_id() -> Column:
    """Stable id of a record, made from its place in the feed: a repeated task gives the same id again."""
    place = [F.col(c).cast("string") for c in POSITION]
    opened = [*place[:2], F.lit("open"), *[F.col(c).cast("string") for c in OPEN_POSITION]]
    name = F.when(F.col("open_seq").isNotNull(), F.concat_ws("|", *opened)).otherwise(F.concat_ws("|", *place))
    digest = F.md5(name.cast("binary"))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, start, n) for start, n in cuts])


def wlcg_columns(now_ms: Column, host: str, unique_id: Column, size: Column | None = None) -> list[Column]:
    c = F.col
    empty = F.lit("")
    return [
        F.coalesce("site", empty).alias("site_name"),
        F.lit(True).alias("fallback"),
        F.coalesce("user_dn", empty).alias("user_dn"),
        F.coalesce("host", empty).alias("client_host"),
        F.coalesce("user_domain", empty).alias("client_domain"),
        F.coalesce("server_hostname", empty).alias("server_host"),
        F.when(c("server_hostname") != "", F.substring_index("server_hostname", ".", -2)).alias("server_domain"),
        F.when(F.coalesce("server_hostname", empty) == "", empty).alias("server_hostname"),
        c("server_ip"),
        unique_id.alias("unique_id"),
        c("filename").alias("file_lfn"),
        (c("filesize") if size is None else size).alias("file_size"),
        (c("read") + c("readv")).alias("read_bytes"),
        c("readv").alias("read_vector_bytes"),
        c("write").alias("write_bytes"),
        F.coalesce("ipv6", F.lit(False)).alias("ipv6"),
        rules.dn_user(c("user_dn")).alias("user"),
        c("start_time"),
        c("end_time"),
        c("operation_time"),
        rules.operation_kind(c("read"), c("readv"), c("write")).alias("operation"),
        F.coalesce("site", empty).alias("server_site"),
        c("protocol").alias("user_protocol"),
        c("vo"),
        *[value.alias(name) for name, value in rules.wlcg_stats().items()],
        *[value.alias(name) for name, value in rules.crab_fields(c("appinfo")).items()],
        rules.metadata("cms", "aaa-ng", unique_id, now_ms, F.lit(host)).alias("metadata"),
    ]


def to_wlcg(
    records: DataFrame, now_ms: Column | None = None, host: str = "", unique_id: Column | None = None
) -> DataFrame:
    """Transfer records in the WLCG form. `unique_id` may be `F.uuid()` where ids need not be repeatable."""
    now_ms = F.unix_millis(F.current_timestamp()) if now_ms is None else now_ms
    return records.select(*POSITION, *wlcg_columns(now_ms, host, record_id() if unique_id is None else unique_id))
