"""Scalar rules that turn an enriched transfer into its published fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from packetloom.functions.paths import MISSING_DIRECTORY, dir_level, is_store_family, logical_dirname, user_domain

MISSING_SIZE = -1
# Organisations whose transfers are reported in the WLCG format.
WLCG_VOS = ["cms", "dteam"]


def times(open_time: Column, close_time: Column) -> dict[str, Column]:
    """Milliseconds since the epoch, and whole seconds in between, rounded towards zero."""
    start = (open_time * 1000).cast("bigint")
    end = (close_time * 1000).cast("bigint")
    return {
        "timestamp": end,
        "start_time": start,
        "end_time": end,
        "operation_time": ((end - start) / 1000).cast("bigint"),
    }


def user_fields(user: Column) -> dict[str, Column]:
    host = user["host"]
    return {
        "user": user["username"],
        "host": host,
        "user_domain": user_domain(host),
        "protocol": F.nullif(user["protocol"], F.lit("")),
    }


def auth_fields(auth: Column) -> dict[str, Column]:
    return {
        "ipv6": F.when(auth["inetv"] != "", auth["inetv"] == "6"),
        "user_dn": F.when(auth["info"] != "", F.substring_index(auth["info"], "::", 1)),
        "vo": F.nullif(auth["on"], F.lit("")),
    }


def filename_fields(known: Column, open_name: Column, path: Column, file_size: Column) -> dict[str, Column]:
    """Name, size and directories. The path entry only stands in for an empty name; without an open all is missing."""
    name = F.when(open_name == "", F.coalesce(path, F.lit(""))).otherwise(open_name)
    return {
        "filename": F.when(known, name).otherwise(MISSING_DIRECTORY),
        "filesize": F.when(known, file_size).otherwise(F.lit(MISSING_SIZE).cast("decimal(20,0)")),
        "dirname1": F.when(known, dir_level(name, 2)),
        "dirname2": F.when(known, dir_level(name, 3)),
        "logical_dirname": F.when(known, logical_dirname(name, open_name)).otherwise(MISSING_DIRECTORY),
    }


def is_wlcg_transfer(vo: Column, filename: Column) -> Column:
    return F.coalesce(vo.isin(WLCG_VOS), F.lit(False)) | is_store_family(filename)


def _ratio(amount: Column, count: Column) -> Column:
    return F.coalesce(F.try_divide(amount.cast("double"), count.cast("double")), F.lit(0.0))


def io_stats(read: Column, readv: Column, write: Column, ops: Column) -> dict[str, Column]:
    """Statistics of the operation counters, all NULL without counters. A mean over nothing is 0.

    The mean length of vector reads divides segments by vector read *bytes*, and is kept that way.
    """
    total = read + readv
    stats = {
        "read_average": _ratio(total, ops["read"] + ops["readv"]),
        "read_bytes_at_close": total,
        "read_max": F.greatest(ops["rdMax"], ops["rvMax"]),
        "read_min": F.least(ops["rdMin"], ops["rvMin"]),
        "read_operations": ops["read"] + ops["readv"],
        "read_single_average": _ratio(read, ops["read"]),
        "read_single_bytes": read,
        "read_single_max": ops["rdMax"],
        "read_single_min": ops["rdMin"],
        "read_single_operations": ops["read"],
        "read_vector_average": _ratio(readv, ops["readv"]),
        "read_vector_count_average": _ratio(ops["rsegs"], readv),
        "read_vector_count_max": ops["rsMax"],
        "read_vector_count_min": ops["rsMin"],
        "read_vector_max": ops["rvMax"],
        "read_vector_min": ops["rvMin"],
        "read_vector_operations": ops["readv"],
        "write_average": _ratio(write, ops["write"]),
        "write_bytes_at_close": write,
        "write_max": ops["wrMax"],
        "write_min": ops["wrMin"],
        "write_operations": ops["write"],
    }
    return {name: F.when(ops.isNotNull(), value) for name, value in stats.items()}


# Statistics of the WLCG format, 0 where a record has none.
WLCG_STATS = [
    "read_average",
    "read_bytes_at_close",
    "read_max",
    "read_min",
    "read_operations",
    "read_sigma",
    "read_single_average",
    "read_single_bytes",
    "read_single_max",
    "read_single_min",
    "read_single_operations",
    "read_single_sigma",
    "read_vector_average",
    "read_vector_count_average",
    "read_vector_count_max",
    "read_vector_count_min",
    "read_vector_count_sigma",
    "read_vector_max",
    "read_vector_min",
    "read_vector_operations",
    "read_vector_sigma",
    "write_average",
    "write_bytes_at_close",
    "write_max",
    "write_min",
    "write_operations",
    "write_sigma",
]
NEVER_MEASURED = {"read_sigma", "read_single_sigma", "read_vector_count_sigma", "read_vector_sigma", "write_sigma"}


def wlcg_stats() -> dict[str, Column]:
    return {
        name: F.lit(0) if name in NEVER_MEASURED else F.coalesce(F.col(name), F.lit(0)) for name in WLCG_STATS
    }


def operation_kind(read: Column, readv: Column, write: Column) -> Column:
    return F.when((read > 0) | (readv > 0), "read").when(write > 0, "write").otherwise("unknown")


def dn_user(user_dn: Column) -> Column:
    """What stands between the first and the second `CN=`."""
    return F.try_element_at(F.split(user_dn, "CN="), F.lit(2))


def crab_fields(appinfo: Column) -> dict[str, Column]:
    """Job id, retry and workflow from `id_url/workflow_retry`; nothing unless there are exactly three parts."""
    parts = F.split(appinfo, "_")
    three = F.size(parts) == 3
    return {
        "CRAB_Id": F.when(three, F.get(parts, F.lit(0))),
        "CRAB_Retry": F.when(three, F.get(parts, F.lit(2))),
        "CRAB_Workflow": F.when(three, F.substring_index(F.get(parts, F.lit(1)), "/", -1)),
    }


def metadata(producer: str, kind: Column | str, record_id: Column, now_ms: Column, host: Column) -> Column:
    """Where a published record comes from; clock and host are arguments, so results can be repeated."""
    return F.struct(
        F.lit(producer).alias("producer"),
        (F.lit(kind) if isinstance(kind, str) else kind).alias("type"),
        now_ms.alias("timestamp"),
        F.lit("raw").alias("type_prefix"),
        host.alias("host"),
        record_id.alias("_id"),
    )
