"""Map messages: a dictionary id, an identity line and a rest whose meaning depends on the packet code."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.functions.binary import tail, text, uint
from packetloom.functions.text import (
    has_protocol,
    has_session,
    parse_auth,
    parse_purge,
    parse_server_info,
    parse_staging,
    parse_user_ident,
)

MAP_KINDS = ["server", "path", "app", "purge", "user", "staging", "map"]
_BASE = ["sid", "addr", "arrival_ts", "arrival_seq", "dict_id"]


def decode_map(framed: DataFrame, *extra: str) -> DataFrame:
    """`dict_id`, and the text before and after the first line break; without a line break `rest` is empty.

    `whole` tells that a message can be used at all: a `:` in the identity calls for a `/` before it.
    """
    info = text(tail(F.col("body"), 5))
    ident = F.substring_index("info", "\n", 1)
    rest = F.substring(F.col("info"), F.char_length("ident_text") + 2, F.char_length("info"))
    split = framed.filter(F.col("kind").isin(MAP_KINDS) & (F.octet_length("body") >= 4)).withColumn("info", info)
    # A column below the generator, which otherwise cuts the line out again wherever its parser looks at it.
    split = split.withColumn("ident_text", ident)
    return split.select(
        *extra,
        "sid",
        "kind",
        "addr",
        "arrival_ts",
        "arrival_seq",
        uint(F.col("body"), 1, 4).alias("dict_id"),
        "ident_text",
        rest.alias("rest"),
        # In a generator of one row, so that filters on the identity do not make Spark parse it again.
        F.explode_outer(F.array(parse_user_ident(F.col("ident_text")))).alias("ident"),
    ).withColumn("whole", has_protocol(F.col("ident_text")) | ~has_session(F.col("ident_text")))


def _of_kind(maps: DataFrame, kind: str, needs_ident: bool) -> DataFrame:
    usable = "ident IS NOT NULL" if needs_ident else "whole"
    return maps.filter((F.col("kind") == kind) & F.expr(usable))


def user_messages(maps: DataFrame) -> DataFrame:
    return _of_kind(maps, "user", True).select(*_BASE, "ident", parse_auth(F.col("rest")).alias("auth"))


def app_messages(maps: DataFrame) -> DataFrame:
    return _of_kind(maps, "app", True).select(*_BASE, "ident", F.col("rest").alias("appinfo"))


def identity_messages(maps: DataFrame) -> DataFrame:
    """User and app messages in one pass: `auth` of the ones, `appinfo` of the others."""
    rows = maps.filter(F.col("kind").isin("user", "app") & F.col("ident").isNotNull())
    is_user = F.col("kind") == "user"
    return rows.select(
        *_BASE, "ident", F.when(is_user, parse_auth(F.col("rest"))).alias("auth"), F.when(~is_user, F.col("rest")).alias("appinfo")
    )


def path_messages(maps: DataFrame) -> DataFrame:
    return _of_kind(maps, "path", True).select(*_BASE, "ident", F.col("rest").alias("path"))


def server_messages(maps: DataFrame) -> DataFrame:
    return _of_kind(maps, "server", False).select(*_BASE, parse_server_info(F.col("rest")).alias("server"))


def purge_messages(maps: DataFrame) -> DataFrame:
    purge = parse_purge(F.col("rest"))
    return _of_kind(maps, "purge", False).withColumn("purge", purge).filter("purge IS NOT NULL").select(*_BASE, "purge")


def staging_messages(maps: DataFrame) -> DataFrame:
    staging = parse_staging(F.col("rest"))
    rows = _of_kind(maps, "staging", False).withColumn("staging", staging)
    return rows.filter("staging IS NOT NULL").select(*_BASE, "staging")


def dict_entries(maps: DataFrame) -> DataFrame:
    """Everything that writes the dictionary of a stream: users and apps map an id to an identity, paths to a path."""
    rows = maps.filter(F.col("kind").isin("user", "app", "path") & F.col("ident").isNotNull())
    is_path = F.col("kind") == "path"
    return rows.select(
        "sid",
        "dict_id",
        "arrival_ts",
        "arrival_seq",
        F.struct(
            is_path.alias("is_path"), "ident", F.when(is_path, F.col("rest")).alias("path"), "arrival_ts"
        ).alias("entry"),
    )


def bad_maps(framed: DataFrame) -> DataFrame:
    """Map messages without a dictionary id, without the identity they need, or without all positional values."""
    short = framed.filter(F.col("kind").isin(MAP_KINDS) & (F.octet_length("body") < 4)).select(
        F.lit("map header").alias("reason"), F.col("body").alias("payload"), "arrival_seq"
    )
    maps = decode_map(framed, "body")
    rest = F.col("rest")
    reason = (
        F.when(~F.col("whole"), "identity")
        .when(F.col("kind").isin("user", "app", "path") & F.col("ident").isNull(), "identity")
        .when((F.col("kind") == "purge") & parse_purge(rest).isNull(), "purge")
        .when((F.col("kind") == "staging") & parse_staging(rest).isNull(), "staging")
    )
    broken = maps.withColumn("reason", reason).filter("reason IS NOT NULL")
    return short.unionByName(broken.select("reason", F.col("body").alias("payload"), "arrival_seq"))
