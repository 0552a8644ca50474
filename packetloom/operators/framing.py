"""Packet headers: what stream a packet belongs to, what it carries, and whether its length is right."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.functions.binary import tail, text, uint

HEADER_BYTES = 8
# Fixed values of the wire format: packet code -> what it carries. Any other code is a map message nobody acts on.
KINDS = {
    "f": "fstream",
    "g": "gstream",
    "r": "ignored",
    "t": "ignored",
    "=": "server",
    "d": "path",
    "i": "app",
    "p": "purge",
    "u": "user",
    "x": "staging",
}


def kind_of(code: Column) -> Column:
    chain = F
    for value, kind in KINDS.items():
        chain = chain.when(code == value, kind)
    return chain.otherwise("map")


def frame_packets(packets: DataFrame) -> DataFrame:
    """Header fields, stream id, kind and body of every packet with a readable header."""
    return _headers(packets).filter("code IS NOT NULL").withColumns(
        {
            "sid": F.concat_ws("#", F.col("server_start").cast("string"), "addr", "port"),
            "kind": kind_of(F.col("code")),
            "length_ok": F.octet_length("payload") == F.col("plen"),
            "body": tail(F.col("payload"), HEADER_BYTES + 1),
        }
    ).select(
        "sid", "code", "kind", "pseq", "plen", "server_start", "length_ok", "addr", "port", "arrival_ts",
        "arrival_seq", "body",
    )


def bad_headers(packets: DataFrame) -> DataFrame:
    """Packets too short for a header, or with a code that is not ASCII."""
    return _headers(packets).filter("code IS NULL").select(F.lit("header").alias("reason"), "payload", "arrival_seq")


def _headers(packets: DataFrame) -> DataFrame:
    p = F.col("payload")
    # Bytes compare as they are, without being made numbers.
    readable = (F.octet_length(p) >= HEADER_BYTES) & (F.substring(p, 1, 1) < F.lit(b"\x80"))
    return packets.withColumns(
        {
            "code": F.when(readable, text(F.substring(p, 1, 1))),
            "pseq": uint(p, 2, 1),
            "plen": uint(p, 3, 2),
            "server_start": uint(p, 5, 4),
        }
    )
