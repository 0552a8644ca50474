"""Big-endian integers and text inside binary columns, read and written with built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ALL = 2147483647


def uint(data: Column, start: int | Column, width: int) -> Column:
    """Unsigned integer of `width` bytes at 1-based `start`; NULL when nothing is there.

    Eight bytes do not fit BIGINT, so they come back as DECIMAL(20,0).
    """
    digits = F.conv(F.hex(F.substring(data, start, width)), 16, 10)
    return digits.cast("decimal(20,0)" if width == 8 else "bigint")


def tail(data: Column, start: int) -> Column:
    return F.substring(data, start, ALL)


def text(data: Column) -> Column:
    """Bytes as text; bytes that are not UTF-8 become the replacement character, the row stays."""
    return F.make_valid_utf8(data.cast("string"))


def strip_nul(value: Column) -> Column:
    return F.regexp_replace(value, r"\x00+$", "")


def pack(value: Column | int, width: int) -> Column:
    """Inverse of `uint` for values below 2^63."""
    value = F.lit(value) if isinstance(value, int) else value
    return F.unhex(F.lpad(F.hex(value.cast("bigint")), 2 * width, "0"))


def pack_u64(value: Column) -> Column:
    """Inverse of `uint(.., 8)` over its whole range: two 32-bit halves of a DECIMAL(20,0)."""
    value = value.cast("decimal(20,0)")
    high = F.floor(value / F.lit(4294967296).cast("decimal(20,0)")).cast("bigint")
    low = (value % F.lit(4294967296).cast("decimal(20,0)")).cast("bigint")
    return F.concat(pack(high, 4), pack(low, 4))


def to_binary(value: Column | str) -> Column:
    value = F.lit(value) if isinstance(value, str) else value
    return F.encode(value, "UTF-8")
