"""File-stream packets: one time record, then records of varying length for opens, closes, progress, disconnects."""

from __future__ import annotations

from collections.abc import Iterator
from types import SimpleNamespace

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.functions.binary import strip_nul, text, uint
from packetloom.operators import record_walk

# Tasks take the walk's code with them: executors need numpy and pyarrow, but not this library.
cloudpickle.register_pickle_by_value(record_walk)

# Fixed values of the wire format.
CLOSE, OPEN, TIME, PROGRESS, DISCONNECT = 0, 1, 2, 3, 4
HAS_NAME = 1
HAS_OPS = 2
TIME_BYTES = 24
# Fixed values of the wire format: operation counters at bytes 33 to 80 of a close record, with their widths.
OPS_FIELDS = [
    ("read", 4),
    ("readv", 4),
    ("write", 4),
    ("rsMin", 2),
    ("rsMax", 2),
    ("rsegs", 8),
    ("rdMin", 4),
    ("rdMax", 4),
    ("rvMin", 4),
    ("rvMax", 4),
    ("wrMin", 4),
    ("wrMax", 4),
]
#: A walk gathers its positions in pieces of this many, so that appending copies no long array.
_PIECE = 64
_WALK = "struct<pos:int,pieces:array<array<int>>,bad:boolean>"
_PART = "struct<pos:int,at:array<int>,bad:boolean>"


def _needed(kind: Column, flag: Column, size: Column) -> Column:
    """Bytes a record must have from its start on."""
    return (
        F.when(kind == CLOSE, F.when(flag.bitwiseAND(F.lit(HAS_OPS)) != 0, 80).otherwise(32))
        .when(kind == OPEN, F.when(flag == HAS_NAME, F.greatest(size, F.lit(20))).otherwise(16))
        .when(kind == TIME, TIME_BYTES)
        .when(kind == PROGRESS, 32)
        .otherwise(8)
    )


def _walked(framed: DataFrame) -> DataFrame:
    """Walk the announced number of records; `walk.bad` tells that a record did not fit and the walk stopped there.

    The walk itself only notes positions; `recs` cuts the records out once it is done.
    """
    body = F.col("body")
    length = F.octet_length(body)
    total = uint(body, 7, 2).cast("int")

    def step(acc: Column, _: Column) -> Column:
        pos = acc["pos"]
        kind, flag, size = uint(body, pos, 1), uint(body, pos + 1, 1), uint(body, pos + 2, 2)
        cut = F.coalesce(pos - 1 + _needed(kind, flag, size) > length, F.lit(True))
        nameless = (kind == OPEN) & (flag == HAS_NAME) & (size < 20)
        legacy = (kind == TIME) & (size == 16)
        bad = cut | (size == 0) | nameless | legacy
        onward = F.struct((pos + size).cast("int").alias("pos"), F.array_append(acc["at"], pos).alias("at"), F.lit(False).alias("bad"))
        stopped = F.struct(pos.alias("pos"), acc["at"].alias("at"), F.lit(True).alias("bad"))
        return F.when(acc["bad"], acc).when(bad, stopped).otherwise(onward)

    def piece(acc: Column, first: Column) -> Column:
        empty = F.struct(acc["pos"].alias("pos"), F.array().cast("array<int>").alias("at"), acc["bad"].alias("bad")).cast(_PART)
        part = F.aggregate(F.sequence(first, F.least(first + (_PIECE - 1), total)), empty, step)
        # One field more, so that the part is walked once and not once per field.
        whole = F.aggregate(
            F.array(part), acc,
            lambda a, p: F.struct(p["pos"].alias("pos"), F.array_append(a["pieces"], p["at"]).alias("pieces"), p["bad"].alias("bad")),
        )
        return F.when(acc["bad"], acc).otherwise(whole)

    start = F.struct(
        (uint(body, 3, 2) + 1).cast("int").alias("pos"),
        F.array().cast("array<array<int>>").alias("pieces"),
        F.lit(False).alias("bad"),
    ).cast(_WALK)
    firsts = F.sequence(F.lit(1), F.greatest(total, F.lit(1)), F.lit(_PIECE))
    walk = F.when(_readable(), F.when(total > 0, F.aggregate(firsts, start, piece)).otherwise(start))
    return _timed(framed).withColumn("walk", walk)


def _records() -> Column:
    """The bytes of the records walked. A record may be read past its own size, as far as its fixed part reaches."""
    body = F.col("body")
    return F.transform(
        F.flatten("walk.pieces"), lambda pos: F.substring(body, pos, F.greatest(uint(body, pos + 2, 2), F.lit(80)).cast("int"))
    )


def _readable() -> Column:
    """A packet that begins with a time record of the present form."""
    body = F.col("body")
    return (F.octet_length(body) >= TIME_BYTES) & (uint(body, 1, 1) == TIME) & (uint(body, 3, 2) != 16)


def _timed(framed: DataFrame) -> DataFrame:
    body = F.col("body")
    return framed.filter("kind = 'fstream'").withColumns(
        {
            "xfr_recs": uint(body, 5, 2),
            "total_recs": uint(body, 7, 2),
            "t_beg": uint(body, 9, 4),
            "t_end": uint(body, 13, 4),
            "source_sid": uint(body, 17, 8),
        }
    )


def decode_times(framed: DataFrame) -> DataFrame:
    """The leading time record of every file-stream packet."""
    return _timed(framed).filter(_readable()).select(
        "sid", "addr", "arrival_ts", "arrival_seq", "xfr_recs", "total_recs", "t_beg", "t_end", "source_sid"
    )


def explode_fstream(framed: DataFrame) -> DataFrame:
    """One row per record, with the event time of its packet and its place in it (`rec_idx`)."""
    columns = ["sid", "addr", "arrival_ts", "arrival_seq", "t_beg"]
    # The outer form, because Spark would put a filter on the array below a plain one and walk every packet twice.
    spread = _walked(framed).select(*columns, F.posexplode_outer(_records()).alias("rec_idx", "rec"))
    return spread.filter("rec IS NOT NULL")


def bad_fstream(framed: DataFrame) -> DataFrame:
    """Packets without a usable time record, or with a record that is cut off, empty or of the old short time form."""
    wire, names, walk = _wire(), ["reason", "payload", "arrival_seq"], record_walk

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in walk.parts_of(batch):
                yield walk.unread_of(part, names, wire)

    packets = framed.filter("kind = 'fstream'").select("body", "arrival_seq")
    return packets.mapInArrow(run, "reason string, payload binary, arrival_seq bigint")


def decode_records(records: DataFrame) -> DataFrame:
    """Typed columns of every record; a column is NULL where the record type does not have it."""
    rec = F.col("rec")
    kind, flag = uint(rec, 1, 1), uint(rec, 2, 1)
    is_open, named = kind == OPEN, (kind == OPEN) & (flag == HAS_NAME)
    moved = kind.isin(CLOSE, PROGRESS)
    ops, at = [], 33
    for name, width in OPS_FIELDS:
        ops.append(uint(rec, at, width).alias(name))
        at += width
    name_bytes = F.substring(rec, F.lit(21), (uint(rec, 3, 2) - 20).cast("int"))
    return records.withColumns(
        {
            "rec_type": kind,
            "rec_flag": flag,
            "rec_size": uint(rec, 3, 2),
            "file_id": F.when(is_open | moved, uint(rec, 5, 4)),
            "file_size": F.when(is_open, uint(rec, 9, 8)),
            "user_id": F.when(named, uint(rec, 17, 4)).when(is_open, 0).when(kind > PROGRESS, uint(rec, 5, 4)),
            "file_name": F.when(named, strip_nul(text(name_bytes))).when(is_open, ""),
            "read": F.when(moved, uint(rec, 9, 8)),
            "readv": F.when(moved, uint(rec, 17, 8)),
            "write": F.when(moved, uint(rec, 25, 8)),
            "ops": F.when((kind == CLOSE) & (flag.bitwiseAND(F.lit(HAS_OPS)) != 0), F.struct(*ops)),
        }
    ).drop("rec")


def fstream_records(framed: DataFrame) -> DataFrame:
    """Typed records of all file-stream packets, decoded by whole Arrow batches. The watermark of a stream is set below that, and what keeps
    state by its clock asks for no event-time column."""
    return _decoded(framed)


_KEPT = ["sid", "addr", "arrival_ts", "arrival_seq"]
_ROW = [
    ("t_beg", "bigint"), ("rec_idx", "int"), ("rec_type", "bigint"), ("rec_flag", "bigint"), ("rec_size", "bigint"), ("file_id", "bigint"),
    ("file_size", "decimal(20,0)"), ("user_id", "bigint"), ("file_name", "binary"), ("read", "decimal(20,0)"), ("readv", "decimal(20,0)"),
    ("write", "decimal(20,0)"),
    ("ops", "struct<" + ",".join(f"{n}:{'decimal(20,0)' if w == 8 else 'bigint'}" for n, w in OPS_FIELDS) + ">"),
]


def _wire() -> SimpleNamespace:
    """What a task needs of this module, of which nothing itself is used there."""
    return SimpleNamespace(
        CLOSE=CLOSE, OPEN=OPEN, TIME=TIME, PROGRESS=PROGRESS, HAS_NAME=HAS_NAME, HAS_OPS=HAS_OPS, TIME_BYTES=TIME_BYTES, OPS_FIELDS=OPS_FIELDS
    )


def _decoded(framed: DataFrame) -> DataFrame:
    kept, names, walk, wire = list(_KEPT), [*_KEPT, *[n for n, _ in _ROW]], record_walk, _wire()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in walk.parts_of(batch):
                yield walk.records_of(part, kept, names, wire)

    packets = framed.filter("kind = 'fstream'").select(*_KEPT, "body")
    same = [f"{f.name} {f.dataType.simpleString()}" for f in packets.select(*_KEPT).schema]
    rows = packets.mapInArrow(run, ", ".join([*same, *[f"`{n}` {t}" for n, t in _ROW]]))
    return rows.withColumn("file_name", strip_nul(text(F.col("file_name"))))


def opens(records: DataFrame) -> DataFrame:
    return records.filter(F.col("rec_type") == OPEN)


def closes(records: DataFrame) -> DataFrame:
    return records.filter(F.col("rec_type") == CLOSE)


def progress_records(records: DataFrame) -> DataFrame:
    return records.filter(F.col("rec_type") == PROGRESS)


def disconnects(records: DataFrame) -> DataFrame:
    """Disconnect records; every record type above the known ones counts as one."""
    return records.filter(F.col("rec_type") >= DISCONNECT).select(
        "sid", "arrival_ts", "arrival_seq", "rec_idx", "t_beg", "user_id"
    )
