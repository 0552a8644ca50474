"""Wire formats written as expressions, to turn tables into packet feeds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from packetloom.functions.binary import pack, to_binary
from packetloom.operators.fstream import CLOSE, DISCONNECT, HAS_NAME, HAS_OPS, OPEN, OPS_FIELDS, PROGRESS, TIME, TIME_BYTES


def packet(code: str | Column, pseq: Column, server_start: Column, body: Column, wrong_by: Column | int = 0) -> Column:
    """Header and body. `wrong_by` is added to the announced length."""
    wrong_by = F.lit(wrong_by) if isinstance(wrong_by, int) else wrong_by
    length = F.octet_length(body) + 8 + wrong_by
    return F.concat(to_binary(code), pack(pseq, 1), pack(length, 2), pack(server_start, 4), body)


def map_body(dict_id: Column, ident: Column, rest: Column | None) -> Column:
    pieces = [pack(dict_id, 4), to_binary(ident)]
    if rest is not None:
        pieces += [to_binary("\n"), to_binary(rest)]
    return F.concat(*pieces)


def time_record(n_xfr: Column | int, n_total: Column | int, t_beg: Column, t_end: Column, source: Column) -> Column:
    return F.concat(
        pack(TIME, 1), pack(0, 1), pack(TIME_BYTES, 2), pack(n_xfr, 2), pack(n_total, 2), pack(t_beg, 4), pack(t_end, 4),
        pack(source, 8),
    )


def open_record(file_id: Column, file_size: Column, user_id: Column, name: Column, named: Column) -> Column:
    bare = F.concat(pack(OPEN, 1), pack(0, 1), pack(16, 2), pack(file_id, 4), pack(file_size, 8))
    text = to_binary(name)
    size = F.octet_length(text) + 21
    full = F.concat(
        pack(OPEN, 1), pack(HAS_NAME, 1), pack(size, 2), pack(file_id, 4), pack(file_size, 8), pack(user_id, 4), text,
        pack(0, 1),
    )
    return F.when(named, full).otherwise(bare)


def _moved(kind: int, flag: int, size: int, file_id: Column, read: Column, readv: Column, write: Column) -> Column:
    return F.concat(
        pack(kind, 1), pack(flag, 1), pack(size, 2), pack(file_id, 4), pack(read, 8), pack(readv, 8), pack(write, 8)
    )


def close_record(
    file_id: Column, read: Column, readv: Column, write: Column, ops: dict[str, Column], has_ops: Column
) -> Column:
    counters = [pack(ops[name], width) for name, width in OPS_FIELDS]
    full = F.concat(_moved(CLOSE, HAS_OPS, 80, file_id, read, readv, write), *counters)
    return F.when(has_ops, full).otherwise(_moved(CLOSE, 0, 32, file_id, read, readv, write))


def progress_record(file_id: Column, read: Column, readv: Column, write: Column) -> Column:
    return _moved(PROGRESS, 0, 32, file_id, read, readv, write)


def disconnect_record(user_id: Column) -> Column:
    return F.concat(pack(DISCONNECT, 1), pack(0, 1), pack(8, 2), pack(user_id, 4))


def gstream_body(stream: str | Column, begin: Column, end: Column, lines: Column) -> Column:
    return F.concat(
        pack(begin, 4), pack(end, 4), to_binary(stream), pack(0, 7), to_binary(F.concat_ws("\n", lines)), pack(0, 1)
    )


def pushed(addr: Column, port: Column, payload: Column) -> Column:
    """JSON envelope of a pushed packet."""
    return F.to_json(F.struct(F.concat_ws(":", addr, port).alias("remote"), F.base64(payload).alias("data")))
