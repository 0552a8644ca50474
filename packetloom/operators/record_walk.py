"""The walk over file-stream packets on whole Arrow batches: what `explode_fstream` and `decode_records` give, without a call per byte field.

Step k looks at the k-th record of all packets of a batch that still have one, so the work is a few array operations per step. Only places
that a packet really holds are read; a record that does not fit ends the walk of its packet, as in `fstream._walked`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Records that one part of a batch may lead to: large packets are decoded a few at a time.
PART_RECORDS = 200_000
_HEAD = 8
_U64 = pa.decimal128(20, 0)


class Bodies:
    """The bytes of a binary column in one array, with the place where each value begins and ends."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_binary())
        _, places, data = column.buffers()
        edges = np.frombuffer(places, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        self.start, self.end = edges[:-1], edges[1:]
        self.data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)

    def uint(self, at: np.ndarray, width: int) -> np.ndarray:
        """Big-endian numbers of `width` bytes, which have to be there."""
        found = self.data[at[:, None] + np.arange(width)]
        return np.ascontiguousarray(found).view(f">u{width}")[:, 0].astype(np.uint64 if width == 8 else np.int64)


def _needed(kind: np.ndarray, flag: np.ndarray, size: np.ndarray, wire) -> np.ndarray:
    of_open = np.where(flag == wire.HAS_NAME, np.maximum(size, 20), 16)
    of_close = np.where(flag & wire.HAS_OPS != 0, 80, 32)
    cases = [kind == wire.CLOSE, kind == wire.OPEN, kind == wire.TIME, kind == wire.PROGRESS]
    return np.select(cases, [of_close, of_open, wire.TIME_BYTES, 32], _HEAD)


def walk(bodies: Bodies, wire) -> tuple[np.ndarray, ...]:
    """Packet, number in it, place, kind, flag and size of every record, packet after packet."""
    row = np.flatnonzero(bodies.end - bodies.start >= wire.TIME_BYTES)
    at = bodies.start[row]
    first, total = bodies.uint(at + 2, 2), bodies.uint(at + 6, 2)
    usable = (bodies.data[at] == wire.TIME) & (first != 16) & (total > 0)
    row, at, left = row[usable], (at + first)[usable], total[usable]
    found, k = [], 0
    while len(row):
        there = bodies.end[row] - at >= _HEAD
        row, at, left = row[there], at[there], left[there]
        kind, flag, size = bodies.data[at].astype(np.int64), bodies.data[at + 1].astype(np.int64), bodies.uint(at + 2, 2)
        nameless = (kind == wire.OPEN) & (flag == wire.HAS_NAME) & (size < 20)
        legacy = (kind == wire.TIME) & (size == 16)
        fits = (at + _needed(kind, flag, size, wire) <= bodies.end[row]) & (size > 0) & ~nameless & ~legacy
        row, at, left, kind, flag, size = (a[fits] for a in (row, at, left, kind, flag, size))
        found.append((row, np.full(len(row), k, dtype=np.int32), at, kind, flag, size))
        more = left > 1
        row, at, left, k = row[more], (at + size)[more], left[more] - 1, k + 1
    if not found:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(6))
    parts = [np.concatenate(p) for p in zip(*found)]
    order = np.lexsort((parts[1], parts[0]))
    return tuple(p[order] for p in parts)


def _numbers(values: np.ndarray, there: np.ndarray) -> pa.Array:
    """Eight bytes as DECIMAL(20,0), others as BIGINT; NULL where a record has no such field."""
    if values.dtype != np.uint64:
        return pa.array(values, pa.int64(), mask=~there)
    wide = np.zeros((len(values), 2), dtype=np.uint64)
    wide[:, 0] = values
    bits = pa.py_buffer(np.packbits(there, bitorder="little").tobytes())
    return pa.Array.from_buffers(_U64, len(values), [bits, pa.py_buffer(wide.tobytes())])


def _field(bodies: Bodies, at: np.ndarray, there: np.ndarray, width: int) -> pa.Array:
    values = np.zeros(len(at), dtype=np.uint64 if width == 8 else np.int64)
    values[there] = bodies.uint(at[there], width)
    return _numbers(values, there)


def _names(bodies: Bodies, at: np.ndarray, named: np.ndarray, size: np.ndarray, there: np.ndarray) -> pa.Array:
    lengths = np.where(named, size - 20, 0)
    edges = np.concatenate(([0], np.cumsum(lengths)))
    places = np.repeat(at + 20 - edges[:-1], lengths) + np.arange(edges[-1])
    bits = pa.py_buffer(np.packbits(there, bitorder="little").tobytes())
    data = pa.py_buffer(bodies.data[places].tobytes())
    return pa.Array.from_buffers(pa.large_binary(), len(at), [bits, pa.py_buffer(edges.astype(np.int64).tobytes()), data]).cast(pa.binary())


def records_of(batch: pa.RecordBatch, kept: list[str], names: list[str], wire) -> pa.RecordBatch:
    """One row per record of the packets of `batch`; `kept` columns go along. `names` are those of the result."""
    bodies = Bodies(batch.column("body"))
    row, place, at, kind, flag, size = walk(bodies, wire)
    is_open, moved = kind == wire.OPEN, (kind == wire.CLOSE) | (kind == wire.PROGRESS)
    named, other = is_open & (flag == wire.HAS_NAME), kind > wire.PROGRESS
    counted = (kind == wire.CLOSE) & (flag & wire.HAS_OPS != 0)
    user = np.zeros(len(at), dtype=np.int64)
    user[named], user[other] = bodies.uint(at[named] + 16, 4), bodies.uint(at[other] + 4, 4)
    ops, offset = [], 32
    for _, width in wire.OPS_FIELDS:
        ops.append(_field(bodies, at + offset, counted, width))
        offset += width
    every = np.ones(len(at), dtype=bool)
    took = pa.array(row)
    columns = [
        *[batch.column(c).take(took) for c in kept],
        _field(bodies, bodies.start[row] + 8, every, 4),
        pa.array(place, pa.int32()),
        *[pa.array(v, pa.int64()) for v in (kind, flag, size)],
        _field(bodies, at + 4, is_open | moved, 4),
        _field(bodies, at + 8, is_open, 8),
        _numbers(user, is_open | other),
        _names(bodies, at, named, size, is_open),
        *[_field(bodies, at + n, moved, 8) for n in (8, 16, 24)],
        pa.StructArray.from_arrays(ops, [n for n, _ in wire.OPS_FIELDS], mask=pa.array(~counted)),
    ]
    return pa.RecordBatch.from_arrays(columns, names)


def unread_of(batch: pa.RecordBatch, names: list[str], wire) -> pa.RecordBatch:
    """Reason, bytes and position of the packets of `batch` whose walk cannot begin or ends before the last record."""
    bodies = Bodies(batch.column("body"))
    readable = bodies.end - bodies.start >= wire.TIME_BYTES
    at = bodies.start[readable]
    first, total = bodies.uint(at + 2, 2), np.zeros(batch.num_rows, dtype=np.int64)
    total[readable] = bodies.uint(at + 6, 2)
    readable[readable] = (bodies.data[at] == wire.TIME) & (first != 16)
    walked = np.bincount(walk(bodies, wire)[0], minlength=batch.num_rows)
    bad = np.flatnonzero(~readable | (walked < total))
    reasons = pa.array(["record" if r else "time record" for r in readable[bad].tolist()], pa.string())
    took = pa.array(bad)
    return pa.RecordBatch.from_arrays([reasons, batch.column("body").take(took), batch.column("arrival_seq").take(took)], names)


def parts_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """`batch` in parts that lead to a bounded number of records: a packet has no more than it has bytes, nor than 16 bits announce."""
    bodies = Bodies(batch.column("body"))
    most = np.cumsum(np.minimum(bodies.end - bodies.start, 65535))
    at = 0
    while at < batch.num_rows:
        before = int(most[at - 1]) if at else 0
        upto = max(at + 1, int(np.searchsorted(most, before + PART_RECORDS, side="right")))
        yield batch.slice(at, upto - at)
        at = upto
