"""Expiry by the event clock and late packets; the other streaming jobs are compared with SQL in test_queries.py."""

import struct
from datetime import datetime, timezone

import pytest

from packetloom.operators import framing, fstream, transfers
from packetloom.operators.records import record_id
from packetloom.sources.packets import PACKET_SCHEMA, stream_packets
from packetloom.streaming import streams

T0 = 1700000000


def fpacket(t, record):
    body = struct.pack("!BBHHHIIQ", 2, 0, 24, 0, 1, t, t + 1, 0) + record
    return struct.pack("!cBHI", b"f", 0, len(body) + 8, 7) + body


def opened(fid):
    return struct.pack("!BBHIQ", 1, 0, 16, fid, 9)


def moved(fid):
    return struct.pack("!BBHIQQQ", 3, 0, 32, fid, 5, 6, 7)


def closed(fid):
    return struct.pack("!BBHIQQQ", 0, 0, 32, fid, 1, 2, 3)


def run(spark, tmp_path, files):
    """Stitched rows of a feed that comes in these micro-batches."""
    seq = 0
    for part in files:
        rows = []
        for t, record in part:
            seq += 1
            at = datetime.fromtimestamp(T0 + t, tz=timezone.utc)
            rows.append((bytearray(fpacket(T0 + t, record)), "a", "1", at, seq))
        spark.createDataFrame(rows, PACKET_SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    packets = stream_packets(spark, str(tmp_path / "in"), max_files_per_trigger=1).withWatermark("arrival_ts", "0 seconds")
    records = fstream.fstream_records(framing.frame_packets(packets))
    query = (
        streams.stream_stitch(records, ttl_seconds=3600)
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    assert query.awaitTermination(90)
    return spark.read.parquet(str(tmp_path / "out")).collect()


FEED = [
    (0, opened(1)), (10, moved(1)), (20, opened(2)), (30, opened(3)), (40, moved(3)), (100, closed(3)), (20000, opened(4)), (20001, opened(1)),
    (20002, closed(1)), (30000, opened(5)),
]


def as_found(rows):
    return sorted((r.file_id, r.open_time - T0, r.close_time - T0, int(r.read), r.is_open_known, r.open_seq) for r in rows)


@pytest.mark.parametrize("cut", [(1, 10), (6, 10), (10,), (2, 3, 7, 8, 10)])
def test_the_cut_into_batches_changes_nothing(spark, tmp_path, cut):
    files = [FEED[i:j] for i, j in zip((0, *cut), cut)]
    # 1 is given up with its progress and opened again, 2 vanishes without any, 3 was closed in time
    assert as_found(run(spark, tmp_path, files)) == [(1, 0, 3600, 5, True, 1), (1, 20001, 20002, 1, True, None), (3, 30, 100, 1, True, None)]


def test_late_packets_are_not_dropped(spark, tmp_path):
    files = [[(0, opened(1)), (5, opened(2)), (6, moved(2))], [(90000, opened(3))], [(50, closed(1)), (90001, opened(4))], [(60, closed(9)), (70, closed(2))]]
    got = as_found(run(spark, tmp_path, files))
    assert (9, 60, 60, 1, False, None) in got and {r[0] for r in got} == {1, 2, 9}


def test_pending_transfers_are_given_up(spark, tmp_path):
    files = [
        [(0, opened(1)), (10, moved(1)), (20, opened(2)), (30, opened(3)), (40, moved(3))],
        [(100, closed(3)), (20000, opened(4))],
    ]
    rows = run(spark, tmp_path, files)
    got = {r.file_id: (r.open_time - T0, r.close_time - T0, int(r.read), r.is_open_known) for r in rows}
    # 1 is given up with its progress, 2 vanishes without any, 3 was closed in time, 4 is still pending
    assert got == {1: (0, 3600, 5, True), 3: (30, 100, 1, True)}


def test_batch_gives_up_the_same_transfers(spark):
    rows = [
        (bytearray(fpacket(T0 + t, record)), "a", "1", datetime.fromtimestamp(T0 + t, tz=timezone.utc), i + 1) for i, (t, record) in enumerate(FEED)
    ]
    records = fstream.fstream_records(framing.frame_packets(spark.createDataFrame(rows, PACKET_SCHEMA)))
    ended = transfers.stitch_transfers(records, 3600).unionByName(transfers.given_up_transfers(records, 3600))
    assert as_found(ended.collect()) == [(1, 0, 3600, 5, True, 1), (1, 20001, 20002, 1, True, None), (3, 30, 100, 1, True, None)]


def test_ids_of_given_up_transfers_differ(spark):
    end = transfers.END_OF_TIME
    rows = [("s", 1, end, 0, 10, 0), ("s", 1, end, 0, 20, 0), ("s", 1, 5, 0, None, None), ("s", 1, 5, 0, 5, 0)]
    df = spark.createDataFrame(rows, "sid string, file_id long, arrival_seq long, rec_idx int, open_seq long, open_idx int")
    ids = [r.id for r in df.select(record_id().alias("id")).collect()]
    assert len(set(ids)) == len(ids)
