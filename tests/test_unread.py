"""Unreadable file-stream packets are found by the walk over Arrow batches; the walk by expressions tells the same."""

import random
import struct

from pyspark.sql import functions as F

from packetloom.operators import fstream


def record(kind, flag, size, length):
    return struct.pack("!BBH", kind, flag, size) + b"\1" * (length - 4)


def bodies():
    draw = random.Random(5)
    good = [record(1, 0, 16, 16), record(0, 0, 32, 32), record(0, 2, 80, 80), record(3, 0, 32, 32), record(4, 0, 8, 8), record(1, 1, 24, 24)]
    odd = [record(1, 1, 8, 24), record(2, 0, 16, 24), record(0, 0, 0, 32), record(0, 2, 80, 40), record(7, 0, 5, 8), record(3, 0, 32, 10)]
    made = [None, b"", b"\2", b"\2" * 23]
    for n in range(400):
        records = [draw.choice(good if draw.random() < 0.9 else odd) for _ in range(draw.randint(0, 5))]
        total = len(records) + draw.choice([0, 0, 0, 1, -1])
        time = struct.pack("!BBHHHIIQ", draw.choice([2, 2, 2, 2, 1]), 0, draw.choice([24, 24, 24, 16, 40]), 0, max(total, 0), 1, 2, 3)
        made.append(time + b"".join(records))
    return made


def test_the_walk_by_batches_finds_what_the_walk_by_expressions_finds(spark, monkeypatch):
    rows = [("fstream" if i % 9 else "user", bytearray(b) if b is not None else None, i) for i, b in enumerate(bodies())]
    framed = spark.createDataFrame(rows, "kind string, body binary, arrival_seq long").withColumns(
        {"sid": F.lit("s"), "addr": F.lit("a"), "arrival_ts": F.timestamp_seconds("arrival_seq")}
    )
    walk = fstream._walked(framed).filter("walk IS NULL OR walk.bad").select(
        F.when(F.col("walk").isNull(), "time record").otherwise("record").alias("reason"), F.col("body").alias("payload"), "arrival_seq"
    )
    want = sorted(walk.collect(), key=lambda r: r.arrival_seq)
    monkeypatch.setattr(fstream, "_walked", None)  # it took most of the time of dead letters
    assert sorted(fstream.bad_fstream(framed).collect(), key=lambda r: r.arrival_seq) == want
    assert {r.reason for r in want} == {"record", "time record"} and 50 < len(want) < len(rows) - 50
    assert fstream.bad_fstream(framed.limit(0)).collect() == []
