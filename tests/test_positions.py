"""Equal positions of hot keys, sweeps, host names in time and long packets, against plain loops."""

import random
import struct
import time
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from packetloom.operators import framing, fstream, lookups, sweeps, transfers
from packetloom.operators.ordered import before, find_hot_keys
from packetloom.operators.spacing import hot_times, times_apart
from packetloom.sources.packets import PACKET_SCHEMA

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
END = transfers.END_OF_TIME


def parts_of(df, hot, keys, order):
    from packetloom.operators.ordered import _slices

    at, part = _slices(df.join(hot, keys), order, hot)
    return df.join(hot, keys).groupBy(*keys, at.alias("at"), part.alias("part")).count().collect()


def test_equal_positions_are_split(spark):
    df = spark.range(1000).select(F.lit("k").alias("k"), F.lit(END).alias("arrival_seq"), F.lit(0).alias("rec_idx"), "id")
    hot = find_hot_keys(df, ["k"], ["arrival_seq", "rec_idx"], 100)
    counts = [r["count"] for r in parts_of(df, hot, ["k"], ["arrival_seq", "rec_idx"])]
    assert sum(counts) == 1000 and len(counts) >= 8 and max(counts) <= 200


@pytest.mark.parametrize("limit", [None, 60, 300])
def test_crowded_positions_change_nothing(spark, limit):
    rng = random.Random(11)
    rows = []
    for i in range(3000):
        key = "hot" if rng.random() < 0.6 else f"k{rng.randrange(20)}"
        seq = rng.choice([5, 5, 7, END, END, END, rng.randrange(20)])
        idx = rng.choice([0, 0, 0, rng.randrange(6)])
        rows.append((i, key, seq, idx))
    # a position is written once at most, as by a packet; probes write nothing
    places, data = set(), []
    for i, key, seq, idx in rows:
        writes = (key, seq, idx) not in places and rng.random() < 0.5 and not any(r[1:4] == (key, seq, idx) for r in data)
        places.add((key, seq, idx))
        data.append((i, key, seq, idx, i if writes else None))
    written = {}
    for i, key, seq, idx, v in data:
        if v is not None:
            written.setdefault(key, []).append(((seq, idx), v))
    want = {}
    for i, key, seq, idx, v in data:
        earlier = [w for w in written.get(key, []) if w[0] < (seq, idx)]
        want[i] = (max(earlier)[1] if earlier else None, max((w[1] for w in earlier), default=None))
    probes_after_own = {i for i, key, seq, idx, v in data if any(w[0] == (seq, idx) for w in written.get(key, []))}
    df = spark.createDataFrame(data, "i long, k string, seq long, idx int, v long").repartition(5)
    hot = find_hot_keys(df, ["k"], ["seq", "idx"], limit)
    assert (hot is None) == (limit is None)
    found = before(df, ["k"], ["seq", "idx"], last={"l": F.col("v")}, largest={"m": F.col("v")}, hot=hot)
    got = {r.i: (r.l, r.m) for r in found.collect()}
    # rows that share their whole position with a writer may or may not see it; all others are exact
    assert len(got) == len(data) and all(got[i] == want[i] for i in got if i not in probes_after_own)
    if hot is not None:
        assert max(r["count"] for r in parts_of(df, hot, ["k"], ["seq", "idx"])) <= 2 * limit


# --- sweeps


def collector(events, arrivals, ttl=3600, every=300):
    """Rows (file, known, open time, close time, progress) of a collector that goes packet by packet."""
    pending, rows, last = {}, [], None
    by_seq = {}
    for seq, idx, f, kind, t in events:
        by_seq.setdefault(seq, []).append((idx, f, kind, t))
    for t, seq in arrivals:
        last = t if last is None else last
        for idx, f, kind, at in sorted(by_seq.get(seq, [])):
            if kind == "o":
                pending[f] = [at, None]
            elif kind == "x" and f in pending:
                pending[f][1] = seq
            elif kind == "c":
                opened = pending.pop(f, None)
                rows.append((f, opened is not None, opened[0] if opened else at, at, None))
        if t > last + every:
            last = t
            for f in [f for f, p in pending.items() if t > p[0] + ttl]:
                opened, moved = pending.pop(f)
                if moved is not None:
                    rows.append((f, True, opened, t, moved))
    return sorted(rows, key=repr)


@pytest.mark.parametrize("seed, limit", [(1, None), (2, None), (3, 20)])
def test_sweeps(spark, seed, limit):
    rng = random.Random(seed)
    t, events, arrivals = 0, [], []
    for seq in range(1, 700):
        t += rng.choice([0, 0, 1, 5, 20, 40, 299, 300, 301, 2000] if rng.random() < 0.5 else [0, 1, 3])
        arrivals.append((t, seq))
        for idx in range(rng.randrange(0, 3)):
            events.append((seq, idx, rng.randrange(25), rng.choice("oxxc"), t - rng.randrange(0, 3)))
    base = int(T0.timestamp())
    kinds = {"c": 0, "o": 1, "x": 3}
    at = dict((s, x) for x, s in arrivals)
    rows = [("s", "a", T0 + timedelta(seconds=at[q]), q, base + b, i, kinds[k], f, Decimal(9), 5, "/n", Decimal(q), Decimal(q), Decimal(q), None)
            for q, i, f, k, b in events]
    schema = """sid string, addr string, arrival_ts timestamp, arrival_seq bigint, t_beg bigint, rec_idx int, rec_type bigint, file_id bigint,
        file_size decimal(20,0), user_id bigint, file_name string, read decimal(20,0), readv decimal(20,0), write decimal(20,0), ops struct<read:bigint>"""
    records = spark.createDataFrame(rows, schema).repartition(3)
    feed = spark.createDataFrame([(T0 + timedelta(seconds=x), s) for x, s in arrivals], "arrival_ts timestamp, arrival_seq bigint")
    found = sweeps.swept_transfers(records, feed, group_limit=limit).collect()
    given = lambda r: int(r.read) if r.open_seq is not None else None
    got = sorted(((r.file_id, r.is_open_known, r.open_time - base, r.close_time - base, given(r)) for r in found), key=repr)
    assert got == collector(events, arrivals) and any(r[4] for r in got)
    times = sorted(r.t // 1000000 - base for r in sweeps.sweep_times(feed, limit=limit).collect())
    want, last = [], arrivals[0][0]
    for x, _ in arrivals:
        if x > last + 300:
            want.append(x)
            last = x
    assert times == want


@pytest.mark.parametrize("seed, limit", [(5, None), (6, 25)])
def test_one_order_ends_the_same_transfers(spark, seed, limit):
    rng = random.Random(seed)
    t, rows, kinds = 0, [], {"c": 0, "o": 1, "x": 3}
    for seq in range(1, 600):
        t += rng.choice([0, 1, 30, 300])
        for idx in range(rng.randrange(1, 3)):
            k, b = rng.choice("oxxc"), int(T0.timestamp()) + t - rng.randrange(3)
            rows.append(("s", "a", T0 + timedelta(seconds=t), seq, b, idx, kinds[k], rng.randrange(30), Decimal(9), rng.randrange(5), f"/n{seq}",
                         Decimal(seq), Decimal(idx), Decimal(1), (seq,) if k == "c" else None))
    schema = """sid string, addr string, arrival_ts timestamp, arrival_seq bigint, t_beg bigint, rec_idx int, rec_type bigint, file_id bigint,
        file_size decimal(20,0), user_id bigint, file_name string, read decimal(20,0), readv decimal(20,0), write decimal(20,0), ops struct<read:bigint>"""
    records = spark.createDataFrame(rows, schema).repartition(4)
    apart = transfers.stitch_transfers(records, 3600).unionByName(transfers.given_up_transfers(records, 3600))
    one = transfers.ended_transfers(records, 3600, limit)
    assert one.columns == apart.columns and sorted(map(repr, one.collect())) == sorted(map(repr, apart.collect()))
    assert one.filter("open_seq IS NOT NULL").count() > 5


def test_sweeps_of_an_empty_feed(spark):
    feed = spark.createDataFrame([], "arrival_ts timestamp, arrival_seq bigint")
    assert sweeps.sweep_times(feed).count() == 0
    rows = spark.createDataFrame([(1, T0, 5, 1)], "arrival_seq bigint, arrival_ts timestamp, t_beg bigint, k int")
    assert sweeps.with_sweep(rows, sweeps.sweep_times(feed), 3600, 300).first().swept_t is None


def test_chains_with_repeated_times(spark):
    rows = [("k", t) for t in [0, 0, 0, 5, 10, 11, 11, 12, 22, 23, 40] for _ in range(30)] + [("c", 3), ("c", 14)]
    df = spark.createDataFrame(rows, "k string, t long")
    for limit in (None, 20):
        got = sorted((r.k, r.t) for r in times_apart(df, ["k"], 10, hot_times(df, ["k"], limit)).collect())
        assert got == [("c", 3), ("c", 14), ("k", 0), ("k", 11), ("k", 22), ("k", 40)]


# --- host names


def test_host_names_in_time(spark):
    rng = random.Random(4)
    rows = [(f"a{rng.randrange(4)}", rng.randrange(0, 500_000)) for _ in range(300)] + [("gone", 5)]
    names = [("a0", "x0", 0), ("a0", "y0", 90_000), ("a1", "x1", 50_000), ("a2", "x2", 0), ("a2", None, 100_000), ("a2", "z2", 300_000)]
    want = []
    looked = {}
    for addr, t in sorted(rows, key=lambda r: r[1]):
        if addr not in looked or t > looked[addr][0] + 86400:
            known = [n for a, n, s in sorted(names, key=lambda n: n[2]) if a == addr and s <= t]
            looked[addr] = (t, known[-1] if known else None)
        want.append((addr, t, looked[addr][1] or addr))
    ts = lambda t: T0 + timedelta(seconds=t)
    df = spark.createDataFrame([(a, ts(t)) for a, t in rows], "addr string, arrival_ts timestamp")
    history = spark.createDataFrame([(a, n, ts(s)) for a, n, s in names], "addr string, hostname string, valid_from timestamp")
    found = lookups.resolve_host_asof(df, history).collect()
    got = [(r.addr, int((r.arrival_ts.replace(tzinfo=timezone.utc) - T0).total_seconds()), r.server_hostname) for r in found]
    assert sorted(got) == sorted(want)


# --- long packets


def test_packets_of_thousands_of_records(spark):
    n = 8000
    disconnects = b"".join(struct.pack("!BBHI", 4, 0, 8, i) for i in range(n))
    body = struct.pack("!BBHHHIIQ", 2, 0, 24, 0, n, 10, 20, 0) + disconnects
    payload = struct.pack("!cBHI", b"f", 0, 65535, 7) + body
    cut = struct.pack("!cBHI", b"f", 0, 65535, 7) + body[:-4]
    rows = [(bytearray(payload), "a", "1", T0, i) for i in range(4)] + [(bytearray(cut), "a", "1", T0, 9)]
    framed = framing.frame_packets(spark.createDataFrame(rows, PACKET_SCHEMA))
    start = time.perf_counter()
    found = fstream.fstream_records(framed).select("arrival_seq", "rec_idx", "user_id").collect()
    assert time.perf_counter() - start < 60
    assert sorted(map(tuple, found)) == [(s, i, i) for s in range(4) for i in range(n)] + [(9, i, i) for i in range(n - 1)]
    assert [r.reason for r in fstream.bad_fstream(framed).collect()] == ["record"]
