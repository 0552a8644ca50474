"""Golden cases with bytes packed by hand."""

import struct
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from packetloom.functions import encode
from packetloom.functions.binary import pack_u64, uint
from packetloom.functions.text import parse_auth, parse_purge, parse_server_info, parse_staging, parse_user_ident
from packetloom.operators import framing, fstream, gstream, mapping, summaries
from packetloom.plans.detailed import dead_letters
from packetloom.sources.packets import PACKET_SCHEMA, bad_envelopes, unwrap_pushed

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def packet(code, body, pseq=0, start=7, plen=None):
    return struct.pack("!cBHI", code, pseq, len(body) + 8 if plen is None else plen, start) + body


def times(total, size=24):
    return struct.pack("!BBHHHIIQ", 2, 0, size, 0, total, 1000, 1001, 2**64 - 1)


def opened(fid, size, name=None, uid=0):
    if name is None:
        return struct.pack("!BBHIQ", 1, 0, 16, fid, size)
    return struct.pack("!BBHIQI", 1, 1, 20 + len(name) + 2, fid, size, uid) + name + b"\0\0"


def closed(fid, r=1, v=2, w=3, ops=None):
    if ops is None:
        return struct.pack("!BBHIQQQ", 0, 0, 32, fid, r, v, w)
    return struct.pack("!BBHIQQQ", 0, 2, 80, fid, r, v, w) + struct.pack("!IIIHHQIIIIII", *ops)


def frame(spark, *payloads):
    rows = [(bytearray(p), "10.0.0.1", "1094", T0, i) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, PACKET_SCHEMA)


def test_records_of_one_packet(spark):
    ops = [5, 6, 7, 1, 9, 2**63 + 1, 10, 20, 30, 40, 50, 60]
    body = times(5) + opened(1, 2**64 - 1, b"/a/b", 42) + opened(2, 9) + closed(1, ops=ops) + struct.pack(
        "!BBHIQQQ", 3, 0, 32, 2, 11, 12, 13) + struct.pack("!BBHI", 9, 0, 8, 77)
    rows = fstream.fstream_records(framing.frame_packets(frame(spark, packet(b"f", body)))).orderBy("rec_idx").collect()
    assert [r.rec_type for r in rows] == [1, 1, 0, 3, 9]
    assert (rows[0].file_size, rows[0].user_id, rows[0].file_name) == (2**64 - 1, 42, "/a/b")
    assert (rows[1].user_id, rows[1].file_name) == (0, "")
    assert list(rows[2].ops) == ops and rows[3].ops is None
    assert (rows[3].read, rows[3].readv, rows[3].write) == (11, 12, 13)
    assert rows[4].user_id == 77 and {r.t_beg for r in rows} == {1000}


def test_broken_packets_become_dead_letters(spark):
    good = times(1) + closed(1)
    bad = {
        "short header": b"f\0",
        "code not ascii": packet(b"\xff", b"1234"),
        "old time form": packet(b"f", times(1, size=16)[:16] + b"\0" * 16),
        "no time record": packet(b"f", closed(1)),
        "cut record": packet(b"f", times(2) + closed(1) + closed(2)[:20]),
        "empty record": packet(b"f", times(1) + struct.pack("!BBHI", 4, 0, 0, 1)),
        "name too short": packet(b"f", times(1) + struct.pack("!BBHIQI", 1, 1, 18, 1, 1, 1)),
        "no ident": packet(b"u", struct.pack("!I", 1) + b"nothing\n&p=1"),
        "map too short": packet(b"u", b"12"),
        "purge": packet(b"p", struct.pack("!I", 1) + b"a/b.1:2@h\nx\n&tod=1"),
        "event line": packet(b"g", struct.pack("!II", 1, 2) + b"T" + b"\0" * 7 + b'{"a":1}\nnope\0'),
        "cache event": packet(b"g", struct.pack("!II", 1, 2) + b"C" + b"\0" * 7 + b'{"lfn":"/a"}'),
        "event header": packet(b"g", b"123"),
    }
    feed = frame(spark, packet(b"f", good), *bad.values())
    found = {r.arrival_seq for r in dead_letters(feed).collect()}
    assert found == set(range(1, len(bad) + 1))
    # what came before a broken record still counts, and a packet without records is no error
    records = fstream.fstream_records(framing.frame_packets(feed)).groupBy("arrival_seq").count().collect()
    assert {r.arrival_seq: r["count"] for r in records} == {0: 1, 5: 1}
    assert dead_letters(frame(spark, packet(b"f", times(0)))).count() == 0


def test_framing(spark):
    feed = frame(spark, packet(b"f", b"x", pseq=255, start=2**32 - 1, plen=1), packet(b"r", b""), packet(b"z", b"1234"))
    rows = framing.frame_packets(feed).orderBy("arrival_seq").collect()
    assert (rows[0].sid, rows[0].pseq, rows[0].length_ok) == (f"{2**32 - 1}#10.0.0.1#1094", 255, False)
    assert [r.kind for r in rows] == ["fstream", "ignored", "map"]


@pytest.mark.parametrize(
    "message, expected",
    [
        ("xroot/carol.10:2059@node-4.example.edu", ("xroot", "carol", 10, 2059, "node-4.example.edu")),
        ("a/b.c.5:7@h@x", ("a", "b.c", 5, 0, "x")),  # the sid is "7@h", which is no number
        ("a/b.x:7@h", ("a", "b", 0, 0, "h")),
        ("a/b.5:x@h", ("a", "b", 5, 0, "h")),
        ("a/b5:7@h", ("a", "b", 0, 0, "h")),
        ("a/b.5:78", ("a", "b", 5, 7, "b.5:78")),
        ("a/b/c.1:2@h", ("a", "b/c", 1, 2, "h")),
        ("b.5:7@h", None),
        ("a/b.5@h", None),
    ],
)
def test_user_ident(spark, message, expected):
    got = spark.createDataFrame([(message,)], "m string").select(parse_user_ident(F.col("m")).alias("i")).first().i
    assert (None if got is None else tuple(got)) == expected


def test_key_value_lists(spark):
    df = spark.createDataFrame([("&p=x509&n=d=k&o=cms&o=&m=/DC=a::b&I=6&zz=1&y", "&pgm=x&ver=&inst=a+b%20c&site=S1&site=")],
                               "a string, s string")
    auth, server = df.select(parse_auth(F.col("a")), parse_server_info(F.col("s"))).first()
    assert (auth.ap, auth.dn, auth.on, auth.info, auth.inetv, auth.moninfo) == ("x509", "d=k", "", "/DC=a::b", "6", "")
    assert tuple(server) == ("x", None, "a b c", None, "S1")


def test_positional_lists(spark):
    df = spark.createDataFrame([("f\n&tod=1&sz=2&at=3&ct=4&mt=5&fn=6=7", "f\n&tod=1&sz=2&tm=3&op=4&rc=5", "f\n&tod=1&sz=2&tm=3&op=4&rc=5&pd=9")],
                               "p string, x string, y string")
    p, x, y = df.select(parse_purge(F.col("p")), parse_staging(F.col("x")), parse_staging(F.col("y"))).first()
    assert tuple(p) == ("f", "1", "2", "3", "4", "5", "6")
    assert (x.rc, x.pd, y.pd) == ("5", "", "9")


def test_server_message_needs_no_session(spark):
    feed = frame(spark, packet(b"=", struct.pack("!I", 0) + b"daemon\n&pgm=a&site=S"), packet(b"=", struct.pack("!I", 0) + b"a:b@c\n&pgm=a"))
    assert [r.arrival_seq for r in mapping.server_messages(mapping.decode_map(framing.frame_packets(feed))).collect()] == [0]


def test_u64_round_trip(spark):
    df = spark.createDataFrame([(str(n),) for n in (2**64 - 1, 0, 2**63)], "s string").select(F.col("s").cast("decimal(20,0)").alias("n")).withColumn("b", pack_u64(F.col("n")))
    assert all(r.n == r.m for r in df.select("n", uint(F.col("b"), 1, 8).alias("m")).collect())


def test_unknown_event_keys_pass_through(spark):
    event = ('{"lfn":"/store/x","blk_size":1,"n_blks":2,"n_blks_done":1,"access_cnt":1,"attach_t":1,"detach_t":2,"remotes":[],'
             '"b_hit":1,"b_miss":2,"b_bypass":3,"b_todisk":4,"b_prefetch":1,"new":{"k":[1,2]}}')
    feed = frame(spark, packet(b"g", struct.pack("!II", 1, 2) + b"C" + b"\0" * 7 + event.encode() + b"\0\0"))
    lines = gstream.explode_gstream(framing.frame_packets(feed)).withColumns({"site": F.lit(""), "server_hostname": F.lit("h")})
    row = gstream.cache_events(lines).withColumn("json", F.from_json(F.to_json("document"), "map<string,string>")).first()
    assert row.json["new"] == '{"k":[1,2]}' and row.json["remotes_origin"] == "" and "lfn" not in row.json
    assert (row.bytes_read_by_remote, row.bytes_explicit_remote_read, row.is_wlcg) == (7, 6, True)


def test_pushed_addresses(spark):
    rows = [('{"remote":"[::1]:1234","data":"AAE="}', T0, 1), ('{"remote":"nowhere","data":"AA=="}', T0, 2), ("junk", T0, 3)]
    df = spark.createDataFrame(rows, "value string, arrival_ts timestamp, arrival_seq bigint")
    got = unwrap_pushed(df).collect()
    assert [(r.addr, r.port, bytes(r.payload)) for r in got] == [("[::1]", "1234", b"\0\1")]
    assert {r.arrival_seq for r in bad_envelopes(df).collect()} == {2, 3}


def test_reports(spark):
    head = '<statistics tod="1700000000" ver="v" src="s" tos="1600000000" pgm="{}" pid="{}"{}>{}</statistics>'
    link = '<stats id="link"><num>1</num><tot>5</tot><in>6</in><out>7</out><ctime>8</ctime><tmo>9</tmo></stats>'
    feed = frame(spark, *[x.encode() for x in (head.format("xrootd", 1, ' site="S"', link), head.format("cmsd", 1, "", ""),
                                              head.format("xrootd", 2, "", link), "<broken", head.format("xrootd", "x", "", ""))])
    rows = summaries.summary_fields(feed).orderBy("arrival_seq").collect()
    assert [(r.arrival_seq, r.site, r.link_num) for r in rows] == [(0, "S", 1), (2, "UnknownSite", None)]
    assert (rows[0].timestamp, rows[0].counters.link_total, rows[0].counters.ops_read) == ("2023-11-14T22:13:20", 5, 0)
    assert {r.arrival_seq for r in summaries.bad_summaries(feed).collect()} == {3, 4}


def test_encoder_matches_struct(spark):
    row = spark.range(1).select(
        encode.close_record(F.lit(5), F.lit(1), F.lit(2), F.lit(3), {n: F.lit(4) for n, _ in fstream.OPS_FIELDS}, F.lit(True)).alias("c"),
        encode.open_record(F.lit(5), F.lit(6), F.lit(7), F.lit("/x"), F.lit(True)).alias("o"),
    ).first()
    assert bytes(row.c) == closed(5, ops=[4] * 12)
    assert bytes(row.o) == struct.pack("!BBHIQI", 1, 1, 23, 5, 6, 7) + b"/x\0"
