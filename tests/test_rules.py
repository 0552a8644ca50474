"""Rules on paths, hosts and statistics, and the ordered operators with hot keys."""

import random
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from packetloom.functions import fields as rules
from packetloom.functions.paths import is_wlcg_url, logical_dirname, user_domain, vo_from_path
from packetloom.operators import lookups, sequence, summaries, transfers
from packetloom.operators.ordered import before, find_hot_keys, limit_for

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "v string").select(expr(F.col("v")).alias("x")).first().x


@pytest.mark.parametrize(
    "path, expected",
    [
        ("/user/a/b/c", "/user/a"), ("/user/dteam/x/y", "/user/dteam"), ("/osgconnect/public/u/f", "/osgconnect/public/u"),
        ("/ospool/PROTECTED/u/f", "/ospool/PROTECTED/u"), ("/ospool/ap21/data/u/f", "/ospool/ap21/data/u"),
        ("/hcc/a/b/c/d/e/f", "/hcc/a/b/c/d"), ("/pnfs/fnal.gov/usr/x/y", "/pnfs/fnal.gov/usr/x"), ("/chtc/x", "/chtc"),
        ("/chtcx", "unknown directory"), ("/igwn/ligo/x/y", "/igwn/ligo/x"), ("/storage/x/y", "unknown directory"), ("/storefront/x/y", "/storefront/x"), ("", "unknown directory"),
    ],
)
def test_logical_dirname(spark, path, expected):
    assert one(spark, path, logical_dirname) == expected


def test_name_from_path_entry_keeps_open_name_rule(spark):
    df = spark.createDataFrame([("/pnfs/fnal.gov/usr/x/y", "")], "p string, o string")
    assert df.select(logical_dirname(F.col("p"), F.col("o")).alias("x")).first().x == ""


def test_hosts_owners_urls(spark):
    assert one(spark, "n1.unl.edu", user_domain) == "unl.edu"
    assert [one(spark, h, user_domain) for h in ("f1.unl.edu", "[::1]", "10.0.0.1")] == [None] * 3
    assert [one(spark, p, vo_from_path) for p in ("/osgconnect/public/x", "/chtc", "/gwdata/x")] == ["osg", "noVO", "gwdata"]
    urls = {"root://h:1094//store/x": True, "davs://h/user/dteam/x": True, "davs://h/data/store": False, "store/x": True,
            "https://h/a b/store": False, "https://h/store a": True, "https://[h/store": False, "?store": False}
    assert {u: one(spark, u, is_wlcg_url) for u in urls} == urls


def test_crab_examples(spark):
    for text, want in {
        "162_https://host.example/162/190501:101553:carol:crab:RPC-v2_0": ("162", "0", "190501:101553:carol:crab:RPC-v2"),
        "3-99_https://host.example/3-99/190608:dave:E_2": ("3-99", "2", "190608:dave:E"),
        "a_b": (None, None, None),
    }.items():
        got = spark.createDataFrame([(text,)], "a string").select(*[v.alias(n) for n, v in rules.crab_fields(F.col("a")).items()]).first()
        assert tuple(got) == want


@pytest.mark.parametrize(
    "last, now, expected",
    [(None, 9, (9, 0, 0)), (255, 0, (0, 0, 0)), (5, 6, (6, 0, 0)), (5, 9, (6, 3, 0)), (250, 1, (251, 5, 0)),
     (0, 253, (1, 252, 0)), (0, 254, (1, 0, 1)), (5, 5, (6, 0, 1)), (5, 2, (6, 251, 0))],
)
def test_sequence_rule(spark, last, now, expected):
    row = spark.createDataFrame([(last, now)], "l bigint, n bigint").select(
        *[v.alias(k) for k, v in sequence.judge(F.col("n"), F.col("l")).items()]).first()
    assert tuple(row) == expected


def _skewed(spark, n=4000):
    rng = random.Random(7)
    rows = [("hot" if rng.random() < 0.4 else f"k{rng.randrange(50)}", i, rng.randrange(100) if rng.random() < 0.3 else None)
            for i in range(n)]
    return rows, spark.createDataFrame(rows, "k string, seq bigint, v bigint").repartition(7)


def test_hot_keys_change_nothing(spark):
    rows, df = _skewed(spark)
    hot = find_hot_keys(df, ["k"], "seq", 200)
    found = {r.k: len(r.bounds) for r in hot.collect()}
    assert list(found) == ["hot"] and found["hot"] >= 8
    got = {r.seq: (r.l, r.m) for r in before(df, ["k"], ["seq"], last={"l": F.col("v")}, largest={"m": F.col("v")}, hot=hot).collect()}
    last, largest, want = {}, {}, {}
    for k, seq, v in rows:
        want[seq] = (last.get(k), largest.get(k))
        if v is not None:
            last[k], largest[k] = v, max(v, largest.get(k, v))
    assert got == want
    # no slice of the hot key holds more than the limit
    sliced = df.join(hot, "k").groupBy(F.size(F.filter("bounds", lambda b: b < F.col("seq")))).count()
    assert sliced.agg(F.max("count")).first()[0] <= 200
    assert find_hot_keys(df, ["k"], "seq", 10**6) is None
    assert (limit_for(4000, df), limit_for(3999, df), limit_for(None, df)) == (None, 3999, None)


def test_leases_fold_and_jumps_agree(spark):
    rng = random.Random(3)
    ident = ("x", "u", 1, 2, "h")
    offsets = sorted(rng.randrange(0, 400000) for _ in range(600)) + [500000, 503600, 503601]
    rows = [("s", ident, T0 + timedelta(seconds=t), i) for i, t in enumerate(offsets)]
    schema = "sid string, ident struct<protocol:string,username:string,pid:bigint,sid:bigint,host:string>, arrival_ts timestamp, arrival_seq bigint"
    df = spark.createDataFrame(rows, schema)
    want, start = [], None
    for t in offsets:
        if start is None or t > start + 3600:
            start = t
            want.append(t)
    base = int(T0.timestamp())
    for limit in (None, 50):
        got = sorted(r.t // 1000000 - base for r in lookups.user_leases(df, 3600, limit).collect())
        assert got == want
    assert 503600 not in want and 503601 in want


def _records(spark, events):
    """(seq, file, type, t) with type o(pen), c(lose), x(fer)."""
    kinds = {"c": 0, "o": 1, "x": 3}
    rows = [("s", "a", T0 + timedelta(seconds=t), q, t, 0, kinds[k], f, Decimal(9) if k == "o" else None, 5 if k == "o" else None,
             f"/n{q}" if k == "o" else None, Decimal(q), Decimal(q), Decimal(q), None) for q, f, k, t in events]
    ops = "struct<read:bigint>"
    return spark.createDataFrame(rows, f"""sid string, addr string, arrival_ts timestamp, arrival_seq bigint, t_beg bigint,
        rec_idx int, rec_type bigint, file_id bigint, file_size decimal(20,0), user_id bigint, file_name string,
        read decimal(20,0), readv decimal(20,0), write decimal(20,0), ops {ops}""")


def test_stitching_and_progress(spark):
    events = [(1, 1, "o", 0), (2, 1, "o", 5), (3, 1, "x", 6), (4, 1, "x", 7), (5, 1, "c", 9), (6, 1, "c", 10), (7, 1, "x", 11),
              (8, 2, "o", 0), (9, 2, "x", 1), (10, 3, "o", 0), (11, 2, "o", 50)]
    recs = _records(spark, events)
    for limit in (None, 2):
        got = {r.arrival_seq: (r.is_open_known, r.open_time, r.user_id) for r in transfers.stitch_transfers(recs, group_limit=limit).collect()}
        assert got == {5: (True, 5, 5), 6: (False, 10, 0)}
        moved = {(r.file_id, r.open_seq): (r.progress.arrival_seq, r.n_progress) for r in transfers.attach_progress(recs, limit).collect()}
        assert moved == {(1, 2): (4, 2), (2, 8): (9, 1)}
    now = int(T0.timestamp()) + 10000
    # file 2 was opened again and has no progress since; file 3 never had any
    assert transfers.expire_transfers(recs, now).count() == 0
    again = recs.unionByName(_records(spark, [(12, 2, "x", 60)]))
    row = transfers.expire_transfers(again, now).first()
    assert (row.file_id, row.open_time, row.has_close, int(row.read)) == (2, 50, True, 12)


def test_results_do_not_depend_on_partitions(spark):
    _, df = _skewed(spark, 1000)
    counted = df.select(F.lit("a").alias("addr"), F.length("k").cast("bigint").alias("pid"), F.col("seq").alias("arrival_seq"),
                        F.coalesce("v", F.lit(50)).alias("tod"), F.lit(True).alias("has_site"))
    sets = [{tuple(r) for r in summaries.drop_late_summaries(counted.repartition(n), limit).collect()} for n, limit in ((1, None), (16, 100))]
    assert sets[0] == sets[1] and sets[0]
