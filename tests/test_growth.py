"""What keeps the work of a task from growing with the feed."""

import random

import pytest
from pyspark.sql import functions as F

from packetloom.functions import text
from packetloom.operators import fstream, ordered, record_walk, report_cuts, summaries, transfers
from packetloom.operators.fstream import CLOSE, OPEN, PROGRESS
from packetloom.sources import stage
from packetloom.workload import feeds
from tests.conftest import SF


def test_many_rows_are_ordered_by_as_many_tasks_as_they_ask_for(spark, monkeypatch):
    rows = spark.range(2000).select((F.col("id") % 50).alias("k"), "id", (F.col("id") * 7 % 100).alias("v"))
    plain = ordered.before(rows, ["k"], ["id"], last={"p": F.col("v")})
    monkeypatch.setattr(ordered, "TASK_ROWS", 100)
    dealt = ordered.before(rows, ["k"], ["id"], last={"p": F.col("v")}, rows=2000)
    assert dealt.rdd.getNumPartitions() == 20
    assert sorted(map(tuple, dealt.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_partitioned_stages_keep_files_open_and_restore_the_setting(spark):
    option = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(option)
    with pytest.raises(ZeroDivisionError), stage.open_files(spark):
        assert int(spark.conf.get(option)) == stage.OPEN_FILES
        raise ZeroDivisionError
    assert spark.conf.get(option) == before
    # More values than files that stay open.
    rows = spark.range(1000).select("id", (F.col("id") % 40).cast("string").alias("kind"))
    read = stage.write_stage(rows, "kinds", partition_by="kind")
    assert sorted(map(tuple, read.select("id", "kind").collect())) == [(i, str(i % 40)) for i in range(1000)] and spark.conf.get(option) == before


IDENTS = [
    "xroot/u1.5:7@n1.unl.edu", "xroot/a.b.07:008@h", "x/a/b.1:2@h:1094", "x/.1:2@h", "x/a.1:2@", "x/a.1:2@h\n", "x/a.1 :2@h", "x/a.-1:2@h",
    "x/a.1:2:3@h", "x/a.1:2@h@i", "x:y/a.1:2@h", "x@y/a.1:2@h", "x/a1:2@h", "x/a.1:b@h", "x/a.999999999999999999:1@h", "x/a.9999999999999999999:1@h",
    "/a.1:2@h", "x/a\n.1:2@h", "x/a.1@2:3@h", "x/a.\u0661:2@h", "x/\u00fc\U0001f600.1:2@\u00e9", "x/a.1:2", "xa.1:2@h", "", "x/a.1:@h", "x/a.:2@h",
]


def test_identities_cut_by_position_are_those_of_the_patterns(spark, monkeypatch):
    rows = spark.createDataFrame([(m,) for m in IDENTS], "m string")

    def parsed():
        return [tuple(r) for r in rows.select("m", text.parse_user_ident(F.col("m")).alias("i"), F.col("m").rlike(text._PLAIN_IDENT).alias("q")).collect()]

    quick = parsed()
    assert sum(q for _, _, q in quick) >= 10
    monkeypatch.setattr(text, "_PLAIN_IDENT", "(?!)")
    assert [r[:2] for r in quick] == [r[:2] for r in parsed()]


def test_overdue_transfers_have_the_progress_of_an_ordered_pass(spark):
    pick, rows = random.Random(5), []
    for at in range(1500):
        rows.append((f"s{pick.randrange(2)}", pick.randrange(60), at // 2, at % 2, pick.choice([OPEN, CLOSE, PROGRESS, PROGRESS]), 1000 + at * 3, at))
    seen = spark.createDataFrame(rows, "sid string, file_id long, arrival_seq long, rec_idx int, rec_type long, t_beg long, n long")
    none = {c: F.lit(None).cast(t) for c, t in feeds.records(spark, SF).dtypes if c not in seen.columns}
    records = seen.withColumns(none).withColumns(
        {"arrival_ts": F.timestamp_seconds("t_beg"), **{c: F.col("n").cast("decimal(20,0)") for c in ("read", "readv", "write")}}
    )
    clock, ttl = 1000 + 1500 * 3, 900
    got = transfers.overdue_transfers(records, clock, ttl).select("sid", "file_id", "open_seq", "open_idx", "read", "close_time")
    old = transfers.pending_opens(records, clock).filter(clock - F.col("t_beg") > ttl).drop("progress")
    want = old.join(transfers.attach_progress(records, None, ttl), [*transfers.FILE_KEY, "open_seq", "open_idx"])
    want = want.select("sid", "file_id", "open_seq", "open_idx", "progress.read", F.col("t_beg") + ttl)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 0
    # One pass over aggregates and a join; nothing is ordered.
    assert "Window" not in transfers.overdue_transfers(records, clock, ttl)._jdf.queryExecution().optimizedPlan().toString()


def _odd_packets(pick, n):
    """Bodies of file-stream packets with records of every kind and form, whole and broken, and random bytes."""
    def num(value, width):
        return value.to_bytes(width, "big")

    def record():
        kind = pick.choice([0, 0, 1, 1, 1, 2, 3, 3, 4, 7, 255])
        flag = pick.choice([0, 1, 2, 3, 255])
        size = pick.choice([0, 3, 8, 16, 19, 20, 24, 32, 40, 80, 90])
        size = size if pick.random() < 0.3 else {0: 80 if flag & 2 else 32, 1: pick.choice([20, 21, 27]) if flag == 1 else 16, 2: 24, 3: 32}.get(kind, 8)
        name = pick.choice([b"/a\x00\x00", b"/b\x00\n", b"\xff\xfe\x00x", "/ü\x00".encode()])
        return num(kind, 1) + num(flag, 1) + num(size, 2) + (pick.randbytes(16) + name * 20 + pick.randbytes(80))[: max(size - 4, 0)]

    for i in range(n):
        if i % 50 == 0:
            yield None if i % 100 == 0 else pick.randbytes(pick.randrange(60))
            continue
        held = [record() for _ in range(pick.choice([0, 1, 1, 2, 5, 70]))]
        total = max(0, len(held) + pick.choice([0, 0, 0, -1, 1]))
        first = pick.choice([24, 24, 24, 24, 24, 0, 16, 30, 60000])
        body = num(pick.choice([2, 2, 2, 2, 2, 1]), 1) + num(0, 1) + num(first, 2) + num(1, 2) + num(total, 2) + pick.randbytes(16) + b"".join(held)
        yield body if pick.random() < 0.8 else body[: pick.randrange(len(body) + 1)]


def test_records_walked_by_whole_batches_are_those_of_the_expressions(spark, monkeypatch):
    bodies = list(_odd_packets(random.Random(11), 1500))
    framed = spark.createDataFrame([(f"s{i % 3}", "fstream" if i % 20 else "user", "a", i, b) for i, b in enumerate(bodies)],
                                   "sid string, kind string, addr string, arrival_seq long, body binary")
    framed = framed.withColumn("arrival_ts", F.timestamp_seconds("arrival_seq"))
    plain = framed.transform(fstream.explode_fstream).transform(fstream.decode_records)
    monkeypatch.setattr(record_walk, "PART_RECORDS", 500)
    monkeypatch.setattr(fstream, "_walked", None)  # the walk by expressions, which took most of the time of records
    walked = fstream.fstream_records(framed)
    assert walked.dtypes == plain.dtypes
    rows = sorted(map(tuple, plain.collect()), key=lambda r: (r[3], r[5]))
    assert len(rows) > 2000 and {r[6] for r in rows} >= {0, 1, 2, 3, 4, 7, 255}
    assert sorted(map(tuple, walked.collect()), key=lambda r: (r[3], r[5])) == rows
    assert fstream.fstream_records(framed.limit(0)).collect() == []


def _report(pick, odd):
    def num():
        return pick.choice(["0", "17", "-3", "007", "x1", "1.5"]) if pick.random() < 0.1 else str(pick.randrange(5000))

    def leaves(*names):
        held = [f"<{n}>{num()}</{n}>" for n in names if pick.random() < 0.95]
        return "".join(held + held[:1] * (pick.random() < 0.1))

    def stats(name, inner):
        return f'<stats id="{name}">{inner}</stats>'

    sections = [
        stats("info", "<host>h1.site</host><port>1094</port>"), stats("link", leaves("num", "tot", "in", "out", "ctime", "tmo")),
        stats("proc", f"<usr><s>{num()}</s><u>1</u></usr><sys>{leaves('s', 'u') or '<s>1</s>'}</sys>"),
        stats("xrootd", leaves("num") + f"<ops><open>3</open>{leaves('pr', 'rd', 'rv', 'sync', 'wr')}</ops>{leaves('err', 'dly', 'rdr')}"
              f"<lgn><num>5</num>{leaves('af', 'au', 'ua')}</lgn>"),
        stats("ofs", "<role>server</role>"), stats("sched", leaves("inq", "threads", "idle")), stats("sgen", leaves("as", "toe")),
    ]
    kept = [s for s in sections if pick.random() < 0.9] + ([pick.choice(sections)] if pick.random() < 0.1 else [])
    site = pick.choice([' site="S1"', ""])
    whole = f'<statistics tod="{num()}" ver="v5" src="h:1" tos="17" pgm="{pick.choice(["xrootd", "xrootd", "cmsd"])}" pid="{num()}"{site}>{"".join(kept)}</statistics>'
    changes = [("<tot>", "<tot> "), ("<inq>", "<!-- c --><inq>"), ("h1.site", "h&amp;1"), ("<in>", "<in a='1'>"), ("</stats>", "", 1), ("ver=", "pid='3' ver="),
               ("server", "sérver"), ("<num>", "<num></num><num>"), ("<as>", "<as><as>1</as>"), ('site="S1"', 'site=""'), ("</statistics>", "</statistics> "),
               ("<port>1094</port>", "<tot><out>1</out></tot>"), ("<ops>", "<ops>5"), ("<link>", "<lgn>5</lgn>"), ('id="sched"', 'id="sched" b="1"')]
    return whole.replace(*pick.choice(changes)) if odd else whole


def test_reports_cut_by_position_are_those_of_the_parser(spark, monkeypatch):
    pick = random.Random(3)
    texts = [_report(pick, i % 3 == 0) for i in range(600)] + ["", "<", "<statistics>", "<statistics></statistics>", '<statistics pgm="xrootd"></statistics>']
    rows = [(t.encode(), "a", i) for i, t in enumerate(texts)] + [(None, "a", -1), (b"\xff<statistics", "a", -2)]
    feed = spark.createDataFrame(rows, "payload binary, addr string, arrival_seq long").withColumn("arrival_ts", F.timestamp_seconds("arrival_seq"))

    def read():
        shown = [sorted(map(repr, df.collect())) for df in (summaries.summary_fields(feed), summaries.bad_summaries(feed))]
        cut = summaries._cut_reports(feed.select("addr", "arrival_ts", "arrival_seq", "payload")).filter("usual").count()
        return shown, cut

    monkeypatch.setattr(report_cuts, "LAYOUTS", 50)
    (quick, cut) = read()
    monkeypatch.setattr(report_cuts.Cutter, "read", lambda self, report: None)  # nothing is usual
    (plain, none) = read()
    assert cut > 350 and none == 0 and len(plain[0]) > 200 and len(plain[1]) > 50
    assert quick == plain
