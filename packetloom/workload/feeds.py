"""Packet feeds made from the driver tables by the formulas of FIXTURES.md.

Every feed is a Spark job over whole tables; a feed that several queries use is written once per session and
read back, the way packets would lie on shared storage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from packetloom.functions import encode
from packetloom.functions.binary import pack, to_binary
from packetloom.functions.text import encode_auth, encode_ident, encode_server_info
from packetloom.operators.framing import frame_packets
from packetloom.operators.fstream import fstream_records
from packetloom.operators.mapping import decode_map
from packetloom.operators.summaries import summary_fields
from packetloom.operators.transfers import stitch_transfers
from packetloom.plans.detailed import enrich_transfers
from packetloom.sources.packets import PACKET_SCHEMA, read_packets
from packetloom.sources.stage import new_folder, write_stage

PORT = "1094"
SERVER_START = 1600000000
T0 = 1700000000
SEQ_STEP = 100_000_000
PREFIXES = [
    "/user/alice", "/user/dteam", "/osgconnect/public", "/osgconnect/protected", "/ospool/PROTECTED",
    "/ospool/ap21/data", "/path-facility/data", "/hcc/a/b", "/pnfs/fnal.gov/usr", "/gwdata", "/chtc", "/icecube",
    "/igwn/ligo", "/store", "/storage", "/other",
]
CODES = {"click": "f", "view": "g", "purchase": "u", "signup": "i", "error": "t"}
# One odd factor per counter, so that they wrap at different times.
COUNTER_FACTORS = {
    "link_total": 3, "link_in": 7, "link_out": 11, "link_ctime": 13, "link_tmo": 17, "proc_usr": 19, "proc_sys": 23,
    "ops_open": 29, "ops_preread": 31, "ops_read": 37, "ops_readv": 41, "ops_sync": 43, "ops_write": 47,
    "xrootd_errors": 53, "xrootd_delays": 59, "xrootd_redirections": 61, "login_attempts": 67,
    "authentication_failures": 71, "authentication_successes": 73, "unauthenticated_successes": 79,
}
_cache: dict[tuple[str, str, str], DataFrame] = {}
_paths: dict[tuple[str, str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A file of one row group is read by one task: deal its rows out when there are more cores than scan tasks."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def div(value: Column, by: int) -> Column:
    return F.floor(value / by).cast("bigint")


def epoch(ts: Column) -> Column:
    """Whole seconds since the epoch of a time without zone."""
    days = F.unix_date(ts.cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def cents(value: Column) -> Column:
    return F.round(value * 100).cast("bigint")


def prefix(n: Column) -> Column:
    return F.get(F.array(*[F.lit(p) for p in PREFIXES]), (n % 16).cast("int"))


def seq(t: Column, rank: int, n: Column) -> Column:
    return (t * 10 + rank) * SEQ_STEP + n


def _text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _as_packets(rows: DataFrame) -> DataFrame:
    """Rows with srv, t, rank, n and payload become packets of server `srv`."""
    return rows.select(
        "payload",
        _text("10.0.0.", F.col("srv")).alias("addr"),
        F.lit(PORT).alias("port"),
        F.timestamp_seconds("t").alias("arrival_ts"),
        ((F.col("t") * 10 + F.col("rank")) * SEQ_STEP + F.col("n")).alias("arrival_seq"),
    )


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the totals of their lines and all derived choices; one shuffle, on the order key."""
    li = table(spark, sf_dir, "lineitem")
    totals = li.groupBy(F.col("l_orderkey").alias("k")).agg(
        F.sum(cents(F.col("l_extendedprice"))).alias("read"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("readv"),
        F.sum(F.col("l_linenumber").cast("bigint")).alias("lines"),
        F.count("*").alias("n"),
        F.min(F.col("l_quantity").cast("bigint")).alias("q_min"),
        F.max(F.col("l_quantity").cast("bigint")).alias("q_max"),
        F.max(F.col("l_linenumber").cast("bigint")).alias("line_max"),
    )
    k, c = F.col("k"), F.col("c")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), cents(F.col("o_totalprice")).alias("size")
    )
    # The join needs this shuffle anyway; the fixed number keeps small inputs on all cores.
    orders = orders.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                                    spark.sparkContext.defaultParallelism), "k")
    u = c % 40
    short_host = F.when(u % 9 == 0, _text("f", u)).otherwise(_text("n", u))
    domain = F.when(c % 2 == 0, "unl.edu").otherwise("cern.ch")
    vo = F.get(F.array(*[F.lit(v) for v in ("cms", "osg", "dteam", "")]), (div(k, 512) % 4).cast("int"))
    inetv = F.get(F.array(*[F.lit(v) for v in ("4", "6", "")]), (k % 3).cast("int"))
    t_open = F.lit(T0) + (k * 7919) % 200000
    return orders.join(totals, "k", "left").withColumns(
        {
            "srv": k % 8,
            "t_open": t_open,
            "t_close": t_open + 30 + k % 5400,
            "t_user": t_open - k % 4000,
            "file_id": k + 1000,
            "user_id": c % 30 + 1,
            "name": _text(prefix(div(k, 8)), "/d", k % 7, "/e", k % 5, "/f", k, ".root"),
            "ident": encode_ident(F.lit("xroot"), _text("u", u), u, k % 8, _text(short_host, ".", domain)),
            "auth": encode_auth(on=vo, info=_text("/DC=org/CN=User ", u, "::x"), inetv=inetv),
            "app": _text(k, "_https://host/", k, "/wf:", c, "_", k % 3),
        }
    )


def server_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One server message for servers 0 to 6; server 6 has no site, server 7 stays unknown."""
    srv = F.col("srv")
    site = F.when(srv < 6, _text("T2_", srv)).otherwise("")
    rest = encode_server_info(program=F.lit("xrootd"), version=F.lit("v5.5"), instance=_text("inst", srv),
                              port=F.lit(PORT), site=site)
    body = encode.map_body(F.lit(0), _text("xroot/daemon.1:", srv, "@host"), rest)
    rows = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("srv")).filter("srv <= 6")
    return _as_packets(
        rows.select(
            srv, F.lit(SERVER_START).cast("bigint").alias("t"), F.lit(0).alias("rank"), srv.alias("n"),
            encode.packet("=", srv, srv + SERVER_START, body).alias("payload"),
        )
    )


def transfer_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users, apps, paths, opens, progress, closes and disconnects of all orders, and the servers.

    All packets of an order are made in one pass over it and spread into rows.
    """
    c = F.col
    k = c("k")

    def fstream(t: Column, record: Column) -> Column:
        return F.concat(encode.time_record(0, 1, t, t + 1, c("srv")), record)

    ops = {
        "read": c("n"), "readv": c("n") % 3, "write": c("n") % 2, "rsMin": F.lit(1), "rsMax": c("n"),
        "rsegs": c("n") * 2, "rdMin": c("q_min"), "rdMax": c("q_max"), "rvMin": F.lit(1), "rvMax": c("n"),
        "wrMin": F.lit(0), "wrMax": c("line_max"),
    }
    write = F.when(k % 4 == 0, c("lines")).otherwise(0)
    closed = encode.close_record(c("file_id"), c("read"), c("readv"), write, ops, k % 2 == 0)
    opened = encode.open_record(c("file_id"), c("size"), c("user_id"), c("name"), k % 11 != 0)
    moved = encode.progress_record(c("file_id"), k * 10, k, F.lit(0))
    user_body = encode.map_body(c("user_id"), c("ident"), c("auth"))
    app_body = encode.map_body(c("user_id"), c("ident"), c("app"))
    path_body = encode.map_body(c("file_id"), c("ident"), c("name"))
    has_lines = c("n").isNotNull()
    t_again, t_gone = c("t_close") + 60, c("t_close") + 1
    plan = [
        (1, "u", c("t_user"), div(k, 128) % 4 != 3, user_body),
        (2, "i", c("t_user"), k % 5 == 0, app_body),
        (3, "d", c("t_open") - 1, k % 22 == 0, path_body),
        (4, "f", c("t_open"), k % 13 != 0, fstream(c("t_open"), opened)),
        (5, "f", c("t_open") + 10, k % 3 == 0, fstream(c("t_open") + 10, moved)),
        (6, "f", c("t_close"), has_lines, fstream(c("t_close"), closed)),
        (6, "f", t_again, has_lines & (k % 29 == 0), fstream(t_again, closed)),
        (7, "f", t_gone, k % 50 == 0, fstream(t_gone, encode.disconnect_record(c("user_id")))),
    ]
    made = [
        F.when(wanted, F.struct(F.lit(rank).alias("rank"), F.lit(code).alias("code"), t.alias("t"), body.alias("body")))
        for rank, code, t, wanted, body in plan
    ]
    # What is not wanted is left out after the spread: a function over the array would have Spark interpret all that is in it. Headers
    # follow then too, since they need the length of the body and would make it twice.
    facts = order_facts(spark, sf_dir).select("srv", k.alias("n"), F.explode_outer(F.array(*made)).alias("p"))
    rows = facts.filter("p IS NOT NULL").select("srv", "n", "p.*")
    payload = encode.packet(c("code"), c("n") % 256, c("srv") + SERVER_START, c("body"))
    return _as_packets(rows.withColumn("payload", payload)).unionByName(server_packets(spark, sf_dir))


def extra_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A purge message per part and a staging message per supplier."""
    key = F.col("key")

    def rows(name: str, key_col: str, size: Column, code: str, rank: int, rest: Callable[[Column], Column]) -> DataFrame:
        t = table(spark, sf_dir, name).select(F.col(key_col).alias("key"), size.alias("size"))
        body = encode.map_body(F.lit(0), F.lit("xroot/frm.1:2@host"), rest(key))
        return _as_packets(
            t.select(
                (key % 8).alias("srv"), F.lit(T0).cast("bigint").alias("t"), F.lit(rank).alias("rank"), key.alias("n"),
                encode.packet(code, key % 256, key % 8 + SERVER_START, body).alias("payload"),
            )
        )

    purge = rows(
        "part", "p_partkey", F.col("p_size").cast("bigint") * 1000, "p", 8,
        lambda n: _text("/purged/", n, "\n&tod=", n + T0, "&sz=", F.col("size"), "&at=1&ct=2&mt=3&fn=p", n),
    )
    staging = rows(
        "supplier", "s_suppkey", F.col("s_suppkey") * 1000, "x", 9,
        lambda n: F.concat(
            _text("/staged/", n, "\n&tod=", n + T0, "&sz=", F.col("size"), "&tm=", n % 60, "&op=g&rc=0"),
            F.when(n % 2 == 0, _text("&pd=d", n)).otherwise(""),
        ),
    )
    return purge.unionByName(staging)


def hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host dimension: names of servers 0 to 5."""
    n = F.col("n_nationkey").cast("bigint")
    return table(spark, sf_dir, "nation").filter("n_nationkey <= 5").select(
        _text("10.0.0.", n).alias("addr"), _text("xrd", n, ".site", n, ".org").alias("hostname")
    )


def host_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of servers 0 to 5 that change every 30,000 seconds, from n * 1000 seconds after the start on."""
    n, d = F.col("n_nationkey").cast("bigint"), F.col("d")
    rows = table(spark, sf_dir, "nation").filter("n_nationkey <= 5").withColumn("d", F.explode(F.sequence(F.lit(0), F.lit(6))))
    return rows.select(
        _text("10.0.0.", n).alias("addr"), _text("xrd", n, "-", d, ".site", n, ".org").alias("hostname"),
        F.timestamp_seconds(F.lit(T0) + n * 1000 + d * 30000).alias("valid_from"),
    )


def numbered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their number `rn` within (user_id % 4, event_type), counted in blocks of ids of bounded size."""
    ev = spread(table(spark, sf_dir, "events")).select(
        "event_id", (F.col("user_id") % 4).alias("src"), "event_type", div(F.col("event_id"), 100000).alias("block")
    )
    key = ["src", "event_type"]
    inside = Window.partitionBy(*key, "block").orderBy("event_id")
    earlier = Window.partitionBy(*key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ev.groupBy(*key, "block").count()
    offsets = sizes.select(*key, "block", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("offset"))
    local = ev.withColumn("rn", F.row_number().over(inside))
    return local.join(offsets, [*key, "block"]).withColumn("rn", F.col("rn") + F.col("offset"))


def sequence_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One packet per event, with lost, repeated and far-off sequence numbers, and some wrong lengths."""
    e, rn = F.col("event_id"), F.col("rn")
    code = F.create_map(*[F.lit(x) for pair in CODES.items() for x in pair])
    pseq = F.when(e % 46 == 0, (rn + 250) % 256).when(e % 23 == 0, (rn + 255) % 256).otherwise(rn % 256)
    wrong_by = F.when(e % 17 == 0, 1).otherwise(0)
    rows = numbered_events(spark, sf_dir).filter(e % 19 != 0)
    return rows.select(
        encode.packet(F.try_element_at(code, F.col("event_type")), pseq, F.col("src") + SERVER_START, pack(0, 4), wrong_by)
        .alias("payload"),
        _text("10.0.0.", F.col("src")).alias("addr"),
        F.lit(PORT).alias("port"),
        F.timestamp_seconds(e + T0).alias("arrival_ts"),
        e.alias("arrival_seq"),
    )


def pushed_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequence feed in JSON envelopes, one address in five being IPv6."""
    addr = F.when(F.col("arrival_seq") % 5 == 0, "[::1]").otherwise(F.col("addr"))
    return sequence_packets(spark, sf_dir).select(
        encode.pushed(addr, F.col("port"), F.col("payload")).alias("value"), "arrival_ts", "arrival_seq"
    )


def gstream_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cache and TCP events, three to a packet, a third-party copy per page, and the servers."""
    e, t = F.col("event_id"), epoch(F.col("ts"))
    k = F.get_json_object("props", "$.k").cast("bigint")
    amount = cents(F.col("value"))
    cache = F.to_json(
        F.struct(
            _text(prefix(e), "/", e).alias("lfn"),
            F.lit(1048576).alias("blk_size"),
            F.col("user_id").alias("n_blks"),
            div(F.col("user_id"), 2).alias("n_blks_done"),
            k.alias("access_cnt"),
            t.alias("attach_t"),
            (t + k).alias("detach_t"),
            F.when(e % 2 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("r1"))).alias("remotes"),
            amount.alias("b_hit"),
            (amount * 2).alias("b_miss"),
            (amount * 3).alias("b_bypass"),
            (amount * 4).alias("b_todisk"),
            (amount * 5).alias("b_prefetch"),
            F.when(e % 3 == 0, e % 5).alias("n_cks_errs"),
        )
    )
    tcp = F.to_json(F.struct("event_type", amount.alias("value"), "user_id"))
    n = F.col("n")
    line = F.when(div(e, 3) % 2 == 0, cache).otherwise(tcp)
    # Three lines to a packet at most.
    grouped = (
        spread(table(spark, sf_dir, "events"))
        .select(div(e, 3).alias("n"), F.struct(e.alias("event_id"), line.alias("line")).alias("item"))
        .groupBy("n")
        .agg(F.array_sort(F.collect_list("item")).alias("items"))
    )
    start = F.lit(T0) + n

    def packed(rows: DataFrame, stream: Column, lines: Column, rank: int) -> DataFrame:
        body = encode.gstream_body(stream, start, start + 1, lines)
        payload = encode.packet("g", n % 256, n % 8 + SERVER_START, body)
        return _as_packets(
            rows.select((n % 8).alias("srv"), start.alias("t"), F.lit(rank).alias("rank"), n, payload.alias("payload"))
        )

    events = packed(grouped, F.when(n % 2 == 0, "C").otherwise("T"), F.col("items.line"), 8)
    p = F.col("page_id")
    copy = F.to_json(
        F.struct(
            F.lit("https").alias("TPC"),
            _text("c", p).alias("Client"),
            F.struct(
                _text("b", p).alias("Beg"), _text("e", p).alias("End"), (p % 2 * 2 + 4).alias("IPv"), (p % 3).alias("RC"),
                (p % 4 + 1).alias("Strm"), F.when(p % 2 == 0, "pull").otherwise("push").alias("Type"),
            ).alias("Xeq"),
            F.col("url").alias("Src"),
            F.when(p % 3 == 0, _text("root://h:1094//store/", p)).otherwise(_text("davs://h/data/", p)).alias("Dst"),
            F.char_length("html").alias("Size"),
        )
    )
    pages = table(spark, sf_dir, "pages").select(p.alias("n"), copy.alias("line"))
    copies = packed(pages, F.lit("P"), F.array("line"), 9)
    return events.unionByName(copies).unionByName(server_packets(spark, sf_dir))


def summary_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One XML report per event; some late, some of another program, some without a site."""
    e, u = F.col("event_id"), F.col("user_id")
    t = epoch(F.col("ts"))
    tod = F.when(e % 7 == 0, t - 172800).otherwise(t)
    n = {name: ((e * factor) % 5000).cast("string") for name, factor in COUNTER_FACTORS.items()}
    program = F.when(e % 31 == 0, "cmsd").otherwise("xrootd")
    site = F.when(e % 37 == 0, "").otherwise(_text(' site="S', u % 8, '"'))
    xml = _text(
        '<statistics tod="', tod, '" ver="v5.5" src="h:1094" tos="1700000000" pgm="', program, '" pid="', u, '"', site, ">",
        '<stats id="info"><host>h', u % 16, "</host><port>1094</port></stats>",
        '<stats id="link"><num>', e % 100, "</num><tot>", n["link_total"], "</tot><in>", n["link_in"], "</in><out>",
        n["link_out"], "</out><ctime>", n["link_ctime"], "</ctime><tmo>", n["link_tmo"], "</tmo></stats>",
        '<stats id="proc"><usr><s>', n["proc_usr"], "</s><u>1</u></usr><sys><s>", n["proc_sys"],
        "</s><u>2</u></sys></stats>",
        '<stats id="xrootd"><num>1</num><ops><open>', n["ops_open"], "</open><pr>", n["ops_preread"], "</pr><rd>",
        n["ops_read"], "</rd><rv>", n["ops_readv"], "</rv><sync>", n["ops_sync"], "</sync><wr>", n["ops_write"],
        "</wr></ops><err>", n["xrootd_errors"], "</err><dly>", n["xrootd_delays"], "</dly><rdr>",
        n["xrootd_redirections"], "</rdr><lgn><num>", n["login_attempts"], "</num><af>", n["authentication_failures"],
        "</af><au>", n["authentication_successes"], "</au><ua>", n["unauthenticated_successes"], "</ua></lgn></stats>",
        '<stats id="ofs"><role>server</role></stats>',
        '<stats id="sched"><inq>', e % 10, "</inq><threads>", e % 50, "</threads><idle>", e % 20, "</idle></stats>",
        '<stats id="sgen"><as>', e % 3, "</as><toe>", tod + 1, "</toe></stats></statistics>",
    )
    return spread(table(spark, sf_dir, "events")).select(
        to_binary(xml).alias("payload"),
        _text("10.1.0.", u % 16).alias("addr"),
        F.lit("9931").alias("port"),
        F.timestamp_seconds(e + T0).alias("arrival_ts"),
        e.alias("arrival_seq"),
    )


def broken(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Packets, reports and envelopes that cannot be read, one per event, of eight kinds by `event_id % 8`."""
    e = F.col("event_id")
    head = F.lit("AAB1234")  # the header after its code
    body = _text("e", e)
    packet = (
        F.when(e % 8 == 0, _text("x", e % 10))
        .when(e % 8 == 1, _text("u", head, e % 10))
        .when(e % 8 == 2, _text("f", head, body))
        .when(e % 8 == 3, _text("g", head, "e", e % 1000))
        .when(e % 8 == 4, _text("d", head, "0000no identity of ", e, ":1@h"))
    )
    xml = _text(
        '<statistics tod="', e, '" ver="v5" src="h:1" tos="1" pgm="xrootd" pid="7" site="S"><stats id="link"><num>1</num><tot>t', e,
        "</tot></stats></statistics>",
    )
    report = F.when(e % 8 == 5, _text("<stat", e)).when(e % 8 == 6, xml)
    events = spread(table(spark, sf_dir, "events")).withColumns(
        {"arrival_ts": F.timestamp_seconds(e + T0), "arrival_seq": e, "addr": F.lit("10.0.0.9"), "port": F.lit("1")}
    )
    columns = PACKET_SCHEMA.fieldNames()
    packets_in = events.filter("event_id % 8 < 5").withColumn("payload", to_binary(packet)).select(*columns)
    reports_in = events.filter("event_id % 8 IN (5, 6)").withColumn("payload", to_binary(report)).select(*columns)
    pushed = events.filter("event_id % 8 = 7").select(_text('{"remote": "h', e, '", "da').alias("value"), "arrival_ts", "arrival_seq")
    return packets_in, reports_in, pushed


FEEDS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "transfer": transfer_packets,
    "extra": extra_packets,
    "sequence": sequence_packets,
    "gstream": gstream_packets,
    "summary": summary_packets,
}


def _staged(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame], partition_by: str | None = None):
    """`make()` written once per session, and the table read back on every call."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _cache:
        _cache[key] = write_stage(make(), name, partition_by)
    return _cache[key]


def packets(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Feed `name`, written as packet files once per session and read from there."""
    key = (spark.sparkContext.applicationId, sf_dir, f"path-{name}")
    if key not in _paths:
        path = new_folder(spark, f"feed-{name}")
        FEEDS[name](spark, sf_dir).select(*PACKET_SCHEMA.fieldNames()).write.option("compression", "zstd").parquet(path)
        _paths[key] = path
    return read_packets(spark, _paths[key])


def framed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Framed packets of feed `name`, kept by kind, so that a consumer of one kind reads only its files."""
    return _staged(spark, sf_dir, f"framed-{name}", lambda: frame_packets(packets(spark, sf_dir, name)), "kind")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed file-stream records of the transfer feed: several operators read a few columns of them each."""
    return _staged(spark, sf_dir, "records", lambda: fstream_records(framed(spark, sf_dir, "transfer")))


def maps(spark: SparkSession, sf_dir: str, name: str = "transfer") -> DataFrame:
    """Decoded map messages of a feed, kept by kind: users, apps, paths and servers are read by different lookups."""
    return _staged(spark, sf_dir, f"maps-{name}", lambda: decode_map(framed(spark, sf_dir, name)), "kind")


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transfers of the feed with all that was known when they ended, before the rules are applied."""

    def make() -> DataFrame:
        return enrich_transfers(stitch_transfers(records(spark, sf_dir)), maps(spark, sf_dir))

    return _staged(spark, sf_dir, "enriched", make)


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed fields of the summary feed."""
    return _staged(spark, sf_dir, "reports", lambda: summary_fields(packets(spark, sf_dir, "summary")))
