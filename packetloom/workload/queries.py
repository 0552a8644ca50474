"""Queries over the feeds, one or more per operator; `sql.py` holds their SQL twins over the base tables."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from packetloom.functions import fields as rules
from packetloom.functions.paths import logical_dirname
from packetloom.operators import framing, fstream, gstream, lookups, mapping, metrics, records, routing, sequence
from packetloom.operators import summaries as reports
from packetloom.operators import sweeps, transfers
from packetloom.operators.routing import route_transfers
from packetloom.plans import detailed, summary
from packetloom.sources.packets import stream_packets, unwrap_pushed
from packetloom.sources.sinks import stream_routed, write_routed
from packetloom.sources.stage import new_folder
from packetloom.streaming import batches, gauges, outputs, streams
from packetloom.workload import feeds

AS_OF = 1700150000
SUMMARY_SHOWN = ["arrival_seq", *reports.BASICS, "host", *reports.CURRENT, "cend"]
OPS = [name for name, _ in fstream.OPS_FIELDS]
TRANSFERS_SHOWN = [
    "file_id", "start_time", "end_time", "operation_time", "HasFileCloseMsg", "server_hostname", "site", "user", "vo",
    "appinfo", "filename", "filesize", "logical_dirname", "read", "readv", "write", "read_operations", "is_wlcg",
]
WLCG_SHOWN = [
    "file_id", "site_name", "fallback", "user_dn", "client_host", "client_domain", "server_host", "server_domain",
    "server_hostname", "server_ip", "file_lfn", "file_size", "read_bytes", "read_single_bytes", "read_vector_bytes",
    "write_bytes", "ipv6", "user", "start_time", "end_time", "operation_time", "operation", "server_site",
    "user_protocol", "vo", "read_average", "read_sigma", "write_max", "metadata.producer", "metadata.type",
    "metadata.type_prefix", "metadata.host",
]


def longs(df: DataFrame) -> DataFrame:
    """All whole numbers as BIGINT, so that results compare with SQL."""
    return df.select(
        *[
            F.col(f"`{n}`").cast("bigint").alias(n) if t == "int" or t.startswith("decimal") else F.col(f"`{n}`")
            for n, t in df.dtypes
        ]
    )


def srv() -> Column:
    return F.substring_index("addr", ".", -1).cast("bigint").alias("srv")


def _all(*dfs: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, dfs)


# --- packets and headers


def pushed_unwrap(spark: SparkSession, sf: str) -> DataFrame:
    return unwrap_pushed(feeds.pushed_packets(spark, sf)).select(
        "arrival_seq", "addr", "port", F.octet_length("payload").cast("bigint").alias("length")
    )


def header(spark: SparkSession, sf: str) -> DataFrame:
    framed = framing.frame_packets(feeds.packets(spark, sf, "transfer"))
    return longs(framed.select("arrival_seq", "sid", "code", "pseq", "server_start", "length_ok"))


def dispatch(spark: SparkSession, sf: str) -> DataFrame:
    both = _all(feeds.packets(spark, sf, "transfer"), feeds.packets(spark, sf, "gstream"))
    return framing.frame_packets(both).groupBy("code", "kind").agg(F.count("*").alias("n"))


def length_check(spark: SparkSession, sf: str) -> DataFrame:
    framed = framing.frame_packets(feeds.packets(spark, sf, "sequence"))
    return framed.filter("NOT length_ok").select("arrival_seq", "plen")


# --- file-stream records


def fstream_open(spark: SparkSession, sf: str) -> DataFrame:
    rows = fstream.opens(fstream.fstream_records(feeds.framed(spark, sf, "transfer")))
    return longs(rows.select("file_id", "t_beg", "rec_flag", "file_size", "user_id", "file_name"))


def fstream_close(spark: SparkSession, sf: str) -> DataFrame:
    rows = fstream.closes(fstream.fstream_records(feeds.framed(spark, sf, "transfer")))
    ops = [F.col(f"ops.{name}").alias(f"ops_{name}") for name in OPS]
    return longs(rows.select("file_id", "t_beg", "rec_flag", "read", "readv", "write", *ops))


def fstream_xfr(spark: SparkSession, sf: str) -> DataFrame:
    rows = fstream.progress_records(fstream.fstream_records(feeds.framed(spark, sf, "transfer")))
    return longs(rows.select("file_id", "t_beg", "read", "readv", "write"))


def fstream_time(spark: SparkSession, sf: str) -> DataFrame:
    rows = fstream.decode_times(feeds.framed(spark, sf, "transfer"))
    return longs(rows.select("arrival_seq", "xfr_recs", "total_recs", "t_beg", "t_end", "source_sid"))


def fstream_disc(spark: SparkSession, sf: str) -> DataFrame:
    rows = fstream.disconnects(fstream.fstream_records(feeds.framed(spark, sf, "transfer")))
    return longs(rows.select("arrival_seq", "t_beg", "user_id"))


# --- map messages


def user_ident(spark: SparkSession, sf: str) -> DataFrame:
    rows = mapping.user_messages(mapping.decode_map(feeds.framed(spark, sf, "transfer")))
    return rows.select(
        "arrival_seq", "dict_id", "ident.protocol", "ident.username", "ident.pid", F.col("ident.sid").alias("user_sid"),
        "ident.host",
    )


def auth(spark: SparkSession, sf: str) -> DataFrame:
    rows = mapping.user_messages(mapping.decode_map(feeds.framed(spark, sf, "transfer")))
    return rows.select("arrival_seq", "auth.*")


def server_info(spark: SparkSession, sf: str) -> DataFrame:
    framed = feeds.framed(spark, sf, "transfer")
    # Servers only: what other messages say is of no use here.
    rows = mapping.server_messages(mapping.decode_map(framed.filter("kind = 'server'"))).select("sid", "server.*")
    used = framed.groupBy("sid").agg(F.count("*").alias("packets"))
    return used.join(rows, "sid", "left")


def app_info(spark: SparkSession, sf: str) -> DataFrame:
    rows = mapping.app_messages(mapping.decode_map(feeds.framed(spark, sf, "transfer")))
    return rows.select("arrival_seq", "dict_id", "ident.username", "appinfo")


def path_info(spark: SparkSession, sf: str) -> DataFrame:
    rows = mapping.path_messages(mapping.decode_map(feeds.framed(spark, sf, "transfer")))
    return rows.select("arrival_seq", "dict_id", "ident.username", "path")


def purge(spark: SparkSession, sf: str) -> DataFrame:
    rows = mapping.purge_messages(mapping.decode_map(feeds.framed(spark, sf, "extra")))
    return rows.select("arrival_seq", "purge.*")


def staging(spark: SparkSession, sf: str) -> DataFrame:
    rows = mapping.staging_messages(mapping.decode_map(feeds.framed(spark, sf, "extra")))
    return rows.select("arrival_seq", "staging.*")


# --- transfers


def stitch(spark: SparkSession, sf: str) -> DataFrame:
    rows = transfers.stitch_transfers(feeds.records(spark, sf))
    shown = ["file_id", "close_time", "is_open_known", "user_id", "open_time", "open_name", "file_size", "read", "write"]
    return longs(rows.select(*shown))


def stitch_ttl(spark: SparkSession, sf: str) -> DataFrame:
    rows = transfers.stitch_transfers(feeds.records(spark, sf), ttl_seconds=transfers.TTL_SECONDS)
    return longs(rows.select("file_id", "close_time", "is_open_known", "user_id", "open_time"))


def progress(spark: SparkSession, sf: str) -> DataFrame:
    rows = transfers.attach_progress(feeds.records(spark, sf))
    shown = ["progress.t_beg", "progress.read", "progress.readv", "progress.write", "n_progress"]
    return longs(rows.select("file_id", "open_seq", *shown))


GIVEN_UP = ["file_id", "is_open_known", "open_time", "close_time", "read", "readv"]


def given_up(spark: SparkSession, sf: str) -> DataFrame:
    """Closes in time, closes that came too late, and the transfers given up before those."""
    rows = feeds.records(spark, sf)
    ended = transfers.stitch_transfers(rows, transfers.TTL_SECONDS).unionByName(transfers.given_up_transfers(rows))
    return longs(ended.select(*GIVEN_UP))


def hot_keys(spark: SparkSession, sf: str) -> DataFrame:
    """The whole job with a limit so small that busy keys are found, cut into slices and put together again."""
    rows, entries = feeds.records(spark, sf), feeds.maps(spark, sf)
    ended = detailed.transfers_from(rows, entries, feeds.hosts(spark, sf), as_of=AS_OF, group_limit=200, give_up=False)
    return longs(ended.select(*TRANSFERS_SHOWN))


def hot_keys_expired(spark: SparkSession, sf: str) -> DataFrame:
    """Transfers given up at one moment, which all have the same place in the feed, looked up with a limit that their keys exceed there."""
    until = F.col("arrival_ts") <= F.timestamp_seconds(F.lit(AS_OF))
    rows, entries = feeds.records(spark, sf).filter(until), feeds.maps(spark, sf).filter(until)
    ended = detailed.enrich_transfers(transfers.expire_transfers(rows, AS_OF), entries, group_limit=2)
    return longs(records.transfer_records(lookups.resolve_host(ended, feeds.hosts(spark, sf))).select(*TRANSFERS_SHOWN))


def transfers_swept(spark: SparkSession, sf: str) -> DataFrame:
    """The whole job over all packets, with opens given up at the end of their time."""
    rows = detailed.transfers_from(feeds.records(spark, sf), feeds.maps(spark, sf), feeds.hosts(spark, sf))
    return longs(rows.select(*TRANSFERS_SHOWN))


def sweep_times(spark: SparkSession, sf: str) -> DataFrame:
    """When a collector that reads the whole feed sweeps, and the packet that makes it."""
    rows = sweeps.sweep_times(feeds.packets(spark, sf, "transfer"))
    return rows.select(F.floor(F.col("t") / 1000000).alias("sweep_time"), F.col("seq").alias("arrival_seq"))


def sweep_transfers(spark: SparkSession, sf: str) -> DataFrame:
    """Closes and transfers given up, when opens are dropped by sweeps every five minutes."""
    rows = sweeps.swept_transfers(feeds.records(spark, sf), feeds.packets(spark, sf, "transfer"))
    return longs(rows.select(*GIVEN_UP))


def expired(spark: SparkSession, sf: str) -> DataFrame:
    rows = transfers.expire_transfers(feeds.records(spark, sf), AS_OF)
    return longs(rows.select("file_id", "has_close", "user_id", "open_time", "close_time", "open_name", "read", "readv"))


def dict_asof(spark: SparkSession, sf: str) -> DataFrame:
    stitched = transfers.stitch_transfers(feeds.records(spark, sf))
    rows = lookups.lookup_dict(stitched, mapping.dict_entries(feeds.maps(spark, sf)))
    return rows.select("file_id", "close_time", "ident.username", "ident.host")


def path_fallback(spark: SparkSession, sf: str) -> DataFrame:
    stitched = transfers.stitch_transfers(feeds.records(spark, sf))
    rows = lookups.lookup_dict(stitched.filter("user_id = 0"), mapping.dict_entries(feeds.maps(spark, sf)))
    name = rules.filename_fields(F.col("is_open_known"), F.col("open_name"), F.col("path"), F.col("file_size"))
    return rows.select("file_id", "close_time", "path", name["filename"].alias("filename"), "ident.username")


def user_asof(spark: SparkSession, sf: str) -> DataFrame:
    return _user(spark, sf, None)


def user_lease(spark: SparkSession, sf: str) -> DataFrame:
    return _user(spark, sf, transfers.TTL_SECONDS)


def _user(spark: SparkSession, sf: str, ttl: int | None) -> DataFrame:
    maps = feeds.maps(spark, sf)
    named = lookups.lookup_dict(
        transfers.stitch_transfers(feeds.records(spark, sf)), mapping.dict_entries(maps), transfers.TTL_SECONDS
    )
    rows = lookups.lookup_user(named, mapping.user_messages(maps), mapping.app_messages(maps), ttl)
    return rows.select("file_id", "close_time", "user.username", "auth.on", "auth.inetv", "appinfo")


def server(spark: SparkSession, sf: str) -> DataFrame:
    stitched = transfers.stitch_transfers(feeds.records(spark, sf))
    rows = lookups.lookup_server(stitched, mapping.server_messages(feeds.maps(spark, sf)))
    return rows.select("file_id", "close_time", "server_id", "server", "site")


def host(spark: SparkSession, sf: str) -> DataFrame:
    rows = lookups.resolve_host(fstream.closes(feeds.records(spark, sf)), feeds.hosts(spark, sf))
    return rows.select("file_id", F.col("t_beg").alias("close_time"), "addr", "server_hostname")


def host_asof(spark: SparkSession, sf: str) -> DataFrame:
    """Host names that change, each kept for a day after it was looked up."""
    rows = lookups.resolve_host_asof(fstream.closes(feeds.records(spark, sf)), feeds.host_names(spark, sf))
    return rows.select("file_id", F.col("t_beg").alias("close_time"), "addr", "server_hostname")


def disconnects(spark: SparkSession, sf: str) -> DataFrame:
    """With disconnects honoured: who is still known at each close."""
    recs = feeds.records(spark, sf)
    rows = lookups.lookup_dict(
        transfers.stitch_transfers(recs), mapping.dict_entries(feeds.maps(spark, sf)), disconnected=fstream.disconnects(recs)
    )
    return rows.select("file_id", "close_time", "ident.username")


def first_seen(spark: SparkSession, sf: str) -> DataFrame:
    framed = framing.frame_packets(feeds.packets(spark, sf, "sequence"))
    return lookups.first_seen(framed.select("sid", "code", "pseq", "arrival_seq"), ["sid", "code"])


# --- rules


def times(spark: SparkSession, sf: str) -> DataFrame:
    rows = feeds.enriched(spark, sf)
    return rows.select(
        "file_id", *[v.alias(n) for n, v in rules.times(F.col("open_time"), F.col("close_time")).items()]
    )


def _names() -> dict[str, Column]:
    return rules.filename_fields(F.col("is_open_known"), F.col("open_name"), F.col("path"), F.col("file_size"))


def dirs(spark: SparkSession, sf: str) -> DataFrame:
    named = {n: v for n, v in _names().items() if n != "logical_dirname"}
    return longs(
        feeds.enriched(spark, sf).select("file_id", "close_time", *[v.alias(n) for n, v in named.items()])
    )


def logical_dir(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.enriched(spark, sf).select("file_id", "close_time", _names()["logical_dirname"].alias("logical_dirname"))


def user_fields(spark: SparkSession, sf: str) -> DataFrame:
    rows = feeds.enriched(spark, sf)
    return rows.select("file_id", "close_time", *[v.alias(n) for n, v in rules.user_fields(F.col("user")).items()])


def auth_fields(spark: SparkSession, sf: str) -> DataFrame:
    rows = feeds.enriched(spark, sf)
    return rows.select("file_id", "close_time", *[v.alias(n) for n, v in rules.auth_fields(F.col("auth")).items()])


def io_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = rules.io_stats(F.col("read"), F.col("readv"), F.col("write"), F.col("ops"))
    return longs(
        feeds.enriched(spark, sf).select("file_id", "close_time", *[v.alias(n) for n, v in stats.items()])
    )


def transfer_table(spark: SparkSession, sf: str) -> DataFrame:
    return records.transfer_records(lookups.resolve_host(feeds.enriched(spark, sf), feeds.hosts(spark, sf)))


def route(spark: SparkSession, sf: str) -> DataFrame:
    rows = transfer_table(spark, sf).groupBy("is_wlcg", "vo", "logical_dirname").agg(F.count("*").alias("n"))
    return rows.withColumn("vo", F.coalesce("vo", F.lit("none")))


def wlcg(spark: SparkSession, sf: str) -> DataFrame:
    rows = records.to_wlcg(transfer_table(spark, sf).filter("is_wlcg"), F.lit(0), "collector")
    return longs(rows.select(*WLCG_SHOWN))


def wlcg_documents(spark: SparkSession, sf: str) -> DataFrame:
    """WLCG documents as they are sent, read back from their JSON: names, statistics, metadata, and the size as it is written."""
    table = transfer_table(spark, sf).filter("is_wlcg")
    sent = route_transfers(table, F.lit(0), "collector")
    kinds = dict(records.to_wlcg(table, F.lit(0), "collector").dtypes)
    meta = "struct<producer:string,type:string,type_prefix:string,host:string>"
    fields = ", ".join(f"`{c}`:{kinds[c]}" for c in kinds if c not in (*records.POSITION, "file_size", "metadata"))
    read = sent.select("value", F.from_json("value", f"struct<{fields}, metadata:{meta}>").alias("d"))
    quoted = F.regexp_extract("value", '"file_size":("[^"]*"|[^,]*)', 1)
    shown = [c for c in WLCG_SHOWN if c not in ("file_id", "file_size", "read_average", "read_sigma", "write_max")]
    stats = [F.col(f"d.{c}").cast("double").alias(c) for c in sorted(rules.WLCG_STATS)]
    return longs(read.select(*[F.col(f"d.{c}") for c in shown if c != "read_single_bytes"], quoted.alias("file_size"), *stats))


def dead(spark: SparkSession, sf: str) -> DataFrame:
    packets, reports_in, pushed = feeds.broken(spark, sf)
    rows = detailed.dead_letters(packets, reports_in, pushed)
    return rows.select("arrival_seq", "reason", F.hex("payload").alias("payload"))


def crab(spark: SparkSession, sf: str) -> DataFrame:
    rows = feeds.enriched(spark, sf).filter("appinfo IS NOT NULL")
    return rows.select("file_id", "close_time", *[v.alias(n) for n, v in rules.crab_fields(F.col("appinfo")).items()])


def transfers_full(spark: SparkSession, sf: str) -> DataFrame:
    """The whole job at one moment: closes until then and transfers given up by then, with the main fields."""
    rows = detailed.transfers_from(
        feeds.records(spark, sf), feeds.maps(spark, sf), feeds.hosts(spark, sf), as_of=AS_OF, give_up=False
    )
    return longs(rows.select(*TRANSFERS_SHOWN))


# --- events


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return detailed.event_lines(
        feeds.framed(spark, sf, "gstream"), feeds.maps(spark, sf, "gstream"), feeds.hosts(spark, sf)
    )


def cache_events(spark: SparkSession, sf: str) -> DataFrame:
    rows = gstream.cache_events(_lines(spark, sf))
    remotes = F.array_join("remotes_origin", ",")
    return longs(rows.withColumn("remotes_origin", remotes).drop("arrival_ts", "addr", "document"))


def copy_events(spark: SparkSession, sf: str) -> DataFrame:
    rows = gstream.copy_events(_lines(spark, sf))
    shown = ["arrival_seq", "tpc_protocol", "client", "source", "destination", "size", "xeq.*", "is_wlcg"]
    return longs(rows.select(*shown))


def tcp_events(spark: SparkSession, sf: str) -> DataFrame:
    rows = gstream.tcp_events(_lines(spark, sf))
    event = {"event_type": "string", "value": "bigint", "user_id": "bigint"}
    values = [F.try_variant_get(F.try_element_at("document", F.lit(k)), "$", t).alias(k) for k, t in event.items()]
    return longs(rows.select("arrival_seq", "line_idx", "from", "hostname", *values))


def event_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Cache, copy and TCP documents as they are sent, but for their ids."""
    sent = detailed.event_output(_lines(spark, sf), F.lit(0), "collector")
    return sent.withColumn("value", F.regexp_replace("value", '"_id":"[-0-9a-f]{36}",', ""))


def vo_path(spark: SparkSession, sf: str) -> DataFrame:
    rows = gstream.cache_events(_lines(spark, sf))
    return rows.groupBy("vo", logical_dirname(F.col("file_path")).alias("logical_dirname"), "is_wlcg").agg(
        F.count("*").alias("n")
    )


# --- sequences, reports, metrics


def sequence_gaps(spark: SparkSession, sf: str) -> DataFrame:
    rows = sequence.sequence_gaps(framing.frame_packets(feeds.packets(spark, sf, "sequence")))
    return rows.select("arrival_seq", "pseq", "is_first", "expected", "missing", "reordered")


def summary_fields(spark: SparkSession, sf: str) -> DataFrame:
    rows = reports.summary_fields(feeds.packets(spark, sf, "summary"))
    counters = [F.col(f"counters.{name}").alias(name) for name in reports.COUNTERS]
    return rows.select("has_site", *SUMMARY_SHOWN, *counters)


def summary_late(spark: SparkSession, sf: str) -> DataFrame:
    return reports.drop_late_summaries(feeds.reports(spark, sf)).select("arrival_seq", "addr", "pid", "tod")


def summary_deltas(spark: SparkSession, sf: str) -> DataFrame:
    rows = reports.summary_records(feeds.reports(spark, sf))
    return rows.select("arrival_seq", "addr", "pid", "timestamp", "site", "link_num", *reports.COUNTERS)


def _hosts_for_sequences(spark: SparkSession, sf: str) -> DataFrame:
    gaps = sequence.sequence_gaps(framing.frame_packets(feeds.packets(spark, sf, "sequence")))
    return lookups.resolve_host(gaps, feeds.hosts(spark, sf))


def metric_table(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.metrics(
        metrics.packet_metrics(feeds.packets(spark, sf, "transfer")),
        metrics.pushed_metrics(feeds.pushed_packets(spark, sf)),
        metrics.sequence_metrics(_hosts_for_sequences(spark, sf)),
        metrics.gstream_metrics(gstream.explode_gstream(feeds.framed(spark, sf, "gstream"))),
        metrics.transfer_metrics(transfer_table(spark, sf)),
    )


def state_sizes(spark: SparkSession, sf: str) -> DataFrame:
    maps = feeds.maps(spark, sf)
    base = [*lookups.USER_KEY, "arrival_ts", "arrival_seq"]
    messages = _all(mapping.user_messages(maps).select(*base), mapping.app_messages(maps).select(*base))
    leases = lookups.user_leases(messages, transfers.TTL_SECONDS)
    return metrics.state_sizes(feeds.records(spark, sf), mapping.dict_entries(maps), leases, AS_OF)


def idle(spark: SparkSession, sf: str) -> DataFrame:
    framed = framing.frame_packets(feeds.packets(spark, sf, "sequence"))
    # Sources end a few seconds apart, so a gap of three seconds tells them apart.
    last = framed.agg(F.max(F.unix_seconds("arrival_ts")).alias("t")).first().t
    rows = lookups.idle_streams(framed, last, gap_seconds=2)
    return rows.select("sid", F.unix_seconds("last_ts").alias("last_seen"))


def routed_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Everything routed, written by exchange as JSON, and counted from what was written."""
    routed = _all(
        detailed.detailed_output(transfer_table(spark, sf), _lines(spark, sf), F.lit(0), "collector"),
        summary.summary_output(reports.summary_records(feeds.reports(spark, sf))),
    )
    path = new_folder(spark, "routed")
    write_routed(routed, path)
    schema = "routing_key string, value string, exchange string"
    return spark.read.schema(schema).json(path).groupBy("exchange", "routing_key").agg(F.count("*").alias("n"))


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Transfers, bytes and mean duration per server site, organisation and logical directory, from raw packets on."""
    rows = detailed.transfers_of(feeds.packets(spark, sf, "transfer"), feeds.hosts(spark, sf), give_up=False)
    return longs(
        rows.groupBy(F.coalesce("site", F.lit("unknown")).alias("site"), F.coalesce("vo", F.lit("none")).alias("vo"),
                     "logical_dirname")
        .agg(
            F.count("*").alias("transfers"),
            F.sum(F.col("read") + F.col("readv")).alias("read_bytes"),
            F.sum("write").alias("write_bytes"),
            F.sum("operation_time").alias("seconds"),
        )
    )


# --- the same on streams


def _laid_down(spark: SparkSession, sf: str, feed: str, batches: int) -> tuple[str, int]:
    """The whole feed as files, arrival range by arrival range; the folder and the files of a range."""
    return _laid_out(spark, feeds.packets(spark, sf, feed), feed, batches)


def _laid_out(spark: SparkSession, packets: DataFrame, feed: str, batches: int) -> tuple[str, int]:
    files = max(1, spark.sparkContext.defaultParallelism)
    path = new_folder(spark, f"stream-{feed}-in")
    cuts = packets.approxQuantile("arrival_seq", [i / batches for i in range(1, batches)], 0.01)
    edges = [-1, *[int(c) for c in cuts], 2**63 - 1]
    for low, high in zip(edges, edges[1:]):
        part = packets.filter((F.col("arrival_seq") > low) & (F.col("arrival_seq") <= high))
        part.repartition(files).write.mode("append").parquet(path)
    return path, files


@contextmanager
def _rocksdb(spark: SparkSession, path: str, batches: int) -> Iterator[None]:
    """State in RocksDB, in as many tasks as the micro-batches of the feed in `path` ask for."""
    rows = spark.read.parquet(path).count()
    settings = {
        "spark.sql.streaming.stateStore.providerClass": streams.ROCKSDB,
        "spark.sql.shuffle.partitions": str(streams.state_tasks(spark, math.ceil(rows / batches))),
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _stream(spark: SparkSession, sf: str, feed: str, job: Callable[[DataFrame], DataFrame], batches: int = 2) -> DataFrame:
    """Run a streaming job over the whole feed, laid down in arrival order, and read what it wrote."""
    path, files = _laid_down(spark, sf, feed, batches)
    out, checkpoint = (new_folder(spark, f"stream-{feed}-{part}") for part in ("out", "checkpoint"))
    with _rocksdb(spark, path, batches):
        stream = job(stream_packets(spark, path, max_files_per_trigger=files))
        writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def stream_routed_files(spark: SparkSession, sf: str) -> DataFrame:
    """Transfers of a stream delivered as routed documents, and counted from the files the streaming sink committed."""
    hosts = feeds.hosts(spark, sf)
    path, files = _laid_down(spark, sf, "transfer", 2)
    out, checkpoint = (new_folder(spark, f"routed-{part}") for part in ("out", "checkpoint"))
    with _rocksdb(spark, path, 2):
        packets = stream_packets(spark, path, max_files_per_trigger=files)
        routed = route_transfers(streams.stream_transfers(packets, hosts, expire=False, salts=2), F.lit(0), "collector")
        stream_routed(routed, out, checkpoint).trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.schema("routing_key string, value string, exchange string").json(out)
    return rows.groupBy("exchange", "routing_key").agg(F.count("*").alias("n"))


def stream_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Totals reported by the micro-batches of a job that is stopped half-way and goes on from its checkpoint."""
    path, files = _laid_down(spark, sf, "sequence", 3)
    out, checkpoint = (new_folder(spark, f"metrics-{part}") for part in ("out", "checkpoint"))
    runs = []
    with _rocksdb(spark, path, 3):
        for last in (False, True):
            gaps = streams.stream_sequence(stream_packets(spark, path, max_files_per_trigger=files))
            writer = streams.sequence_observed(gaps).writeStream.format("parquet").option("path", out)
            query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
            while not last and not query.recentProgress and query.isActive:
                query.awaitTermination(1)
            if not last:
                query.stop()
            query.awaitTermination()
            runs.append(query)
    totals = streams.observed_totals(runs, "sequence")
    return spark.createDataFrame(sorted(totals.items()), "metric string, value long")


class Interrupted(Exception):
    """Raised between two writes of a micro-batch."""


def _interrupted(start: Callable[[Callable[[str, int], None]], StreamingQuery], at: tuple[str, int] | None) -> None:
    """Run the query that `start` makes to its end; with `at`, it fails after that write of that micro-batch and is started again."""
    stops = [] if at is None else [at]

    def written(name: str, number: int) -> None:
        if (name, number) in stops:
            stops.remove((name, number))
            raise Interrupted(name)

    while True:
        try:
            start(written).awaitTermination()
            break
        except StreamingQueryException:
            if at is None or stops:
                raise
            at = None
    if stops:
        raise AssertionError(f"no write {at}")


def _steps(
    spark: SparkSession, sf: str, feed: str, step: batches.Step, size: int = 2, at: tuple[str, int] | None = None
) -> DataFrame:
    """What a stepwise streaming job wrote over the whole feed; with `at`, it fails in the middle of a micro-batch and goes on."""
    path, files = _laid_down(spark, sf, feed, size)
    out, checkpoint = (new_folder(spark, f"steps-{feed}-{part}") for part in ("out", "checkpoint"))

    def start(written: Callable[[str, int], None]) -> StreamingQuery:
        stream = stream_packets(spark, path, max_files_per_trigger=files)
        return batches.write_steps(stream, step, out, checkpoint, written).trigger(availableNow=True).start()

    _interrupted(start, at)
    return spark.read.parquet(out).drop("batch")


SEQUENCES_SHOWN = ["arrival_seq", "pseq", "is_first", "expected", "missing", "reordered"]


def stream_sequence(spark: SparkSession, sf: str) -> DataFrame:
    return _steps(spark, sf, "sequence", batches.sequence_step()).select(*SEQUENCES_SHOWN)


def stream_sequence_hot(spark: SparkSession, sf: str) -> DataFrame:
    """Sequence checks in micro-batches, with a limit so small that every (stream, code) is cut into slices."""
    return _steps(spark, sf, "sequence", batches.sequence_step(group_limit=20)).select(*SEQUENCES_SHOWN)


def stream_sequence_keyed(spark: SparkSession, sf: str) -> DataFrame:
    return _stream(spark, sf, "sequence", streams.stream_sequence).select(*SEQUENCES_SHOWN)


REPORTS_SHOWN = ["arrival_seq", "addr", "pid", "timestamp", "site", "link_num", *reports.COUNTERS]


def stream_summaries(spark: SparkSession, sf: str) -> DataFrame:
    """Counter differences in micro-batches, one of which fails half-way."""
    return _steps(spark, sf, "summary", batches.summary_step(), size=3, at=("output", 1)).select(*REPORTS_SHOWN)


def stream_summaries_keyed(spark: SparkSession, sf: str) -> DataFrame:
    return _stream(spark, sf, "summary", streams.stream_summaries).select(*REPORTS_SHOWN)


STREAM_SHOWN = [
    "file_id", "floor(end_time / 1000) AS close_time", "`user`", "vo", "appinfo", "site", "filename", "filesize", "logical_dirname",
    "read", "is_wlcg",
]


def stream_transfers(spark: SparkSession, sf: str) -> DataFrame:
    hosts = feeds.hosts(spark, sf)
    rows = _stream(
        spark, sf, "transfer", lambda p: streams.stream_transfers(p, hosts, expire=False, salts=2)
    )
    return longs(rows.selectExpr(*STREAM_SHOWN))


def stream_transfers_steps(spark: SparkSession, sf: str) -> DataFrame:
    """Transfers in micro-batches of the batch operators, with a limit so small that busy keys are cut."""
    step = batches.transfer_step(feeds.hosts(spark, sf), expire=False, group_limit=500)
    return longs(_steps(spark, sf, "transfer", step).selectExpr(*STREAM_SHOWN))


def stream_expiry_steps(spark: SparkSession, sf: str) -> DataFrame:
    """Closes of micro-batches that carry on only what is young enough, one of which fails half-way."""
    rows = _steps(spark, sf, "transfer", batches.transfer_step(feeds.hosts(spark, sf)), size=3, at=("output", 1))
    return longs(rows.filter(F.col("open_seq").isNull()).selectExpr(*STREAM_SHOWN))


def stream_expiry(spark: SparkSession, sf: str) -> DataFrame:
    """Closes of the whole streaming job with all state ending by the event clock, in three micro-batches."""
    hosts = feeds.hosts(spark, sf)
    rows = _stream(spark, sf, "transfer", lambda p: streams.stream_transfers(p, hosts, salts=2), batches=3)
    return longs(rows.filter(F.col("open_seq").isNull()).selectExpr(*STREAM_SHOWN))


def stream_outputs(spark: SparkSession, sf: str) -> DataFrame:
    """Transfers, events and dead letters of one stream that stops between two writes of its second micro-batch and goes on."""
    all_packets = _all(feeds.packets(spark, sf, "transfer"), feeds.packets(spark, sf, "gstream"), feeds.broken(spark, sf)[0])
    path, files = _laid_out(spark, all_packets, "outputs", 2)
    out, checkpoint = (new_folder(spark, f"outputs-{part}") for part in ("out", "checkpoint"))

    def start(written: Callable[[str, int], None]) -> StreamingQuery:
        packets = stream_packets(spark, path, max_files_per_trigger=files)
        found = outputs.detailed_outputs(packets, feeds.hosts(spark, sf), F.lit(0), "collector", salts=2, expire=False)
        return outputs.write_outputs(found, out, checkpoint, written).trigger(availableNow=True).start()

    with _rocksdb(spark, path, 2):
        _interrupted(start, ("transfers", 1))
    routed = [outputs.read_output(spark, out, name).select(F.lit(name).alias("output"), F.concat_ws("/", "exchange", "routing_key").alias("kind"))
              for name in ("transfers", "events")]
    dead = outputs.read_output(spark, out, "dead_letters").select(F.lit("dead_letters").alias("output"), F.col("reason").alias("kind"))
    return _all(*routed, dead).groupBy("output", "kind").agg(F.count("*").alias("n"))


def stream_state_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """As q_state_sizes, from the state a stream holds after the packets until then."""
    until = F.col("arrival_ts") <= F.timestamp_seconds(F.lit(AS_OF))
    path, files = _laid_out(spark, feeds.packets(spark, sf, "transfer").filter(until), "gauges", 2)
    out, checkpoint = (new_folder(spark, f"gauges-{part}") for part in ("out", "checkpoint"))
    with _rocksdb(spark, path, 2):
        packets = stream_packets(spark, path, max_files_per_trigger=files)
        stream = streams.stream_transfers(packets, feeds.hosts(spark, sf), expire=False, salts=2)
        writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()
        return gauges.stream_state_sizes(spark, checkpoint, AS_OF)


def stream_given_up(spark: SparkSession, sf: str) -> DataFrame:
    """As q_given_up, from a stream in three micro-batches; of files that were closed, as the others depend on when the stream ends."""

    def job(packets: DataFrame) -> DataFrame:
        marked = packets.withWatermark("arrival_ts", "10 seconds")
        return streams.stream_stitch(fstream.fstream_records(framing.frame_packets(marked)), transfers.TTL_SECONDS)

    rows = _stream(spark, sf, "transfer", job, batches=3)
    closed = rows.filter(F.col("open_seq").isNull()).select("sid", "file_id").distinct()
    return longs(rows.join(closed, ["sid", "file_id"], "left_semi").select(*GIVEN_UP))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "q_flagship": flagship,
    "q_pushed_unwrap": pushed_unwrap,
    "q_header": header,
    "q_dispatch": dispatch,
    "q_length_check": length_check,
    "q_fstream_open": fstream_open,
    "q_fstream_close": fstream_close,
    "q_fstream_xfr": fstream_xfr,
    "q_fstream_time": fstream_time,
    "q_fstream_disc": fstream_disc,
    "q_user_ident": user_ident,
    "q_auth": auth,
    "q_server_info": server_info,
    "q_app_info": app_info,
    "q_path_info": path_info,
    "q_purge": purge,
    "q_staging": staging,
    "q_stitch": stitch,
    "q_stitch_ttl": stitch_ttl,
    "q_progress": progress,
    "q_given_up": given_up,
    "q_hot_keys": hot_keys,
    "q_hot_keys_expired": hot_keys_expired,
    "q_transfers_swept": transfers_swept,
    "q_wlcg_documents": wlcg_documents,
    "q_dead_letters": dead,
    "q_sweep_times": sweep_times,
    "q_sweep_transfers": sweep_transfers,
    "q_expired": expired,
    "q_dict_asof": dict_asof,
    "q_path_fallback": path_fallback,
    "q_user_asof": user_asof,
    "q_user_lease": user_lease,
    "q_server": server,
    "q_host": host,
    "q_host_asof": host_asof,
    "q_disconnects": disconnects,
    "q_first_seen": first_seen,
    "q_times": times,
    "q_dirs": dirs,
    "q_logical_dirname": logical_dir,
    "q_user_fields": user_fields,
    "q_auth_fields": auth_fields,
    "q_io_stats": io_stats,
    "q_route": route,
    "q_wlcg": wlcg,
    "q_crab": crab,
    "q_transfers": transfers_full,
    "q_cache_events": cache_events,
    "q_tpc_events": copy_events,
    "q_tcp_events": tcp_events,
    "q_event_documents": event_documents,
    "q_vo_path": vo_path,
    "q_sequence": sequence_gaps,
    "q_summary_fields": summary_fields,
    "q_summary_late": summary_late,
    "q_summary_deltas": summary_deltas,
    "q_metrics": metric_table,
    "q_state_sizes": state_sizes,
    "q_idle": idle,
    "q_routed_sink": routed_sink,
    "q_stream_sequence": stream_sequence,
    "q_stream_sequence_hot": stream_sequence_hot,
    "q_stream_sequence_keyed": stream_sequence_keyed,
    "q_stream_summaries": stream_summaries,
    "q_stream_summaries_keyed": stream_summaries_keyed,
    "q_stream_transfers": stream_transfers,
    "q_stream_transfers_steps": stream_transfers_steps,
    "q_stream_expiry_steps": stream_expiry_steps,
    "q_stream_given_up": stream_given_up,
    "q_stream_expiry": stream_expiry,
    "q_stream_routed": stream_routed_files,
    "q_stream_metrics": stream_metrics,
    "q_stream_outputs": stream_outputs,
    "q_stream_state_sizes": stream_state_sizes,
}
