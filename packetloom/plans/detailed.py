"""Detailed packets: transfers and events."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.operators import framing, fstream, gstream, lookups, mapping, routing, summaries, sweeps, transfers
from packetloom.operators.ordered import GROUP_LIMIT, limit_for
from packetloom.operators.records import transfer_records
from packetloom.operators.transfers import TTL_SECONDS
from packetloom.sources.packets import bad_envelopes
from packetloom.sources.stage import write_stage


def stage_packets(packets: DataFrame) -> DataFrame:
    """Framed packets written by kind: one pass over the payloads, and every later step reads only its kind."""
    return write_stage(framing.frame_packets(packets), "framed", partition_by="kind")


def stage_records(framed: DataFrame) -> DataFrame:
    return write_stage(fstream.fstream_records(framed), "records")


def stage_maps(framed: DataFrame) -> DataFrame:
    return write_stage(mapping.decode_map(framed), "maps", partition_by="kind")


def enrich_transfers(
    stitched: DataFrame,
    maps: DataFrame,
    ttl_seconds: int | None = TTL_SECONDS,
    group_limit: int | None = GROUP_LIMIT,
    disconnected: DataFrame | None = None,
) -> DataFrame:
    """Users, paths and servers as they were known when each transfer ended."""
    named = lookups.lookup_dict(stitched, mapping.dict_entries(maps), ttl_seconds, group_limit, disconnected)
    known = lookups.lookup_user(
        named, mapping.user_messages(maps), mapping.app_messages(maps), ttl_seconds, group_limit
    )
    return lookups.lookup_server(known, mapping.server_messages(maps))


def transfers_from(
    records: DataFrame,
    maps: DataFrame,
    hosts: DataFrame,
    as_of: int | None = None,
    ttl_seconds: int | None = TTL_SECONDS,
    group_limit: int | None = GROUP_LIMIT,
    honor_disconnect: bool = False,
    give_up: bool = True,
    sweep_seconds: int | None = None,
    arrivals: DataFrame | None = None,
) -> DataFrame:
    """One published record per close and per transfer given up: opens older than the TTL when their close or their next open comes (then
    that close belongs to no open) and, with `as_of`, those still pending then. `give_up=False` matches closes however late they are.

    With `sweep_seconds`, transfers are given up by sweeps that far apart, driven by `arrivals` (by default the packets of `records` and
    `maps`); then `as_of` only ends the feed.

    `records` and `maps` are read by several steps, so both should be written tables.
    """
    # A lookup sees at most one row per record and one per map message.
    group_limit = limit_for(group_limit, records, maps)
    if as_of is not None:
        until = F.col("arrival_ts") <= F.timestamp_seconds(F.lit(as_of))
        records, maps = records.filter(until), maps.filter(until)
    gone = fstream.disconnects(records) if honor_disconnect else None
    if sweep_seconds is not None:
        seen = ["arrival_ts", "arrival_seq"]
        arrivals = records.select(*seen).unionByName(maps.select(*seen)) if arrivals is None else arrivals
        ended = sweeps.swept_transfers(records, arrivals, ttl_seconds or TTL_SECONDS, sweep_seconds, group_limit)
        enriched = enrich_transfers(ended, maps, ttl_seconds, group_limit, gone)
        return transfer_records(lookups.resolve_host(enriched, hosts))
    sweep = give_up and ttl_seconds is not None
    if sweep:
        ended = transfers.ended_transfers(records, ttl_seconds, group_limit)
    else:
        ended = transfers.stitch_transfers(records, None, group_limit)
    if as_of is not None:
        ended = ended.unionByName(transfers.expire_transfers(records, as_of, ttl_seconds or TTL_SECONDS))
    enriched = enrich_transfers(ended, maps, ttl_seconds, group_limit, gone)
    return transfer_records(lookups.resolve_host(enriched, hosts))


def transfers_of(packets: DataFrame, hosts: DataFrame, as_of: int | None = None, **options) -> DataFrame:
    """From raw packets: payloads are read for records and for map messages, then everything runs on typed tables."""
    framed = framing.frame_packets(packets)
    return transfers_from(stage_records(framed), stage_maps(framed), hosts, as_of, **options)


def event_lines(framed: DataFrame, maps: DataFrame, hosts: DataFrame) -> DataFrame:
    """Event lines with the site and the name of their server; only joins with small dimensions."""
    lines = lookups.lookup_server(gstream.explode_gstream(framed), mapping.server_messages(maps))
    named = lookups.resolve_host(lines.drop("server", "server_id"), hosts)
    return named.withColumn("site", F.coalesce("site", F.lit("")))


def detailed_output(
    records: DataFrame, lines: DataFrame, now_ms=None, host: str = "", exchanges: dict[str, str] = routing.EXCHANGES
) -> DataFrame:
    """Everything the detailed packets lead to, routed."""
    return routing.route_transfers(records, now_ms, host, exchanges).unionByName(event_output(lines, now_ms, host, exchanges))


def event_output(lines: DataFrame, now_ms=None, host: str = "", exchanges: dict[str, str] = routing.EXCHANGES) -> DataFrame:
    """Cache, copy and TCP events, routed. What leads to the lines runs once, not once per kind."""
    return routing.route_events(gstream.published_events(lines), now_ms, host, exchanges)


def dead_letters(packets: DataFrame, reports: DataFrame | None = None, pushed: DataFrame | None = None) -> DataFrame:
    """All of detailed `packets`, summary `reports` and `pushed` envelopes that could not be read, with the reason and the bytes.

    `packets` is framed and written by kind first, so that each reader opens its own kind only.
    """
    parts = [bad_packets(packets, stage_packets(packets))]
    if reports is not None:
        parts.append(summaries.bad_summaries(reports))
    if pushed is not None:
        parts.append(bad_envelopes(pushed))
    return reduce(DataFrame.unionByName, parts)


def bad_packets(packets: DataFrame, framed: DataFrame) -> DataFrame:
    """Detailed packets, and lines of them, that could not be read."""
    parts = [framing.bad_headers(packets), fstream.bad_fstream(framed), mapping.bad_maps(framed), gstream.bad_gstream(framed)]
    return reduce(DataFrame.unionByName, parts)
