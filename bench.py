"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "q_header", "q_fstream_close", "q_user_ident", "q_stitch", "q_expired", "q_dict_asof", "q_user_lease", "q_transfers",
    "q_route", "q_wlcg", "q_cache_events", "q_tpc_events", "q_sequence", "q_summary_fields", "q_summary_deltas", "q_metrics",
    "q_flagship", "q_transfers_swept",
]
STREAMS = ["q_stream_sequence", "q_stream_summaries"]


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("packetloom-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        # Small data on one machine: keep all cores busy instead of merging partitions.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="packetloom-bench-"))  # one machine: its folder is shared
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from packetloom.workload import feeds
    from packetloom.workload.queries import QUERIES

    # The packets are the input: making them from the tables is not part of a query.
    start = time.perf_counter()
    counts = {name: feeds.packets(spark, SF_DIR, name).count() for name in feeds.FEEDS}
    feed_seconds = round(time.perf_counter() - start, 3)
    # Tables that several queries share are timed by themselves, so that no query's time depends on its place in the list.
    stages = {}
    makers = {"records": feeds.records, "maps": feeds.maps, "enriched": feeds.enriched, "reports": feeds.reports}
    for name, make in makers.items():
        start = time.perf_counter()
        make(spark, SF_DIR)
        stages[name] = round(time.perf_counter() - start, 3)

    def timed(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    seconds = {name: timed(name) for name in HEADLINE}
    streams = {name: timed(name) for name in STREAMS}
    total = round(sum(seconds.values()), 3)
    result = {"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds,
              "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1], "packets": counts, "feed_seconds": feed_seconds,
              "stage_seconds": stages, "stream_seconds": streams,
              "flagship_packets_per_sec": round(counts["transfer"] / seconds["q_flagship"])}
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
