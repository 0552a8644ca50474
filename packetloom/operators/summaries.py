"""Periodic XML reports of server processes: fields, lateness, and counter differences."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from packetloom.functions.binary import text
from packetloom.functions.paths import utc_iso
from packetloom.operators import report_cuts
from packetloom.operators.ordered import GROUP_LIMIT, before, find_hot_keys
from packetloom.sources.stage import write_stage

# Tasks take the code with them.
cloudpickle.register_pickle_by_value(report_cuts)

KEY = ["addr", "pid"]
# Fixed value: only this program reports.
PROGRAM = "xrootd"
UNKNOWN_SITE = "UnknownSite"
REPORT_SCHEMA = """
    _pgm string, _ver string, _src string, _site string, _tos string, _tod string, _pid string,
    stats array<struct<
        _id string, host string,
        num string, tot string, `in` string, `out` string, ctime string, tmo string,
        sys struct<s string>, usr struct<s string>,
        err string, dly string, rdr string,
        ops struct<open string, pr string, rd string, rv string, sync string, wr string>,
        lgn struct<num string, af string, au string, ua string>,
        inq string, threads string, idle string,
        `as` string, toe string>>
"""
# Published counter -> (section, path in it). A difference below zero means a restart of the counter.
RESTARTING = {
    "link_total": ("link", "tot"),
    "link_in": ("link", "in"),
    "link_out": ("link", "out"),
    "link_ctime": ("link", "ctime"),
    "link_tmo": ("link", "tmo"),
    "proc_usr": ("proc", "usr.s"),
    "proc_sys": ("proc", "sys.s"),
    "ops_open": ("xrootd", "ops.open"),
    "ops_preread": ("xrootd", "ops.pr"),
    "ops_read": ("xrootd", "ops.rd"),
    "ops_readv": ("xrootd", "ops.rv"),
    "ops_sync": ("xrootd", "ops.sync"),
    "ops_write": ("xrootd", "ops.wr"),
}
# Counters whose difference is published as it is, even below zero.
PLAIN = {
    "xrootd_errors": ("xrootd", "err"),
    "xrootd_delays": ("xrootd", "dly"),
    "xrootd_redirections": ("xrootd", "rdr"),
    "login_attempts": ("xrootd", "lgn.num"),
    "authentication_failures": ("xrootd", "lgn.af"),
    "authentication_successes": ("xrootd", "lgn.au"),
    "unauthenticated_successes": ("xrootd", "lgn.ua"),
}
# Published as they are.
CURRENT = {
    "link_num": ("link", "num"),
    "sched_in_queue": ("sched", "inq"),
    "sched_threads": ("sched", "threads"),
    "sched_idle_threads": ("sched", "idle"),
    "sgen_as": ("sgen", "as"),
}
COUNTERS = RESTARTING | PLAIN
SECTIONS = ["info", "link", "proc", "xrootd", "sched", "sgen"]
BASICS = ["type", "server_ip", "pid", "version", "timestamp", "tos", "cstart", "site"]


def _section(name: str) -> Column:
    """The last section of that name, as repeated ones overwrite each other; NULL without one."""
    return F.try_element_at(F.filter("report.stats", lambda s: s["_id"] == name), F.lit(-1))


def _text(section: str, path: str) -> str:
    return ".".join(f"`{part}`" for part in (f"s_{section}", *path.split(".")))


def _number(section: str, path: str) -> Column:
    return F.expr(f"try_cast(trim({_text(section, path)}) AS bigint)")


def _cut_reports(packets: DataFrame) -> DataFrame:
    """Add `usual` and, for reports of the usual form, `quick`: the report with the elements that are published."""
    shape = StructType.fromDDL(REPORT_SCHEMA)
    attributes = [f.name[1:] for f in shape.fields[:-1]]
    wanted = [*COUNTERS.values(), *CURRENT.values(), ("info", "host"), ("sgen", "toe")]
    sections = {name: [path for section, path in wanted if section == name] for name in SECTIONS}
    columns = [f"a_{a}" for a in attributes] + [c for name, paths in sections.items() for c in (name, *[f"{name}.{p}" for p in paths])]
    names, cuts = [*packets.columns, "usual", *columns], report_cuts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return cuts.cut_batches(batches, attributes, sections, names)

    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in packets.schema]
    rows = packets.mapInArrow(run, ", ".join([*kinds, "usual boolean", *[f"`{c}` string" for c in columns]]))

    def element(section: str, path: str, kind: DataType) -> Column:
        if isinstance(kind, StructType):
            inner = {f"{path}.{f.name}": f.dataType for f in kind.fields}
            if not set(inner) & set(sections[section]):
                return F.lit(None).cast(kind)
            return F.struct(*[element(section, p, k).alias(p.split(".")[-1]) for p, k in inner.items()])
        return F.col(f"`{section}.{path}`") if path in sections[section] else F.lit(None).cast(kind)

    kinds_of = shape["stats"].dataType.elementType.fields[1:]
    found = [
        F.when(F.col(name).isNotNull(), F.struct(F.lit(name).alias("_id"), *[element(name, f.name, f.dataType).alias(f.name) for f in kinds_of]))
        for name in SECTIONS
    ]
    quick = F.struct(*[F.col(f"a_{a}").alias(f"_{a}") for a in attributes], F.array(*found).alias("stats"))
    return rows.select(*packets.columns, "usual", quick.alias("quick"))


def parse_reports(packets: DataFrame) -> DataFrame:
    """The XML of every packet; `report` is NULL where it cannot be read. Of a report of the usual form, which is cut by position, it has the
    published elements only; any other goes to the XML parser, and so do all of a stream, through which its watermark passes."""
    rows = packets.select("addr", "arrival_ts", "arrival_seq", "payload")
    parsed = F.from_xml(text(F.col("payload")), REPORT_SCHEMA)
    if not packets.isStreaming:
        rows = _cut_reports(rows)
        parsed = F.when(F.col("usual"), F.col("quick")).otherwise(parsed)
    # A generator of one row keeps Spark from parsing again for every filter and field above (the outer form too).
    rows = rows.select("addr", "arrival_ts", "arrival_seq", "payload", F.explode_outer(F.array(parsed)).alias("report"))
    return rows.withColumn("report", F.when(F.col("report._pgm").isNotNull(), F.col("report")))


def _typed(packets: DataFrame) -> DataFrame:
    r = "report."
    numbers = {name: F.trim(F.col(f"{r}_{name}")).try_cast("bigint") for name in ("tos", "tod", "pid")}
    return parse_reports(packets).withColumns(numbers | {f"s_{name}": _section(name) for name in SECTIONS})


def _is_usable() -> Column:
    """Header numbers are there, and every counter that is there (in a report with a site) can be read."""
    unreadable = " OR ".join(
        f"({_text(*at)} IS NOT NULL AND try_cast(trim({_text(*at)}) AS bigint) IS NULL)" for at in COUNTERS.values()
    )
    return F.expr(f"tos IS NOT NULL AND tod IS NOT NULL AND pid IS NOT NULL AND NOT (report._site IS NOT NULL AND ({unreadable}))")


def bad_summaries(packets: DataFrame) -> DataFrame:
    rows = _typed(packets).filter(F.col("report").isNull() | ((F.col("report._pgm") == PROGRAM) & ~_is_usable()))
    return rows.select(F.lit("report").alias("reason"), "payload", "arrival_seq")


def summary_fields(packets: DataFrame) -> DataFrame:
    """One row per report of the right program: published fields as they are and the current counters.

    Reports of servers without a site name only carry the basic fields, and `has_site` is false.
    """
    reports = _typed(packets).filter((F.col("report._pgm") == PROGRAM) & _is_usable())
    has_site = F.col("report._site").isNotNull()
    sections = reports.select(
        "addr",
        "arrival_ts",
        "arrival_seq",
        "tod",
        has_site.alias("has_site"),
        F.lit("summary").alias("type"),
        F.col("addr").alias("server_ip"),
        "pid",
        F.col("report._ver").alias("version"),
        utc_iso(F.col("tod")).alias("timestamp"),
        utc_iso(F.col("tos")).alias("tos"),
        utc_iso(F.col("tod")).alias("cstart"),
        F.coalesce("report._site", F.lit(UNKNOWN_SITE)).alias("site"),
        *[F.when(has_site, F.col(f"s_{s}")).alias(f"s_{s}") for s in SECTIONS],
    )
    current = {name: _number(*at) for name, at in CURRENT.items()}
    counters = [F.coalesce(_number(*at), F.lit(0)).alias(name) for name, at in COUNTERS.items()]
    return sections.select(
        "addr",
        "arrival_ts",
        "arrival_seq",
        "tod",
        "has_site",
        *BASICS,
        F.col("s_info.host").alias("host"),
        *[value.alias(name) for name, value in current.items()],
        utc_iso(_number("sgen", "toe")).alias("cend"),
        F.struct(*counters).alias("counters"),
    )


def _hot_processes(rows: DataFrame, group_limit: int | None) -> DataFrame | None:
    return find_hot_keys(rows.select(*KEY, "arrival_seq"), KEY, "arrival_seq", group_limit)


def drop_late_summaries(summaries: DataFrame, group_limit: int | None = GROUP_LIMIT) -> DataFrame:
    """Leave out reports that are older than one accepted earlier for the same process.

    The largest time of all earlier reports is also the largest of the accepted ones, so no state is needed.
    """
    rows = summaries.filter("has_site")
    return _on_time(rows, _hot_processes(rows, group_limit))


def _on_time(rows: DataFrame, hot: DataFrame | None) -> DataFrame:
    seen = before(rows, KEY, ["arrival_seq"], largest={"newest": F.col("tod")}, hot=hot)
    return seen.filter(F.col("newest").isNull() | (F.col("tod") >= F.col("newest"))).drop("newest")


def difference(counters: Column, earlier: Column) -> dict[str, Column]:
    deltas = {}
    for name in COUNTERS:
        now = counters[name]
        delta = now - earlier[name]
        # Negative differences are those of a counter that began anew.
        deltas[name] = F.when(delta < 0, now).otherwise(delta) if name in RESTARTING else delta
    return deltas


def counter_deltas(accepted: DataFrame, group_limit: int | None = GROUP_LIMIT) -> DataFrame:
    """Counters minus those of the accepted report before; the first report of a process has none and is left out."""
    return _deltas(accepted, _hot_processes(accepted, group_limit))


def _deltas(accepted: DataFrame, hot: DataFrame | None) -> DataFrame:
    linked = before(accepted, KEY, ["arrival_seq"], last={"earlier": F.col("counters")}, hot=hot)
    known = linked.filter("earlier IS NOT NULL")
    return known.withColumns(difference(F.col("counters"), F.col("earlier"))).drop("earlier", "counters")


def summary_records(summaries: DataFrame, group_limit: int | None = GROUP_LIMIT) -> DataFrame:
    """Everything that is published: differences of accepted reports, and basic fields of those without a site.

    Both passes run over one shuffle by process. `summaries` is read several times: a written table is best.
    """
    rows = summaries.filter("has_site")
    hot = _hot_processes(rows, group_limit)
    basic = summaries.filter("NOT has_site").drop("counters")
    return _deltas(_on_time(rows, hot), hot).unionByName(basic, allowMissingColumns=True)


def summary_step(
    summaries: DataFrame, last: DataFrame | None = None, group_limit: int | None = GROUP_LIMIT
) -> tuple[DataFrame, DataFrame]:
    """`summary_records` of one part of a feed, and the last accepted report per process for the next part.

    `last` is what the part before left. Such a report comes first of its process, so it is compared with and never published again.
    """
    rows = summaries.filter("has_site")
    if last is not None:
        rows = rows.unionByName(last.withColumn("has_site", F.lit(True)), allowMissingColumns=True)
    hot = _hot_processes(rows, group_limit)
    accepted = write_stage(_on_time(rows, hot), "accepted-reports")
    basic = summaries.filter("NOT has_site").drop("counters")
    kept = F.struct("arrival_seq", "tod", "counters")
    latest = accepted.groupBy(*KEY).agg(F.max_by(kept, "arrival_seq").alias("last")).select(*KEY, "last.*")
    return _deltas(accepted, hot).unionByName(basic, allowMissingColumns=True), latest
