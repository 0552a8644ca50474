"""Enrichment with what was known when a record arrived: users, paths, servers, hosts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.operators.joins import broadcast_if_small
from packetloom.operators.ordered import GROUP_LIMIT, before, find_hot_keys, rank, rows_of
from packetloom.operators.spacing import TIMES_LIMIT, hot_times, times_apart
from packetloom.operators.transfers import TTL_SECONDS
from packetloom.sources.stage import write_stage

DICT_KEY = ["sid", "dict_id"]
USER_KEY = ["sid", "ident"]
ORDER = ["arrival_seq", "rec_idx"]
LEASE_GROUP_LIMIT = TIMES_LIMIT
#: Probes at no more places than this have what they look up reduced first.
PLACES = 100


def _age(since: str, at: str = "arrival_ts"):
    return F.unix_micros(at) - F.unix_micros(since)


def _micros(ttl_seconds: int) -> int:
    return ttl_seconds * 1_000_000


def _asof(
    probes: DataFrame,
    states: DataFrame,
    keys: list[str],
    values: list[str],
    group_limit: int | None,
    writers: DataFrame | None = None,
) -> DataFrame:
    """Probes with the latest earlier non-NULL `values` of `states`: union, then one pass per key in arrival order.

    `writers` has the same keys as `states` and is cheaper to count. Where hot keys are searched for, probes are written first, so that
    what leads to them runs once and not again for every count. If they stand at few places, a key keeps only what it says last before each.
    """
    if group_limit is not None:
        probes = write_stage(probes, "probes")
        asked = _few_places(probes)
        if asked is not None:
            states, writers = write_stage(_last_before(states, keys, values, asked), "latest-states"), None
    probe_cols = [c for c in probes.columns if c not in (*keys, *ORDER)]
    both = probes.select(*keys, *ORDER, F.struct(*probe_cols).alias("probe")).unionByName(
        states.select(*keys, "arrival_seq", F.lit(-1).alias("rec_idx"), *values), allowMissingColumns=True
    )
    written = (states if writers is None else writers).select(*keys, "arrival_seq", F.lit(-1).alias("rec_idx"))
    places = probes.select(*keys, *ORDER).unionByName(written)
    rows = rows_of(places, group_limit)
    hot = find_hot_keys(places, keys, ORDER, group_limit, rows)
    found = before(both, keys, ORDER, last={f"_{v}": F.col(v) for v in values}, hot=hot, rows=rows)
    return found.filter("probe IS NOT NULL").select(
        *keys, *ORDER, "probe.*", *[F.col(f"_{v}").alias(v) for v in values]
    )


def _few_places(probes: DataFrame) -> list[int] | None:
    """The positions of all `probes` in ascending order; None if they are many, or one is not known."""
    about = probes.agg(F.approx_count_distinct("arrival_seq")).first()[0]
    if about > 2 * PLACES:
        return None
    found = [r.arrival_seq for r in probes.select("arrival_seq").distinct().limit(PLACES + 1).collect()]
    return None if len(found) > PLACES or None in found else sorted(found)


def _last_before(states: DataFrame, keys: list[str], values: list[str], places: list[int]) -> DataFrame:
    """Of the `states` of a key between two `places` the last value of each kind, in one row: no probe sees more of them. States after the
    last place are left out. Every map task reduces its states before they are shuffled."""
    at = F.struct("arrival_seq")
    slot = F.lit(0) if len(places) < 2 else rank(F.array(*[F.lit(p) for p in places]), F.col("arrival_seq"))
    seen = states.filter(F.coalesce(F.col("arrival_seq") <= F.lit(places[-1]), F.lit(True))) if places else states.limit(0)
    return seen.withColumn("_slot", slot).groupBy(*keys, "_slot").agg(
        F.max("arrival_seq").alias("arrival_seq"), *[F.max_by(v, F.when(F.col(v).isNotNull(), at)).alias(v) for v in values]
    ).drop("_slot")


def lookup_dict(
    transfers: DataFrame,
    entries: DataFrame,
    ttl_seconds: int | None = TTL_SECONDS,
    group_limit: int | None = GROUP_LIMIT,
    disconnected: DataFrame | None = None,
) -> DataFrame:
    """Add `ident` and `path` from the dictionary of the stream.

    A transfer with a user id is looked up by it; without one by its file id, and then only a path entry
    helps. Entries live `ttl_seconds` after they were written. `disconnected` (off by default) lets a
    disconnect end the entry of its user.
    """
    by_user = F.col("user_id") != 0
    probes = transfers.withColumn("dict_id", F.when(by_user, F.col("user_id")).otherwise(F.col("file_id")))
    states = entries.select(*DICT_KEY, "arrival_seq", "entry")
    if disconnected is not None:
        kind = entries.schema["entry"].dataType
        ended = disconnected.select(
            "sid",
            F.col("user_id").alias("dict_id"),
            "arrival_seq",
            F.struct(F.lit(None).cast("boolean").alias("is_path"), *[
                F.lit(None).cast(f.dataType).alias(f.name) for f in kind.fields[1:]
            ]).alias("entry"),
        )
        states = states.unionByName(ended)
    found = _asof(probes, states, DICT_KEY, ["entry"], group_limit)
    live = F.col("entry.is_path").isNotNull()
    if ttl_seconds is not None:
        live = live & (_age("entry.arrival_ts") <= _micros(ttl_seconds))
    fits = live & (F.col("entry.is_path") != by_user)
    return found.withColumns(
        {
            "ident": F.when(fits, F.col("entry.ident")),
            "path": F.when(fits, F.col("entry.path")),
        }
    ).drop("entry", "dict_id")


def user_leases(messages: DataFrame, ttl_seconds: int, lease_limit: int | None = LEASE_GROUP_LIMIT) -> DataFrame:
    """Start times `t` of the lives of every (sid, identity): the first message, then each first one after the TTL."""
    timed = messages.withColumn("t", F.unix_micros("arrival_ts"))
    return times_apart(timed, USER_KEY, _micros(ttl_seconds), hot_times(timed, USER_KEY, lease_limit))


def latest_entries(entries: DataFrame) -> DataFrame:
    """The last entry of every dictionary key, all that later lookups need of it."""
    latest = entries.groupBy(*DICT_KEY).agg(F.max_by(F.struct("arrival_ts", "arrival_seq", "entry"), "arrival_seq").alias("last"))
    return latest.select(*DICT_KEY, "last.*")


def latest_users(
    messages: DataFrame, ttl_seconds: int | None, since: int | None = None, lease_limit: int | None = LEASE_GROUP_LIMIT
) -> DataFrame:
    """Of the last life of every identity: its first message (as a mark, without content) and the last ones with `auth` and `appinfo`.

    `messages` has `auth` and `appinfo`, one of them NULL. The rows are messages again, from which a later part of a feed goes on. Lives
    that began before `since` (epoch seconds) are left out as a whole.
    """
    timed = messages.withColumn("t", F.unix_micros("arrival_ts"))
    if ttl_seconds is not None:
        starts = user_leases(messages, ttl_seconds, lease_limit).groupBy(*USER_KEY).agg(F.max("t").alias("start"))
        if since is not None:
            starts = starts.filter(F.col("start") >= since * 1_000_000)
        timed = timed.join(starts, USER_KEY).filter("t >= start")
    place = ["arrival_ts", "arrival_seq"]
    auth, app = (F.lit(None).cast(messages.schema[c].dataType).alias(c) for c in ("auth", "appinfo"))
    latest = timed.groupBy(*USER_KEY).agg(
        F.min_by(F.struct(*place, auth, app), F.struct("t", "arrival_seq")).alias("mark"),
        F.max_by(F.struct(*place, "auth", app), F.when(F.col("auth").isNotNull(), F.col("arrival_seq"))).alias("by_user"),
        F.max_by(F.struct(*place, auth, "appinfo"), F.when(F.col("appinfo").isNotNull(), F.col("arrival_seq"))).alias("by_app"),
    )
    rows = F.filter(F.array("mark", "by_user", "by_app"), lambda r: r.isNotNull())
    return latest.select(*USER_KEY, F.inline(rows))


def lookup_user(
    transfers: DataFrame,
    users: DataFrame,
    apps: DataFrame,
    ttl_seconds: int | None = TTL_SECONDS,
    group_limit: int | None = GROUP_LIMIT,
    lease_limit: int | None = LEASE_GROUP_LIMIT,
) -> DataFrame:
    """Add `user` (the identity, once a user message came), `auth` and `appinfo` of the identity.

    User and app messages fill one entry per identity, which lives `ttl_seconds` from its creation; later
    messages update it without prolonging it. `ttl_seconds=None` keeps entries for ever.
    """
    base = [*USER_KEY, "arrival_ts", "arrival_seq"]
    messages = users.select(*base, "auth").unionByName(apps.select(*base, "appinfo"), allowMissingColumns=True)
    if ttl_seconds is None:
        states = messages.withColumn("lease", F.lit(0).cast("bigint"))
    else:
        timed = messages.withColumn("t", F.unix_micros("arrival_ts"))
        hot = hot_times(timed, USER_KEY, lease_limit)
        marks = times_apart(timed, USER_KEY, _micros(ttl_seconds), hot).withColumn("start", F.col("t"))
        # A life starts before the messages of the same moment.
        marked = timed.unionByName(marks, allowMissingColumns=True).withColumn("tie", F.col("start").isNull().cast("int"))
        states = before(marked, USER_KEY, ["t", "tie"], last={"lease": F.col("start")}, hot=hot).filter("start IS NULL")
    states = states.select(
        *USER_KEY,
        F.lit(0).cast("bigint").alias("spread"),
        "arrival_seq",
        "lease",
        F.when(F.col("auth").isNotNull(), F.struct("auth", "lease")).alias("by_user"),
        F.when(F.col("appinfo").isNotNull(), F.struct("appinfo", "lease")).alias("by_app"),
    )
    # Transfers without an identity find nothing; keys made from what they are keep them from gathering in one task.
    names = [c for c in transfers.columns if c in (*ORDER, "file_id", "open_seq", "open_idx", "open_time")]
    probes = transfers.withColumn("spread", F.when(F.col("ident").isNull(), F.xxhash64(*names)).otherwise(0))
    writers = messages.select(*USER_KEY, F.lit(0).cast("bigint").alias("spread"), "arrival_seq")
    values = ["lease", "by_user", "by_app"]
    found = _asof(probes, states, [*USER_KEY, "spread"], values, group_limit, writers)
    live = F.col("lease").isNotNull()
    if ttl_seconds is not None:
        live = live & (F.unix_micros("arrival_ts") - F.col("lease") <= _micros(ttl_seconds))
    named = live & (F.col("by_user.lease") == F.col("lease"))
    tagged = live & (F.col("by_app.lease") == F.col("lease"))
    return found.withColumns(
        {
            "user": F.when(named, F.col("ident")),
            "auth": F.when(named, F.col("by_user.auth")),
            "appinfo": F.when(tagged, F.col("by_app.appinfo")),
        }
    ).drop("spread", *values)


def first_servers(servers: DataFrame) -> DataFrame:
    """The first server message of every stream; later ones change nothing. One row per server start."""
    first = servers.groupBy("sid").agg(
        F.min_by(F.struct("arrival_seq", "addr", "server"), "arrival_seq").alias("first")
    )
    return first.select(
        "sid",
        F.col("first.arrival_seq").alias("server_seq"),
        F.col("first.addr").alias("server_addr"),
        F.col("first.server.site").alias("server_site"),
    )


def first_messages(servers: DataFrame) -> DataFrame:
    """The first server message of every stream as it came."""
    others = [c for c in servers.columns if c != "sid"]
    return servers.groupBy("sid").agg(F.min_by(F.struct(*others), "arrival_seq").alias("first")).select("sid", "first.*")


def lookup_server(rows: DataFrame, servers: DataFrame) -> DataFrame:
    """Add `server_id`, `server` and `site`. Unknown servers keep their address; known ones without a site get ''."""
    known = broadcast_if_small(first_servers(servers))
    joined = rows.join(known, "sid", "left")
    seen = F.coalesce(F.col("server_seq") <= F.col("arrival_seq"), F.lit(False))
    return joined.withColumns(
        {
            "server_id": F.when(seen, F.col("sid")),
            "server": F.when(seen, F.col("server_addr")).otherwise(F.col("addr")),
            "site": F.when(seen, F.coalesce("server_site", F.lit(""))),
        }
    ).drop("server_seq", "server_addr", "server_site")


def resolve_host(rows: DataFrame, hosts: DataFrame) -> DataFrame:
    """Add `server_hostname` from a host dimension (`addr`, `hostname`); unknown addresses and names stay as they are."""
    names = broadcast_if_small(
        hosts.groupBy("addr").agg(F.min("hostname").alias("server_hostname"))
    )
    return rows.join(names, "addr", "left").withColumn("server_hostname", F.coalesce("server_hostname", "addr"))


# Fixed value: how long a looked-up host name is kept.
HOST_TTL_SECONDS = 24 * 3600


def resolve_host_asof(
    rows: DataFrame, names: DataFrame, ttl_seconds: int = HOST_TTL_SECONDS, times_limit: int | None = TIMES_LIMIT
) -> DataFrame:
    """Add `server_hostname` from names that change: `names` has `addr`, `hostname` and `valid_from`.

    An address is looked up when it is first needed, and again by the first row that comes more than `ttl_seconds` after the last
    lookup; in between the name stays, whatever it is by now. Addresses without a name at that moment stay as they are. Per address, names and
    lookups are sorted arrays, joined by broadcast if they are small.
    """
    timed = rows.select("addr", F.unix_micros("arrival_ts").alias("t"))
    looked = times_apart(timed, ["addr"], _micros(ttl_seconds), hot_times(timed, ["addr"], times_limit))
    history = names.groupBy("addr").agg(
        F.array_sort(F.collect_list(F.struct(F.unix_micros("valid_from").alias("since"), "hostname"))).alias("history")
    )
    known = looked.join(broadcast_if_small(history), "addr", "left").select(
        "addr", "t", F.try_element_at(F.filter("history", lambda h: h["since"] <= F.col("t")), F.lit(-1))["hostname"].alias("name")
    )
    spans = known.groupBy("addr").agg(F.array_sort(F.collect_list(F.struct("t", "name"))).alias("spans"))
    found = rows.join(broadcast_if_small(spans), "addr", "left")
    now = F.try_element_at(F.filter("spans", lambda s: s["t"] <= F.unix_micros("arrival_ts")), F.lit(-1))["name"]
    return found.withColumn("server_hostname", F.coalesce(now, "addr")).drop("spans")


def first_seen(rows: DataFrame, keys: list[str], order: str = "arrival_seq") -> DataFrame:
    """First row of every key, without gathering the rows of a key: the smallest position is an aggregate."""
    packed = F.struct(order, *[c for c in rows.columns if c not in (*keys, order)])
    return rows.groupBy(*keys).agg(F.min_by(packed, order).alias("first")).select(*keys, "first.*")


def idle_streams(framed: DataFrame, as_of: int, gap_seconds: int = 20) -> DataFrame:
    """Streams whose last packet is more than `gap_seconds` before `as_of`."""
    last = framed.groupBy("sid").agg(F.max("arrival_ts").alias("last_ts"))
    return last.filter(F.unix_micros(F.timestamp_seconds(F.lit(as_of))) - F.unix_micros("last_ts") > _micros(gap_seconds))


