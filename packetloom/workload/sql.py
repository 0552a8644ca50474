"""SQL twins of the queries, over the base tables only: no packet is made or read here."""

from __future__ import annotations

from packetloom.functions.fields import NEVER_MEASURED, WLCG_STATS
from packetloom.workload.feeds import CODES, COUNTER_FACTORS, PREFIXES
from packetloom.workload.queries import AS_OF

STEP = 100000000
T0 = 1700000000
TTL = 3600


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _seq(t: str, rank: int, n: str) -> str:
    return f"((CAST({t} AS BIGINT) * 10 + {rank}) * {STEP} + {n})"


def _sid(srv: str, ip: str = "10.0.0.") -> str:
    return f"((1600000000 + {srv}) || '#{ip}' || {srv} || '#1094')"


# Orders with the totals of their lines and all derived choices.
ORDERS = f"""
tot AS (
    SELECT l_orderkey AS k, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS rd,
           CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS rv, CAST(sum(l_linenumber) AS BIGINT) AS lines,
           count(*) AS n, min(CAST(l_quantity AS BIGINT)) AS q_min, max(CAST(l_quantity AS BIGINT)) AS q_max,
           CAST(max(l_linenumber) AS BIGINT) AS line_max
    FROM lineitem GROUP BY 1),
ord AS (
    SELECT o_orderkey AS k, o_custkey AS c, o_orderkey % 8 AS srv, CAST(round(o_totalprice * 100) AS BIGINT) AS size,
           {T0} + (o_orderkey * 7919) % 200000 AS t_open
    FROM orders),
o AS (
    SELECT ord.*, t_open + 30 + k % 5400 AS t_close, t_open - k % 4000 AS t_user, k + 1000 AS file_id,
           c % 30 + 1 AS uid, c % 40 AS u,
           {_list(PREFIXES)}[CAST((k // 8) % 16 + 1 AS INT)] || '/d' || k % 7 || '/e' || k % 5 || '/f' || k || '.root' AS name,
           ['cms', 'osg', 'dteam', ''][CAST((k // 512) % 4 + 1 AS INT)] AS vo, ['4', '6', ''][CAST(k % 3 + 1 AS INT)] AS inetv,
           k || '_https://host/' || k || '/wf:' || c || '_' || k % 3 AS app,
           (k // 128) % 4 <> 3 AS has_user, k % 5 = 0 AS has_app, k % 22 = 0 AS has_path, k % 13 <> 0 AS has_open,
           k % 11 <> 0 AS named, k % 3 = 0 AS has_xfr, n IS NOT NULL AS has_close,
           rd, rv, lines, n, q_min, q_max, line_max, CASE WHEN k % 4 = 0 THEN lines ELSE 0 END AS wr, k % 2 = 0 AS has_ops
    FROM ord LEFT JOIN tot USING (k))"""

# Every close, with the open it belongs to. File ids are unique, so the first close of an order finds its open.
CLOSES = f"""
cl AS (
    SELECT *, t_close AS t, {_seq('t_close', 6, 'k')} AS seq, has_open AS matched FROM o WHERE has_close
    UNION ALL
    SELECT *, t_close + 60 AS t, {_seq('t_close + 60', 6, 'k')} AS seq, FALSE AS matched FROM o WHERE has_close AND k % 29 = 0),
st AS (
    SELECT *, CASE WHEN matched AND named THEN uid ELSE 0 END AS user_id, CASE WHEN matched THEN t_open ELSE t END AS open_time,
           CASE WHEN matched THEN CASE WHEN named THEN name ELSE '' END END AS open_name,
           CASE WHEN matched THEN size END AS file_size, TRUE AS closed
    FROM cl)"""

# Dictionary writes: users and apps by user id, paths by file id.
ENTRIES = f"""
ent AS (
    SELECT srv, uid AS dict, {_seq('t_user', 1, 'k')} AS mseq, t_user AS mt, u AS mu, CAST(NULL AS VARCHAR) AS mpath FROM o WHERE has_user
    UNION ALL SELECT srv, uid, {_seq('t_user', 2, 'k')}, t_user, u, NULL FROM o WHERE has_app
    UNION ALL SELECT srv, file_id, {_seq('t_open - 1', 3, 'k')}, t_open - 1, u, name FROM o WHERE has_path)"""


def _found(extra: str = "") -> str:
    return f"""{extra}
fd AS (
    SELECT p.*, CASE WHEN p.t - e.mt <= {TTL} THEN e.mu END AS fu, CASE WHEN p.t - e.mt <= {TTL} THEN e.mpath END AS path
    FROM (SELECT *, CASE WHEN user_id <> 0 THEN user_id ELSE file_id END AS dict FROM st) p
    ASOF LEFT JOIN ent e ON p.srv = e.srv AND p.dict = e.dict AND p.seq > e.mseq)"""


# User and app messages of every identity (server, user number), with the life they fall into.
MESSAGES = f"""
msg AS (
    SELECT srv, u, {_seq('t_user', 1, 'k')} AS mseq, t_user AS mt, vo AS mvo, inetv AS minetv, CAST(NULL AS VARCHAR) AS mapp FROM o WHERE has_user
    UNION ALL SELECT srv, u, {_seq('t_user', 2, 'k')}, t_user, NULL, NULL, app FROM o WHERE has_app),
lease(srv, u, s) AS (
    SELECT srv, u, min(mt) FROM msg GROUP BY 1, 2
    UNION ALL
    SELECT l.srv, l.u, min(m.mt) FROM lease l JOIN msg m ON l.srv = m.srv AND l.u = m.u AND m.mt > l.s + {TTL} GROUP BY 1, 2),
lm AS (SELECT m.*, l.s FROM msg m ASOF JOIN lease l ON m.srv = l.srv AND m.u = l.u AND m.mt >= l.s)"""

ENRICHED = f"""
e1 AS (SELECT f.*, a.s AS life FROM fd f ASOF LEFT JOIN lm a ON f.srv = a.srv AND f.fu = a.u AND f.seq > a.mseq),
e2 AS (
    SELECT f.*, x.s AS user_life, x.mvo AS x_vo, x.minetv AS x_inetv
    FROM e1 f ASOF LEFT JOIN (SELECT * FROM lm WHERE mvo IS NOT NULL) x
    ON f.srv = x.srv AND f.fu = x.u AND f.seq > x.mseq),
e3 AS (
    SELECT f.*, x.s AS app_life, x.mapp AS x_app
    FROM e2 f ASOF LEFT JOIN (SELECT * FROM lm WHERE mapp IS NOT NULL) x
    ON f.srv = x.srv AND f.fu = x.u AND f.seq > x.mseq),
en AS (
    SELECT * EXCLUDE (vo, inetv, u),
           CASE WHEN t - life <= {TTL} AND user_life = life THEN fu END AS u,
           CASE WHEN t - life <= {TTL} AND user_life = life THEN x_vo END AS vo_raw,
           CASE WHEN t - life <= {TTL} AND user_life = life THEN x_inetv END AS inetv,
           CASE WHEN t - life <= {TTL} AND app_life = life THEN x_app END AS appinfo
    FROM e3)"""

HOST_NAME = "(CASE WHEN {u} % 9 = 0 THEN 'f' ELSE 'n' END || {u} || CASE WHEN {u} % 2 = 0 THEN '.unl.edu' ELSE '.cern.ch' END)"


def _levels(path: str, n: int) -> str:
    return f"array_to_string(string_split({path}, '/')[1:{n}], '/')"


def _logical(name: str, open_name: str) -> str:
    p = name
    return f"""CASE WHEN starts_with({p}, '/user') THEN {_levels(p, 3)}
        WHEN starts_with({p}, '/osgconnect/public') OR starts_with({p}, '/osgconnect/protected')
          OR starts_with({p}, '/ospool/PROTECTED') THEN {_levels(p, 4)}
        WHEN starts_with({p}, '/ospool') THEN {_levels(p, 5)}
        WHEN starts_with({p}, '/path-facility') THEN {_levels(p, 4)}
        WHEN starts_with({p}, '/hcc') THEN {_levels(p, 6)}
        WHEN starts_with({p}, '/pnfs/fnal.gov/usr') THEN {_levels(open_name, 5)}
        WHEN starts_with({p}, '/gwdata') THEN {_levels(p, 3)}
        WHEN starts_with({p}, '/chtc/') THEN '/chtc'
        WHEN starts_with({p}, '/icecube/') THEN '/icecube'
        WHEN starts_with({p}, '/igwn') THEN {_levels(p, 4)}
        WHEN starts_with({p}, '/store') THEN {_levels(p, 3)}
        ELSE 'unknown directory' END"""


def _ratio(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END"


# Statistics in terms of the order totals: ops.read = n, ops.readv = n % 3, ops.write = n % 2 and so on.
STATS = {
    "read_average": _ratio("rd + rv", "n + n % 3"),
    "read_bytes_at_close": "rd + rv",
    "read_max": "greatest(q_max, n)",
    "read_min": "least(q_min, 1)",
    "read_operations": "n + n % 3",
    "read_single_average": _ratio("rd", "n"),
    "read_single_bytes": "rd",
    "read_single_max": "q_max",
    "read_single_min": "q_min",
    "read_single_operations": "n",
    "read_vector_average": _ratio("rv", "n % 3"),
    "read_vector_count_average": _ratio("n * 2", "rv"),
    "read_vector_count_max": "n",
    "read_vector_count_min": "1",
    "read_vector_max": "n",
    "read_vector_min": "1",
    "read_vector_operations": "n % 3",
    "write_average": _ratio("wr", "n % 2"),
    "write_bytes_at_close": "wr",
    "write_max": "line_max",
    "write_min": "0",
    "write_operations": "n % 2",
}

# All published fields of a transfer that the queries look at.
PUBLISHED = f"""
pb AS (
    SELECT *, CASE WHEN matched THEN CASE WHEN open_name = '' THEN coalesce(path, '') ELSE open_name END
              ELSE 'missing directory' END AS filename,
           {HOST_NAME.format(u='u')} AS host, nullif(vo_raw, '') AS vo,
           CASE WHEN u IS NOT NULL THEN '/DC=org/CN=User ' || u END AS user_dn,
           CASE WHEN inetv <> '' THEN inetv = '6' END AS ipv6,
           CASE WHEN srv < 6 THEN 'T2_' || srv WHEN srv = 6 THEN '' END AS site,
           CASE WHEN srv < 6 THEN 'xrd' || srv || '.site' || srv || '.org' ELSE '10.0.0.' || srv END AS server_hostname
    FROM en),
pub AS (
    SELECT *, CASE WHEN matched THEN {_logical('filename', 'open_name')} ELSE 'missing directory' END AS logical_dirname,
           coalesce(vo IN ('cms', 'dteam'), FALSE) OR starts_with(filename, '/store') AS is_wlcg
    FROM pb)"""

_BASE = f"WITH {ORDERS}, {CLOSES}"
_FOUND = f"{_BASE}, {ENTRIES}, {_found()}"
_FULL = f"WITH RECURSIVE {ORDERS}, {CLOSES}, {ENTRIES}, {_found()}, {MESSAGES}, {ENRICHED}"
_PUB = f"{_FULL}, {PUBLISHED}"

# The same at one moment: only packets that have arrived, and pending opens with progress given up.
_AT = f"""WITH RECURSIVE {ORDERS}, {CLOSES.replace('cl AS (', 'cl_all AS (').replace('FROM cl)', f'FROM cl_all WHERE t <= {AS_OF})').replace('st AS (', 'st0 AS (')},
st AS (
    SELECT * FROM st0
    UNION ALL
    SELECT * REPLACE (k * 10 AS rd, k AS rv, 0 AS wr, FALSE AS has_ops),
           CAST({AS_OF} AS BIGINT) AS t, 9223372036854775807 AS seq, TRUE AS matched, CASE WHEN named THEN uid ELSE 0 END,
           t_open, CASE WHEN named THEN name ELSE '' END, size, TRUE
    FROM o WHERE has_open AND has_xfr AND t_open + 10 <= {AS_OF} AND {AS_OF} - t_open > {TTL}
      AND NOT (has_close AND t_close <= {AS_OF})),
{ENTRIES.replace('ent AS (', 'ent_all AS (')}, ent AS (SELECT * FROM ent_all WHERE mt <= {AS_OF}),
{_found()}, {MESSAGES.replace('msg AS (', 'msg_all AS (').replace('lease(srv', f'msg AS (SELECT * FROM msg_all WHERE mt <= {AS_OF}),' + chr(10) + 'lease(srv')}, {ENRICHED}, {PUBLISHED}"""

# The same with opens given up at the end of their time when something comes after it.
_LATE = f"has_open AND has_close AND t_close - t_open > {TTL}"
_SWEPT = f"""WITH RECURSIVE {ORDERS}, {CLOSES.replace('has_open AS matched', f'has_open AND t_close - t_open <= {TTL} AS matched').replace('st AS (', 'st0 AS (')},
st AS (
    SELECT * FROM st0
    UNION ALL
    SELECT * REPLACE (k * 10 AS rd, k AS rv, 0 AS wr, FALSE AS has_ops),
           t_open + {TTL} AS t, {_seq('t_close', 6, 'k')} AS seq, TRUE AS matched, CASE WHEN named THEN uid ELSE 0 END,
           t_open, CASE WHEN named THEN name ELSE '' END, size, TRUE
    FROM o WHERE {_LATE} AND has_xfr),
{ENTRIES}, {_found()}, {MESSAGES}, {ENRICHED}, {PUBLISHED}"""
_GIVEN_UP = f"""{_BASE}
    SELECT file_id, matched AND t - t_open <= {TTL} AS is_open_known, CASE WHEN matched AND t - t_open <= {TTL} THEN t_open ELSE t END AS open_time,
           t AS close_time, rd AS read, rv AS readv
    FROM cl
    UNION ALL
    SELECT file_id, TRUE, t_open, t_open + {TTL}, k * 10, k FROM o WHERE {_LATE} AND has_xfr"""
_STREAMED = """
    SELECT file_id, t AS close_time, 'u' || u AS "user", vo, appinfo, site, filename, coalesce(file_size, -1) AS filesize,
           logical_dirname, rd AS read, is_wlcg
    FROM pub"""
_TRANSFERS = """
    SELECT file_id, open_time * 1000 AS start_time, t * 1000 AS end_time, t - open_time AS operation_time,
           CAST(matched AS BIGINT) AS "HasFileCloseMsg", server_hostname, site, 'u' || u AS "user", vo, appinfo, filename,
           coalesce(file_size, -1) AS filesize, logical_dirname, rd AS read, rv AS readv, wr AS write,
           CASE WHEN has_ops THEN n + n % 3 END AS read_operations, is_wlcg
    FROM pub"""

_CODE_CASE = "CASE event_type " + " ".join(f"WHEN '{t}' THEN '{c}'" for t, c in CODES.items()) + " END"
SEQUENCES = f"""
num AS (
    SELECT event_id AS e, user_id % 4 AS src, event_type, {_CODE_CASE} AS code,
           row_number() OVER (PARTITION BY user_id % 4, event_type ORDER BY event_id) AS rn
    FROM events),
sq AS (
    SELECT e, src, code, CASE WHEN e % 46 = 0 THEN (rn + 250) % 256 WHEN e % 23 = 0 THEN (rn + 255) % 256
                              ELSE rn % 256 END AS pseq
    FROM num WHERE e % 19 <> 0),
lg AS (SELECT *, lag(pseq) OVER (PARTITION BY src, code ORDER BY e) AS prev FROM sq),
ex AS (SELECT *, prev IS NULL AS is_first, CASE WHEN prev IS NULL THEN pseq ELSE (prev + 1) % 256 END AS expected FROM lg),
gp AS (SELECT *, CASE WHEN pseq < expected THEN pseq + 255 - expected ELSE pseq - expected END AS gap FROM ex),
sg AS (
    SELECT e AS arrival_seq, src, code, pseq, is_first, expected, CASE WHEN gap < 253 THEN gap ELSE 0 END AS missing,
           CASE WHEN gap >= 253 THEN 1 ELSE 0 END AS reordered
    FROM gp)"""

EVENTS = f"""
ev AS (
    SELECT event_id AS e, event_id // 3 AS g, (event_id // 3) % 8 AS srv, event_id % 3 AS line_idx, user_id, event_type,
           CAST(round(value * 100) AS BIGINT) AS amount, CAST(floor(epoch(ts)) AS BIGINT) AS ts,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS kk,
           {_list(PREFIXES)}[CAST(event_id % 16 + 1 AS INT)] || '/' || event_id AS lfn, (event_id // 3) % 2 = 0 AS is_cache,
           {_seq(f'{T0} + event_id // 3', 8, 'event_id // 3')} AS arrival_seq
    FROM events)"""
_HOSTNAME = "CASE WHEN srv < 6 THEN 'xrd' || srv || '.site' || srv || '.org' ELSE '10.0.0.' || srv END"
_SITE = "CASE WHEN srv < 6 THEN 'T2_' || srv ELSE '' END"
_VO = """CASE WHEN starts_with(lfn, '/user') OR starts_with(lfn, '/osgconnect/public') THEN 'osg'
    WHEN starts_with(lfn, '/pnfs/fnal.gov/usr') THEN 'fermilab' WHEN starts_with(lfn, '/hcc') THEN 'hcc'
    WHEN starts_with(lfn, '/gwdata') THEN 'gwdata' WHEN starts_with(lfn, '/chtc/') THEN 'chtc'
    WHEN starts_with(lfn, '/icecube/') THEN 'icecube' ELSE 'noVO' END"""
_CACHE_WLCG = "(starts_with(lfn, '/store') OR starts_with(lfn, '/user/dteam'))"
# The path of a page's URL: what follows the host, up to a question mark or hash.
_URL_PATH = "ltrim(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/')"
_COPY_WLCG = f"(page_id % 3 = 0 OR starts_with({_URL_PATH}, 'store') OR starts_with({_URL_PATH}, 'user/dteam'))"

_COUNTERS = ", ".join(f"(event_id * {f}) % 5000 AS {name}" for name, f in COUNTER_FACTORS.items())
_RESTART = list(COUNTER_FACTORS)[:13]
REPORTS = f"""
rp AS (
    SELECT event_id AS e, user_id AS pid, '10.1.0.' || user_id % 16 AS addr, event_id % 37 <> 0 AS has_site,
           CAST(floor(epoch(ts)) AS BIGINT) - CASE WHEN event_id % 7 = 0 THEN 172800 ELSE 0 END AS tod, {_COUNTERS}
    FROM events WHERE event_id % 31 <> 0),
wl AS (
    SELECT *, max(tod) OVER (PARTITION BY addr, pid ORDER BY e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest
    FROM rp WHERE has_site),
ok AS (SELECT * FROM wl WHERE newest IS NULL OR tod >= newest)"""
_ISO = "strftime(make_timestamp(CAST({t} AS BIGINT) * 1000000), '%Y-%m-%dT%H:%M:%S')"
_SITE_NAME = "CASE WHEN has_site THEN 'S' || pid % 8 ELSE 'UnknownSite' END"


def _delta(name: str) -> str:
    d = f"({name} - lag({name}) OVER w)"
    return f"CASE WHEN {d} < 0 THEN {name} ELSE {d} END AS {name}" if name in _RESTART else f"{d} AS {name}"


_DELTAS = f"""
dl AS (
    SELECT e, addr, pid, tod, has_site, lag(e) OVER w AS earlier, {', '.join(_delta(n) for n in COUNTER_FACTORS)}
    FROM ok WINDOW w AS (PARTITION BY addr, pid ORDER BY e)),
sr AS (
    SELECT e AS arrival_seq, addr, pid, {_ISO.format(t='tod')} AS timestamp, {_SITE_NAME} AS site, e % 100 AS link_num,
           {', '.join(COUNTER_FACTORS)}
    FROM dl WHERE earlier IS NOT NULL
    UNION ALL
    SELECT e, addr, pid, {_ISO.format(t='tod')}, 'UnknownSite', NULL, {', '.join('NULL' for _ in COUNTER_FACTORS)}
    FROM rp WHERE NOT has_site)"""

# One row per packet of the transfer feed.
PACKETS = f"""
pk AS (
    SELECT {_seq('t_user', 1, 'k')} AS arrival_seq, srv, 'u' AS code, k % 256 AS pseq, t_user AS t FROM o WHERE has_user
    UNION ALL SELECT {_seq('t_user', 2, 'k')}, srv, 'i', k % 256, t_user FROM o WHERE has_app
    UNION ALL SELECT {_seq('t_open - 1', 3, 'k')}, srv, 'd', k % 256, t_open - 1 FROM o WHERE has_path
    UNION ALL SELECT {_seq('t_open', 4, 'k')}, srv, 'f', k % 256, t_open FROM o WHERE has_open
    UNION ALL SELECT {_seq('t_open + 10', 5, 'k')}, srv, 'f', k % 256, t_open + 10 FROM o WHERE has_xfr
    UNION ALL SELECT {_seq('t_close', 6, 'k')}, srv, 'f', k % 256, t_close FROM o WHERE has_close
    UNION ALL SELECT {_seq('t_close + 60', 6, 'k')}, srv, 'f', k % 256, t_close + 60 FROM o WHERE has_close AND k % 29 = 0
    UNION ALL SELECT {_seq('t_close + 1', 7, 'k')}, srv, 'f', k % 256, t_close + 1 FROM o WHERE k % 50 = 0
    UNION ALL SELECT {_seq('1600000000', 0, 'srv')}, srv, '=', srv, 1600000000
    FROM (SELECT CAST(n_nationkey AS BIGINT) AS srv FROM nation WHERE n_nationkey <= 6))"""

# Sweeps of a collector: each the first packet more than five minutes after the one before.
_SWEEPS = f"""{PACKETS},
arr AS (SELECT t, min(arrival_seq) AS seq FROM pk GROUP BY t),
sw(t) AS (SELECT min(t) FROM arr UNION ALL SELECT min(arr.t) FROM sw JOIN arr ON arr.t > sw.t + 300 GROUP BY sw.t),
sweep AS (SELECT arr.* FROM arr SEMI JOIN (SELECT t FROM sw WHERE t > (SELECT min(t) FROM arr)) USING (t))"""
_SWEEP_TRANSFERS = f"""WITH RECURSIVE {ORDERS}, {CLOSES}, {_SWEEPS},
old AS (SELECT o.*, s.t AS swept, s.seq AS swept_seq FROM (SELECT * FROM o WHERE has_open) o ASOF LEFT JOIN sweep s ON t_open + {TTL} < s.t),
gone AS (SELECT * FROM old WHERE swept IS NOT NULL AND (NOT has_close OR swept_seq < {_seq('t_close', 6, 'k')}))
    SELECT cl.file_id, matched AND gone.k IS NULL AS is_open_known, CASE WHEN matched AND gone.k IS NULL THEN cl.t_open ELSE t END AS open_time,
           t AS close_time, cl.rd AS read, cl.rv AS readv
    FROM cl LEFT JOIN gone USING (k)
    UNION ALL
    SELECT file_id, TRUE, t_open, swept, k * 10, k FROM gone WHERE has_xfr"""

_STATS_WHEN_OPS = ", ".join(f"CASE WHEN has_ops THEN {v} END AS {n}" for n, v in STATS.items())


def _wlcg_stat(name: str) -> str:
    return "0" if name in NEVER_MEASURED else f"CASE WHEN has_ops THEN {STATS[name]} ELSE 0 END"


assert set(WLCG_STATS) == set(STATS) | NEVER_MEASURED

_FLAGSHIP = f"""{_PUB}
SELECT coalesce(site, 'unknown') AS site, coalesce(vo, 'none') AS vo, logical_dirname, count(*) AS transfers,
       CAST(sum(rd + rv) AS BIGINT) AS read_bytes, CAST(sum(wr) AS BIGINT) AS write_bytes,
       CAST(sum(t - open_time) AS BIGINT) AS seconds
FROM pub GROUP BY 1, 2, 3"""

def _document(fields: dict[str, str]) -> str:
    """SQL for a JSON document of these fields, each an expression of its JSON text, or NULL if it is left out."""
    parts = ", ".join(f"""'"{name}":' || ({value})""" for name, value in fields.items())
    return f"'{{' || concat_ws(',', {parts}) || '}}'"


def _quoted(value: str) -> str:
    return f"""'"' || ({value}) || '"'"""


def _meta(kind: str, is_wlcg: str) -> str:
    known = f'{{"host":"collector","producer":"cms-xrootd-cache","timestamp":0,"type":"{kind}","type_prefix":"raw"}}'
    return f"CASE WHEN {is_wlcg} THEN '{known}' END"


_CACHE_DOCUMENT = _document({
    "file_path": _quoted("lfn"), "block_size": "'1048576'", "numbers_blocks": "user_id", "numbers_blocks_done": "user_id // 2", "access_count": "kk",
    "attach_time": "ts", "detach_time": "ts + kk", "bytes_hit_cache": "amount", "bytes_miss_cache": "amount * 2", "bytes_bypass_cache": "amount * 3",
    "bytes_to_disk": "amount * 4", "bytes_by_prefetch": "amount * 5", "numbers_checksum_errors": "CASE WHEN e % 3 = 0 THEN e % 5 END",
    "remotes_origin": """CASE WHEN e % 2 = 1 THEN '["r1"]' ELSE '""' END""", "sid": _quoted(_sid("srv")), "server_ip": _quoted("'10.0.0.' || srv"),
    "server_hostname": _quoted(_HOSTNAME), "site": _quoted(_SITE), "vo": _quoted(_VO), "bytes_read_by_remote": "amount * 7",
    "bytes_explicit_remote_read": "amount * 2", "metadata": _meta("metric", _CACHE_WLCG),
})
_COPY_DOCUMENT = _document({
    "tpc_protocol": """'"https"'""", "client": _quoted("'c' || page_id"), "source": _quoted("url"),
    "destination": _quoted("CASE WHEN page_id % 3 = 0 THEN 'root://h:1094//store/' || page_id ELSE 'davs://h/data/' || page_id END"),
    "size": "length(html)",
    "xeq": _document({
        "begin_transfer": _quoted("'b' || page_id"), "end_transfer": _quoted("'e' || page_id"),
        "flow_direction": _quoted("CASE WHEN page_id % 2 = 0 THEN 'pull' ELSE 'push' END"), "ip_version": "page_id % 2 * 2 + 4",
        "return_code": "page_id % 3", "used_streams": "page_id % 4 + 1",
    }),
    "metadata": _meta("tpc", _COPY_WLCG),
})
_TCP_DOCUMENT = _document({
    "event_type": _quoted("event_type"), "value": "amount", "user_id": "user_id", "from": _quoted("'10.0.0.' || srv"), "hostname": _quoted(_HOSTNAME),
})

ORACLE: dict[str, str] = {
    "q_flagship": _FLAGSHIP,
    "q_pushed_unwrap": """
        SELECT event_id AS arrival_seq, CASE WHEN event_id % 5 = 0 THEN '[::1]' ELSE '10.0.0.' || user_id % 4 END AS addr,
               '1094' AS port, CAST(12 AS BIGINT) AS length
        FROM events WHERE event_id % 19 <> 0""",
    "q_header": f"""WITH {ORDERS}, {PACKETS}
        SELECT arrival_seq, {_sid('srv')} AS sid, code, pseq, 1600000000 + srv AS server_start, TRUE AS length_ok FROM pk""",
    "q_dispatch": f"""WITH {ORDERS}, {PACKETS}, allp AS (
            SELECT code FROM pk
            UNION ALL SELECT '=' FROM nation WHERE n_nationkey <= 6
            UNION ALL SELECT 'g' FROM (SELECT DISTINCT event_id // 3 FROM events)
            UNION ALL SELECT 'g' FROM pages)
        SELECT code, CASE code WHEN 'f' THEN 'fstream' WHEN 'g' THEN 'gstream' WHEN 'u' THEN 'user' WHEN 'i' THEN 'app'
                               WHEN 'd' THEN 'path' ELSE 'server' END AS kind, count(*) AS n
        FROM allp GROUP BY 1, 2""",
    "q_length_check": """
        SELECT event_id AS arrival_seq, CAST(13 AS BIGINT) AS plen FROM events WHERE event_id % 17 = 0 AND event_id % 19 <> 0""",
    "q_fstream_open": f"""{_BASE}
        SELECT file_id, t_open AS t_beg, CAST(named AS BIGINT) AS rec_flag, size AS file_size,
               CASE WHEN named THEN uid ELSE 0 END AS user_id, CASE WHEN named THEN name ELSE '' END AS file_name
        FROM o WHERE has_open""",
    "q_fstream_close": f"""{_BASE}
        SELECT file_id, t AS t_beg, CASE WHEN has_ops THEN 2 ELSE 0 END AS rec_flag, rd AS read, rv AS readv, wr AS write,
               CASE WHEN has_ops THEN n END AS ops_read, CASE WHEN has_ops THEN n % 3 END AS ops_readv,
               CASE WHEN has_ops THEN n % 2 END AS ops_write, CASE WHEN has_ops THEN 1 END AS "ops_rsMin",
               CASE WHEN has_ops THEN n END AS "ops_rsMax", CASE WHEN has_ops THEN n * 2 END AS ops_rsegs,
               CASE WHEN has_ops THEN q_min END AS "ops_rdMin", CASE WHEN has_ops THEN q_max END AS "ops_rdMax",
               CASE WHEN has_ops THEN 1 END AS "ops_rvMin", CASE WHEN has_ops THEN n END AS "ops_rvMax",
               CASE WHEN has_ops THEN 0 END AS "ops_wrMin", CASE WHEN has_ops THEN line_max END AS "ops_wrMax"
        FROM cl""",
    "q_fstream_xfr": f"""{_BASE}
        SELECT file_id, t_open + 10 AS t_beg, k * 10 AS read, k AS readv, 0 AS write FROM o WHERE has_xfr""",
    "q_fstream_time": f"""WITH {ORDERS}, {PACKETS}
        SELECT arrival_seq, 0 AS xfr_recs, 1 AS total_recs, t AS t_beg, t + 1 AS t_end, srv AS source_sid
        FROM pk WHERE code = 'f'""",
    "q_fstream_disc": f"""{_BASE}
        SELECT {_seq('t_close + 1', 7, 'k')} AS arrival_seq, t_close + 1 AS t_beg, uid AS user_id FROM o WHERE k % 50 = 0""",
    "q_user_ident": f"""{_BASE}
        SELECT {_seq('t_user', 1, 'k')} AS arrival_seq, uid AS dict_id, 'xroot' AS protocol, 'u' || u AS username, u AS pid,
               srv AS user_sid, {HOST_NAME.format(u='u')} AS host
        FROM o WHERE has_user""",
    "q_auth": f"""{_BASE}
        SELECT {_seq('t_user', 1, 'k')} AS arrival_seq, '' AS ap, '' AS dn, '' AS hn, vo AS "on", '' AS rn, '' AS gn,
               '/DC=org/CN=User ' || u || '::x' AS info, '' AS execname, '' AS moninfo, inetv
        FROM o WHERE has_user""",
    "q_server_info": f"""WITH {ORDERS}, {PACKETS}
        SELECT {_sid('srv')} AS sid, count(*) AS packets, CASE WHEN srv < 7 THEN 'xrootd' END AS program,
               CASE WHEN srv < 7 THEN 'v5.5' END AS version, CASE WHEN srv < 7 THEN 'inst' || srv END AS instance,
               CASE WHEN srv < 7 THEN '1094' END AS port, CASE WHEN srv < 6 THEN 'T2_' || srv END AS site
        FROM pk GROUP BY srv""",
    "q_app_info": f"""{_BASE}
        SELECT {_seq('t_user', 2, 'k')} AS arrival_seq, uid AS dict_id, 'u' || u AS username, app AS appinfo
        FROM o WHERE has_app""",
    "q_path_info": f"""{_BASE}
        SELECT {_seq('t_open - 1', 3, 'k')} AS arrival_seq, file_id AS dict_id, 'u' || u AS username, name AS path
        FROM o WHERE has_path""",
    "q_purge": f"""
        SELECT {_seq(str(T0), 8, 'p_partkey')} AS arrival_seq, '/purged/' || p_partkey AS xfn,
               CAST(p_partkey + {T0} AS VARCHAR) AS tod, CAST(p_size * 1000 AS VARCHAR) AS sz, '1' AS "at", '2' AS ct, '3' AS mt,
               'p' || p_partkey AS fn
        FROM part""",
    "q_staging": f"""
        SELECT {_seq(str(T0), 9, 's_suppkey')} AS arrival_seq, '/staged/' || s_suppkey AS lfn,
               CAST(s_suppkey + {T0} AS VARCHAR) AS tod, CAST(s_suppkey * 1000 AS VARCHAR) AS sz,
               CAST(s_suppkey % 60 AS VARCHAR) AS tm, 'g' AS op, '0' AS rc,
               CASE WHEN s_suppkey % 2 = 0 THEN 'd' || s_suppkey ELSE '' END AS pd
        FROM supplier""",
    "q_stitch": f"""{_BASE}
        SELECT file_id, t AS close_time, matched AS is_open_known, user_id, open_time, open_name, file_size, rd AS read,
               wr AS write
        FROM st""",
    "q_stitch_ttl": f"""{_BASE}, tt AS (SELECT *, matched AND t - t_open <= {TTL} AS live FROM cl)
        SELECT file_id, t AS close_time, live AS is_open_known, CASE WHEN live AND named THEN uid ELSE 0 END AS user_id,
               CASE WHEN live THEN t_open ELSE t END AS open_time
        FROM tt""",
    "q_progress": f"""{_BASE}
        SELECT file_id, {_seq('t_open', 4, 'k')} AS open_seq, t_open + 10 AS t_beg, k * 10 AS read, k AS readv, 0 AS write,
               CAST(1 AS BIGINT) AS n_progress
        FROM o WHERE has_xfr AND has_open""",
    "q_given_up": _GIVEN_UP,
    "q_stream_given_up": _GIVEN_UP,
    "q_sweep_times": f"""WITH RECURSIVE {ORDERS}, {_SWEEPS}
        SELECT t AS sweep_time, seq AS arrival_seq FROM sweep""",
    "q_sweep_transfers": _SWEEP_TRANSFERS,
    "q_transfers_swept": f"""{_SWEPT}{_TRANSFERS}""",
    "q_hot_keys": f"""{_AT}{_TRANSFERS}""",
    "q_hot_keys_expired": f"""{_AT}{_TRANSFERS} WHERE seq = 9223372036854775807""",
    "q_wlcg_documents": f"""{_PUB}
        SELECT coalesce(site, '') AS site_name, TRUE AS fallback, coalesce(user_dn, '') AS user_dn,
               coalesce(host, '') AS client_host,
               coalesce(CASE WHEN NOT starts_with(host, 'f') THEN array_to_string(string_split(host, '.')[-2:], '.') END, '')
                   AS client_domain,
               server_hostname AS server_host, array_to_string(string_split(server_hostname, '.')[-2:], '.') AS server_domain,
               CAST(NULL AS VARCHAR) AS server_hostname, '10.0.0.' || srv AS server_ip, filename AS file_lfn,
               CASE WHEN file_size IS NULL THEN '"-1"' ELSE CAST(file_size AS VARCHAR) END AS file_size, rd + rv AS read_bytes,
               rv AS read_vector_bytes, wr AS write_bytes,
               coalesce(ipv6, FALSE) AS ipv6, 'User ' || u AS "user", open_time * 1000 AS start_time, t * 1000 AS end_time,
               t - open_time AS operation_time, 'read' AS operation, coalesce(site, '') AS server_site,
               CASE WHEN u IS NOT NULL THEN 'xroot' END AS user_protocol, vo, 'cms' AS producer, 'aaa-ng' AS type,
               'raw' AS type_prefix, 'collector' AS host,
               {", ".join(f"CAST({_wlcg_stat(name)} AS DOUBLE) AS {name}" for name in sorted(WLCG_STATS))}
        FROM pub WHERE is_wlcg""",
    "q_dead_letters": f"""
        SELECT event_id AS arrival_seq,
               CASE event_id % 8 WHEN 0 THEN 'header' WHEN 1 THEN 'map header' WHEN 2 THEN 'time record' WHEN 3 THEN 'event header'
                    WHEN 4 THEN 'identity' WHEN 7 THEN 'envelope' ELSE 'report' END AS reason,
               hex(encode(CASE event_id % 8 WHEN 0 THEN 'x' || event_id % 10 WHEN 1 THEN CAST(event_id % 10 AS VARCHAR)
                    WHEN 2 THEN 'e' || event_id WHEN 3 THEN 'e' || event_id % 1000 WHEN 4 THEN '0000no identity of ' || event_id || ':1@h'
                    WHEN 5 THEN '<stat' || event_id
                    WHEN 6 THEN '<statistics tod="' || event_id || '" ver="v5" src="h:1" tos="1" pgm="xrootd" pid="7" site="S">'
                         || '<stats id="link"><num>1</num><tot>t' || event_id || '</tot></stats></statistics>'
                    ELSE '{{"remote": "h' || event_id || '", "da' END)) AS payload
        FROM events""",
    "q_expired": f"""{_BASE}
        SELECT file_id, TRUE AS has_close, CASE WHEN named THEN uid ELSE 0 END AS user_id, t_open AS open_time,
               CAST({AS_OF} AS BIGINT) AS close_time, CASE WHEN named THEN name ELSE '' END AS open_name, k * 10 AS read, k AS readv
        FROM o WHERE has_open AND has_xfr AND t_open + 10 <= {AS_OF} AND {AS_OF} - t_open > {TTL}
          AND NOT (has_close AND t_close <= {AS_OF})""",
    "q_dict_asof": f"""{_FOUND}
        SELECT file_id, t AS close_time, 'u' || fu AS username, {HOST_NAME.format(u='fu')} AS host FROM fd""",
    "q_path_fallback": f"""{_FOUND}
        SELECT file_id, t AS close_time, path, 'u' || fu AS username,
               CASE WHEN matched THEN coalesce(path, '') ELSE 'missing directory' END AS filename
        FROM fd WHERE user_id = 0""",
    "q_user_asof": f"""{_FOUND}, {MESSAGES.split('lease(srv')[0].rstrip().rstrip(',')},
        a1 AS (SELECT f.* EXCLUDE (vo, inetv), x.mvo, x.minetv FROM fd f
               ASOF LEFT JOIN (SELECT * FROM msg WHERE mvo IS NOT NULL) x
               ON f.srv = x.srv AND f.fu = x.u AND f.seq > x.mseq)
        SELECT f.file_id, f.t AS close_time, CASE WHEN f.mvo IS NOT NULL THEN 'u' || f.fu END AS username, f.mvo AS "on",
               f.minetv AS inetv, x.mapp AS appinfo
        FROM a1 f ASOF LEFT JOIN (SELECT * FROM msg WHERE mapp IS NOT NULL) x
        ON f.srv = x.srv AND f.fu = x.u AND f.seq > x.mseq""",
    "q_user_lease": f"""{_FULL}
        SELECT file_id, t AS close_time, 'u' || u AS username, vo_raw AS "on", inetv, appinfo FROM en""",
    "q_server": f"""{_BASE}
        SELECT file_id, t AS close_time, CASE WHEN srv < 7 THEN {_sid('srv')} END AS server_id, '10.0.0.' || srv AS server,
               CASE WHEN srv < 6 THEN 'T2_' || srv WHEN srv = 6 THEN '' END AS site
        FROM cl""",
    "q_host": f"""{_BASE}
        SELECT file_id, t AS close_time, '10.0.0.' || srv AS addr, {_HOSTNAME} AS server_hostname FROM cl""",
    "q_host_asof": f"""WITH RECURSIVE {ORDERS}, {CLOSES},
        looked(srv, t) AS (
            SELECT srv, min(t) FROM cl GROUP BY 1
            UNION ALL SELECT l.srv, min(c.t) FROM looked l JOIN cl c ON c.srv = l.srv AND c.t > l.t + 86400 GROUP BY l.srv, l.t),
        named AS (SELECT *, least(6, floor((t - {T0} - srv * 1000) / 30000)) AS d FROM looked)
        SELECT c.file_id, c.t AS close_time, '10.0.0.' || c.srv AS addr,
               CASE WHEN c.srv < 6 AND n.d >= 0 THEN 'xrd' || c.srv || '-' || CAST(n.d AS BIGINT) || '.site' || c.srv || '.org'
                    ELSE '10.0.0.' || c.srv END AS server_hostname
        FROM cl c ASOF JOIN named n ON c.srv = n.srv AND c.t >= n.t""",
    "q_disconnects": f"""{_BASE}, {ENTRIES.replace('ent AS (', 'ent0 AS (')},
        ent AS (SELECT * FROM ent0 UNION ALL
                SELECT srv, uid, {_seq('t_close + 1', 7, 'k')}, t_close + 1, NULL, NULL FROM o WHERE k % 50 = 0), {_found()}
        SELECT file_id, t AS close_time, 'u' || fu AS username FROM fd""",
    "q_first_seen": f"""WITH {SEQUENCES}
        SELECT {_sid('src')} AS sid, code, arg_min(pseq, arrival_seq) AS pseq, min(arrival_seq) AS arrival_seq
        FROM sg GROUP BY src, code""",
    "q_times": f"""{_BASE}
        SELECT file_id, t * 1000 AS timestamp, open_time * 1000 AS start_time, t * 1000 AS end_time, t - open_time AS operation_time
        FROM st""",
    "q_dirs": f"""{_PUB}
        SELECT file_id, t AS close_time, filename, coalesce(file_size, -1) AS filesize,
               CASE WHEN matched THEN {_levels('filename', 2)} END AS dirname1,
               CASE WHEN matched THEN {_levels('filename', 3)} END AS dirname2
        FROM pub""",
    "q_logical_dirname": f"{_PUB} SELECT file_id, t AS close_time, logical_dirname FROM pub",
    "q_user_fields": f"""{_PUB}
        SELECT file_id, t AS close_time, 'u' || u AS "user", host,
               CASE WHEN NOT regexp_matches(host, '^[\\[:f0-9.]') THEN array_to_string(string_split(host, '.')[-2:], '.') END
                   AS user_domain,
               CASE WHEN u IS NOT NULL THEN 'xroot' END AS protocol
        FROM pub""",
    "q_auth_fields": f"{_PUB} SELECT file_id, t AS close_time, ipv6, user_dn, vo FROM pub",
    "q_io_stats": f"{_BASE} SELECT file_id, t AS close_time, {_STATS_WHEN_OPS} FROM cl",
    "q_route": f"""{_PUB}
        SELECT is_wlcg, coalesce(vo, 'none') AS vo, logical_dirname, count(*) AS n FROM pub GROUP BY 1, 2, 3""",
    "q_wlcg": f"""{_PUB}
        SELECT file_id, coalesce(site, '') AS site_name, TRUE AS fallback, coalesce(user_dn, '') AS user_dn,
               coalesce(host, '') AS client_host,
               coalesce(CASE WHEN NOT starts_with(host, 'f') THEN array_to_string(string_split(host, '.')[-2:], '.') END, '')
                   AS client_domain,
               server_hostname AS server_host, array_to_string(string_split(server_hostname, '.')[-2:], '.') AS server_domain,
               CAST(NULL AS VARCHAR) AS server_hostname, '10.0.0.' || srv AS server_ip, filename AS file_lfn,
               coalesce(file_size, -1) AS file_size, rd + rv AS read_bytes,
               {_wlcg_stat('read_single_bytes')} AS read_single_bytes, rv AS read_vector_bytes, wr AS write_bytes,
               coalesce(ipv6, FALSE) AS ipv6, 'User ' || u AS "user", open_time * 1000 AS start_time, t * 1000 AS end_time,
               t - open_time AS operation_time, 'read' AS operation, coalesce(site, '') AS server_site,
               CASE WHEN u IS NOT NULL THEN 'xroot' END AS user_protocol, vo, {_wlcg_stat('read_average')} AS read_average,
               {_wlcg_stat('read_sigma')} AS read_sigma, {_wlcg_stat('write_max')} AS write_max, 'cms' AS producer,
               'aaa-ng' AS type, 'raw' AS type_prefix, 'collector' AS host
        FROM pub WHERE is_wlcg""",
    "q_crab": f"""{_FULL}
        SELECT file_id, t AS close_time, string_split(appinfo, '_')[1] AS "CRAB_Id", string_split(appinfo, '_')[3] AS "CRAB_Retry",
               string_split(string_split(appinfo, '_')[2], '/')[-1] AS "CRAB_Workflow"
        FROM en WHERE appinfo IS NOT NULL""",
    "q_transfers": f"""{_AT}{_TRANSFERS}""",
    "q_cache_events": f"""WITH {EVENTS}
        SELECT {_sid('srv')} AS sid, arrival_seq, line_idx, '10.0.0.' || srv AS server_ip, {_HOSTNAME} AS server_hostname,
               {_SITE} AS site, lfn AS file_path, CAST(1048576 AS BIGINT) AS block_size, user_id AS numbers_blocks,
               user_id // 2 AS numbers_blocks_done, kk AS access_count, ts AS attach_time, ts + kk AS detach_time,
               amount AS bytes_hit_cache, amount * 2 AS bytes_miss_cache, amount * 3 AS bytes_bypass_cache,
               amount * 4 AS bytes_to_disk, amount * 5 AS bytes_by_prefetch,
               CASE WHEN e % 3 = 0 THEN e % 5 END AS numbers_checksum_errors, CASE WHEN e % 2 = 1 THEN 'r1' END AS remotes_origin,
               amount * 7 AS bytes_read_by_remote, amount * 2 AS bytes_explicit_remote_read, {_VO} AS vo, {_CACHE_WLCG} AS is_wlcg
        FROM ev WHERE is_cache""",
    "q_tpc_events": f"""
        SELECT {_seq(f'{T0} + page_id', 9, 'page_id')} AS arrival_seq, 'https' AS tpc_protocol, 'c' || page_id AS client,
               url AS source,
               CASE WHEN page_id % 3 = 0 THEN 'root://h:1094//store/' || page_id ELSE 'davs://h/data/' || page_id END AS destination,
               length(html) AS size, 'b' || page_id AS begin_transfer, 'e' || page_id AS end_transfer,
               page_id % 2 * 2 + 4 AS ip_version, page_id % 3 AS return_code, page_id % 4 + 1 AS used_streams,
               CASE WHEN page_id % 2 = 0 THEN 'pull' ELSE 'push' END AS flow_direction, {_COPY_WLCG} AS is_wlcg
        FROM pages""",
    "q_tcp_events": f"""WITH {EVENTS}
        SELECT arrival_seq, line_idx, '10.0.0.' || srv AS "from", {_HOSTNAME} AS hostname, event_type, amount AS value, user_id
        FROM ev WHERE NOT is_cache""",
    "q_event_documents": f"""WITH {EVENTS}
        SELECT CASE WHEN {_CACHE_WLCG} THEN 'xrd.cache.wlcg' ELSE 'xrd.cache.stash' END AS exchange, 'file-close' AS routing_key,
               {_CACHE_DOCUMENT} AS value FROM ev WHERE is_cache
        UNION ALL SELECT CASE WHEN {_COPY_WLCG} THEN 'xrd.tpc.wlcg' ELSE 'xrd.tpc' END, 'tpc', {_COPY_DOCUMENT} FROM pages
        UNION ALL SELECT 'xrd.tcp_exchange', 'tcp-event', {_TCP_DOCUMENT} FROM ev WHERE NOT is_cache""",
    "q_vo_path": f"""WITH {EVENTS}
        SELECT {_VO} AS vo, {_logical('lfn', 'lfn')} AS logical_dirname, {_CACHE_WLCG} AS is_wlcg, count(*) AS n
        FROM ev WHERE is_cache GROUP BY 1, 2, 3""",
    "q_sequence": f"""WITH {SEQUENCES}
        SELECT arrival_seq, pseq, is_first, expected, missing, reordered FROM sg""",
    "q_summary_fields": f"""WITH {REPORTS}
        SELECT has_site, e AS arrival_seq, 'summary' AS type, addr AS server_ip, pid, 'v5.5' AS version,
               {_ISO.format(t='tod')} AS timestamp, '2023-11-14T22:13:20' AS tos, {_ISO.format(t='tod')} AS cstart,
               {_SITE_NAME} AS site, CASE WHEN has_site THEN 'h' || pid % 16 END AS host,
               CASE WHEN has_site THEN e % 100 END AS link_num, CASE WHEN has_site THEN e % 10 END AS sched_in_queue,
               CASE WHEN has_site THEN e % 50 END AS sched_threads, CASE WHEN has_site THEN e % 20 END AS sched_idle_threads,
               CASE WHEN has_site THEN e % 3 END AS sgen_as, CASE WHEN has_site THEN {_ISO.format(t='tod + 1')} END AS cend,
               {', '.join(f'CASE WHEN has_site THEN {n} ELSE 0 END AS {n}' for n in COUNTER_FACTORS)}
        FROM rp""",
    "q_summary_late": f"WITH {REPORTS} SELECT e AS arrival_seq, addr, pid, tod FROM ok",
    "q_summary_deltas": f"WITH {REPORTS}, {_DELTAS} SELECT * FROM sr",
    "q_metrics": f"""{_PUB}, {PACKETS}, {SEQUENCES}, {EVENTS},
        hs AS (SELECT CASE WHEN src < 6 THEN 'xrd' || src || '.site' || src || '.org' ELSE '10.0.0.' || src END AS label,
                      sum(missing) AS missing, sum(reordered) AS reordered FROM sg GROUP BY 1)
        SELECT 'packets' AS metric, '' AS label, count(*) AS value FROM pk
        UNION ALL SELECT 'pushed_messages', '', count(*) FROM sq
        UNION ALL SELECT 'missing_packets', label, CAST(missing AS BIGINT) FROM hs WHERE missing > 0
        UNION ALL SELECT 'reordered_packets', label, CAST(reordered AS BIGINT) FROM hs WHERE reordered > 0
        UNION ALL SELECT 'gstream_message', '', (SELECT count(DISTINCT g) FROM ev) + (SELECT count(*) FROM pages)
        UNION ALL SELECT 'gstream_event_cache', '', count(*) FROM ev WHERE is_cache
        UNION ALL SELECT 'gstream_message_tpc', '', count(*) FROM pages
        UNION ALL SELECT 'failed_user', '', count(*) FROM pub WHERE u IS NULL
        UNION ALL SELECT 'failed_filename', '', count(*) FROM pub WHERE filename = 'missing directory'
        UNION ALL SELECT 'messages_sent', CASE WHEN is_wlcg THEN 'wlcg' ELSE 'stashcache' END, count(*) FROM pub GROUP BY 1, 2""",
    "q_state_sizes": f"""WITH RECURSIVE {ORDERS}, {ENTRIES}, {MESSAGES},
        de AS (SELECT srv, dict, max(mt) AS mt FROM ent WHERE mt <= {AS_OF} GROUP BY 1, 2),
        us AS (SELECT srv, u, max(s) AS s FROM lease WHERE s <= {AS_OF} GROUP BY 1, 2)
        SELECT 'hash_size' AS metric, 'dictid' AS label, count(*) AS value FROM de WHERE {AS_OF} - mt <= {TTL}
        UNION ALL SELECT 'hash_size', 'users', count(*) FROM us WHERE {AS_OF} - s <= {TTL}
        UNION ALL SELECT 'hash_size', 'transfers', count(*) FROM o
        WHERE has_open AND t_open <= {AS_OF} AND {AS_OF} - t_open <= {TTL} AND NOT (has_close AND t_close <= {AS_OF})""",
    "q_idle": f"""WITH {SEQUENCES},
        ls AS (SELECT src, max(arrival_seq) + {T0} AS last_seen FROM sg GROUP BY 1)
        SELECT {_sid('src')} AS sid, last_seen FROM ls WHERE (SELECT max(last_seen) FROM ls) - last_seen > 2""",
    "q_routed_sink": f"""{_PUB}, {EVENTS}, {REPORTS}, {_DELTAS}
        SELECT CASE WHEN is_wlcg THEN 'xrd.wlcg_format' ELSE 'xrd.detailed' END AS exchange, 'file-close' AS routing_key,
               count(*) AS n FROM pub GROUP BY 1, 2
        UNION ALL SELECT CASE WHEN {_CACHE_WLCG} THEN 'xrd.cache.wlcg' ELSE 'xrd.cache.stash' END, 'file-close', count(*)
        FROM ev WHERE is_cache GROUP BY 1, 2
        UNION ALL SELECT 'xrd.tcp_exchange', 'tcp-event', count(*) FROM ev WHERE NOT is_cache
        UNION ALL SELECT CASE WHEN {_COPY_WLCG} THEN 'xrd.tpc.wlcg' ELSE 'xrd.tpc' END, 'tpc', count(*) FROM pages GROUP BY 1, 2
        UNION ALL SELECT 'xrd.detailed', 'summary', count(*) FROM sr""",
}

ORACLE |= {
    "q_stream_sequence": ORACLE["q_sequence"],
    "q_stream_sequence_hot": ORACLE["q_sequence"],
    "q_stream_sequence_keyed": ORACLE["q_sequence"],
    "q_stream_summaries": ORACLE["q_summary_deltas"],
    "q_stream_summaries_keyed": ORACLE["q_summary_deltas"],
    "q_stream_expiry": f"""{_PUB.replace('has_open AS matched', f'has_open AND t_close - t_open <= {TTL} AS matched')}{_STREAMED}""",
    "q_stream_transfers": f"""{_PUB}{_STREAMED}""",
    "q_stream_transfers_steps": f"""{_PUB}{_STREAMED}""",
    "q_stream_routed": f"""{_PUB}
        SELECT CASE WHEN is_wlcg THEN 'xrd.wlcg_format' ELSE 'xrd.detailed' END AS exchange, 'file-close' AS routing_key,
               count(*) AS n FROM pub GROUP BY 1, 2""",
    "q_stream_outputs": f"""{_PUB}, {EVENTS}
        SELECT 'transfers' AS output, CASE WHEN is_wlcg THEN 'xrd.wlcg_format' ELSE 'xrd.detailed' END || '/file-close' AS kind,
               count(*) AS n FROM pub GROUP BY 1, 2
        UNION ALL SELECT 'events', CASE WHEN {_CACHE_WLCG} THEN 'xrd.cache.wlcg' ELSE 'xrd.cache.stash' END || '/file-close', count(*)
        FROM ev WHERE is_cache GROUP BY 1, 2
        UNION ALL SELECT 'events', 'xrd.tcp_exchange/tcp-event', count(*) FROM ev WHERE NOT is_cache
        UNION ALL SELECT 'events', CASE WHEN {_COPY_WLCG} THEN 'xrd.tpc.wlcg' ELSE 'xrd.tpc' END || '/tpc', count(*) FROM pages GROUP BY 1, 2
        UNION ALL SELECT 'dead_letters', ['header', 'map header', 'time record', 'event header', 'identity'][event_id % 8 + 1], count(*)
        FROM events WHERE event_id % 8 < 5 GROUP BY 1, 2""",
    "q_stream_state_sizes": ORACLE["q_state_sizes"],
    "q_stream_metrics": f"""WITH {SEQUENCES}
        SELECT 'packets' AS metric, count(*) AS value FROM sg
        UNION ALL SELECT 'missing_packets', CAST(sum(missing) AS BIGINT) FROM sg
        UNION ALL SELECT 'reordered_packets', CAST(sum(reordered) AS BIGINT) FROM sg""",
}
ORACLE["q_stream_expiry_steps"] = ORACLE["q_stream_expiry"]
