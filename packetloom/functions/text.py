"""Parsers for the text part of map messages: identities, key-value lists, positional lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the wire format: letter on the wire -> field name.
AUTH_KEYS = {
    "p": "ap",
    "n": "dn",
    "h": "hn",
    "o": "on",
    "r": "rn",
    "g": "gn",
    "m": "info",
    "x": "execname",
    "y": "moninfo",
    "I": "inetv",
}
# Fixed values of the wire format: key on the wire -> field name.
SERVER_KEYS = {"pgm": "program", "ver": "version", "inst": "instance", "port": "port", "site": "site"}
# Order of the positional fields after the leading path.
PURGE_FIELDS = ["tod", "sz", "at", "ct", "mt", "fn"]
STAGING_FIELDS = ["tod", "sz", "tm", "op", "rc"]


# protocol / user . pid : sid @ host, cut at the first '/', the last '@', the first ':' and the last '.' before it.
_IDENT = r"(?s)^([^/]*)/(?:([^:]*)\.)?([^:.]*):(.*)@([^@]*)$"

# The usual form, which needs no search: one ':' and one '@' as far as it matters, and whole numbers that fit.
_PLAIN_IDENT = r"(?s)^[^/:@]*/[^:@]*\.[0-9]{1,18}:[0-9]{1,18}@[^@]*$"


def _integer(value: Column) -> Column:
    """Whole number with optional sign, blanks around and single underscores between digits; else NULL."""
    clean = F.regexp_extract(value, r"^\s*([+-]?\d+(?:_\d+)*)\s*$", 1)
    return F.regexp_replace(clean, "_", "").try_cast("bigint")


def has_protocol(message: Column) -> Column:
    return message.contains("/")


def has_session(message: Column) -> Column:
    """A ':' comes before the last '@', or before the last character where there is no '@'."""
    return message.rlike("(?s):.*@") | (~message.contains("@") & message.rlike("(?s):."))


def parse_user_ident(message: Column) -> Column:
    """STRUCT<protocol, username, pid, sid, host> of `protocol/user.pid:sid@host`.

    NULL when the '/' or the ':' is missing. A missing '@' makes all of the rest the host and costs the rest its
    last character; a missing '.' does the same to the pid and the user name. A pid that is no number makes
    pid and sid 0, a sid that is none only the sid.
    """
    no_host = message.rlike("(?s)^[^/]*/[^@]*$")
    whole = F.when(no_host, F.regexp_replace(message, "(?s)^([^/]*/)(.*?)(.?)$", "$1$2@$2$3")).otherwise(message)

    def part(n: int) -> Column:
        return F.regexp_extract(whole, _IDENT, n)

    no_dot = ~whole.rlike(r"(?s)^[^/]*/[^:]*\.[^:.]*:")
    pid = _integer(part(3))
    fields = F.struct(
        part(1).alias("protocol"),
        F.when(no_dot, F.regexp_replace(part(3), "(?s).$", "")).otherwise(part(2)).alias("username"),
        F.coalesce(pid, F.lit(0)).alias("pid"),
        F.when(pid.isNull(), F.lit(0)).otherwise(F.coalesce(_integer(part(4)), F.lit(0))).alias("sid"),
        part(5).alias("host"),
    )
    return F.when(message.rlike(_PLAIN_IDENT), _plain_ident(message)).when(whole.rlike(_IDENT), fields)


def _plain_ident(message: Column) -> Column:
    """As `parse_user_ident`, for identities of the usual form: cut by position instead of by a pattern per field."""
    protocol, process = F.substring_index(message, "/", 1), F.substring_index(message, ":", 1)
    pid = F.substring_index(process, ".", -1)
    length = F.char_length(process) - F.char_length(protocol) - F.char_length(pid) - 2
    return F.struct(
        protocol.alias("protocol"),
        F.substring(process, F.char_length(protocol) + 2, length).alias("username"),
        pid.cast("bigint").alias("pid"),
        F.substring_index(F.substring_index(message, "@", 1), ":", -1).cast("bigint").alias("sid"),
        F.substring_index(message, "@", -1).alias("host"),
    )


def _last_value_of(message: Column, key: str, value: str) -> Column:
    """Value of the last `key=` in an `&` list: the greedy prefix makes the regex stop at the last one."""
    return F.regexp_extract(message, rf"(?s)^(?:.*&)?{key}=({value})", 1)


def parse_auth(rest: Column) -> Column:
    return F.struct(*[_last_value_of(rest, k, "[^&]*").alias(name) for k, name in AUTH_KEYS.items()])


def parse_server_info(rest: Column) -> Column:
    """Query-string fields; blank values do not count, missing ones are NULL, `%XX` and `+` are decoded."""
    fields = []
    for key, name in SERVER_KEYS.items():
        raw = F.nullif(_last_value_of(rest, key, "[^&]+"), F.lit(""))
        fields.append(F.coalesce(F.try_url_decode(raw), raw).alias(name))
    return F.struct(*fields)


def _positional(lines: Column, names: list[str]) -> tuple[Column, dict[str, Column]]:
    parts = F.split(F.get(lines, F.lit(1)), "&")
    values = {name: F.get(F.split(F.get(parts, F.lit(i + 1)), "="), F.lit(1)) for i, name in enumerate(names)}
    return parts, values


def parse_purge(rest: Column) -> Column:
    """STRUCT<xfn, tod, sz, at, ct, mt, fn>; NULL unless there are exactly two lines and all six values."""
    lines = F.split(rest, "\n")
    _, values = _positional(lines, PURGE_FIELDS)
    complete = F.size(lines) == 2
    for v in values.values():
        complete = complete & v.isNotNull()
    return F.when(
        complete, F.struct(F.get(lines, F.lit(0)).alias("xfn"), *[v.alias(n) for n, v in values.items()])
    )


def parse_staging(rest: Column) -> Column:
    """STRUCT<lfn, tod, sz, tm, op, rc, pd>; `pd` is '' unless it is the sixth and last value."""
    lines = F.split(rest, "\n")
    parts, values = _positional(lines, STAGING_FIELDS)
    pd = F.when(F.size(parts) == 7, F.get(F.split(F.get(parts, F.lit(6)), "="), F.lit(1))).otherwise("")
    complete = (F.size(lines) == 2) & pd.isNotNull()
    for v in values.values():
        complete = complete & v.isNotNull()
    return F.when(
        complete,
        F.struct(F.get(lines, F.lit(0)).alias("lfn"), *[v.alias(n) for n, v in values.items()], pd.alias("pd")),
    )


def encode_ident(protocol: Column, username: Column, pid: Column, sid: Column, host: Column) -> Column:
    return F.concat(protocol, F.lit("/"), username, F.lit("."), pid.cast("string"), F.lit(":"), sid.cast("string"),
                    F.lit("@"), host)


def encode_auth(**fields: Column) -> Column:
    pieces = [F.concat(F.lit(f"&{k}="), fields.get(name, F.lit(""))) for k, name in AUTH_KEYS.items()]
    return F.concat(*pieces)


def encode_server_info(**fields: Column) -> Column:
    pieces = [F.concat(F.lit(f"&{k}="), fields.get(name, F.lit(""))) for k, name in SERVER_KEYS.items()]
    return F.concat(*pieces)
