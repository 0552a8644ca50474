"""Rules that read meaning out of file paths and URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Path prefix -> number of leading '/'-parts that name the logical directory. First match wins.
LOGICAL_LEVELS = [
    ("/user", 3),
    ("/osgconnect/public", 4),
    ("/osgconnect/protected", 4),
    ("/ospool/PROTECTED", 4),
    ("/ospool", 5),
    ("/path-facility", 4),
    ("/hcc", 6),
    ("/pnfs/fnal.gov/usr", 5),
    ("/gwdata", 3),
    ("/chtc/", 2),
    ("/icecube/", 2),
    ("/igwn", 4),
    ("/store", 3),
]
# Path prefix -> organisation that owns it. First match wins.
PATH_OWNERS = [
    ("/user", "osg"),
    ("/osgconnect/public", "osg"),
    ("/pnfs/fnal.gov/usr", "fermilab"),
    ("/hcc", "hcc"),
    ("/gwdata", "gwdata"),
    ("/chtc/", "chtc"),
    ("/icecube/", "icecube"),
]
NO_OWNER = "noVO"
UNKNOWN_DIRECTORY = "unknown directory"
MISSING_DIRECTORY = "missing directory"


def _first_match(path: Column, cases: list[tuple[str, Column]], otherwise: str) -> Column:
    chain = F
    for prefix, value in cases:
        chain = chain.when(path.startswith(prefix), value)
    return chain.otherwise(otherwise)


def dir_level(path: Column, parts: int) -> Column:
    return F.substring_index(path, "/", parts)


def logical_dirname(path: Column, open_name: Column | None = None) -> Column:
    """Logical directory of a path. One family is cut from the name given at open, even when it was empty."""
    open_name = path if open_name is None else open_name
    cases = [
        (prefix, dir_level(open_name if prefix == "/pnfs/fnal.gov/usr" else path, parts))
        for prefix, parts in LOGICAL_LEVELS
    ]
    return _first_match(path, cases, UNKNOWN_DIRECTORY)


def is_store_family(path: Column) -> Column:
    """True when the `/store` rule decides the logical directory; no earlier prefix can also match."""
    return path.startswith("/store")


def vo_from_path(path: Column) -> Column:
    return _first_match(path, [(p, F.lit(owner)) for p, owner in PATH_OWNERS], NO_OWNER)


def is_wlcg_path(path: Column) -> Column:
    return path.startswith("/store") | path.startswith("/user/dteam")


def is_wlcg_url(url: Column) -> Column:
    """True when the path of a URL, without leading slashes, starts with `store` or `user/dteam`.

    Blanks in a URL are allowed, which is why this is not `try_parse_url`. A host with an unpaired bracket is no URL.
    """
    clean = F.regexp_replace(F.regexp_replace(url, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    pattern = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://([^/?#]*))?([^?#]*)"
    host = F.regexp_extract(clean, pattern, 1)
    path = F.regexp_replace(F.regexp_extract(clean, pattern, 2), "^/+", "")
    paired = host.contains("[") == host.contains("]")
    return F.coalesce(paired & (path.startswith("store") | path.startswith("user/dteam")), F.lit(False))


def user_domain(host: Column) -> Column:
    """Last two labels of a host name; none for anything that starts like an address (or with the letter f)."""
    return F.when(~host.rlike(r"^[\[:f\d.]"), F.substring_index(host, ".", -2))


def utc_iso(seconds: Column) -> Column:
    """Epoch seconds as ISO text in UTC, whatever the session time zone is."""
    moment = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)")
    )
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")
