"""URLs: normal form, origin, tracking parameters and the route guard."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Query keys that only track, and the prefix of more such keys.
TRACKING_KEYS = ("fbclid", "gclid", "dclid", "yclid", "msclkid", "mc_cid", "mc_eid", "_ga", "_gl", "igshid")
TRACKING_PREFIX = "utm_"
DEFAULT_PORTS = {"http": "80", "https": "443"}

_PARTS = r"^\s*([A-Za-z][A-Za-z0-9+.-]*)://(?:([^/?#@]*)@)?(\[[^\]]*\]|[^/?#:]*)(?::(\d*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?\s*$"
_BREAK = "\x01"


def _of(url: Column, make) -> Column:
    """``make`` of a URL's parts, which are taken out by one pass of the pattern."""
    parts = F.split(F.regexp_replace(F.trim(url), _PARTS, _BREAK.join(f"${n}" for n in range(1, 7))), _BREAK)
    named = F.transform(F.array(parts), lambda p: F.when(F.size(p) == 6, F.struct(F.lower(p[0]).alias("scheme"), p[1].alias("user"), F.lower(p[2]).alias("host"), p[3].alias("port"), p[4].alias("path"), p[5].alias("query"))))
    return F.element_at(F.transform(named, make), 1)


@F.pandas_udf(T.StringType())
def _idna(hosts: pd.Series) -> pd.Series:
    import idna

    def one(host):
        try:
            return None if host is None else idna.encode(host, uts46=True).decode("ascii")
        except idna.IDNAError:
            return ""

    return hosts.map(one)


def ascii_hosts(url: Column) -> Column:
    """The URL with a host beyond ASCII in its IDNA form; a host that has none is emptied. Others stay in the JVM."""
    raw = F.regexp_extract(F.trim(url), _PARTS, 3)
    foreign = raw.rlike(r"[^\x00-\x7F]")
    start = F.instr(F.trim(url), raw)
    given = F.trim(url)
    rebuilt = F.concat(F.substring(given, F.lit(1), start - 1), _idna(F.when(foreign, raw)), F.substring(given, start + F.length(raw), F.length(given)))
    return F.when(foreign, rebuilt).otherwise(url)


def scheme(url: Column) -> Column:
    return _of(url, lambda p: F.coalesce(p["scheme"], F.lit("")))


def host(url: Column) -> Column:
    """The host in lower case; empty if there is none."""
    return _of(url, lambda p: F.coalesce(p["host"], F.lit("")))


def _port(p: Column) -> Column:
    default = F.when(p["scheme"] == "http", "80").when(p["scheme"] == "https", "443").otherwise("")
    return F.when((p["port"] == "") | (p["port"] == default), F.lit("")).otherwise(F.concat(F.lit(":"), p["port"]))


def _origin(p: Column) -> Column:
    return F.concat(p["scheme"], F.lit("://"), p["host"], _port(p))


def _key(parameter: Column) -> Column:
    return F.lower(F.substring_index(parameter, "=", 1))


def is_tracking(parameter: Column) -> Column:
    return _key(parameter).startswith(TRACKING_PREFIX) | _key(parameter).isin(*TRACKING_KEYS)


def tracking_keys(url: Column) -> Column:
    """The different tracking keys of the query, sorted; an empty array if there are none."""
    return _of(url, lambda p: F.array_sort(F.array_distinct(F.transform(F.filter(F.split(F.coalesce(p["query"], F.lit("")), "&"), is_tracking), _key))))


def _problem(p: Column) -> Column:
    bad = F.coalesce(p["host"] == "", F.lit(True)) | F.coalesce(p["port"].try_cast("int") > 65535, F.lit(False))
    return F.when(bad, "url_invalid").when(p["user"] != "", "url_userinfo_forbidden")


def problem(url: Column) -> Column:
    """Why a URL has no normal form, or null."""
    return F.when(url.isNull(), "url_invalid").otherwise(_of(url, _problem))


def _normal(p: Column) -> Column:
    path = F.when(p["path"] == "", "/").otherwise(p["path"])
    kept = F.array_join(F.filter(F.split(p["query"], "&"), lambda q: (q != "") & ~is_tracking(q)), "&")
    query = F.when(kept == "", "").otherwise(F.concat(F.lit("?"), kept))
    return F.when(_problem(p).isNull(), F.concat(_origin(p), path, query))


def normalize(url: Column) -> Column:
    """Lower-case scheme and host, no default port, no fragment, no tracking and no empty parameters.

    The order and the encoding of the other parameters stay. Null if there is a ``problem``.
    Hosts beyond ASCII want ``ascii_hosts`` first.
    """
    return _of(url, _normal)


def origin(url: Column) -> Column:
    """``scheme://host[:port]``, the key of rate limits."""
    return _of(url, _origin)


def robots_url(url: Column) -> Column:
    return F.concat(origin(url), F.lit("/robots.txt"))


def _suffixes(name: Column) -> Column:
    labels = F.split(name, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))


def host_suffixes(url: Column) -> Column:
    """The host and all its parent domains."""
    return _suffixes(host(url))


def guard(url: Column, denied_hosts: tuple[str, ...] = (), denied: tuple[str, ...] = (), allowed: tuple[str, ...] = (), ports: tuple[int, ...] = ()) -> Column:
    """The first reason to refuse a URL, or null: scheme, form, port, denylist, patterns.

    ``ports`` are allowed beside the default ones.
    """

    def reason(p: Column) -> Column:
        wrong = F.when(~F.coalesce(p["scheme"], F.lit("")).isin("http", "https"), "scheme_forbidden").when(_problem(p).isNotNull(), _problem(p))
        wrong = wrong.when((_port(p) != "") & ~_port(p).isin(*[f":{n}" for n in ports]), "port_forbidden")
        if denied_hosts:
            wrong = wrong.when(F.arrays_overlap(_suffixes(p["host"]), F.array(*map(F.lit, denied_hosts))), "host_denied")
        for pattern in denied:
            wrong = wrong.when(_normal(p).rlike(pattern), "path_denied")
        if allowed:
            wrong = wrong.when(~_normal(p).rlike("|".join(f"(?:{p})" for p in allowed)), "path_not_allowed")
        return wrong

    return F.when(url.isNull(), "url_invalid").otherwise(_of(url, reason))


def redirected(current: Column, location: Column) -> Column:
    """``url, problem`` of a redirect: the target without its fragment; from https to http is refused."""
    joined = _joined(current, location)
    down = F.lower(current).startswith("https:") & F.lower(joined).startswith("http:")
    problem = F.when(joined.isNull(), "redirect_location_invalid").when(down, "redirect_downgrade")
    return F.struct(F.when(problem.isNull(), joined).alias("url"), problem.alias("problem"))


@F.pandas_udf(T.StringType())
def _joined(current: pd.Series, location: pd.Series) -> pd.Series:
    from urllib.parse import urldefrag, urljoin

    def one(base, target):
        try:
            return None if base is None or target is None else urldefrag(urljoin(base, target.strip()))[0]
        except ValueError:
            return None

    return pd.Series([one(b, t) for b, t in zip(current, location, strict=True)], dtype=object)
