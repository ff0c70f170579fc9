"""URL identity and allow lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _decoded(text: Column, plus: bool) -> Column:
    """Percent signs decoded; a plus is a space only in queries. What can't be decoded stays."""
    return F.coalesce(F.try_url_decode(text if plus else F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def file_key(url: Column, files: str = r"(?i)\.(?:pdf|zip)$", resolver: tuple[str, str, str] = ("urn.kb.se", "/resolve", "urn:nbn:se:")) -> Column:
    """Identity of a published file's address: no scheme, host in lower case, path decoded, query kept; null for others.

    A file is one by its path, or by the one ``urn`` that a resolver (host, path, prefix) is asked for.
    """
    host = F.lower(F.regexp_extract(url, r"^(?i:https?)://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    path = _decoded(F.regexp_extract(url, r"^(?i:https?)://[^/?#]+([^?#]*)", 1), False)
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    urns = F.filter(F.split(query, "&"), lambda p: F.substring_index(p, "=", 1) == "urn")
    named = (host == resolver[0]) & (path == resolver[1]) & (F.size(urns) == 1) & _decoded(F.substr(F.get(urns, F.lit(0)), F.lit(5)), True).startswith(resolver[2])
    key = F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when((host != "") & (path.rlike(files) | F.coalesce(named, F.lit(False))), key)


def query_map(url: Column) -> Column:
    """The query's keys and values, decoded; of a key that repeats the last value; null without a query."""
    query = F.regexp_extract(F.substring_index(url, "#", 1), r"\?(.*)$", 1)
    pairs = F.filter(F.split(query, "&"), lambda p: p != "")
    entries = F.transform(pairs, lambda p: F.struct(_decoded(F.substring_index(p, "=", 1), True).alias("k"), F.when(F.instr(p, "=") > 0, _decoded(F.substr(p, F.instr(p, "=") + 1), True)).otherwise("").alias("v")))
    keys = F.transform(entries, lambda e: e["k"])
    last = F.filter(entries, lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), e["k"]))
    return F.when(query != "", F.map_from_entries(last))


def allowed(url: Column, hosts: list[str], path_pattern: str, query_keys: list[str]) -> Column:
    """https or http, a known host or its subdomain, a path that fits and no other query keys."""
    host = F.lower(F.regexp_extract(url, r"^(?i:https?)://([^/?#:@]+)", 1))
    path = F.regexp_extract(url, r"^(?i:https?)://[^/?#]+([^?#]*)", 1)
    known = F.lit(False)
    for h in hosts:
        known = known | (host == h) | host.endswith(f".{h}")
    keys = F.coalesce(F.map_keys(query_map(url)), F.array().cast("array<string>"))
    return known & path.rlike(path_pattern) & (F.size(F.array_except(keys, F.array(*map(F.lit, query_keys)))) == 0)
