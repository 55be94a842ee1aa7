"""URL functions: domains and canonical addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def domain(url: Column) -> Column:
    """Lower-case host without ``www.``; an address without a scheme is taken as https."""
    whole = F.when(F.contains(url, F.lit("://")), url).otherwise(F.concat(F.lit("https://"), url))
    return F.regexp_replace(F.lower(F.coalesce(F.try_parse_url(whole, F.lit("HOST")), F.lit(""))), r"^www\.", "")


def in_domains(host: Column, domains: list[str]) -> Column:
    """Whether the host is one of the domains or below one."""
    out = F.lit(False)
    for d in domains:
        out = out | (host == d) | host.endswith(f".{d}")
    return out


def canonical_url(url: Column, detail_domain: str = "ihchina.cn", detail_path: str = r"^(/(?:project_details|ccr_detail)/\d+)\.html$") -> Column:
    """Domain and path, without scheme, fragment or trailing slashes, with sorted query parameters.

    On the detail domain the two kinds of detail pages lose their ``.html``.
    """
    host = domain(url)
    bare = F.regexp_replace(url, r"#.*$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://)?[^/?]*([^?]*)", 1), r"/+$", "")
    path = F.when(path == "", F.lit("/")).otherwise(path)
    path = F.when(host == detail_domain, F.regexp_replace(path, detail_path, "$1")).otherwise(path)
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    # Pairs are sorted by name and value; a pair without '=' has an empty value.
    pairs = F.filter(F.split(query, "&"), lambda p: p != "")
    part = lambda p, pattern: F.url_encode(F.try_url_decode(F.regexp_extract(p, pattern, 1)))
    named = F.transform(pairs, lambda p: F.struct(part(p, "^([^=]*)").alias("k"), part(p, "=(.*)$").alias("v")))
    text = F.array_join(F.transform(F.array_sort(named), lambda s: F.concat(s["k"], F.lit("="), s["v"])), "&")
    return F.concat(host, path, F.when(text == "", F.lit("")).otherwise(F.concat(F.lit("?"), text)))
