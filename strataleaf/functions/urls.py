"""Url functions as Column expressions. The site is a parameter; nothing is fetched."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PARTS = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def part(url: Column, k: int) -> Column:
    return F.regexp_extract(url, PARTS, k)


def sorted_query(query: Column) -> Column:
    return F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda x: x != "")), "&")


def normalized(url: Column, languages: tuple[str, ...] = ("en", "de", "fr", "es")) -> Column:
    """https, lower-case host, path without a leading language, sorted query, no fragment.

    Null for anything but http(s), for a user part and for a port other than 80 and 443.
    """
    host = F.lower(part(url, 2))
    path = F.regexp_replace(part(url, 3), rf"^/(?:{'|'.join(languages)})/", "/")
    query = sorted_query(part(url, 4))
    good = F.lower(part(url, 1)).isin("http", "https") & ~host.contains("@") & (~host.contains(":") | host.rlike(":(?:80|443)$")) & (host != "")
    host = F.regexp_replace(host, ":(?:80|443)$", "")
    return F.when(good, F.concat(F.lit("https://"), host, F.when(path == "", "/").otherwise(path), F.when(query == "", "").otherwise(F.concat(F.lit("?"), query))))


def with_query(url: Column, **updates: str | None) -> Column:
    """url with parameters set, or removed where the value is None, and all of them sorted."""
    pairs = F.filter(F.split(part(url, 4), "&"), lambda x: x != "")
    pairs = F.filter(pairs, lambda x: ~F.substring_index(x, "=", 1).isin(*updates))
    pairs = F.concat(pairs, F.array(*[F.lit(f"{k}={v}") for k, v in sorted(updates.items()) if v is not None]).cast("array<string>"))
    query = F.array_join(F.array_sort(pairs), "&")
    return F.concat(part(url, 1), F.lit("://"), part(url, 2), part(url, 3), F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))


def identity(url: Column) -> Column:
    """The signed number of a document's path, as text; empty if the path is no document's."""
    return F.regexp_extract(part(url, 3), r"^(?:/[a-z]{2})?/(-?\d+)/?(?:\.html)?$", 1)


def route(url: Column) -> Column:
    """Kind of a url for the collector's queue."""
    path, query = part(url, 3), part(url, 4)
    return (
        F.when(part(url, 1) == "", "invalid")
        .when(query.rlike(r"(?:^|&)(?:utm_|ref=)"), "tracked")
        .when(path.endswith(".html"), "document_html")
        .when(identity(url) != "", "document")
        .when(F.lower(path).rlike(r"\.(?:png|jpe?g|gif|svg|webp|ico)$"), "image")
        .otherwise("other")
    )
