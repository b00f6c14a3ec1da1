"""URL parts. The generic URI pattern is used, since `parse_url` rejects the raw characters real links hold."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressloom.functions import text

_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"
_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)"
FILE_NAME_LENGTH = 80


def authority(url: Column) -> Column:
    """Host with user and port, empty when the URL has none."""
    return F.regexp_extract(url, _AUTHORITY, 1)


def host(url: Column) -> Column:
    return F.lower(F.regexp_replace(authority(url), r"^.*@|:\d*\z", ""))


def path(url: Column) -> Column:
    return F.regexp_extract(url, _PATH, 1)


def path_segment(url: Column, n: int) -> Column:
    """Segment `n` of the path split at `/`; segment 0 precedes the first slash."""
    return F.get(F.split(path(url), "/"), F.lit(n))


def first_host_label(url: Column) -> Column:
    return F.get(F.split(authority(url), "[.]"), F.lit(0))


def server(url: Column, suffix: str = "cz", port_label: str | None = "aktualne") -> Column:
    """Last host label, or the one before it when the last is `suffix`.

    Hosts that end in `<suffix>:443` belong to one site only, hence `port_label`.
    """
    labels = F.split(authority(url), "[.]")
    last = F.try_element_at(labels, F.lit(-1))
    name = F.when(last == suffix, F.try_element_at(labels, F.lit(-2))).otherwise(last)
    return name if port_label is None else F.when(name == f"{suffix}:443", port_label).otherwise(name)


def category_from_path(url: Column) -> Column:
    """First path directory as category text."""
    return text.unify(path_segment(url, 1))


def file_name(url: Column) -> Column:
    """URL as a file name: slashes become underscores, cut to a fixed length."""
    return F.substring(F.replace(url, F.lit("/"), F.lit("_")), 1, FILE_NAME_LENGTH)


def in_domain(url: Column, domains: list[str]) -> Column:
    """The host is one of the domains or a subdomain of one."""
    name = host(url)
    hit = F.lit(False)
    for domain in domains:
        hit = hit | (name == domain.lower()) | name.endswith("." + domain.lower())
    return hit
