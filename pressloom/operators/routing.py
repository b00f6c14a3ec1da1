"""Routing of pages to site rules by URL pattern and crawl time."""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.sources.config import Route

# Patterns that are tested one after the other; beyond, plain ones are looked up.
FEW_PATTERNS = 16
# Characters before a dot that the lookup goes by.
GRAM = 5


def route_column(url: Column, crawl_ts: Column, routes: list[Route]) -> Column:
    """Extractor of the first matching route, without a join.

    Validity is half-open, so adjacent routes share a bound without overlap. The cost does not follow the number of routes:
    beyond a few patterns, those that search for a plain text with a dot, as of a host, are found by what stands before the
    dots of the URL.
    """
    if len({r.regex for r in routes}) <= FEW_PATTERNS:
        return _one_by_one(url, crawl_ts, routes)
    return _looked_up(url, crawl_ts, routes)


def _one_by_one(url: Column, crawl_ts: Column, routes: list[Route]) -> Column:
    """One CASE. Neighbouring routes of one URL pattern share its test."""
    choices = []
    for pattern, group in groupby(routes, key=lambda r: r.regex):
        named = [_while_active(r, crawl_ts) for r in group]
        choices.append(F.when(url.rlike(_searchable(pattern)), F.coalesce(*named) if len(named) > 1 else named[0]))
    return F.coalesce(*choices) if choices else F.lit(None).cast("string")


def _plain(pattern: str) -> str | None:
    """The text that a pattern searches for, if it is nothing but text with something before a dot."""
    text = _searchable(pattern)
    if not re.fullmatch(r"(?:[\w/:=&-]|\\[./:-])+", text, re.ASCII):
        return None
    text = text.replace("\\", "")
    return text if _grams(text) else None


def _grams(text: str) -> list[str]:
    """The characters before each dot of a text."""
    return [piece[-GRAM:] for piece in text.split(".")[:-1] if piece]


_ENTRY = "struct<gram:string,text:string,position:int,extractor:string,since:timestamp_ntz,until:timestamp_ntz>"


def _looked_up(url: Column, crawl_ts: Column, routes: list[Route]) -> Column:
    """Plain patterns by a table of buckets, a constant of the plan; the others one by one. The earlier route wins."""
    texts = [_plain(r.regex) for r in routes]
    common = Counter(g for t in {t for t in texts if t} for g in _grams(t))
    buckets: list[list[dict]] = [[] for _ in range(1 << (2 * len(routes)).bit_length())]
    others = []
    for position, (route, text) in enumerate(zip(routes, texts, strict=True)):
        if text is None:
            others.append((position, route))
            continue
        # a URL that holds the text holds the rarest of its grams before a dot
        gram = min(_grams(text), key=lambda g: (common[g], -len(g)))
        bounds = {k: v and v.replace(" ", "T") for k, v in (("since", route.since), ("until", route.until))}
        entry = {"gram": gram, "text": text, "position": position, "extractor": route.extractor, **bounds}
        buckets[zlib.crc32(gram.encode()) % len(buckets)].append(entry)
    grams = sorted({e["gram"] for b in buckets for e in b})
    table = F.from_json(F.lit(json.dumps(buckets)), f"array<array<{_ENTRY}>>")
    sizes = sorted({len(g) for g in grams})
    pieces = F.split(url, "[.]")
    before = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    ends = F.flatten(F.transform(before, lambda p: F.array(*[F.right(p, F.lit(n)) for n in sizes])))
    known = F.filter(ends, lambda g: g.isin(*grams))

    def active(r: Column) -> Column:
        return (r["since"].isNull() | (crawl_ts >= r["since"])) & (r["until"].isNull() | (crawl_ts < r["until"]))

    def matches(g: Column) -> Column:
        bucket = F.get(table, F.pmod(F.crc32(g.cast("binary")), F.lit(len(buckets))).cast("int"))
        return F.filter(bucket, lambda r: (r["gram"] == g) & url.contains(r["text"]) & active(r))

    found = F.transform(F.flatten(F.transform(known, matches)), lambda r: F.struct(r["position"].alias("position"), r["extractor"].alias("extractor")))
    none = F.lit(None).cast("struct<position:int,extractor:string>")
    first = F.array_min(found) if grams else none
    tested = []
    for position, route in others:
        own = F.struct(F.lit(position).alias("position"), F.lit(route.extractor).alias("extractor"))
        tested.append(F.when(url.rlike(_searchable(route.regex)) & _while_active(route, crawl_ts).isNotNull(), own))
    # the earlier of both; null where neither has one
    return F.least(first, F.coalesce(*tested, none))["extractor"]


def _while_active(route: Route, crawl_ts: Column) -> Column:
    name, active = F.lit(route.extractor), None
    if route.since is not None:
        active = crawl_ts >= F.lit(route.since).cast("timestamp_ntz")
    if route.until is not None:
        before = crawl_ts < F.lit(route.until).cast("timestamp_ntz")
        active = before if active is None else active & before
    return name if active is None else F.when(active, name)


def _searchable(pattern: str) -> str:
    """`rlike` searches, so outer `.*` only cost time."""
    return pattern.removeprefix(".*").removesuffix(".*") or ".*"


def name_pages(pages: DataFrame, routes: list[Route]) -> DataFrame:
    """All pages with their `extractor`, null without a route."""
    return pages.withColumn("extractor", route_column(F.col("url"), F.col("crawl_ts"), routes))


def route(pages: DataFrame, routes: list[Route]) -> DataFrame:
    """Pages with their `extractor`; pages without a route are dropped before anything is parsed."""
    return name_pages(pages, routes).where(F.col("extractor").isNotNull())


def route_join(pages: DataFrame, routes: DataFrame, site_pattern: str) -> DataFrame:
    """The same by a route table `(position, site, extractor, since, until)`: one row per site with its routes in order
    of `position` is joined on the site key taken from the URL, and the first route in force is the page's."""
    entry = F.struct("position", "extractor", "since", "until")
    table = routes.groupBy("site").agg(F.array_sort(F.collect_list(entry)).alias("_routes"))
    keyed = pages.withColumn("site", F.regexp_extract("url", site_pattern, 1))
    crawled = F.col("crawl_ts")
    active = F.filter(
        "_routes",
        lambda r: (r["since"].isNull() | (crawled >= r["since"])) & (r["until"].isNull() | (crawled < r["until"])),
    )
    named = keyed.join(table, "site").withColumn("extractor", F.get(active, F.lit(0))["extractor"]).drop("_routes")
    return named.where(F.col("extractor").isNotNull()).select(*pages.columns, "site", "extractor")
