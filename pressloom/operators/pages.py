"""The page parse: one Arrow UDF call per page returns raw strings, Columns clean them."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.functions import authors, dates, text
from pressloom.operators.filters import REQUIRED
from pressloom.operators.html import Page, body_text, unify
from pressloom.plans.sites import Site, Take, clean_date
from pressloom.session import bound_batches

FIELDS = ("content", "headline", "author", "brief", "publication_date", "keywords", "category", "comments_num")
STAGES = ("custom", "article", "head")

#: pages of an Arrow batch; a worker holds the pages and the fields of one batch
BATCH_PAGES = 512
#: pages of a batch that are Python objects at once
PAGES_AT_ONCE = 32

_SPECIAL = ("kept", "failed", "date_text", "year_text", "json_ld")

# Column chains by name, and the default chain of each field.
CLEAN: dict[str, Callable[[Column], Column]] = {
    "content": lambda c: c,
    "content_without_audio_note": text.without_audio_note,
    "headline": text.page_headline,
    "author": authors.split_byline,
    "brief": text.page_brief,
    "brief_or_null": lambda c: F.nullif(text.page_brief(c), F.lit("")),
    "brief_twice_or_null": lambda c: F.nullif(text.page_brief(text.page_brief(c), c), F.lit("")),
    "keywords": text.page_keywords,
    "keywords_spaced": text.page_keywords_spaced,
    "category": text.page_category,
    "comments_num": text.first_number,
    "number_before_comma": text.first_number_before_comma,
}
# The same for dates, in two parts: the moment and its zone.
MOMENTS: dict[str, tuple[Callable[[Column], Column], Callable[[Column], Column]]] = {
    "iso": (dates.parse_iso, dates.iso_offset),
    "publication_date": (dates.parse_iso, dates.iso_offset),
    "czech": (dates.parse_czech, lambda c: F.lit("")),
    "time_day": (lambda c: dates.parse_noisy(dates.czech_months(c), dates.TIME_DAY), lambda c: F.lit("")),
}
CLEAN |= {kind: lambda c, at=at, zone=zone: dates.iso_text(at(c), zone(c)) for kind, (at, zone) in MOMENTS.items()}


def _take(page: Page, scope, take: Take) -> str | None:
    for css in take.css:
        found = page.first(scope, css)
        if found is not None:
            break
    else:
        return None
    if take.get == "exists":
        return "0"
    if take.get == "attribute":
        return " ".join(found.classes) if take.attribute == "class" else found.attrs.get(take.attribute)
    if take.get == "body":
        return body_text(page, found, take.body)
    if take.get == "blocks":
        pieces = [page.text(e) for css in take.members for e in page.select(found, css)]
        pieces += [body_text(page, e, take.body) for css in take.extra_members for e in page.select(found, css)]
        return unify("\n".join(p for p in map(unify, pieces) if p))
    if take.get == "members":
        hits = [e for css in take.members for e in page.select(found, css)]
        if hits or not take.own_text:
            return ",".join(page.text(e) for e in hits)
    return page.text(found)


def _raw_fields(markup: str, site: Site) -> dict[str, str | bool | None]:
    """Raw strings of one page, or only the flag when a tree filter rejects it."""
    page = Page(markup)
    try:
        return _page_fields(page, site)
    finally:
        page.release()


def _page_fields(page: Page, site: Site) -> dict[str, str | bool | None]:
    kept = all(page.first(page.root, css) is not None for css in site.must_exist)
    kept = kept and all(page.first(page.root, css) is None for css in site.must_not_exist)
    if not kept or (site.tree_filter is not None and site.tree_filter(page) is False):
        return {"kept": False}
    raw: dict[str, str | bool | None] = {"kept": True}
    scopes = {"head": page.first(page.root, "head"), "article": page.first(page.root, site.root), "custom": page.root}
    for stage, takes in (("head", site.head), ("article", site.article), ("custom", site.custom)):
        if scopes[stage] is not None:
            raw.update({f"{stage}_{name}": _take(page, scopes[stage], take) for name, take in takes.items()})
    if site.date is not None:
        raw["date_text"] = _take(page, page.root, Take(site.date.css))
        if site.date.year_css:
            raw["year_text"] = _take(page, page.root, Take((site.date.year_css,)))
        if site.date.json_ld_css:
            raw["json_ld"] = _take(page, page.root, Take((site.date.json_ld_css,)))
    if site.hook is not None:
        raw.update({f"custom_{name}": value for name, value in site.hook(page).items()})
    return raw


def _markup(page: str | bytes, charset: str) -> str:
    if isinstance(page, bytes):
        try:
            page = page.decode(charset, "replace")
        except LookupError:
            page = page.decode("utf-8", "replace")
    return page.replace("\r\n", "\n") if "\r" in page else page


def raw_columns(sites: dict[str, Site]) -> list[str]:
    """Raw fields that some site can fill; a hook may fill any custom field."""
    names = {f"{stage}_{f}" for s in sites.values() for stage in ("head", "article", "custom") for f in getattr(s, stage)}
    if any(s.hook is not None for s in sites.values()):
        names.update(f"custom_{f}" for f in FIELDS)
    return [*_SPECIAL, *sorted(names)]


def parse_pages(df: DataFrame, sites: dict[str, Site], page: str, encoding: str | None = None) -> DataFrame:
    """Add the struct `raw`. Each page crosses to Python once; bytes are decoded there, as Spark's own `decode`
    lacks the sites' charset. The UDF is marked non-deterministic so that no filter makes it run twice. A worker's memory
    follows the batch, which is bounded in rows for the session, not the pages of its task."""
    bound_batches(df.sparkSession, BATCH_PAGES)
    names = raw_columns(sites)
    flags = ("kept", "failed")
    shape = pa.struct([(n, pa.bool_() if n in flags else pa.string()) for n in names])
    columns = [(f.name, f.type) for f in shape]
    ddl = ", ".join(f"{n} {'boolean' if n in flags else 'string'}" for n in names)

    def fields(markup: str | bytes | None, name: str | None, charset: str | None) -> dict[str, str | bool | None]:
        site = sites.get(name)
        if site is None or markup is None:
            return {"kept": False, "failed": False}
        try:
            return _raw_fields(_markup(markup, site.charset or charset or "utf-8"), site) | {"failed": False}
        except Exception:  # one bad page must not end the job; it is marked and counted
            return {"kept": False, "failed": True}

    @F.arrow_udf(ddl)
    def parse(pages: pa.Array, extractors: pa.Array, encodings: pa.Array) -> pa.Array:
        done = [pa.array([], shape)]
        for at in range(0, len(pages), PAGES_AT_ONCE):
            pieces = (c.slice(at, PAGES_AT_ONCE).to_pylist() for c in (pages, extractors, encodings))
            rows = [fields(*row) for row in zip(*pieces)]
            # a column at a time: a struct made of rows takes longer by far
            done.append(pa.StructArray.from_arrays([pa.array([r.get(n) for r in rows], kind) for n, kind in columns], fields=list(shape)))
        return pa.concat_arrays(done)

    charset = F.col(encoding) if encoding else F.lit(None).cast("string")
    return df.withColumn("raw", parse.asNondeterministic()(F.col(page), F.col("extractor"), charset))


def _choose(branches: list[tuple[list[str], Column]], total: int) -> Column:
    """One CASE over the extractor; a single branch for all of them needs none."""
    if len(branches) == 1 and len(branches[0][0]) == total:
        return branches[0][1]
    choice = None
    for names, value in branches:
        hit = F.col("extractor").isin(*names)
        choice = F.when(hit, value) if choice is None else choice.when(hit, value)
    return choice


def _groups(sites: dict[str, Site], stage: str, field: str, suffix: str = "") -> dict[str, list[str]]:
    """Extractors that can fill a field, by the name of its cleaning."""
    groups: dict[str, list[str]] = {}
    for extractor, site in sites.items():
        take = getattr(site, stage).get(f"{field}{suffix}")
        if take is not None or (stage == "custom" and site.hook is not None and not suffix):
            groups.setdefault((take.clean if take else None) or field, []).append(extractor)
    return groups


def _field(field: str, sites: dict[str, Site], names: set[str], moments: dict[str, Column]) -> list[Column]:
    """Cleaned candidates of one field, in order of precedence."""
    candidates = []
    for stage in STAGES:
        for suffix in ("", "_fallback"):
            column = f"{stage}_{field}{suffix}"
            if f"_at_{column}" in moments:
                candidates.append(dates.iso_text(F.col(f"_at_{column}"), F.col(f"_zone_{column}")))
            elif column in names:
                groups = _groups(sites, stage, field, suffix)
                branches = [(extractors, CLEAN[kind](F.col(f"raw.{column}"))) for kind, extractors in groups.items()]
                candidates.append(_choose(branches, len(sites)))
    return candidates


def _moments(sites: dict[str, Site], names: set[str]) -> dict[str, Column]:
    """Columns for the dates that are no `_ladder`, by raw field: parsed in a step of its own, as the text of a moment takes it more
    than once."""
    found: dict[str, Column] = {}
    for stage in STAGES:
        column, groups = f"{stage}_publication_date", _groups(sites, stage, "publication_date")
        if column in names and set(groups) <= set(MOMENTS):
            for i, prefix in enumerate(("_at_", "_zone_")):
                branches = [(extractors, MOMENTS[kind][i](F.col(f"raw.{column}"))) for kind, extractors in groups.items()]
                found[f"{prefix}{column}"] = _choose(branches, len(sites))
    return found


def _dates(df: DataFrame, sites: dict[str, Site]) -> DataFrame:
    """Add `_ladder`: cleaning, parsing and printing are one projection each, so that no regex is copied."""
    rules = {name: s.date for name, s in sites.items() if s.date is not None}
    special, ladders, scripted = [], defaultdict(list), []
    for name, r in rules.items():
        cleaning = {"cut_dash": r.cut_dash, "drop_weekday": r.drop_weekday, "month_names": r.month_names}
        if any(cleaning.values()) or r.cleaner:
            cleaner = clean_date(r.cleaner) if r.cleaner else None
            special.append(([name], dates.date_text(F.col("raw.date_text"), cleaner=cleaner, **cleaning)))
        ladders[r.formats, r.no_year_format if r.year_css else None, r.time_of_crawl_day].append(name)
        if r.json_ld_css:
            scripted.append(name)
    text_of_date = F.col("raw.date_text")
    if special:
        text_of_date = _choose(special, 0).otherwise(text_of_date)
    df = df.withColumns({"_cleaned": text_of_date, "_year": dates.footer_year(F.col("raw.year_text"))})
    df = df.withColumn("_quiet", dates.without_noise(F.col("_cleaned")))
    branches = []
    for (formats, no_year, time_of_crawl_day), names in ladders.items():
        steps = dates.climb(
            F.col("_cleaned"), F.col("_quiet"), F.col("crawl_ts"), formats, F.col("_year"), no_year, time_of_crawl_day
        )
        branches.append((names, steps))
    moment = _choose(branches, len(sites))
    if scripted:
        published = F.when(F.col("extractor").isin(*scripted), dates.json_ld_date(F.col("raw.json_ld")))
        moment = F.coalesce(published, moment)
    return df.withColumn("_ladder", dates.iso_text(moment)).drop("_cleaned", "_year", "_quiet")


def required_fields(df: DataFrame, sites: dict[str, Site]) -> DataFrame:
    """Add the fields that an article must have, and the number of the task. That is non-deterministic, so that no filter is pushed
    below this step, where it would clean the fields a second time."""
    return df.withColumns({**_fields(REQUIRED, sites), "_task": F.spark_partition_id()})


def article_fields(df: DataFrame, sites: dict[str, Site]) -> DataFrame:
    """Add the other article fields."""
    with_ladder = any(s.date is not None for s in sites.values())
    if with_ladder:
        df = _dates(df, sites)
    moments = _moments(sites, set(raw_columns(sites)))
    others = [field for field in FIELDS if field not in REQUIRED]
    df = df.withColumns(moments) if moments else df
    return df.withColumns(_fields(others, sites, moments, with_ladder)).drop("_ladder", "_task", "raw", *moments)


def _fields(
    wanted: Sequence[str], sites: dict[str, Site], moments: dict[str, Column] | None = None, with_ladder: bool = False
) -> dict[str, Column]:
    """Article fields from the struct `raw`: first non-null of custom, article and head."""
    names = set(raw_columns(sites))
    fields: dict[str, Column] = {}
    for field in wanted:
        candidates = _field(field, sites, names, moments or {})
        if field == "publication_date" and with_ladder:
            candidates = [F.col("_ladder"), *candidates]
        if field == "comments_num" and "custom_comments_form" in names:
            # an empty comment form means no comments; a found counter without digits stays null
            form = F.when(F.col("raw.custom_comments_num").isNull(), F.col("raw.custom_comments_form"))
            candidates.append(form)
        kind = "array<string>" if field in ("author", "keywords") else "string"
        fields[field] = F.coalesce(*candidates) if candidates else F.lit(None).cast(kind)
    return fields
