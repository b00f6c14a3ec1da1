"""Extraction job: page table to article rows."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pressloom.functions import urls
from pressloom.operators import filters
from pressloom.operators.pages import FIELDS, article_fields, parse_pages, required_fields
from pressloom.operators.routing import name_pages
from pressloom.plans.sites import Site, sites as registered_sites
from pressloom.schemas import CAPTURE
from pressloom.sources.config import DEFAULT_ROUTES, Route


def page_filter(sites: dict[str, Site], url: Column, http_status: Column) -> Column:
    """Everything that can be decided before a page is parsed, as one native predicate."""
    extractor = F.col("extractor")
    lenient = [name for name, s in sites.items() if s.any_status]
    keep = filters.status_ok(http_status)
    if lenient:
        keep = extractor.isin(*lenient) | keep
    groups: dict[tuple, list[str]] = defaultdict(list)
    for name, s in sites.items():
        groups["rejected", s.rejected_segments].append(name)
        groups["required", s.required_segments].append(name)
        groups["hosts", s.host_labels or ()].append(name)
    tests = {
        "rejected": filters.first_segment_not_in,
        "required": filters.first_segment_in,
        "hosts": filters.first_host_label_in,
    }
    for (kind, values), names in groups.items():
        if values:
            keep = keep & (~extractor.isin(*names) | tests[kind](url, values))
    for name, s in sites.items():
        if s.page_filter is not None:
            keep = keep & ((extractor != name) | s.page_filter())
    return keep


class Report:
    """What became of the pages of an `extract`, counted while it runs: no page is read or parsed a second time.

    Give it to one `extract`, run an action on the result, then read `counts` or `table`. They wait for the first action and
    hold its numbers. Pages by extractor:

    - `routed`: named by a route, and of these
    - `filtered`: rejected before the parse, by status, URL segment, host or a site's page filter
    - `unreadable`: the parse failed
    - `rejected`: by a test of the parsed page
    - `incomplete`: without a required field (0 if none is required)
    - `articles`: the rows that come out
    """

    STAGES = (("routed", "filtered"), ("unreadable", "rejected"), ("incomplete", "articles"))

    def __init__(self) -> None:
        self._seen = [Observation() for _ in self.STAGES]
        self._names: list[str] = []

    def _watch(self, df: DataFrame, stage: int, names: list[str], *conditions: Column, **more: Column) -> DataFrame:
        """Count the rows of each extractor that meet the stage's conditions."""
        self._names = names
        counts = [
            F.count_if((F.col("extractor") == name) & F.coalesce(condition, F.lit(False))).alias(f"{kind}_{i}")
            for kind, condition in zip(self.STAGES[stage], conditions, strict=True)
            for i, name in enumerate(names)
        ]
        return df.observe(self._seen[stage], *counts, *[c.alias(k) for k, c in more.items()])

    @property
    def unrouted(self) -> int:
        """Pages that no route names."""
        return self._seen[0].get["unrouted"]

    def counts(self) -> dict[str, dict[str, int]]:
        """Extractor to kind to number of pages."""
        got: dict[str, int] = {}
        for seen in self._seen:
            got |= seen.get
        return {name: {kind: got[f"{kind}_{i}"] for kinds in self.STAGES for kind in kinds} for i, name in enumerate(self._names)}

    def table(self, spark: SparkSession) -> DataFrame:
        kinds = [kind for own in self.STAGES for kind in own]
        rows = [(name, *[own[k] for k in kinds]) for name, own in self.counts().items()]
        return spark.createDataFrame(rows, f"extractor string, {', '.join(f'{k} bigint' for k in kinds)}")


def extract(
    pages: DataFrame,
    routes: list[Route] = DEFAULT_ROUTES,
    sites: dict[str, Site] | None = None,
    required: bool = True,
    partitions: int | None = None,
    report: Report | None = None,
) -> DataFrame:
    """Article rows of a page table.

    Needs `url`, `crawl_ts` and `html` (text) or `body` (bytes); `http_status` and the capture columns are optional.
    Routing and native filters run below the one Python step, cleaning runs above it. There is no shuffle, unless
    `partitions` asks for one to deal out the pages of few scan tasks, as one file. A page that cannot be read gives no
    row; a `report` counts these and all others that are left out, on the way.
    """
    site_rules = _rules(routes, sites)
    names = list(site_rules)
    parsed = _parsed(pages, routes, site_rules, partitions, report)
    if report is not None:
        parsed = report._watch(parsed, 1, names, F.col("raw.failed"), ~F.col("raw.kept") & ~F.col("raw.failed"))
    article = required_fields(parsed.where("raw.kept").drop(_source(pages)), site_rules)
    complete = F.coalesce(filters.has_required(), F.lit(False)) if required else F.lit(True)
    if report is not None:
        article = report._watch(article, 2, names, ~complete, complete)
    if required:
        article = article.where(filters.has_required() & (F.col("_task") >= 0))
    return article_fields(article, site_rules).select(
        *FIELDS,
        "url",
        urls.file_name(F.col("url")).alias("file_name"),
        "extractor",
        _capture(pages.columns).alias("domain_record"),
    )


def unreadable(pages: DataFrame, routes: list[Route] = DEFAULT_ROUTES, sites: dict[str, Site] | None = None) -> DataFrame:
    """Number of pages per extractor whose parse failed, by a parse of its own; a `Report` counts them within `extract`."""
    failed = _parsed(pages, routes, _rules(routes, sites), None).where("raw.failed")
    return failed.groupBy("extractor").agg(F.count("*").alias("n_pages"))


def _rules(routes: list[Route], sites: dict[str, Site] | None) -> dict[str, Site]:
    known = registered_sites() if sites is None else sites
    used = {r.extractor for r in routes}
    missing = used - set(known)
    if missing:
        raise ValueError(f"routes without a site rule: {sorted(missing)}")
    return {name: s for name, s in known.items() if name in used}


def _source(pages: DataFrame) -> str:
    return "body" if "body" in pages.columns else "html"


def _parsed(pages: DataFrame, routes: list[Route], rules: dict[str, Site], partitions: int | None, report: Report | None = None) -> DataFrame:
    """Routed pages with their raw fields."""
    status = F.col("http_status") if "http_status" in pages.columns else F.lit(None).cast("int")
    encoding = "encoding" if "encoding" in pages.columns else None
    named = name_pages(pages, routes)
    wanted = page_filter(rules, F.col("url"), status)
    if report is not None:
        unrouted = F.count_if(F.col("extractor").isNull())
        named = report._watch(named, 0, list(rules), F.lit(True), ~F.coalesce(wanted, F.lit(False)), unrouted=unrouted)
    routed = named.where(F.col("extractor").isNotNull()).where(wanted)
    routed = routed if partitions is None else routed.repartition(partitions)
    return parse_pages(routed, rules, _source(pages), encoding)


def _capture(columns: list[str]) -> Column:
    """The source record as a struct; columns the page table lacks are null."""

    def value(name: str) -> Column:
        if name == "timestamp" and "timestamp" not in columns:
            return F.left(F.col("crawl_ts").cast("string"), F.lit(19))
        return F.col(name) if name in columns else F.lit(None)

    return F.struct(*[value(f.name).cast(f.dataType).alias(f.name) for f in CAPTURE.fields])
