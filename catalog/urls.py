"""URL parts, page filters, routing and the capture index over pages, events and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import pick, query, sql_pick, sql_text, table
from pressloom.functions import urls
from pressloom.operators import filters, routing
from pressloom.sources.config import DEFAULT_ROUTES, SITE_PATTERN, Route
from pressloom.sources.index import query_index, with_crawl_ts

HOST = "regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)"
PATH = "regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)"


@query(
    "server_label",
    f"""WITH u AS (SELECT page_id, string_split({HOST}, '.') AS a FROM pages)
        SELECT page_id, CASE WHEN page_id % 3 = 2 THEN 'aktualne' WHEN a[-1] = 'com' THEN a[-2] ELSE a[-1] END AS server FROM u""",
)
def server_label(spark, d):
    """The last host label, the one before it for the suffix, and the one site that kept its port."""
    with_port = F.regexp_replace("url", r"^([a-z]+://)[^/?#]*", "$1www.site.com:443")
    url = F.when(F.col("page_id") % 3 == 2, with_port).otherwise(F.col("url"))
    return table(spark, d, "pages").select("page_id", urls.server(url, suffix="com").alias("server"))


@query(
    "url_parts",
    f"""WITH u AS (SELECT page_id, url, {HOST} AS host, {PATH} AS path FROM pages)
        SELECT page_id, host, path, string_split(path, '/')[2] AS segment, string_split(path, '/')[3] AS second,
               string_split(path, '/')[2] AS category, string_split(host, '.')[1] AS first_label,
               left(replace(url, '/', '_'), 80) AS file_name FROM u""",
)
def url_parts(spark, d):
    url = F.col("url")
    return table(spark, d, "pages").select(
        "page_id",
        urls.authority(url).alias("host"),
        urls.path(url).alias("path"),
        urls.path_segment(url, 1).alias("segment"),
        urls.path_segment(url, 2).alias("second"),
        urls.category_from_path(url).alias("category"),
        urls.first_host_label(url).alias("first_label"),
        urls.file_name(url).alias("file_name"),
    )


@query(
    "pages_by_status",
    "SELECT page_id, url FROM pages WHERE coalesce([200, 404, NULL, 301][page_id % 4 + 1], 200) = 200",
)
def pages_by_status(spark, d):
    status = F.get(F.array(F.lit(200), F.lit(404), F.lit(None).cast("int"), F.lit(301)), (F.col("page_id") % 4).cast("int"))
    return table(spark, d, "pages").where(filters.status_ok(status)).select("page_id", "url")


@query("pages_rejected_segment", f"SELECT page_id FROM pages WHERE coalesce(string_split({PATH}, '/')[2], '') NOT IN ('en', 'wiki')")
def pages_rejected_segment(spark, d):
    df = table(spark, d, "pages")
    return df.where(filters.first_segment_not_in(F.col("url"), ["en", "wiki"])).select("page_id")


@query("pages_required_segment", f"SELECT page_id FROM pages WHERE string_split({PATH}, '/')[2] = 'fr'")
def pages_required_segment(spark, d):
    return table(spark, d, "pages").where(filters.first_segment_in(F.col("url"), ["fr"])).select("page_id")


@query("pages_by_host_label", f"SELECT page_id FROM pages WHERE string_split({HOST}, '.')[1] IN ('www', 'blog')")
def pages_by_host_label(spark, d):
    return table(spark, d, "pages").where(filters.first_host_label_in(F.col("url"), ["www", "blog"])).select("page_id")


@query(
    "required_fields",
    """SELECT doc_id FROM documents WHERE length(text) > 0 AND length(split_part(text, chr(10), 1)) > 20
       AND doc_id % 3 <> 0""",
)
def required_fields(spark, d):
    head = F.split_part("text", F.lit("\n"), F.lit(1))
    df = table(spark, d, "documents").select(
        "doc_id",
        F.col("text").alias("content"),
        F.when(F.length(head) > 20, head).otherwise(F.when(F.col("doc_id") % 2 == 0, "")).alias("headline"),
        F.when(F.col("doc_id") % 3 != 0, F.array("source")).otherwise(F.array().cast("array<string>")).alias("author"),
    )
    return df.where(filters.has_required()).select("doc_id")


@query(
    "headline_stop_list",
    """WITH h AS (SELECT doc_id, lang, split_part(text, chr(10), 1) AS headline FROM documents)
       SELECT doc_id, headline FROM h WHERE headline NOT IN (SELECT headline FROM h WHERE lang = 'fr')""",
)
def headline_stop_list(spark, d):
    head = F.split_part("text", F.lit("\n"), F.lit(1))
    df = table(spark, d, "documents").select("doc_id", "lang", head.alias("headline"))
    stop = df.where("lang = 'fr'").select("headline")
    return filters.without_headlines(df.select("doc_id", "headline"), stop)


@query(
    "trial_rows",
    "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 100",
)
def trial_rows(spark, d):
    """The trial-run operator: the first rows of a table."""
    return table(spark, d, "documents").select("doc_id", "text").orderBy("doc_id").limit(100)


SITES = ("idnes", "aktualne", "denik", "novinky", "seznamzpravy", "ihned", "irozhlas", "example")
CAPTURE_TIME = "date_trunc('second', ts) - INTERVAL ((user_id * 97 + event_id) % 5000) DAY"
# Expected values, written out: site, extractor and its validity.
EXPECTED_ROUTES = (
    ("idnes", "idnes_cz_v1", None, "2011-08-09 00:00:00"),
    ("idnes", "idnes_cz_v2", "2011-08-09 00:00:00", None),
    ("aktualne", "aktualne_cz_v1", None, "2014-09-10 00:00:00"),
    ("aktualne", "aktualne_cz_v2", "2014-09-10 00:00:00", "2019-09-10 00:00:00"),
    ("aktualne", "aktualne_cz_v3", "2019-09-10 00:00:00", None),
    ("denik", "denik_cz_v1", None, "2012-02-29 00:00:00"),
    ("denik", "denik_cz_v2", "2012-02-29 00:00:00", "2018-12-01 00:00:00"),
    ("denik", "denik_cz_v3", "2018-12-01 00:00:00", None),
    ("novinky", "novinky_cz_v1", None, "2019-08-06 00:00:00"),
    ("novinky", "novinky_cz_v2", "2019-08-06 00:00:00", None),
    ("seznamzpravy", "seznamzpravy_cz", None, None),
    ("ihned", "ihned_cz_v1", None, "2011-05-05 00:00:00"),
    ("ihned", "ihned_cz_v2", "2011-05-05 00:00:00", "2019-05-05 00:00:00"),
    ("ihned", "ihned_cz_v3", "2019-05-05 00:00:00", None),
    ("irozhlas", "irozhlas_cz", None, None),
)
ROUTE_ROWS = ", ".join(f"({', '.join(map(sql_text, r))})" for r in EXPECTED_ROUTES)
ROUTED = f"""WITH c AS (SELECT event_id, {sql_pick('event_id', *SITES)} AS site, {CAPTURE_TIME} AS crawl_ts FROM events),
     r AS (SELECT site, extractor, since::TIMESTAMP AS since, until::TIMESTAMP AS until
           FROM (VALUES {ROUTE_ROWS}) AS r(site, extractor, since, until))
     SELECT event_id, extractor FROM c JOIN r ON c.site = r.site
      AND (since IS NULL OR crawl_ts >= since) AND (until IS NULL OR crawl_ts < until)"""


def captures(spark, d):
    """An index derived from events: one capture per event over the sites and the crawl years."""
    days = F.make_dt_interval(days=((F.col("user_id") * 97 + F.col("event_id")) % 5000).cast("int"))
    site = pick(F.col("event_id"), *SITES)
    when = F.date_trunc("second", "ts") - days
    host = F.concat(pick(F.col("user_id"), "www.", "m.", ""), site, F.lit(".cz"))
    return table(spark, d, "events").select(
        "event_id",
        F.concat(F.lit("CAP"), F.pmod(F.col("event_id"), F.lit(977)).cast("string")).alias("digest"),
        F.lit(None).cast("string").alias("encoding"),
        F.concat(F.lit("crawl/"), "event_type", F.lit(".warc.gz")).alias("filename"),
        (F.col("user_id") + 1).cast("int").alias("length"),
        F.col("event_id").alias("offset"),
        F.date_format(when, "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.concat(F.lit("https://"), host, F.lit("/clanek/"), F.col("user_id").cast("string")).alias("url"),
    )


@query("routes_by_case", ROUTED)
def routes_by_case(spark, d):
    pages = with_crawl_ts(captures(spark, d))
    return routing.route(pages, DEFAULT_ROUTES).select("event_id", "extractor")


@query("routes_by_join", ROUTED)
def routes_by_join(spark, d):
    return routing.route_join(with_crawl_ts(captures(spark, d)), _route_table(spark, EXPECTED_ROUTES), SITE_PATTERN).select("event_id", "extractor")


def _route_table(spark, routes):
    rows = [(i, *r) for i, r in enumerate(routes)]
    df = spark.createDataFrame(rows, "position int, site string, extractor string, since string, until string")
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("since", "until")})


@query(
    "routes_interleaved",
    f"""WITH c AS (SELECT event_id, user_id, {sql_pick('event_id', *SITES)} AS site, {CAPTURE_TIME} AS crawl_ts FROM events),
        r AS (SELECT event_id, CASE WHEN site = 'idnes' AND crawl_ts < TIMESTAMP '2018-01-01' THEN 'old_idnes'
                WHEN user_id::VARCHAR LIKE '1%' THEN 'ones' WHEN site = 'idnes' THEN 'new_idnes'
                WHEN site = 'novinky' AND crawl_ts >= TIMESTAMP '2016-01-01' THEN 'late'
                WHEN site = 'novinky' AND crawl_ts < TIMESTAMP '2020-01-01' THEN 'early' END AS extractor FROM c)
        SELECT * FROM r WHERE extractor IS NOT NULL""",
)
def routes_interleaved(spark, d):
    """Routes of two patterns in turn and routes that overlap in time: the first that matches wins."""
    routes = [
        Route(r".*idnes\.cz.*", "old_idnes", None, "2018-01-01 00:00:00"),
        Route(r".*/clanek/1.*", "ones"),
        Route(r".*idnes\.cz.*", "new_idnes"),
        Route(r".*novinky\.cz.*", "late", "2016-01-01 00:00:00", None),
        Route(r".*novinky\.cz.*", "early", None, "2020-01-01 00:00:00"),
    ]
    return routing.route(with_crawl_ts(captures(spark, d)), routes).select("event_id", "extractor")


@query(
    "routes_overlapping_join",
    f"""WITH c AS (SELECT event_id, {sql_pick('event_id', *SITES)} AS site, {CAPTURE_TIME} AS crawl_ts FROM events),
        r AS (SELECT event_id, CASE WHEN site = 'novinky' AND crawl_ts >= TIMESTAMP '2016-01-01' THEN 'late'
                WHEN site = 'novinky' AND crawl_ts < TIMESTAMP '2020-01-01' THEN 'early'
                WHEN site = 'denik' THEN 'first' END AS extractor FROM c)
        SELECT * FROM r WHERE extractor IS NOT NULL""",
)
def routes_overlapping_join(spark, d):
    """The same by a table: a page in two validities gets the first route, once."""
    routes = (
        ("novinky", "late", "2016-01-01 00:00:00", None),
        ("denik", "first", None, None),
        ("novinky", "early", None, "2020-01-01 00:00:00"),
        ("denik", "second", None, None),
    )
    found = routing.route_join(with_crawl_ts(captures(spark, d)), _route_table(spark, routes), SITE_PATTERN)
    return found.select("event_id", "extractor")


CAPTURES_SQL = f"""SELECT event_id, 'CAP' || (event_id % 977) AS digest, user_id, event_type, {CAPTURE_TIME} AS crawl_ts,
      'https://' || {sql_pick('user_id', 'www.', 'm.', '')} || {sql_pick('event_id', *SITES)} || '.cz' AS host FROM events"""


@query(
    "index_by_domain",
    f"""WITH c AS ({CAPTURES_SQL}) SELECT event_id, strftime(crawl_ts, '%Y-%m-%d %H:%M:%S') AS crawled FROM c
        WHERE (host LIKE '%.idnes.cz' OR host LIKE '%/idnes.cz' OR host LIKE '%.ihned.cz' OR host LIKE '%/ihned.cz')
          AND crawl_ts BETWEEN TIMESTAMP '2012-01-01' AND TIMESTAMP '2021-06-30 12:00:00'""",
)
def index_by_domain(spark, d):
    hits = query_index(
        with_crawl_ts(captures(spark, d)), ["idnes.cz", "ihned.cz"], "2012-01-01 00:00:00", "2021-06-30 12:00:00"
    )
    return hits.select("event_id", F.date_format("crawl_ts", "yyyy-MM-dd HH:mm:ss").alias("crawled"))


@query(
    "index_by_domain_limited",
    f"""WITH c AS ({CAPTURES_SQL})
        SELECT least(25, count(*))::BIGINT AS n_rows FROM c WHERE host LIKE '%.idnes.cz' OR host LIKE '%/idnes.cz'""",
)
def index_by_domain_limited(spark, d):
    """The limit of an index query; which captures it returns is open, so their number is compared."""
    hits = query_index(with_crawl_ts(captures(spark, d)), ["idnes.cz"], limit=25)
    return hits.agg(F.count("*").alias("n_rows"))


@query(
    "index_first_captures",
    f"""WITH c AS ({CAPTURES_SQL})
        SELECT event_id, strftime(crawl_ts, '%Y-%m-%d %H:%M:%S') AS crawled FROM c WHERE host LIKE '%.idnes.cz' OR host LIKE '%/idnes.cz'
        ORDER BY crawl_ts, event_type, event_id LIMIT 200""",
)
def index_first_captures(spark, d):
    """The captures that a limit returns are the first ones crawled."""
    hits = query_index(with_crawl_ts(captures(spark, d)), ["idnes.cz"], limit=200)
    return hits.select("event_id", F.date_format("crawl_ts", "yyyy-MM-dd HH:mm:ss").alias("crawled"))


# A thousand routes: two validities of every other site, one that no host pins, and URLs that name a second site.
MANY_ROUTES = [
    Route(r".*/late/.*", "by_path", "2020-01-01 00:00:00"),
    *[r for i in range(666) for r in ((Route(rf".*site{i}\.cz.*", f"old_{i}", None, "2016-06-01 00:00:00"),) if i % 2 else ()) + (Route(rf".*site{i}\.cz.*", f"new_{i}"),)],
]
MANY_SQL = f"""WITH c AS (SELECT event_id, {CAPTURE_TIME} AS crawl_ts, 'https://' || {sql_pick('user_id', 'www.', 'm.', 'my')} || 'site' || (event_id % 700) || '.cz/' ||
         {sql_pick('event_id // 7', 'clanek', 'late')} || '/' || user_id || CASE WHEN event_id % 11 = 0 THEN '?from=site' || (user_id % 50) || '.cz' ELSE '' END AS url FROM events),
     site AS (SELECT event_id, crawl_ts, url, least(event_id % 700, CASE WHEN event_id % 11 = 0 THEN nullif(regexp_extract(url, 'from=site([0-9]+)', 1), '')::BIGINT END) AS i FROM c)
     SELECT event_id, CASE WHEN contains(url, '/late/') AND crawl_ts >= TIMESTAMP '2020-01-01' THEN 'by_path'
         WHEN i % 2 = 1 AND crawl_ts < TIMESTAMP '2016-06-01' THEN 'old_' || i ELSE 'new_' || i END AS extractor
     FROM site WHERE i < 666 OR (contains(url, '/late/') AND crawl_ts >= TIMESTAMP '2020-01-01')"""


def many_captures(spark, d):
    """Captures of 700 sites, some with the name of another one in the query."""
    key = F.col("event_id")
    other = F.when(key % 11 == 0, F.concat(F.lit("?from=site"), (F.col("user_id") % 50).cast("string"), F.lit(".cz"))).otherwise("")
    site = F.concat(pick(F.col("user_id"), "www.", "m.", "my"), F.lit("site"), (key % 700).cast("string"), F.lit(".cz/"))
    path = F.concat(pick(F.floor(key / 7), "clanek", "late"), F.lit("/"), F.col("user_id").cast("string"))
    days = F.make_dt_interval(days=((F.col("user_id") * 97 + key) % 5000).cast("int"))
    when = (F.date_trunc("second", "ts") - days).cast("timestamp_ntz")
    return table(spark, d, "events").select("event_id", when.alias("crawl_ts"), F.concat(F.lit("https://"), site, path, other).alias("url"))


@query("routes_thousand", MANY_SQL)
def routes_thousand(spark, d):
    """The first of a thousand routes that matches, found by the text before the dots of the URL."""
    return routing.route(many_captures(spark, d), MANY_ROUTES).select("event_id", "extractor")
