"""Readers, writers and streams: tables are written to the shared folder and read back."""

from __future__ import annotations

import json
import os

from pyspark.sql import functions as F

from catalog.base import query, table
from catalog.jobs import CURATED_CTES, author_list, raw_articles, shown
from catalog.pages import EXAMPLE_ROUTES, EXAMPLE_SITE, PAGE_CTES
from catalog.urls import CAPTURES_SQL, EXPECTED_ROUTES, ROUTED, captures
from pressloom.operators import filters, routing
from pressloom.operators.lookups import author_dimension
from pressloom.plans.curate import curate
from pressloom.plans.extract import extract
from pressloom.session import shared_dir
from pressloom.sources import index, readers, writers
from pressloom.sources.config import Route, read_routes, route_list
from pressloom.streaming import intake

RAW_SQL = """SELECT doc_id, 'D' || doc_id AS digest, doc_id AS "offset", text AS content, length(text) AS n FROM documents"""


def _raw_shown(df):
    return df.select(
        F.col("domain_record.offset").alias("doc_id"),
        F.col("domain_record.digest").alias("digest"),
        F.col("domain_record.offset").alias("offset"),
        "content",
        F.length("content").cast("bigint").alias("n"),
    )


@query("read_articles", RAW_SQL)
def read_articles(spark, d):
    """JSON lines written with a record cap, read back under the declared schema."""
    path = shared_dir(spark, "articles")
    writers.write_jsonl(raw_articles(spark, d), path, records_per_file=400)
    return _raw_shown(readers.read_articles(spark, path))


@query(
    "read_articles_quarantine",
    """SELECT count(*) AS n_rows, count(*) FILTER (doc_id % 10 = 0 OR doc_id % 7 = 3) AS n_bad,
              count(DISTINCT source) FILTER (doc_id % 10 <> 0 AND doc_id % 7 <> 3) AS n_sources FROM documents""",
)
def read_articles_quarantine(spark, d):
    """Broken lines, and lines with a comment count that is no number, are kept aside instead of failing the job."""
    path = shared_dir(spark, "broken")
    count = F.when(F.col("doc_id") % 7 == 3, "many").when(F.col("doc_id") % 7 == 4, "12").alias("comments_num")
    row = F.to_json(F.struct(F.col("text").alias("content"), F.col("source").alias("url"), count))
    line = F.when(F.col("doc_id") % 10 == 0, F.substring_index(row, "}", 1)).otherwise(row)
    table(spark, d, "documents").select(line.alias("value")).write.text(path)
    rows = readers.read_articles(spark, path, quarantine=True).select("url", readers.QUARANTINE)
    good = F.when(F.col(readers.QUARANTINE).isNull(), F.col("url"))
    return rows.agg(
        F.count("*").alias("n_rows"), F.count(readers.QUARANTINE).alias("n_bad"), F.countDistinct(good).alias("n_sources")
    )


@query("read_article_tree", RAW_SQL + " WHERE doc_id % 3 < 2")
def read_article_tree(spark, d):
    """All files of one ending below a folder, at any depth; files of other endings are left out."""
    root = shared_dir(spark, "tree")
    rows = raw_articles(spark, d)
    third = F.col("domain_record.offset") % 3
    rows.where(third == 0).write.json(os.path.join(root, "a"))
    rows.where(third == 1).write.json(os.path.join(root, "b", "c"))
    rows.where(third == 2).select(F.to_json(F.struct("*"))).write.text(os.path.join(root, "b", "d"))
    return _raw_shown(readers.read_article_tree(spark, root, pattern="*.json"))


_CAPTURE_ROWS = f"SELECT digest, event_id AS \"offset\", strftime(crawl_ts, '%Y-%m-%d %H:%M:%S') AS crawled FROM ({CAPTURES_SQL})"


@query("read_index", _CAPTURE_ROWS)
def read_index(spark, d):
    """Bare and wrapped index lines."""
    root = shared_dir(spark, "index")
    rows = captures(spark, d).drop("event_id")
    rows.where("offset % 2 = 0").write.json(os.path.join(root, "bare"))
    wrapped = rows.where("offset % 2 = 1").select(F.struct("*").alias("domain_record"))
    wrapped.write.json(os.path.join(root, "wrapped"))
    return index.read_index(spark, os.path.join(root, "*")).select(
        "digest", "offset", F.date_format("crawl_ts", "yyyy-MM-dd HH:mm:ss").alias("crawled")
    )


@query(
    "read_author_gender",
    "SELECT c_name AS author, CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 2 END::INTEGER AS gender FROM customer",
)
def read_author_gender(spark, d):
    path = shared_dir(spark, "authors")
    gender = F.when(F.col("c_custkey") % 3 == 0, " male").when(F.col("c_custkey") % 3 == 1, "female").otherwise("x")
    table(spark, d, "customer").select("c_name", gender).write.option("ignoreLeadingWhiteSpace", False).csv(path)
    return author_dimension(readers.read_author_gender(spark, path))


@query(
    "read_stop_list",
    """SELECT doc_id, text FROM documents WHERE length(text) > 0 AND text NOT IN
         (SELECT text FROM documents WHERE source = 'src0' AND NOT contains(text, chr(10))) ORDER BY doc_id""",
)
def read_stop_list(spark, d):
    path = shared_dir(spark, "stop")
    docs = table(spark, d, "documents").select("doc_id", "text", "source")
    docs.where("source = 'src0' AND NOT contains(text, '\n')").select("text").write.text(path)
    return filters.without_headlines(docs.drop("source"), readers.read_stop_list(spark, path), "text")


@query("read_routes", ROUTED)
def read_routes_query(spark, d):
    """Routes from a configuration file, applied to captures."""
    path = shared_dir(spark, "routes")
    groups: dict[str, list] = {}
    for site, extractor, since, until in EXPECTED_ROUTES:
        bounds = {k: v.replace(" ", "T") + "+00:00" for k, v in (("since", since), ("to", until)) if v}
        groups.setdefault(rf".*{site}\.cz.*", []).append({"name": extractor, **bounds})
    config = {"extractors_path": "x", "routes": [{"regexes": [k], "extractors": v} for k, v in groups.items()]}
    spark.range(1).select(F.lit(json.dumps(config, indent=1)).alias("value")).coalesce(1).write.text(path)
    routes = route_list(read_routes(spark, path))
    return routing.route(index.with_crawl_ts(captures(spark, d)), routes).select("event_id", "extractor")


_PAGE_KEYS = f"WITH {PAGE_CTES} SELECT page_id, headline FROM page_rows WHERE content <> ''"


@query("read_pages_bytes", _PAGE_KEYS)
def read_pages_bytes(spark, d):
    """A page table with raw bytes and a charset column, scanned from Parquet."""
    path = shared_dir(spark, "pages")
    pages = table(spark, d, "pages").select(
        "url",
        F.encode("html", "UTF-16LE").alias("body"),
        F.lit("utf-16-le").alias("encoding"),
        F.col("page_id").alias("offset"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("crawl_ts"),
    )
    pages.write.parquet(path)
    articles = extract(readers.read_pages(spark, path), EXAMPLE_ROUTES, {"example": EXAMPLE_SITE})
    return articles.select(F.col("domain_record.offset").alias("page_id"), "headline")


@query("read_html_folder", _PAGE_KEYS)
def read_html_folder(spark, d):
    """A folder of HTML files, one page each; the file's path is the URL."""
    root = shared_dir(spark, "html")
    folders = writers.write_page_files(table(spark, d, "pages"), root, "page_id", "html")
    files = readers.read_html_folder(spark, folders, date="2024-01-01 00:00:00", pattern="*.txt")
    articles = extract(files, [Route(r".*page_id=.*", "example")], {"example": EXAMPLE_SITE})
    page_id = F.regexp_extract("url", r"page_id=(\d+)", 1).cast("bigint")
    return articles.select(page_id.alias("page_id"), "headline")


@query("write_dataset", f"WITH {CURATED_CTES} SELECT * EXCLUDE (sets), unnest(sets) AS split FROM curated")
def write_dataset(spark, d):
    path = shared_dir(spark, "dataset")
    writers.write_dataset(curate(raw_articles(spark, d), author_list(spark, d)), path)
    return shown(readers.read_dataset(spark, path))


@query(
    "read_one_split",
    f"""WITH {CURATED_CTES} SELECT url, split FROM (SELECT url, unnest(sets) AS split FROM curated) WHERE split = 'test'""",
)
def read_one_split(spark, d):
    """Reading one split prunes to its folder."""
    path = shared_dir(spark, "dataset")
    writers.write_dataset(curate(raw_articles(spark, d), author_list(spark, d)), path)
    return readers.read_dataset(spark, path, split="test").select("url", "split")


@query(
    "label_json",
    f"""WITH {CURATED_CTES}, g AS (SELECT *, [['None', 'Man', 'Woman'][x::INTEGER + 1] for x in string_split(authors_gender, '|')
               if x <> ''] AS gender_names FROM curated)
        SELECT url, '{{"url":"' || url || '","date":' || coalesce('"' || date || '"', 'null') ||
          ',"category":"' || coalesce(en, 'None') || '","authors_gender":[' ||
          array_to_string(['"' || x || '"' for x in gender_names], ',') ||
          '],"authors_cum_gender":"' || ['None', 'Man', 'Woman', 'Mixed'][authors_cum_gender + 1] || '"}}' AS json
        FROM g LEFT JOIN cat ON cat.id = g.category""",
)
def label_json(spark, d):
    """Rows as JSON text with class names and ISO dates."""
    rows = curate(raw_articles(spark, d), author_list(spark, d), split=False)
    rows = rows.select("url", "date", "category", "authors_gender", "authors_cum_gender")
    return rows.select("url", writers.label_json(rows).alias("json"))


def _drained(spark, stream, name, form="parquet"):
    out = shared_dir(spark, name)
    intake.write_stream(stream, out, shared_dir(spark, f"{name}-checkpoint"), form).awaitTermination()
    return out


@query("stream_index", _CAPTURE_ROWS)
def stream_index(spark, d):
    """Index lines of one folder per domain, drained by a stream."""
    root = shared_dir(spark, "queue")
    rows = captures(spark, d).drop("event_id").withColumn("queue", F.regexp_extract("url", r"([a-z]+)\.cz", 1))
    rows.write.partitionBy("queue").json(root)
    stream = intake.read_index_stream(spark, os.path.join(root, "*"), files_per_trigger=3)
    out = _drained(spark, stream, "index-stream")
    return spark.read.parquet(out).select(
        "digest", "offset", F.date_format("crawl_ts", "yyyy-MM-dd HH:mm:ss").alias("crawled")
    )


@query("stream_duplicates", "SELECT DISTINCT user_id, event_type FROM events")
def stream_duplicates(spark, d):
    """Streaming duplicate suppression over several micro-batches equals the batch form."""
    source = shared_dir(spark, "events")
    events = table(spark, d, "events").select("user_id", "event_type", F.col("ts").alias("crawl_ts"))
    events.repartition(4, "user_id").write.parquet(source)
    stream = intake.read_stream(spark, source, events.schema, files_per_trigger=2)
    out = _drained(spark, intake.drop_duplicates(stream, ["user_id", "event_type"]), "unique")
    return spark.read.parquet(out).select("user_id", "event_type")


@query(
    "stream_duplicates_unordered",
    """SELECT DISTINCT user_id, CASE WHEN event_id % 50 = 0 THEN NULL ELSE event_type END AS event_type,
         CASE WHEN event_id % 50 = 0 THEN event_id END AS event_id FROM events""",
)
def stream_duplicates_unordered(spark, d):
    """Captures of many years in no order: the first of each key passes, however old it is, and so do all without a key."""
    source = shared_dir(spark, "unordered")
    key = F.col("event_id")
    days = F.make_dt_interval(days=((F.col("user_id") * 97 + key) % 5000).cast("int"))
    events = table(spark, d, "events").select(
        "user_id", F.when(key % 50 != 0, F.col("event_type")).alias("event_type"), "event_id", (F.col("ts") - days).alias("crawl_ts")
    )
    # later years come first in some files, earlier ones in others
    events.repartitionByRange(6, F.pmod(key * 7919, F.lit(6))).sortWithinPartitions(F.desc("crawl_ts")).write.parquet(source)
    stream = intake.read_stream(spark, source, events.schema, files_per_trigger=1)
    out = _drained(spark, intake.drop_duplicates(stream, ["user_id", "event_type"]), "unordered-unique")
    lacking = F.when(F.col("event_type").isNull(), F.col("event_id")).alias("event_id")
    return spark.read.parquet(out).select("user_id", "event_type", lacking)


# A bucket that remembers its last keys; with room for every key the first of each passes, and all rows without one do.
@query(
    "stream_duplicates_bounded",
    """SELECT DISTINCT user_id, CASE WHEN event_id % 50 = 0 THEN NULL ELSE event_type END AS event_type,
         CASE WHEN event_id % 50 = 0 THEN event_id END AS event_id FROM events""",
)
def stream_duplicates_bounded(spark, d):
    """At most so many keys are remembered; the stream stops half-way and goes on from its checkpoint."""
    source, out, checkpoint = (shared_dir(spark, f"bounded-{n}") for n in ("in", "out", "checkpoint"))
    key = F.col("event_id")
    rows = table(spark, d, "events").select("user_id", F.when(key % 50 != 0, F.col("event_type")).alias("event_type"), "event_id")
    at_most = 16 * rows.select("user_id", "event_type").distinct().count()
    for half in (0, 1):
        rows.where(F.pmod(F.xxhash64("event_id"), F.lit(2)) == half).repartition(2).write.mode("append").parquet(source)
        stream = intake.read_stream(spark, source, rows.schema, files_per_trigger=1)
        unique = intake.drop_duplicates(stream, ["user_id", "event_type"], at_most=at_most, buckets=16)
        intake.write_stream(unique, out, checkpoint).awaitTermination()
    lacking = F.when(F.col("event_type").isNull(), F.col("event_id")).alias("event_id")
    return spark.read.parquet(out).select("user_id", "event_type", lacking)


@query("stream_extract", _PAGE_KEYS)
def stream_extract(spark, d):
    """Streaming extraction into Parquet files."""
    source = shared_dir(spark, "page-stream")
    pages = table(spark, d, "pages").select(
        "url", "html", F.col("page_id").alias("offset"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("crawl_ts")
    )
    pages.write.parquet(source)
    stream = intake.read_stream(spark, source, pages.schema)
    articles = intake.extract_stream(stream, routes=EXAMPLE_ROUTES, sites={"example": EXAMPLE_SITE})
    out = _drained(spark, articles, "article-stream")
    return spark.read.parquet(out).select(F.col("domain_record.offset").alias("page_id"), "headline")
