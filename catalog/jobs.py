"""Curation, collection and merging as whole jobs, with raw articles and author lists derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (
    dealt,
    pick,
    query,
    sql_drop_dot,
    sql_pick,
    sql_squash,
    sql_upper_first,
    table,
)
from catalog.lookups import CATEGORY_CTES, RAW_CATEGORIES, sql_category
from catalog.urls import CAPTURES_SQL, captures
from pressloom.plans import collect as collecting
from pressloom.plans.curate import curate
from pressloom.plans.merge import merge
from pressloom.session import shared_dir
from pressloom.sources.index import with_crawl_ts
from pressloom.sources.writers import write_dataset

SERVERS = ("idnes", "denik", "aktualne", "irozhlas", "seznamzpravy", "novinky", "ihned")
SERVER_IDS = "[1, 2, 3, 4, 5, 6, 0]"
# Bylines around the source name, and the authors that remain with their genders.
BYLINES = ("Mgr. {} Novák", "{} čápová - redaktorka", "neznámý {}", "text {} NOVÁK (red)")
KEPT = (("Novák", 1), ("Čápová", 2), (None, None), ("Novák", 1))


def author_list(spark, d):
    """Two known authors per document source: a man (spelled exactly) and a woman (spelled exactly)."""
    source = F.initcap(F.col("source"))
    docs = table(spark, d, "documents").select("source").distinct()
    man = docs.select(F.concat(source, F.lit(" Novák")).alias("author"), F.lit("male").alias("gender"))
    woman = docs.select(F.concat(source, F.lit(" Čápová")).alias("author"), F.lit("female").alias("gender"))
    return man.unionByName(woman)


def raw_articles(spark, d):
    """Documents in the raw article schema."""
    key = F.col("doc_id")
    moment = F.lit("2010-01-01 23:05:00").cast("timestamp_ntz") + F.make_dt_interval(hours=(key * 7 % 90000).cast("int"))
    offset = pick(key, "", "+02:00", "-11:00")
    published = F.when(key % 11 != 0, F.concat(F.date_format(moment, "yyyy-MM-dd HH:mm:ss"), offset))
    first, second = (
        F.concat(
            pick(key / div, *[b.split("{}")[0] for b in BYLINES]),
            F.col("source"),
            pick(key / div, *[b.split("{}")[1] for b in BYLINES]),
        )
        for div in (1, 4)
    )
    sets = (
        F.when(key % 5 == 0, F.array(F.lit("test"), F.lit("test_small")))
        .when(key % 5 == 1, F.array(F.lit("validation")))
        .when(key % 5 == 2, F.array().cast("array<string>"))
        .otherwise(F.array(F.lit("train")))
    )
    host = F.concat(pick(key, "www.", "m.", ""), pick(key, *SERVERS), F.lit(".cz"))
    none = F.lit(None).cast("string")
    return dealt(table(spark, d, "documents"), "doc_id").select(
        F.concat(F.lit("https://"), host, F.lit("/clanek/"), key.cast("string")).alias("url"),
        F.when(key % 6 == 0, F.array().cast("array<string>")).when(key % 6 != 1, F.array(first, second)).alias("author"),
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("headline"),
        F.when(key % 4 != 0, F.concat(F.lit("\xa0"), F.lower("text"))).alias("brief"),
        published.alias("publication_date"),
        F.when(key % 7 != 0, F.split("text", "[.]")).alias("keywords"),
        pick(key, *RAW_CATEGORIES).alias("category"),
        F.col("text").alias("content"),
        F.when(key % 3 == 0, key.cast("int")).alias("comments_num"),
        F.struct(
            F.concat(F.lit("D"), key.cast("string")).alias("digest"),
            none.alias("encoding"),
            F.col("source").alias("filename"),
            F.col("n_chars").cast("int").alias("length"),
            key.alias("offset"),
            F.lit("2023-03-22 02:06:35").alias("timestamp"),
            none.alias("url"),
        ).alias("domain_record"),
        F.struct(sets.alias("sets")).alias("additional_info"),
    )


def _sql_byline(div: int, part: str) -> str:
    names = [name for name, _ in KEPT]
    genders = [None if g is None else str(g) for _, g in KEPT]
    index = f"(doc_id // {div})"
    if part == "gender":
        return sql_pick(index, *genders)
    return f"upper(left(source, 1)) || substr(source, 2) || ' ' || {sql_pick(index, *names)}"


CURATED_CTES = f"""{CATEGORY_CTES},
     r AS (SELECT doc_id, source, text, {sql_pick('doc_id', *RAW_CATEGORIES)} AS category_unclean,
             split_part(text, chr(10), 1) AS h, CASE WHEN doc_id % 4 <> 0 THEN chr(160) || lower(text) END AS b,
             CASE WHEN doc_id % 11 <> 0 THEN
               (TIMESTAMP '2010-01-01 23:05:00' + INTERVAL (doc_id * 7 % 90000) HOUR)::DATE END AS day,
             'https://' || {sql_pick('doc_id', 'www.', 'm.', '')} || {sql_pick('doc_id', *SERVERS)} || '.cz/clanek/' || doc_id AS url,
             {SERVER_IDS}[doc_id % 7 + 1] AS server,
             CASE WHEN doc_id % 6 < 2 THEN [] ELSE
               [x for x in [{_sql_byline(1, 'name')}, {_sql_byline(4, 'name')}] if x IS NOT NULL] END AS names,
             CASE WHEN doc_id % 6 < 2 THEN [] ELSE
               [x for x in [{_sql_byline(1, 'gender')}, {_sql_byline(4, 'gender')}] if x IS NOT NULL] END AS genders,
             CASE doc_id % 5 WHEN 0 THEN ['test', 'test_small'] WHEN 1 THEN ['validation'] WHEN 2 THEN [] ELSE ['train'] END AS sets
           FROM documents),
     s AS (SELECT *, {sql_drop_dot('h')} AS h1, {sql_drop_dot('b')} AS b1 FROM r),
     t AS (SELECT *, {sql_upper_first('h1')} AS h2, {sql_upper_first('b1')} AS b2 FROM s),
     k AS (SELECT doc_id, pos, {sql_squash('lower(w)')} AS w FROM (SELECT doc_id,
             unnest(string_split(text, '.')) AS w, generate_subscripts(string_split(text, '.'), 1) AS pos
             FROM documents WHERE doc_id % 7 <> 0)),
     k1 AS (SELECT doc_id, pos, {sql_drop_dot('w')} AS x FROM k),
     k2 AS (SELECT doc_id, string_agg({sql_upper_first('x')}, chr(10) ORDER BY pos) AS keywords FROM k1 GROUP BY doc_id),
     c AS ({sql_category('category_unclean', '(SELECT doc_id, category_unclean FROM t)')}),
     curated AS (SELECT url, {sql_squash('h2')} AS headline, {sql_squash('b2')} AS brief, {sql_squash('text')} AS content,
             CASE WHEN t.doc_id % 3 = 0 THEN t.doc_id::INTEGER END AS comments_num, t.category_unclean,
             coalesce(keywords, '') AS keywords, array_to_string(names, '|') AS authors, day::VARCHAR AS date,
             server::INTEGER AS server, coalesce(cat.id, 0)::INTEGER AS category,
             coalesce(isodow(day), 0)::INTEGER AS day_of_week, array_to_string(genders, '|') AS authors_gender,
             CASE WHEN len(genders) = 0 THEN 0 WHEN len(list_distinct(genders)) = 1 THEN genders[1]::INTEGER ELSE 3 END
               AS authors_cum_gender, sets
           FROM t LEFT JOIN k2 USING (doc_id) JOIN c USING (doc_id) LEFT JOIN cat ON cat.en = c.category)"""


def shown(df):
    lists = {
        "keywords": F.array_join("keywords", "\n"),
        "authors": F.array_join("authors", "|"),
        "authors_gender": F.array_join(F.col("authors_gender").cast("array<string>"), "|"),
        "date": F.col("date").cast("string"),
    }
    return df.withColumns(lists)


@query("curate_articles", f"WITH {CURATED_CTES} SELECT * EXCLUDE (sets) FROM curated")
def curate_articles(spark, d):
    """The whole curation job without the split fan-out."""
    return shown(curate(raw_articles(spark, d), author_list(spark, d), split=False))


@query("curate_splits", f"WITH {CURATED_CTES} SELECT * EXCLUDE (sets), unnest(sets) AS split FROM curated")
def curate_splits(spark, d):
    return shown(curate(raw_articles(spark, d), author_list(spark, d)))


@query("curate_large_author_list", f"WITH {CURATED_CTES} SELECT * EXCLUDE (sets) FROM curated")
def curate_large_author_list(spark, d):
    """The same with all customers' and parts' names in the author list."""
    more = table(spark, d, "customer").select("c_name").union(table(spark, d, "part").select("p_name"))
    authors = author_list(spark, d).union(more.withColumn("gender", F.lit("male")))
    return shown(curate(raw_articles(spark, d), authors, split=False))


@query(
    "merge_datasets",
    f"""WITH {CURATED_CTES}, rows AS (SELECT * EXCLUDE (sets), unnest(sets) AS split FROM curated)
        SELECT * FROM rows UNION ALL SELECT * FROM rows WHERE comments_num IS NOT NULL""",
)
def merge_datasets(spark, d):
    """Two saved datasets merged split by split."""
    dataset = curate(raw_articles(spark, d), author_list(spark, d))
    roots = [shared_dir(spark, "dataset") for _ in range(2)]
    write_dataset(dataset, roots[0])
    write_dataset(dataset.where("comments_num IS NOT NULL"), roots[1])
    return shown(merge(spark, roots))


@query(
    "collect_captures",
    f"""WITH c AS ({CAPTURES_SQL}), hits AS (SELECT * FROM c WHERE
              (host LIKE '%.idnes.cz' OR host LIKE '%/idnes.cz' OR host LIKE '%.novinky.cz' OR host LIKE '%/novinky.cz')
              AND crawl_ts >= TIMESTAMP '2011-01-01')
        SELECT digest, arg_min(event_id, (crawl_ts, event_type, event_id)) AS event_id,
               strftime(min(crawl_ts), '%Y-%m-%d %H:%M:%S') AS crawled FROM hits GROUP BY digest""",
)
def collect_captures(spark, d):
    """Domain query, then the earliest capture of each digest."""
    index = with_crawl_ts(captures(spark, d))
    kept = collecting.collect(index, ["idnes.cz", "novinky.cz"], since="2011-01-01 00:00:00")
    return kept.select("digest", "event_id", F.date_format("crawl_ts", "yyyy-MM-dd HH:mm:ss").alias("crawled"))


# The first half of the hits, some of them without a digest; the limit comes before the copies are dropped.
LIMITED_SQL = f"""WITH c AS (SELECT * REPLACE (CASE WHEN event_id % 5 <> 0 THEN digest END AS digest) FROM ({CAPTURES_SQL})),
     hits AS (SELECT * FROM c WHERE host LIKE '%.idnes.cz' OR host LIKE '%/idnes.cz' OR host LIKE '%.novinky.cz' OR host LIKE '%/novinky.cz'),
     cut AS (SELECT * FROM hits QUALIFY row_number() OVER (ORDER BY crawl_ts, event_type, event_id) <= (SELECT count(*) FROM events) // 8)
     SELECT digest, event_id FROM cut WHERE digest IS NULL
     UNION ALL SELECT digest, arg_min(event_id, (crawl_ts, event_type, event_id)) FROM cut WHERE digest IS NOT NULL GROUP BY digest"""


@query("collect_captures_limited", LIMITED_SQL)
def collect_captures_limited(spark, d):
    """A limit is one fixed set of captures: the first ones crawled, of which copies are dropped; those without a digest stay."""
    index = with_crawl_ts(captures(spark, d)).withColumn("digest", F.when(F.col("event_id") % 5 != 0, F.col("digest")))
    limit = table(spark, d, "events").count() // 8
    return collecting.collect(index, ["idnes.cz", "novinky.cz"], limit=limit).select("digest", "event_id")


@query(
    "merge_again",
    f"""WITH {CURATED_CTES}, rows AS (SELECT * EXCLUDE (sets), unnest(sets) AS split FROM curated)
        SELECT * FROM rows WHERE split <> 'train' UNION ALL SELECT * FROM rows WHERE comments_num IS NOT NULL""",
)
def merge_again(spark, d):
    """A merge that was broken off and is repeated, with a glob of roots: every row is there as often as after one merge."""
    dataset = curate(raw_articles(spark, d), author_list(spark, d))
    folder, target = shared_dir(spark, "datasets"), shared_dir(spark, "merged")
    write_dataset(dataset.where("split <> 'train'"), f"{folder}/first")
    merge(spark, [f"{folder}/*"], target, mode="overwrite_splits")
    write_dataset(dataset.where("comments_num IS NOT NULL"), f"{folder}/second")
    for _ in range(2):
        merged = merge(spark, [f"{folder}/*"], target, mode="overwrite_splits")
    return shown(merged)
