"""Text, list and author cleaning over documents, pages, parts and customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (
    WS,
    pick,
    query,
    sql_drop_dot,
    sql_entities,
    sql_pick,
    sql_squash,
    sql_strip,
    sql_unify,
    sql_upper_first,
    table,
)
from pressloom.functions import authors, text

TITLE = r"<title>(.*?)</title>"
PADDED = "concat(chr(160), chr(9), {0}, chr(10), ' ', chr(10), chr(9), ' ', chr(9), lang, ' ')"


@query("text_unify", f"SELECT doc_id, {sql_unify(PADDED.format('text'))} AS unified FROM documents")
def text_unify(spark, d):
    padded = F.concat(F.lit("\xa0\t"), "text", F.lit("\n \n\t \t"), "lang", F.lit(" "))
    return table(spark, d, "documents").select("doc_id", text.unify(padded).alias("unified"))


@query("text_strip", f"SELECT doc_id, {sql_strip(PADDED.format('text'))} AS stripped FROM documents")
def text_strip(spark, d):
    padded = F.concat(F.lit("\xa0\t"), "text", F.lit("\n \n\t \t"), "lang", F.lit(" "))
    return table(spark, d, "documents").select("doc_id", text.strip(padded).alias("stripped"))


@query("text_normalize", f"SELECT doc_id, {sql_squash('text')} AS content FROM documents")
def text_normalize(spark, d):
    df = table(spark, d, "documents").select("doc_id", F.col("text").alias("content"))
    return text.normalize_columns(df, "content")


@query(
    "text_entities",
    f"SELECT doc_id, replace({sql_squash('text')}, '###', ' é...&lt;') AS content FROM documents",
)
def text_entities(spark, d):
    """Decoding of entities and NFKC; `&amp;lt;` is decoded once."""
    marked = F.replace("text", F.lit("###"), F.lit("&nbsp;&eacute;&#x2026;&amp;lt;"))
    return table(spark, d, "documents").select("doc_id", text.content(marked).alias("content"))


@query(
    "text_named_entities",
    f"""SELECT doc_id, replace({sql_squash('text')}, '###', ' é...&lt;"') AS content,
               regexp_matches(text, '&[A-Za-z]|&#[0-9xX]') OR doc_id % 50 = 0 AS in_python
        FROM documents""",
)
def text_named_entities(spark, d):
    """Common named entities are decoded without Python; a number in every fiftieth text sends that text there."""
    number = F.when(F.col("doc_id") % 50 == 0, "&#34;").otherwise("&quot;")
    marked = text.squash(F.replace("text", F.lit("###"), F.concat(F.lit("&nbsp;&eacute;&hellip;&amp;lt;"), number)))
    # a mark in every text, as not all have one; it is cut off again
    marked = F.concat(marked, F.when(F.col("doc_id") % 50 == 0, "&#33;").otherwise("&amp;"))
    rows = table(spark, d, "documents").select("doc_id", marked.alias("marked"))
    content = F.regexp_replace(text.decode_entities(F.col("marked")), ".$", "")
    return rows.select("doc_id", content.alias("content"), text.needs_python(F.col("marked")).alias("in_python"))


@query(
    "text_tidy_sentence",
    f"""WITH r AS (SELECT doc_id, {sql_pick('doc_id', '', 'ǅ', 'ǆ', 'é', ' ß')} || text AS raw FROM documents),
             t AS (SELECT doc_id, {sql_drop_dot('raw')} AS x FROM r)
        SELECT doc_id, CASE WHEN doc_id % 5 = 1 THEN x WHEN doc_id % 5 = 2 THEN 'Ǆ' || substr(x, 2) ELSE {sql_upper_first('x')} END AS tidy
        FROM t""",
)
def text_tidy_sentence(spark, d):
    """A title-case letter stays, a small one is raised."""
    raw = F.concat(pick(F.col("doc_id"), "", "ǅ", "ǆ", "é", " ß"), "text")
    return table(spark, d, "documents").select("doc_id", text.tidy_sentence(raw).alias("tidy"))


@query(
    "page_title_headline",
    f"""WITH t AS (SELECT page_id, regexp_extract(html, '{TITLE}', 1) AS raw FROM pages),
             u AS (SELECT page_id, {sql_drop_dot('raw')} AS x FROM t),
             v AS (SELECT page_id, {sql_upper_first('x')} AS y FROM u)
        SELECT page_id, {sql_entities(sql_squash('y'))} AS headline FROM v""",
)
def page_title_headline(spark, d):
    title = F.regexp_extract("html", TITLE, 1)
    return table(spark, d, "pages").select("page_id", text.headline(title).alias("headline"))


@query(
    "dataset_brief",
    f"""WITH t AS (SELECT doc_id, {sql_drop_dot('text')} AS x FROM documents),
             v AS (SELECT doc_id, {sql_upper_first('x')} AS y FROM t)
        SELECT doc_id, {sql_squash('y')} AS brief FROM v""",
)
def dataset_brief(spark, d):
    return table(spark, d, "documents").select("doc_id", text.brief(F.col("text")).alias("brief"))


@query(
    "dataset_keywords",
    f"""WITH k AS (SELECT doc_id, pos, {sql_squash('lower(w)')} AS w
                   FROM (SELECT doc_id, unnest(string_split(text, ',')) AS w,
                                generate_subscripts(string_split(text, ','), 1) AS pos FROM documents)),
             t AS (SELECT doc_id, pos, {sql_drop_dot('w')} AS x FROM k),
             u AS (SELECT doc_id, pos, {sql_upper_first('x')} AS y FROM t)
        SELECT doc_id, string_agg(y, chr(10) ORDER BY pos) AS keywords FROM u GROUP BY doc_id""",
)
def dataset_keywords(spark, d):
    lists = table(spark, d, "documents").select("doc_id", F.split("text", ",").alias("keywords"))
    return text.keyword_column(lists, "keywords").withColumn("keywords", F.array_join("keywords", "\n"))


@query(
    "dataset_category_text",
    "SELECT p_partkey, upper(left(p_type, 1)) || lower(substr(p_type, 2)) AS category FROM part",
)
def dataset_category_text(spark, d):
    return table(spark, d, "part").select("p_partkey", text.category(F.col("p_type")).alias("category"))


SITE_ENDS = (" - Novinky.cz", " | aktuálně.cz zprávy", " – iDNES.cz", "- x seznam zprávy", " | deník", "")


@query(
    "page_headline_suffix",
    f"""WITH t AS (SELECT doc_id, replace(text, '|', '/') AS x, (doc_id % 6) AS k FROM documents)
        SELECT doc_id, {sql_unify("x || CASE WHEN k = 4 THEN ' | deník' ELSE '' END")} AS headline FROM t""",
)
def page_headline_suffix(spark, d):
    """Live mark and site names at the end of a title are removed."""
    title = F.concat(F.lit("ONLINE:"), F.replace("text", F.lit("|"), F.lit("/")), pick(F.col("doc_id"), *SITE_ENDS))
    return table(spark, d, "documents").select("doc_id", text.page_headline(title).alias("headline"))


@query("page_brief_mark", f"SELECT doc_id, {sql_unify('text')} AS brief, {sql_unify('source')} AS category FROM documents")
def page_brief_mark(spark, d):
    marked = F.concat(F.lit("EXKLUZIVNĚ. "), "text", F.lit(" EXKLUZIVNĚ."))
    return table(spark, d, "documents").select(
        "doc_id",
        text.page_brief(marked).alias("brief"),
        text.page_category(F.concat(F.lit("\n \n"), "source")).alias("category"),
    )


@query(
    "first_numbers",
    """SELECT doc_id, nullif(regexp_extract(text, '(\\d+)', 1), '') AS number,
              nullif(regexp_extract(string_split(text, ',')[1], '(\\d+)', 1), '') AS number_before_comma
       FROM documents""",
)
def first_numbers(spark, d):
    return table(spark, d, "documents").select(
        "doc_id",
        text.first_number(F.col("text")).alias("number"),
        text.first_number_before_comma(F.col("text")).alias("number_before_comma"),
    )


@query("boilerplate_sentence", "SELECT doc_id, text AS content FROM documents")
def boilerplate_sentence(spark, d):
    noted = F.concat(F.lit(text.AUDIO_NOTE), "text", F.lit(text.AUDIO_NOTE))
    return table(spark, d, "documents").select("doc_id", text.without_audio_note(noted).alias("content"))


@query(
    "page_keyword_lists",
    f"""WITH t AS (SELECT doc_id,
                 [{sql_unify('w')} for w in string_split(text, ',')] AS a,
                 [{sql_unify('w')} for w in string_split(replace(text, ' ', ','), ',')] AS b FROM documents)
        SELECT doc_id, array_to_string([w for w in a if w <> ''], ',') AS commas,
               len([w for w in a if w <> '']) AS n_commas,
               array_to_string([w for w in b if w <> ''], ',') AS spaces FROM t""",
)
def page_keyword_lists(spark, d):
    commas = text.page_keywords(F.col("text"))
    spaces = text.page_keywords_spaced(F.col("text"))
    return table(spark, d, "documents").select(
        "doc_id",
        text.join_texts(commas).alias("commas"),
        F.size(commas).cast("bigint").alias("n_commas"),
        text.join_texts(spaces).alias("spaces"),
    )


@query(
    "author_lines",
    """SELECT c_custkey, c_name || ',' || lower(c_mktsegment) || ' x' AS authors FROM customer""",
)
def author_lines(spark, d):
    byline = F.concat(
        pick(F.col("c_custkey"), "Autor/ři: ", "AUTOŘI:", "autor ", "Authors:"),
        "c_name",
        F.lit(", Foto: někdo, ,\xa0"),
        F.lower("c_mktsegment"),
        F.lit(" x ,fotograf"),
    )
    return table(spark, d, "customer").select(
        "c_custkey", text.join_texts(authors.split_byline(byline)).alias("authors")
    )


# Raw author text around a name, and what is left of the additions.
OPENINGS = ("", "Mgr. ", "text: připravila ", "pro MF DNES ", "ing. prof.  bc ", "ČTENÁŘKA ", "recenze\t")
CLOSINGS = (" (red)", " | autor", " - editor", "ČTK", "mgr.", " [foto]", " pro novinky dnes.cz", "idnesbc.", " ing")


@query(
    "author_names",
    """SELECT c_custkey, upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) || ' Čápová-nová' AS author,
              CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE
                   upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) || ' Čápová-nová|Eva Malá' END AS authors
       FROM customer""",
)
def author_names(spark, d):
    raw = F.concat(
        pick(F.col("c_custkey"), *OPENINGS),
        F.lower("c_mktsegment"),
        F.lit(" \t čápová-NOVÁ"),
        pick(F.col("c_custkey"), *CLOSINGS),
    )
    lists = F.when(F.col("c_custkey") % 7 == 0, F.array().cast("array<string>")).otherwise(
        F.array(raw, F.lit("EVA MALÁ"))
    )
    return table(spark, d, "customer").select(
        "c_custkey",
        authors.author_name(raw).alias("author"),
        F.array_join(authors.author_names(lists), "|").alias("authors"),
    )


HUMAN = r"""len([w for w in string_split({0}, ' ') if w <> '']) BETWEEN 2 AND 4
     AND len([w for w in string_split({0}, ' ') if w <> '' AND length(w) <= 2]) = 0
     AND regexp_full_match(replace({0}, ' ', ''), '[\p{{L}}\p{{N}}]+') AND NOT regexp_matches({0}, '[0-9]')"""


@query(
    "human_names",
    f"""WITH t AS (SELECT doc_id, [regexp_replace({sql_strip('w')}, '[.]$', '') for w in string_split(text, ',')] AS names
                   FROM documents),
             u AS (SELECT doc_id, [n for n in names if {HUMAN.format('n')}] AS kept FROM t)
        SELECT doc_id, len(kept) AS n_human,
               CASE WHEN len(kept) > 0 THEN array_to_string(kept, ',') END AS human FROM u""",
)
def human_names(spark, d):
    names = F.transform(F.split("text", ","), lambda w: F.regexp_replace(text.strip(w), r"[.]\z", ""))
    kept = F.filter(names, authors.is_human_name)
    return table(spark, d, "documents").select(
        "doc_id",
        F.size(kept).cast("bigint").alias("n_human"),
        F.when(F.size(kept) > 0, F.array_join(kept, ",")).alias("human"),
    )


@query(
    "human_authors",
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'Mgr. ' || c_mktsegment || ' Nováková (red)' END AS human
       FROM customer""",
)
def human_authors(spark, d):
    """Names are judged in cleaned form and kept in raw form; no name left gives null."""
    raw = F.concat(F.lit("Mgr. "), "c_mktsegment", F.lit(" Nováková (red)"))
    lists = F.when(F.col("c_custkey") % 3 == 0, F.array("c_name", F.lit("Jan"))).otherwise(F.array(raw, F.col("c_name")))
    return table(spark, d, "customer").select("c_custkey", F.array_join(authors.human_authors(lists), "|").alias("human"))


@query(
    "word_case",
    r"""WITH w AS (SELECT doc_id, unnest(string_split(text, ' ')) AS w FROM documents)
        SELECT doc_id,
               count(*) FILTER (w = '' OR (regexp_matches(w, '^\p{Lu}') AND regexp_matches(w, '\p{Ll}')
                                AND NOT regexp_matches(substr(w, 2), '\p{Lu}'))) AS n_capitalized,
               count(*) FILTER (regexp_matches(w, '\p{Lu}') AND NOT regexp_matches(w, '\p{Ll}')) AS n_upper
        FROM w GROUP BY doc_id""",
)
def word_case(spark, d):
    words = F.split("text", " ")
    return table(spark, d, "documents").select(
        "doc_id",
        F.size(F.filter(words, text.is_capitalized)).cast("bigint").alias("n_capitalized"),
        F.size(F.filter(words, text.is_upper)).cast("bigint").alias("n_upper"),
    )


@query(
    "column_chain",
    f"SELECT p_partkey, coalesce({sql_unify('lower(p_name)')}, 'none') AS name, p_name AS name_unclean, 'idnes' AS server FROM part",
)
def column_chain(spark, d):
    """Copy, rename, chained functions, default, constant and drop in one projection."""
    df = table(spark, d, "part").withColumn("name_unclean", F.col("p_name")).withColumnRenamed("p_name", "name")
    chained = text.chain(F.col("name"), F.lower, text.unify, lambda c: text.or_default(c, F.lit("none")))
    return df.withColumns({"name": chained, "server": F.lit("idnes")}).select("p_partkey", "name", "name_unclean", "server")
