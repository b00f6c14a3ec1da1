"""Dictionary lookups, labels, duplicates, splits and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import pick, query, sql_pick, table
from pressloom.functions import labels
from pressloom.functions.categories import CATEGORIES, category_table, synonym_table
from pressloom.operators import duplicates, lookups, splits
from pressloom.plans.curate import clean_category, encode

RAW_CATEGORIES = (
    "SPORT",
    "Zprávy z domova",
    "hokej",
    "Hradecko",
    "tipy deníku",
    "LIDÉ",
    None,
    "Kultura",
    "věda & vesmír",
    "životní styl.",
    "  Auto ",
    "web",
    "Výtvarné umění",
    "unknown section",
    "PRAHA",
    "",
)
# Expected values, written out: the synonyms that the sections above hit, and the categories with their class ids.
SYNONYM_ROWS = """('zprávy z domova', 'domácí'), ('hokej', 'sport'), ('tipy deníku', 'tipy'), ('lidé', 'člověk'),
    ('věda & vesmír', 'věda'), ('web', 'technologie'), ('praha', 'domácí')"""
CATEGORY_ROWS = """(1, 'Zahraniční', 'World'), (2, 'Domácí', 'Home'), (3, 'Sport', 'Sport'), (4, 'Kultura', 'Culture'),
    (5, 'Revue', 'Celebrity'), (6, 'Koktejl', 'Gossip and curiosities'), (7, 'Ekonomika', 'Economy'), (8, 'Krimi', 'Crime'),
    (9, 'Podnikání', 'Entrepreneurship'), (10, 'Auto', 'Car'), (11, 'Věda', 'Science'), (12, 'Komentáře', 'Comments'),
    (13, 'Cestování', 'Travel'), (14, 'Finance', 'Finance'), (15, 'Technologie', 'Technology'), (16, 'Bydlení', 'Housing'),
    (17, 'Koronavirus', 'Coronavirus'), (18, 'Byznys', 'Business'), (19, 'Rozhovory', 'Interviews'),
    (20, 'Podcasty', 'Podcasts'), (21, 'Životní styl', 'Lifestyle'), (22, 'Literatura', 'Literature'),
    (23, 'Vánoce', 'Christmas'), (24, 'Výtvarné umění', 'Fine arts'), (25, 'Kolo', 'Bike')"""
CATEGORY_CTES = f"""syn(synonym, target) AS (VALUES {SYNONYM_ROWS}), cat(id, cz, en) AS (VALUES {CATEGORY_ROWS})"""


def sql_category(raw: str, rows: str) -> str:
    """The category chain over the relation `rows` with the column `raw`: adds `category`."""
    tidy = "CASE WHEN length(s) >= 2 AND s LIKE '%.' AND s NOT LIKE '%..' THEN left(s, length(s) - 1) ELSE s END"
    upper = "CASE WHEN length(t) > 1 THEN upper(left(t, 1)) || substr(t, 2) ELSE t END"
    return f"""SELECT q.* EXCLUDE (s, t), cat.en AS category FROM (
        SELECT *, {tidy} AS t FROM (
          SELECT r.*, trim(lower(coalesce(syn.target, r.{raw}))) AS s FROM {rows} r
          LEFT JOIN syn ON syn.synonym = lower(r.{raw}))) q
        LEFT JOIN cat ON cat.cz = ({upper})"""


@query(
    "category_chain",
    f"""WITH {CATEGORY_CTES}, d AS (SELECT doc_id, {sql_pick('doc_id', *RAW_CATEGORIES)} AS category_unclean FROM documents)
        {sql_category('category_unclean', 'd')}""",
)
def category_chain(spark, d):
    raw = pick(F.col("doc_id"), *RAW_CATEGORIES).alias("category")
    df = clean_category(table(spark, d, "documents").select("doc_id", raw))
    return df.select("doc_id", "category_unclean", "category")


@query(
    "synonyms_translate",
    f"""WITH {CATEGORY_CTES}, d AS (SELECT doc_id, {sql_pick('doc_id', *RAW_CATEGORIES)} AS raw FROM documents)
        SELECT doc_id, coalesce(target, raw) AS category FROM d LEFT JOIN syn ON synonym = lower(raw)""",
)
def synonyms_translate(spark, d):
    df = table(spark, d, "documents").select("doc_id", pick(F.col("doc_id"), *RAW_CATEGORIES).alias("category"))
    return lookups.translate(df, "category", synonym_table(spark), "synonym", "category", lower=True)


@query(
    "names_translate",
    """SELECT c_custkey, coalesce(n_name, c_nationkey::VARCHAR) AS nation FROM customer
       LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 2 = 0) ON n_nationkey = c_nationkey""",
)
def names_translate(spark, d):
    """Translation by a table whose size the planner does not know."""
    codes = table(spark, d, "nation").where("n_nationkey % 2 = 0").select(F.col("n_nationkey").cast("string"), "n_name")
    df = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("nation"))
    return lookups.translate(df, "nation", codes, "n_nationkey", "n_name")


KNOWN_TYPES = "(SELECT DISTINCT p_type FROM part WHERE p_type < 'M')"


@query(
    "scalar_set_filter",
    f"SELECT p_partkey, CASE WHEN p_type IN {KNOWN_TYPES} THEN p_type END AS p_type FROM part",
)
def scalar_set_filter(spark, d):
    """Values outside the set become null; case is ignored by the test and kept in the value."""
    part = table(spark, d, "part")
    known = part.where("p_type < 'M'").select(F.lower("p_type").alias("p_type"))
    return lookups.keep_known(part.select("p_partkey", "p_type"), "p_type", known, "p_type", lower=True)


@query(
    "list_set_filter",
    """SELECT doc_id, array_to_string([w for w in string_split(text, ' ') if lower(w) IN ('the', 'of', 'and', 'que', 'der')], ' ')
              AS kept FROM documents""",
)
def list_set_filter(spark, d):
    kept = lookups.keep_known_members(F.split("text", " "), ["The", "of", "and", "que", "der"], lower=True)
    return table(spark, d, "documents").select("doc_id", F.array_join(kept, " ").alias("kept"))


# Author lists derived from part: the names of the part's brand and type, in two spellings, or none.
LISTS_SQL = """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN []::VARCHAR[] WHEN 1 THEN [p_brand, p_name]
                  WHEN 2 THEN [upper(p_name), p_name, p_type] ELSE NULL END AS names FROM part"""
DIMENSION_SQL = """SELECT p_name AS author, max(CASE WHEN p_size % 2 = 0 THEN 1 ELSE 2 END) AS gender FROM part GROUP BY 1
                   UNION ALL SELECT DISTINCT p_type, 1 FROM part WHERE p_type <> 'SMALL'"""
GENDER_SQL = f"""WITH lists AS ({LISTS_SQL}), dim AS ({DIMENSION_SQL}),
     member AS (SELECT p_partkey, unnest(names) AS name, generate_subscripts(names, 1) AS pos FROM lists),
     found AS (SELECT p_partkey, pos, name, coalesce(exact.gender, 0) AS gender FROM member
               JOIN (SELECT DISTINCT lower(author) AS folded FROM dim) known ON known.folded = lower(name)
               LEFT JOIN dim exact ON exact.author = name),
     grouped AS (SELECT p_partkey, string_agg(name, '|' ORDER BY pos) AS authors,
                        string_agg(gender::VARCHAR, '|' ORDER BY pos) AS genders,
                        CASE WHEN min(gender) = max(gender) THEN min(gender) ELSE 3 END AS joint FROM found GROUP BY 1)
     SELECT p_partkey, coalesce(authors, '') AS authors, coalesce(genders, '') AS genders,
            coalesce(joint, 0)::INTEGER AS joint FROM lists LEFT JOIN grouped USING (p_partkey)"""


def _genders(spark, d, more):
    part = table(spark, d, "part")
    gender = F.when(F.col("p_size") % 2 == 0, "male").otherwise("female")
    rows = part.select(F.col("p_name").alias("author"), gender.alias("gender"))
    types = part.where("p_type <> 'SMALL'").select(F.col("p_type").alias("author"), F.lit(" male ").alias("gender"))
    authors = rows.unionByName(types)
    if more:
        names = table(spark, d, "customer").select("c_name").union(table(spark, d, "orders").select(F.col("o_orderkey").cast("string")))
        authors = authors.union(names.withColumn("gender", F.lit("male")))
    kind = F.col("p_partkey") % 4
    names = (
        F.when(kind == 0, F.array().cast("array<string>"))
        .when(kind == 1, F.array("p_brand", "p_name"))
        .when(kind == 2, F.array(F.upper("p_name"), "p_name", "p_type"))
    )
    df = part.select("p_partkey", names.alias("authors"))
    found = lookups.authors_with_gender(df, lookups.author_dimension(authors))
    return found.select(
        "p_partkey",
        F.array_join("authors", "|").alias("authors"),
        F.array_join(F.col("authors_gender").cast("array<string>"), "|").alias("genders"),
        labels.joint_gender(F.col("authors_gender")).alias("joint"),
    )


@query("author_gender", GENDER_SQL)
def author_gender(spark, d):
    return _genders(spark, d, False)


@query("author_gender_large_dimension", GENDER_SQL)
def author_gender_large_dimension(spark, d):
    return _genders(spark, d, True)


SERVER_NAMES = (None, "idnes", "ihned", "novinky", "denik")


@query(
    "class_labels",
    f"""WITH {CATEGORY_CTES}, d AS (SELECT o_orderkey, {sql_pick('o_orderkey', *[en for _, en in CATEGORIES], None, 'other')} AS en,
             {sql_pick('o_orderkey', *SERVER_NAMES)} AS server, o_orderdate FROM orders)
        SELECT o_orderkey, coalesce(cat.id, 0)::INTEGER AS category, coalesce(cat.en, 'None') AS category_name,
               CASE server WHEN 'idnes' THEN 1 WHEN 'denik' THEN 2 WHEN 'novinky' THEN 6 ELSE 0 END::INTEGER AS server,
               isodow(o_orderdate)::INTEGER AS day_of_week, strftime(o_orderdate, '%A') AS day_name
        FROM d LEFT JOIN cat ON cat.en = d.en""",
)
def class_labels(spark, d):
    """Names to ids and back; unknown names and null give class 0."""
    key = F.col("o_orderkey")
    df = table(spark, d, "orders").select(
        "o_orderkey",
        pick(key, *[en for _, en in CATEGORIES], None, "other").alias("category"),
        pick(key, *SERVER_NAMES).alias("server"),
        (F.weekday("o_orderdate") + 1).alias("day_of_week"),
        F.array(F.lit(1)).alias("authors_gender"),
        F.lit(1).alias("authors_cum_gender"),
    )
    return encode(df).select(
        "o_orderkey",
        "category",
        labels.to_name(F.col("category"), labels.CATEGORY_LABELS).alias("category_name"),
        "server",
        "day_of_week",
        labels.to_name(F.col("day_of_week"), labels.DAYS).alias("day_name"),
    )


@query(
    "category_table_labels",
    f"""WITH {CATEGORY_CTES}
        SELECT id, cz, en, (SELECT count(*) FROM documents WHERE doc_id % 25 = id - 1) AS n_docs FROM cat""",
)
def category_table_labels(spark, d):
    """The category dimension with class ids, joined with the class of each document."""
    docs = table(spark, d, "documents").groupBy((F.col("doc_id") % 25 + 1).cast("int").alias("id"))
    counts = docs.agg(F.count("*").alias("n_docs"))
    joined = category_table(spark).join(counts, "id", "left")
    return joined.withColumn("n_docs", F.coalesce("n_docs", F.lit(0).cast("bigint")))


@query(
    "duplicates_earliest",
    "SELECT text, min(doc_id) AS doc_id, arg_min(source, doc_id) AS source FROM documents GROUP BY text",
)
def duplicates_earliest(spark, d):
    df = table(spark, d, "documents").select("doc_id", "source", "text")
    return duplicates.earliest(df, ["text"], ["doc_id"])


@query("duplicates_by_two_keys", "SELECT DISTINCT user_id, event_type FROM events")
def duplicates_by_two_keys(spark, d):
    df = table(spark, d, "events").select("user_id", "event_type")
    return duplicates.any_of(df, ["user_id", "event_type"])


@query(
    "duplicates_null_keys",
    """WITH c AS (SELECT event_id, CASE WHEN event_id % 9 = 0 THEN NULL ELSE 'CAP' || (event_id % 977) END AS digest,
                         CASE WHEN event_id % 4 <> 1 THEN ts END AS crawled FROM events)
       SELECT event_id, digest FROM c WHERE digest IS NULL
       UNION ALL
       SELECT event_id, digest FROM (SELECT *, row_number() OVER (PARTITION BY digest ORDER BY crawled NULLS LAST, event_id) AS n
                                     FROM c WHERE digest IS NOT NULL) WHERE n = 1""",
)
def duplicates_null_keys(spark, d):
    """Captures without a digest are nobody's copies; one without a crawl time is no earliest."""
    key = F.col("event_id")
    digest = F.when(key % 9 != 0, F.concat(F.lit("CAP"), (key % 977).cast("string")))
    df = table(spark, d, "events").select("event_id", digest.alias("digest"), F.when(key % 4 != 1, F.col("ts")).alias("crawled"))
    return duplicates.earliest(df, ["digest"], ["crawled", "event_id"]).select("event_id", "digest")


@query(
    "category_fold_keys",
    """SELECT doc_id, ['Home', 'Home', 'Home', 'Sport', NULL, 'Home', NULL, 'Home'][doc_id % 8 + 1] AS category FROM documents""",
)
def category_fold_keys(spark, d):
    """Regional sections match with folded keys, in any case."""
    raw = pick(F.col("doc_id"), "Hradecko", "KRAJ VYSOČINA", "plzeňsko", "Hokej", None, "Žatecko a Lounsko", "Horní Dolní", "Praha")
    df = clean_category(table(spark, d, "documents").select("doc_id", raw.alias("category")), fold_keys=True)
    return df.select("doc_id", "category")


SETS_SQL = """SELECT doc_id, CASE WHEN toxic = 1 THEN ['test', 'test_small'] WHEN quality = 1 THEN ['train', 'train_small', 'train']
                WHEN doc_id % 2 = 0 THEN ['validation'] WHEN doc_id % 3 = 0 THEN []::VARCHAR[] ELSE NULL END AS sets FROM labels"""


def _with_sets(spark, d):
    sets = (
        F.when(F.col("toxic") == 1, F.array(F.lit("test"), F.lit("test_small")))
        .when(F.col("quality") == 1, F.array(F.lit("train"), F.lit("train_small"), F.lit("train")))
        .when(F.col("doc_id") % 2 == 0, F.array(F.lit("validation")))
        .when(F.col("doc_id") % 3 == 0, F.array().cast("array<string>"))
    )
    return table(spark, d, "labels").select("doc_id", sets.alias("sets"))


@query("split_fan_out", f"SELECT doc_id, unnest(sets) AS split FROM ({SETS_SQL})")
def split_fan_out(spark, d):
    return splits.fan_out(_with_sets(spark, d), F.col("sets")).select("doc_id", "split")


@query("split_sizes", f"SELECT split, count(*) AS n_rows FROM (SELECT unnest(sets) AS split FROM ({SETS_SQL})) GROUP BY split")
def split_sizes(spark, d):
    return splits.split_sizes(splits.fan_out(_with_sets(spark, d), F.col("sets")))


@query("union_of_parts", "SELECT doc_id, lang FROM documents UNION ALL SELECT doc_id, lang FROM documents WHERE lang = 'fr'")
def union_of_parts(spark, d):
    df = table(spark, d, "documents").select("doc_id", "lang")
    french = F.coalesce(F.col("lang") == "fr", F.lit(False))
    return splits.union(df.where(~french), df.where(french), df.where(french))


@query("row_count", "SELECT count(*) AS n_rows FROM documents")
def row_count(spark, d):
    return table(spark, d, "documents").agg(F.count("*").alias("n_rows"))
