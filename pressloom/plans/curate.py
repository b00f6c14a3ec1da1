"""Curation job: extracted records to the labelled dataset with splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.functions import authors as names
from pressloom.functions import dates, labels, text, urls
from pressloom.functions.categories import category_table, synonym_table
from pressloom.operators import lookups, splits

COLUMNS = (
    "url",
    "headline",
    "brief",
    "content",
    "comments_num",
    "category_unclean",
    "keywords",
    "authors",
    "date",
    "server",
    "category",
    "day_of_week",
    "authors_gender",
    "authors_cum_gender",
)


def clean_category(df: DataFrame, extra_synonyms: DataFrame | None = None, fold_keys: bool = False) -> DataFrame:
    """`category` to its English class name, null when unknown; the raw value stays in `category_unclean`.

    The own vocabularies are fixed and short, which the planner knows, so each is one broadcast join.
    """
    spark = df.sparkSession
    fixed = extra_synonyms is None
    synonyms = synonym_table(spark, extra_synonyms, fold_keys)
    known = category_table(spark)
    df = df.withColumn("category_unclean", F.col("category"))
    df = lookups.translate(df, "category", synonyms, "synonym", "category", lower=True, unique=fixed)
    df = df.withColumn("category", text.category(F.col("category")))
    # set filter by lower-cased name, then exact translation: one probe serves both
    table = known.select(F.lower("cz").alias("_folded"), F.col("cz").alias("_cz"), F.col("en").alias("_en"))
    joined = df.withColumn("_folded", F.lower("category")).join(F.broadcast(table), "_folded", "left")
    kept = F.when(F.col("category") == F.col("_cz"), F.col("_en")).when(F.col("_cz").isNotNull(), F.col("category"))
    return joined.withColumn("category", kept).drop("_folded", "_cz", "_en")


def clean_texts(df: DataFrame) -> DataFrame:
    """Headline, brief, content and keywords."""
    df = text.tidy_columns(df, "headline", "brief")
    return text.keyword_column(text.normalize_columns(df, "headline", "brief", "content"), "keywords")


def enrich(df: DataFrame) -> DataFrame:
    """Date, weekday and the gender of the author group."""
    df = df.withColumn("date", dates.local_date(F.col("publication_date")))
    return df.withColumns(
        {
            "day_of_week": dates.day_of_week(F.col("date")),
            "authors_cum_gender": labels.joint_gender(F.col("authors_gender")),
        }
    )


def encode(df: DataFrame, strict: bool = False) -> DataFrame:
    """Category and server names to class ids; all label columns carry their names as metadata."""
    ids = {
        "category": labels.to_id(F.col("category"), labels.CATEGORY_LABELS, strict),
        "server": labels.to_id(F.col("server"), labels.SERVERS, strict),
    }
    encoded = {c: labels.with_names(ids.get(c, F.col(c)), c) for c in labels.LABELS}
    return df.select(*[encoded.get(c, F.col(c)) for c in df.columns])


def curate(
    articles: DataFrame,
    author_gender: DataFrame,
    split: bool = True,
    strict: bool = False,
    extra_synonyms: DataFrame | None = None,
    fold_keys: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """The curated dataset, one row per article and split (or per article without `split`).

    Few distinct author lists are broadcast, and no row is shuffled. The input is read for them alone, once here to measure them
    and once by the join. `partitions` deals out an input of few scan tasks, as one file.
    """
    df = articles if partitions is None else articles.repartition(partitions)
    df = df.withColumn("server", urls.server(F.col("url"))).withColumnRenamed("author", "authors")
    # authors come first, so that the second reading is of this much of the plan
    df = names.author_column(df, "authors")
    df = lookups.authors_with_gender(df, lookups.author_dimension(author_gender))
    df = clean_category(df, extra_synonyms, fold_keys)
    df = encode(enrich(clean_texts(df)), strict)
    if not split:
        return df.select(*COLUMNS)
    return splits.fan_out(df, F.col("additional_info.sets"), strict=strict).select(*COLUMNS, "split")
