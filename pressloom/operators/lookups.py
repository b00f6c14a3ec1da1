"""Dictionary lookups as joins. The planner broadcasts a table that it knows to be small and shuffles a larger one; the
adaptive skew join splits hot keys, which all lookups here allow, as they keep the left side whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: distinct author lists of fewer bytes in all are broadcast
BROADCAST_BYTES = 8 << 20


def lookup(df: DataFrame, table: DataFrame, key: Column) -> DataFrame:
    """Left join with a table of unique `_key`s; a null key matches nothing."""
    return df.withColumn("_key", key).join(table, "_key", "left").drop("_key")


def translate(
    df: DataFrame, column: str, table: DataFrame, source: str, target: str, lower: bool = False, unique: bool = False
) -> DataFrame:
    """Replace `column` by the table's `target` where it equals `source`; without a match it stays.

    With `lower` the probe is lower-cased, the keys are not. Unless the keys are known to be `unique` they are made
    so, as rows must never multiply.
    """
    keyed = table.select(F.col(source).alias("_key"), F.col(target).alias("_to"))
    if not unique:
        keyed = keyed.groupBy("_key").agg(F.max("_to").alias("_to"))
    joined = lookup(df, keyed, F.lower(column) if lower else F.col(column))
    return joined.withColumn(column, F.coalesce("_to", column)).drop("_to")


def keep_known(df: DataFrame, column: str, table: DataFrame, name: str, lower: bool = False, unique: bool = False) -> DataFrame:
    """Null out values of a scalar column that are not in the table; kept values retain their case."""
    fold = F.lower if lower else (lambda c: c)
    keyed = table.select(fold(F.col(name)).alias("_key")).where("_key is not null")
    keyed = keyed if unique else keyed.distinct()
    joined = lookup(df, keyed.withColumn("_hit", F.lit(True)), fold(F.col(column)))
    return joined.withColumn(column, F.when(F.col("_hit"), F.col(column))).drop("_hit")


def keep_known_members(c: Column, known: list[str], lower: bool = False) -> Column:
    """Members of a list that are in a short, literal set; null stays null."""
    names = F.array(*[F.lit(k.lower() if lower else k) for k in known])
    return F.filter(c, lambda x: F.array_contains(names, F.lower(x) if lower else x))


def _gender_code(gender: Column) -> Column:
    return F.when(F.trim(gender) == "male", 1).otherwise(2)


def author_dimension(authors: DataFrame) -> DataFrame:
    """`(author, gender)` with gender 1 (man) or 2 (woman), one row per exact name."""
    return authors.groupBy("author").agg(F.max(_gender_code(F.col("gender"))).alias("gender"))


def authors_with_gender(df: DataFrame, dimension: DataFrame, column: str = "authors") -> DataFrame:
    """Keep the authors known to the dimension (any case) and add `authors_gender` (exact case, else 0).

    Null lists become empty. The distinct author lists, few next to the rows and combined before their shuffle, are
    looked up in the dimension (folded name to its spellings); one join gives each row the result for its list. The lists are
    measured first, by a job that reads the authors alone: up to `BROADCAST_BYTES` the results are broadcast and no row is
    shuffled; the planner, which cannot know it in time, would shuffle all rows by few keys.
    """
    lists = df.select(F.col(column).alias("_list")).where(F.size(column) > 0).distinct()
    # the entry of a name is its place, itself and a code, next to the list that holds it as well
    size = lists.agg(F.sum(2 * F.octet_length(F.array_join("_list", "")) + 48 * F.size("_list"))).first()[0] or 0
    names = lists.select("_list", F.posexplode("_list").alias("_pos", "_name"))
    spelling = F.struct("author", "gender")
    known = (
        dimension.where("author IS NOT NULL")
        .groupBy(F.lower("author").alias("_key"))
        .agg(F.map_from_entries(F.collect_list(spelling)).alias("_spellings"))
    )
    matched = names.withColumn("_key", F.lower("_name")).join(known, "_key")
    gender = F.coalesce(F.try_element_at("_spellings", F.col("_name")), F.lit(0))
    entry = F.struct("_pos", "_name", gender.alias("_gender"))
    found = matched.groupBy("_list").agg(F.sort_array(F.collect_list(entry)).alias("_found"))
    found = F.broadcast(found) if size <= BROADCAST_BYTES else found
    joined = lookup(df, found.withColumnRenamed("_list", "_key"), F.when(F.size(column) > 0, F.col(column)))
    empty_names, empty_codes = F.array().cast("array<string>"), F.array().cast("array<int>")
    return joined.withColumns(
        {
            column: F.coalesce(F.col("_found._name"), empty_names),
            "authors_gender": F.coalesce(F.col("_found._gender"), empty_codes),
        }
    ).drop("_found")
