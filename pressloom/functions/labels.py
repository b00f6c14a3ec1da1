"""Class labels: name lists, name to id, id to name."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.functions.categories import CATEGORIES
from pressloom.sources.local import local_table

NONE = "None"

# Label names, the position is the class id.
GENDERS = (NONE, "Man", "Woman", "Mixed")
AUTHOR_GENDERS = GENDERS[:3]
GENDER_NONE, GENDER_MAN, GENDER_WOMAN, GENDER_MIXED = range(4)
DAYS = (NONE, "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
SERVERS = (NONE, "idnes", "denik", "aktualne", "irozhlas", "seznamzpravy", "novinky")
CATEGORY_LABELS = (NONE, *(english for _, english in CATEGORIES))

LABELS = {
    "category": CATEGORY_LABELS,
    "server": SERVERS,
    "day_of_week": DAYS,
    "authors_gender": AUTHOR_GENDERS,
    "authors_cum_gender": GENDERS,
}


def _literal(names: Sequence[str]) -> Column:
    return F.array(*[F.lit(n) for n in names])


def to_id(c: Column, names: Sequence[str], strict: bool = False) -> Column:
    """Name to class id; null is the "None" class. Unknown names give 0, or raise when `strict`."""
    position = F.array_position(_literal(names), F.coalesce(c, F.lit(NONE))).cast("int")
    unknown = F.raise_error(F.concat(F.lit("unknown class name: "), c)).cast("int") if strict else F.lit(0)
    return F.when(position > 0, position - 1).otherwise(unknown)


def to_name(c: Column, names: Sequence[str]) -> Column:
    """Class id to name, null outside the list."""
    return F.get(_literal(names), c)


def to_names(c: Column, names: Sequence[str]) -> Column:
    return F.transform(c, lambda x: to_name(x, names))


def with_names(c: Column, column: str) -> Column:
    """Attach the label names as column metadata."""
    return c.alias(column, metadata={"class_names": list(LABELS[column])})


def label_table(spark: SparkSession) -> DataFrame:
    """All labels as `(column, id, name)`."""
    rows = [(column, i, name) for column, names in LABELS.items() for i, name in enumerate(names)]
    return local_table(spark, rows, {"column": pa.string(), "id": pa.int32(), "name": pa.string()})


def joint_gender(genders: Column) -> Column:
    """Gender of a list of authors: none, the common one, or mixed."""
    return (
        F.when(F.size(genders) == 0, GENDER_NONE)
        .when(F.size(F.array_distinct(genders)) == 1, F.get(genders, F.lit(0)))
        .otherwise(F.lit(GENDER_MIXED))
    )
