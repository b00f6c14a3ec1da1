"""Duplicate captures: one row per key, the earliest crawl."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the input does not use."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def lacks_key(keys: Sequence[str]) -> Column:
    """Whether a row has a null key: nothing is known to be a copy of it."""
    return reduce(or_, [F.col(f"`{k}`").isNull() for k in keys])


def earliest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of each key by `order`, nulls last, which should end in columns that make it total.

    Rows with a null key all stay: each gets one more key of its own, so that the input is read once. Every input task keeps
    its first row of a key before the shuffle (a group limit of the planner), so a key that holds a large part of the rows
    comes as one row of each task.
    """
    own, place = free_name(df, "_own"), free_name(df, "_place")
    keyed = df.withColumn(own, F.when(lacks_key(keys), F.monotonically_increasing_id()))
    window = Window.partitionBy(*[F.col(f"`{k}`") for k in keys], own).orderBy(*[F.col(f"`{c}`").asc_nulls_last() for c in order])
    return keyed.withColumn(place, F.row_number().over(window)).where(F.col(place) == 1).drop(own, place)


def any_of(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row of each key, whichever comes first; rows with a null key all stay."""
    own = free_name(df, "_own")
    keyed = df.withColumn(own, F.when(lacks_key(keys), F.monotonically_increasing_id()))
    return keyed.dropDuplicates([*keys, own]).drop(own)
