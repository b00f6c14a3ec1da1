"""Split fan-out, split report, unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The split names.
SPLITS = ("test_human", "train", "test", "validation", "train_small", "test_small")


def fan_out(df: DataFrame, sets: Column, names: Sequence[str] = SPLITS, strict: bool = True) -> DataFrame:
    """One output row per split of a row, in column `split`; rows without a split vanish.

    An unknown split name raises, or is dropped when not `strict`.
    """
    rows = df.withColumn("split", F.explode(sets))
    if not strict:
        return rows.where(F.col("split").isin(*names))
    unknown = F.raise_error(F.concat(F.lit("unknown split name: "), F.coalesce("split", F.lit("null")))).cast("string")
    return rows.withColumn("split", F.when(F.col("split").isin(*names), F.col("split")).otherwise(unknown))


def split_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count("*").alias("n_rows"))


def union(*frames: DataFrame) -> DataFrame:
    """All rows of same-schema frames, duplicates kept."""
    return reduce(DataFrame.unionByName, frames)
