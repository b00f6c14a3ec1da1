"""A limit that is one fixed set of rows: the first ones of a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.operators.duplicates import free_name
from pressloom.session import shared_dir

# Most rows that one task may gather and merge; a greater limit is cut from a sorted table.
GATHERED = 100_000


def first_rows(df: DataFrame, n: int, order: Sequence[str], gathered: int = GATHERED) -> DataFrame:
    """The first `n` rows by `order`, nulls last; equal places go by a hash of the whole row, so that the set is the same in
    every run and however the rows are dealt.

    Up to `gathered` rows, every task keeps its first ones and one task merges them. Beyond, the rows are written once, sorted by
    ranges, and the counts of the ranges tell which of them are whole, cut or out; no task holds more than a range.
    """
    if n <= 0:
        return df.where(F.lit(False))
    tie = free_name(df, "_tie")
    keyed = df.withColumn(tie, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    keys = [*[F.col(f"`{c}`").asc_nulls_last() for c in order], F.col(tie)]
    if n <= gathered:
        return keyed.orderBy(*keys).limit(n).drop(tie)
    return _cut(keyed, n, keys, tie).drop(tie)


def _cut(df: DataFrame, n: int, keys: list, tie: str) -> DataFrame:
    spark = df.sparkSession
    part, place = free_name(df, "_part"), free_name(df, "_place")
    ranges = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = ranges.withColumns({part: F.spark_partition_id(), place: F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    path = shared_dir(spark, "first-rows")
    placed.write.parquet(path)
    rows = spark.read.schema(placed.schema).parquet(path)
    # one number for each range
    counts = sorted((r[part], r["count"]) for r in rows.groupBy(part).count().collect())
    left = n
    for number, count in counts:
        if count >= left:
            inside = (F.col(part) < number) | ((F.col(part) == number) & (F.col(place) < left))
            return rows.where(inside).drop(part, place)
        left -= count
    return rows.drop(part, place)
