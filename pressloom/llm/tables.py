"""Intermediate tables of the operators, written to the shared folder, and the columns they add."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.session import shared_dir, ship_package

_scopes: list[str] = []


@contextmanager
def scope(spark: SparkSession, name: str) -> Iterator[str]:
    """A folder that holds all tables `stored` within the block, so that they can be given up together (`emptied`)."""
    _scopes.append(shared_dir(spark, name))
    try:
        yield _scopes[-1]
    finally:
        _scopes.pop()


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the scope, or else below `spark.checkpoint.dir`."""
    return os.path.join(_scopes[-1], f"{name}-{uuid.uuid4().hex}") if _scopes else shared_dir(spark, name)


def emptied(spark: SparkSession, folder: str) -> None:
    """Give up all tables in a folder: an empty one is written over it, on whatever file system it is."""
    spark.range(0).coalesce(1).write.mode("overwrite").parquet(folder)


#: partitions of a table of narrow rows that one task writes: a file's cost is more than that of the rows of one
NARROW = 8


def narrow(df: DataFrame) -> DataFrame:
    """Rows of a few numbers, without text, to be written: a task takes several partitions, but all cores have a task."""
    spark = df.sparkSession
    return df.coalesce(max(spark.sparkContext.defaultParallelism, tasks(spark) // NARROW))


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write `df` to a new folder below `spark.checkpoint.dir` and read it: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def only(df: DataFrame, **columns) -> DataFrame:
    """The named columns under fixed names, so that no other column of the input can clash with an operator's own."""
    return df.select(*[(F.col(f"`{c}`") if isinstance(c, str) else c).alias(name) for name, c in columns.items()])


#: rows of an Arrow batch; with texts, the usual 10000 would be tens of MB in each worker and its executor, several times
BATCH_ROWS = 2048


def ready(spark: SparkSession) -> None:
    """Send the package to the workers, and bound the batches of texts that they get, unless a smaller bound is set."""
    ship_package(spark)
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= BATCH_ROWS:
        spark.conf.set(setting, str(BATCH_ROWS))


def tasks(spark: SparkSession) -> int:
    """Partitions of an explicit shuffle: the session's setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
