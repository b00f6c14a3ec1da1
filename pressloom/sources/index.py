"""Capture index: scan and domain query."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressloom.functions import urls
from pressloom.operators.limits import first_rows
from pressloom.schemas import CAPTURE

# Index lines hold the capture directly or inside `domain_record`; both are read by one schema.
INDEX_LINE = T.StructType([*CAPTURE.fields, T.StructField("domain_record", CAPTURE, True)])

# Captures in the order of their crawl, then of their place in the archive.
ORDER = ("crawl_ts", "filename", "offset")


def with_crawl_ts(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Parse the crawl time once, as wall-clock time."""
    return df.withColumn("crawl_ts", F.col(column).try_cast("timestamp_ntz"))


def flatten_index(lines: DataFrame) -> DataFrame:
    """Capture columns of wrapped and bare lines, with `crawl_ts`."""
    fields = [F.coalesce(f"domain_record.{f.name}", f.name).alias(f.name) for f in CAPTURE.fields]
    return with_crawl_ts(lines.select(*fields))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return flatten_index(spark.read.schema(INDEX_LINE).json(path))


def query_index(
    index: DataFrame,
    domains: list[str],
    since: str | None = None,
    to: str | None = None,
    limit: int | None = None,
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """Captures of the domains and their subdomains within `[since, to]`; an absent bound is open.

    A `limit` takes the first captures by `order`, the same ones in every run; columns that the index lacks are passed over.
    """
    hits = index
    if since is not None:
        hits = hits.where(F.col("crawl_ts") >= F.lit(since).cast("timestamp_ntz"))
    if to is not None:
        hits = hits.where(F.col("crawl_ts") <= F.lit(to).cast("timestamp_ntz"))
    hits = hits.where(urls.in_domain(F.col("url"), domains))
    return hits if limit is None else first_rows(hits, limit, [c for c in order if c in index.columns])
