"""Row filters on pages and articles."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.functions import urls

REQUIRED = ("content", "headline", "author")


def status_ok(http_status: Column) -> Column:
    """HTTP 200; a missing status counts as 200."""
    return F.coalesce(http_status, F.lit(200)) == 200


def first_segment_not_in(url: Column, rejected: Iterable[str]) -> Column:
    return ~F.coalesce(urls.path_segment(url, 1).isin(*rejected), F.lit(False))


def first_segment_in(url: Column, accepted: Iterable[str]) -> Column:
    return F.coalesce(urls.path_segment(url, 1).isin(*accepted), F.lit(False))


def first_host_label_in(url: Column, labels: Iterable[str]) -> Column:
    return F.coalesce(urls.first_host_label(url).isin(*labels), F.lit(False))


def has_required(content: str = "content", headline: str = "headline", author: str = "author") -> Column:
    """Content, headline and author list are present and not empty."""
    present = (F.octet_length(content) > 0) & (F.octet_length(headline) > 0) & (F.size(author) > 0)
    return F.coalesce(present, F.lit(False))


def without_headlines(df: DataFrame, stop_list: DataFrame, column: str = "headline") -> DataFrame:
    """Drop rows whose headline is on the stop list; a very frequent headline is split by the adaptive skew join."""
    lines = stop_list.select(F.col(stop_list.columns[0]).alias("_key"))
    return df.join(lines, F.col(column) == F.col("_key"), "left_anti")
