"""Collection job: captures of the wanted domains without duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from pressloom.operators.duplicates import earliest
from pressloom.sources.index import ORDER, query_index


def collect(
    index: DataFrame,
    domains: list[str],
    since: str | None = None,
    to: str | None = None,
    limit: int | None = None,
    keys: Sequence[str] = ("digest",),
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """Captures of the domains in the time range; the earliest of each key is kept, and every one without a key.

    A `limit` is on the captures of the index, as an index query returns them: the first ones by `order`, before copies are
    dropped. The index is read once.
    """
    return earliest(query_index(index, domains, since, to, limit, order), keys, order)
