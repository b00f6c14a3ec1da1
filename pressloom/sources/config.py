"""Route configuration."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.schemas import ROUTES_FILE


class Route(NamedTuple):
    regex: str
    extractor: str
    since: str | None = None
    until: str | None = None


# URL pattern, extractor and its validity.
DEFAULT_ROUTES = [
    Route(r".*idnes\.cz.*", "idnes_cz_v1", None, "2011-08-09 00:00:00"),
    Route(r".*idnes\.cz.*", "idnes_cz_v2", "2011-08-09 00:00:00", None),
    Route(r".*aktualne\.cz.*", "aktualne_cz_v1", None, "2014-09-10 00:00:00"),
    Route(r".*aktualne\.cz.*", "aktualne_cz_v2", "2014-09-10 00:00:00", "2019-09-10 00:00:00"),
    Route(r".*aktualne\.cz.*", "aktualne_cz_v3", "2019-09-10 00:00:00", None),
    Route(r".*denik\.cz.*", "denik_cz_v1", None, "2012-02-29 00:00:00"),
    Route(r".*denik\.cz.*", "denik_cz_v2", "2012-02-29 00:00:00", "2018-12-01 00:00:00"),
    Route(r".*denik\.cz.*", "denik_cz_v3", "2018-12-01 00:00:00", None),
    Route(r".*novinky\.cz.*", "novinky_cz_v1", None, "2019-08-06 00:00:00"),
    Route(r".*novinky\.cz.*", "novinky_cz_v2", "2019-08-06 00:00:00", None),
    Route(r".*seznamzpravy\.cz.*", "seznamzpravy_cz"),
    Route(r".*ihned\.cz.*", "ihned_cz_v1", None, "2011-05-05 00:00:00"),
    Route(r".*ihned\.cz.*", "ihned_cz_v2", "2011-05-05 00:00:00", "2019-05-05 00:00:00"),
    Route(r".*ihned\.cz.*", "ihned_cz_v3", "2019-05-05 00:00:00", None),
    Route(r".*irozhlas\.cz.*", "irozhlas_cz"),
]
SITE_PATTERN = r"(idnes|aktualne|denik|novinky|seznamzpravy|ihned|irozhlas)\.cz"


def read_routes(spark: SparkSession, path: str) -> DataFrame:
    """A route file as `(position, regex, extractor, since, until)`, in file order."""
    file = spark.read.schema(ROUTES_FILE).option("multiLine", True).option("mode", "FAILFAST").json(path)
    groups = file.select(F.posexplode("routes").alias("_group", "_route"))
    patterns = groups.select("_group", "_route.extractors", F.posexplode("_route.regexes").alias("_pattern", "regex"))
    rows = patterns.select("_group", "_pattern", "regex", F.posexplode("extractors").alias("_place", "_extractor"))
    return rows.select(
        F.struct("_group", "_pattern", "_place").alias("position"),
        "regex",
        F.col("_extractor.name").alias("extractor"),
        F.col("_extractor.since").cast("timestamp_ntz").alias("since"),
        F.col("_extractor.to").cast("timestamp_ntz").alias("until"),
    )


def route_list(routes: DataFrame) -> list[Route]:
    """The routes of a file in order; a configuration, so it is small by nature."""
    shown = routes.orderBy("position").select(
        "regex", "extractor", F.col("since").cast("string"), F.col("until").cast("string")
    )
    return [Route(*row) for row in shown.collect()]
