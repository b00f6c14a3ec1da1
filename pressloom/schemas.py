"""Declared schemas of the tables that enter and leave the jobs."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


STRINGS = T.ArrayType(T.StringType())

# One archive capture. `offset` is widened to LONG, archive files grow past 2 GiB.
CAPTURE = _struct(
    ("digest", T.StringType()),
    ("encoding", T.StringType()),
    ("filename", T.StringType()),
    ("length", T.IntegerType()),
    ("offset", T.LongType()),
    ("timestamp", T.StringType()),
    ("url", T.StringType()),
)

# Extracted records as they come from the extraction job, plus the split names.
RAW_ARTICLE = _struct(
    ("url", T.StringType()),
    ("author", STRINGS),
    ("headline", T.StringType()),
    ("brief", T.StringType()),
    ("publication_date", T.StringType()),
    ("keywords", STRINGS),
    ("category", T.StringType()),
    ("content", T.StringType()),
    ("comments_num", T.IntegerType()),
    ("domain_record", CAPTURE),
    ("additional_info", _struct(("sets", STRINGS))),
)

PAGE = _struct(
    ("url", T.StringType()),
    ("crawl_ts", T.TimestampNTZType()),
    ("http_status", T.IntegerType()),
    ("encoding", T.StringType()),
    ("body", T.BinaryType()),
)

AUTHOR_GENDER = _struct(("author", T.StringType()), ("gender", T.StringType()))

ROUTES_FILE = _struct(
    ("extractors_path", T.StringType()),
    (
        "routes",
        T.ArrayType(
            _struct(
                ("regexes", STRINGS),
                (
                    "extractors",
                    T.ArrayType(
                        _struct(("name", T.StringType()), ("since", T.StringType()), ("to", T.StringType()))
                    ),
                ),
            )
        ),
    ),
)
