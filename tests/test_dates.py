"""Dates against literal expectations and Python's own parser."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pressloom.functions import dates
from pressloom.plans.sites import clean_date

CRAWL = "2019-03-04 05:06:07"


def crawl():
    return F.lit(CRAWL).cast("timestamp_ntz")


def shown(c):
    return dates.iso_text(c)


FORMATS = [
    dates.DAY_TIME_SPACED,
    dates.DAY_SPACED,
    dates.DAY_COMMA_TIME,
    dates.DAY_TIME_TIGHT,
    dates.DAY_TIGHT,
    dates.TIME_DAY,
    dates.JSON_LD,
]
TEXTS = [
    "5. 1. 2020 9:05",
    "05. 01. 2020 09:05",
    "5.  1.\t2020 9:5",
    "5. 1. 2020",
    "31. 2. 2020 10:00",
    "5.1.2020 9:05",
    "5.1.2020",
    "5. 1. 2020, 9:05",
    "9:05 5. 1. 2020",
    "5. 1. 2020 24:00",
    "5. 1. 2020 9:60",
    "5. 1. 2020 9:05 hodin",
    "2020-01-05T09:05:06.7Z",
    "2020-01-05T09:05:06Z",
    "2020-01-05",
    "0. 1. 2020",
    "",
]


@pytest.mark.parametrize("pattern", FORMATS)
def test_parse_equals_strptime(one, pattern):
    def python(value):
        try:
            return str(datetime.strptime(value, pattern))
        except ValueError:
            return None

    assert one(lambda c: shown(dates.parse(c, pattern)), TEXTS) == [python(t) for t in TEXTS]


def test_update_marks_are_removed(one):
    raw = ["DNES 5. 1. 2020", "(aktualizováno 5. 1. 2020", "\xa05. 1. 2020 \n"]
    assert one(lambda c: shown(dates.parse_noisy(c, dates.DAY_SPACED)), raw) == ["2020-01-05 00:00:00"] * 3


def test_iso(one):
    raw = [
        "2020-01-05T10:30:00+01:00",
        "2020-01-05 10",
        "2020-01-05",
        "2020-01-05T10:30:00.123456",
        "2020-01-05T10:30Z",
        "2020-01-05T10:30:00-0530",
        "2020-1-5",
        "2020-02-30T10:30:00",
        "včera",
        None,
    ]
    got = one(lambda c: dates.iso_text(dates.parse_iso(c), dates.iso_offset(c)), raw)
    assert got == [
        "2020-01-05 10:30:00+01:00",
        "2020-01-05 10:00:00",
        "2020-01-05 00:00:00",
        "2020-01-05 10:30:00.123456",
        "2020-01-05 10:30:00+00:00",
        "2020-01-05 10:30:00-05:30",
        None,
        None,
        None,
        None,
    ]


def test_results_do_not_depend_on_the_session_zone(spark, one):
    before = spark.conf.get("spark.sql.session.timeZone")
    raw = ["29. 3. 2020 2:30"]
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Prague")
        assert one(lambda c: shown(dates.parse(c, dates.DAY_TIME_SPACED)), raw) == ["2020-03-29 02:30:00"]
        ladder = one(lambda c: shown(dates.ladder(c, crawl(), (dates.DAY_SPACED,), time_of_crawl_day=True)), ["2:30"])
        assert ladder == ["2019-03-04 02:30:07"]
        assert one(lambda c: dates.local_date(c).cast("string"), ["2020-03-29T23:30:00-11:00"]) == ["2020-03-29"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(
    "raw, footer, value",
    [
        ("5. 1. 2020 9:05", None, "2020-01-05 09:05:00"),
        ("5. 1. 2020", None, "2020-01-05 00:00:00"),
        ("DNES 5. 1. 10:30", "© 2001 – 2014", "2014-01-05 10:30:00"),
        ("29. 2. 10:30", "2001–2012", "2012-02-29 10:30:00"),
        # without a footer year the time of day of the crawl is used
        ("5. 1. 10:30", "© Redakce", "2019-03-04 10:30:07"),
        ("dnes v 7:05", None, "2019-03-04 07:05:07"),
        ("25:70", None, CRAWL),
        ("včera", None, CRAWL),
        (None, "2001 – 2014", None),
    ],
)
def test_ladder(spark, raw, footer, value):
    df = spark.createDataFrame([(raw, footer)], "raw string, footer string")
    step = dates.ladder(
        F.col("raw"), crawl(), (dates.DAY_TIME_SPACED, dates.DAY_SPACED), F.col("footer"), dates.DAY_TIME_NO_YEAR, True
    )
    assert df.select(shown(step).alias("y")).first()["y"] == value


def test_ladder_cleaning(one):
    def climb(c):
        return shown(
            dates.ladder(c, crawl(), (dates.DAY_COMMA_TIME,), cut_dash=True, drop_weekday=True, month_names=True)
        )

    raw = ["pondělí 5. ledna 2015, 10:30 - Praha", "úterý 6. Ledna 2015, 10:30"]
    assert one(climb, raw) == ["2015-01-05 10:30:00", CRAWL]


def test_update_notes(one):
    assert one(clean_date("updated"), ["1. 2. 2011 (aktualizováno 3. 2.)"]) == ["1. 2. 2011 "]
    assert one(clean_date("last_update"), ["(Poslední aktualizace 1. 2. 2011 (aktualizováno x"]) == ["1. 2. 2011"]


def test_json_ld(one):
    raw = ['{"datePublished": "2020-01-05T10:30:00.000Z"}', '{"datePublished": "x"}', "{", "{}"]
    assert one(lambda c: shown(dates.json_ld_date(c)), raw) == ["2020-01-05 10:30:00", None, None, None]


def test_weekday(one):
    days = ["2020-01-06", "2020-01-12T23:00:00+02:00", None, "2020", "2020-02-30"]
    assert one(lambda c: dates.day_of_week(dates.local_date(c)), days) == [1, 7, 0, 0, 0]
