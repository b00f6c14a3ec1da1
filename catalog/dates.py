"""Date parsing over orders and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import pick, query, sql_pick, table
from pressloom.functions import dates
from pressloom.functions.dates import CZECH_MONTHS, CZECH_WEEKDAYS
from pressloom.plans.sites import clean_date

ORDER_TIME = "o_orderdate + INTERVAL (o_orderkey % 1440) MINUTE"
EVENT_TIME = "date_trunc('minute', ts)"


def _shown(c, pattern="yyyy-MM-dd HH:mm:ss"):
    return F.date_format(c, pattern)


def orders_with_time(spark, d):
    minutes = F.make_dt_interval(mins=(F.col("o_orderkey") % 1440).cast("int"))
    return table(spark, d, "orders").select("o_orderkey", (F.col("o_orderdate") + minutes).alias("ts"))


def events_by_minute(spark, d):
    return table(spark, d, "events").select("event_id", "user_id", F.date_trunc("minute", "ts").alias("ts"))


@query(
    "date_by_pattern",
    f"SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE "
    f"strftime({ORDER_TIME}, '%Y-%m-%d %H:%M:%S') END AS published FROM orders",
)
def date_by_pattern(spark, d):
    """Update marks, blank runs and one-digit parts are accepted; trailing text is not."""
    df = orders_with_time(spark, d)
    head = pick(F.col("o_orderkey"), "DNES ", "(Aktualizováno ", "\xa0", "", "")
    tail = pick(F.col("o_orderkey"), "", "", "\n", " aktualizováno", " hodin")
    raw = F.concat(head, _shown("ts", "d.  M.\xa0yyyy H:mm"), tail)
    return df.select("o_orderkey", _shown(dates.parse_noisy(raw, dates.DAY_TIME_SPACED)).alias("published"))


@query(
    "date_two_formats",
    f"""SELECT o_orderkey, strftime(CASE WHEN o_orderkey % 2 = 0 THEN {ORDER_TIME}
                                         ELSE date_trunc('day', {ORDER_TIME}) END, '%Y-%m-%d %H:%M:%S') AS published
        FROM orders""",
)
def date_two_formats(spark, d):
    df = orders_with_time(spark, d)
    raw = F.when(F.col("o_orderkey") % 2 == 0, _shown("ts", "dd. MM. yyyy HH:mm")).otherwise(_shown("ts", "d. M. yyyy"))
    return df.select("o_orderkey", _shown(dates.parse_day_time(raw)).alias("published"))


@query(
    "date_iso",
    f"""SELECT event_id,
               strftime({EVENT_TIME}, '%Y-%m-%d %H:%M:%S') ||
                 {sql_pick('event_id', '', '+02:00', '+00:00', '-05:30')} AS published,
               strftime(ts, '%Y-%m-%d') AS local_day
        FROM events""",
)
def date_iso(spark, d):
    """Wall-clock time and offset are both kept; the calendar date never shifts."""
    offset = pick(F.col("event_id"), "", "+02:00", "Z", "-0530")
    raw = F.concat(_shown("ts", "yyyy-MM-dd'T'HH:mm"), offset)
    moment = dates.iso_text(dates.parse_iso(raw), dates.iso_offset(raw))
    df = events_by_minute(spark, d)
    return df.select("event_id", moment.alias("published"), dates.local_date(raw).cast("string").alias("local_day"))


# Expected values, written out.
MONTHS_SQL = """['ledna', 'února', 'března', 'dubna', 'května', 'června', 'července', 'srpna', 'září', 'října', 'listopadu',
    'prosince']"""


@query(
    "date_czech_words",
    f"SELECT o_orderkey, strftime({ORDER_TIME}, '%Y-%m-%d %H:%M:%S') AS published FROM orders",
)
def date_czech_words(spark, d):
    df = orders_with_time(spark, d)
    month = F.get(F.array(*[F.lit(m) for m in CZECH_MONTHS]), F.month("ts") - 1)
    weekday = F.get(F.array(*[F.lit(w) for w in CZECH_WEEKDAYS]), F.weekday("ts"))
    raw = F.concat(weekday, F.lit(" "), _shown("ts", "d. "), month, _shown("ts", " yyyy H:mm"))
    return df.select("o_orderkey", _shown(dates.parse_czech(dates.without_weekday(raw))).alias("published"))


@query(
    "date_update_notes",
    f"""SELECT event_id, strftime(ts, '%-d. %-m. %Y') || ' ' AS v1,
               strftime(ts, '%Y-%m-%d') || ' 00:00:00' AS v2 FROM events""",
)
def date_update_notes(spark, d):
    raw = F.concat(_shown("ts", "d. M. yyyy"), F.lit(" (aktualizováno v "), _shown("ts", "H:mm"), F.lit(")"))
    last = F.concat(F.lit("(Poslední aktualizace "), raw)
    cleaned = dates.parse_day_time(clean_date("last_update")(last))
    return events_by_minute(spark, d).select(
        "event_id", clean_date("updated")(raw).alias("v1"), _shown(cleaned).alias("v2")
    )


@query(
    "date_ladder",
    f"""WITH e AS (SELECT event_id, {EVENT_TIME} AS t, {EVENT_TIME} + INTERVAL 3 DAY + INTERVAL 7 SECOND AS crawl FROM events)
        SELECT event_id, CASE event_id % 8
                 WHEN 0 THEN strftime(t, '%Y-%m-%d %H:%M:%S')
                 WHEN 1 THEN strftime(t, '%Y-%m-%d') || ' 00:00:00'
                 WHEN 2 THEN '2013' || strftime(t, '-%m-%d %H:%M:%S')
                 WHEN 3 THEN strftime(crawl, '%Y-%m-%d') || strftime(t, ' %H:%M') || ':07'
                 WHEN 4 THEN strftime(crawl, '%Y-%m-%d %H:%M:%S')
                 WHEN 5 THEN strftime(crawl, '%Y-%m-%d %H:%M:%S')
                 WHEN 6 THEN NULL
                 ELSE strftime(crawl, '%Y-%m-%d') || strftime(t, ' %H:%M') || ':07' END AS published
        FROM e""",
)
def date_ladder(spark, d):
    """Every step: full formats, footer year, time of the crawl day, crawl time, no element."""
    df = events_by_minute(spark, d)
    kind = F.col("event_id") % 8
    raw = (
        F.when(kind == 0, _shown("ts", "d. M. yyyy H:mm"))
        .when(kind == 1, _shown("ts", "d. M. yyyy"))
        .when(kind.isin(2, 7), F.concat(F.lit("DNES "), _shown("ts", "d. M. H:mm")))
        .when(kind == 3, F.concat(F.lit("dnes v "), _shown("ts", "H:mm")))
        .when(kind == 4, "včera")
        .when(kind == 5, "25:70")
    )
    footer = F.when(kind != 7, F.concat(F.lit("© 1999 – 2013 "), kind.cast("string")))
    crawl = (F.col("ts") + F.expr("INTERVAL '3 00:00:07' DAY TO SECOND")).cast("timestamp_ntz")
    formats = (dates.DAY_TIME_SPACED, dates.DAY_SPACED)
    df = dates.ladder_column(df, "moment", raw, crawl, formats, footer, dates.DAY_TIME_NO_YEAR, time_of_crawl_day=True)
    return df.select("event_id", dates.iso_text(F.col("moment")).alias("published"))


@query(
    "date_weekday",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day,
              CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE isodow(o_orderdate) END::INTEGER AS day_of_week FROM orders""",
)
def date_weekday(spark, d):
    raw = F.when(F.col("o_orderkey") % 9 != 0, _shown("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'+02:00'"))
    day = dates.local_date(raw)
    return table(spark, d, "orders").select(
        "o_orderkey", day.cast("string").alias("day"), dates.day_of_week(day).alias("day_of_week")
    )


@query(
    "json_ld_date",
    """SELECT event_id, CASE WHEN event_id % 6 IN (0, 5) THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || '.120000'
              END AS published, json_extract_string(props, '$.k') AS k FROM events""",
)
def json_ld_date(spark, d):
    """Broken JSON, text behind it, a missing key or another format give null."""
    kind = F.col("event_id") % 6
    stamp = _shown("ts", "yyyy-MM-dd'T'HH:mm:ss")
    script = (
        F.when(kind == 0, F.concat(F.lit('{"@type":"NewsArticle","datePublished":"'), stamp, F.lit('.12Z"}')))
        .when(kind == 1, F.concat(F.lit('{"datePublished":"'), stamp))
        .when(kind == 2, F.col("props"))
        .when(kind == 3, F.concat(F.lit('{"datePublished":"'), stamp, F.lit('.12Z"} x')))
        .when(kind == 5, F.concat(F.lit('  {"a":[{"b":1}],"datePublished":"'), stamp, F.lit('.12Z"}\n')))
        .otherwise(F.concat(F.lit('{"datePublished":"'), stamp, F.lit('"}')))
    )
    return table(spark, d, "events").select(
        "event_id",
        dates.iso_text(dates.json_ld_date(script)).alias("published"),
        F.get_json_object("props", "$.k").alias("k"),
    )
