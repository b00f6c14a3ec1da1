"""Publication dates. Wall-clock values are TIMESTAMP_NTZ: the local date is kept, zones never shift it."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.functions import text

# Czech month names (genitive, in order) and weekday names.
CZECH_MONTHS = (
    "ledna",
    "února",
    "března",
    "dubna",
    "května",
    "června",
    "července",
    "srpna",
    "září",
    "října",
    "listopadu",
    "prosince",
)
CZECH_WEEKDAYS = ("pondělí", "úterý", "středa", "čtvrtek", "pátek", "sobota", "neděle")

# Fixed values (patterns): noise inside date texts, the footer year and the time of day.
DATE_NOISE = r"DNES|(\(?AKTUALIZOVÁNO)"
FOOTER_YEAR = r"\d{4}\s*–\s*(\d{4})"
TIME_OF_DAY = r"(\d+):(\d+)"

# Date formats of the sites.
DAY_TIME_SPACED = "%d. %m. %Y %H:%M"
DAY_SPACED = "%d. %m. %Y"
DAY_COMMA_TIME = "%d. %m. %Y, %H:%M"
DAY_TIME_TIGHT = "%d.%m.%Y %H:%M"
DAY_TIGHT = "%d.%m.%Y"
TIME_DAY = "%H:%M %d. %m. %Y"
DAY_TIME_NO_YEAR = "%d. %m. %H:%M"
JSON_LD = "%Y-%m-%dT%H:%M:%S.%fZ"

_PART = {
    "%d": r"\d{1,2}",
    "%m": r"\d{1,2}",
    "%Y": r"\d{4}",
    "%H": r"\d{1,2}",
    "%M": r"\d{1,2}",
    "%S": r"\d{1,2}",
    "%f": r"\d{1,6}",
}
_ISO = (
    r"^(\d{4}-\d{2}-\d{2})(?:.(\d{2}(?::\d{2}(?::\d{2}(?:\.\d{3}(?:\d{3})?)?)?)?)"
    r"(Z|[+-]\d{2}:?\d{2}(?::\d{2}(?:\.\d{6})?)?)?)?\z"
)


def _wall_clock(value: Column) -> Column:
    return value.try_cast("timestamp_ntz")


def _plain(moment: Column) -> Column:
    """`yyyy-MM-dd HH:mm:ss`, followed by a fraction if there is one."""
    return moment.cast("timestamp_ntz").cast("string")


def parse(c: Column, pattern: str, year: Column | None = None) -> Column:
    """Parse by a `strptime` pattern; text that does not fit gives null.

    The parts are put in ISO order by regex and cast. This fails without exceptions, takes one- and two-digit parts,
    lets one blank of the pattern stand for any run of blanks, and does not depend on the session zone. A `year`
    column stands in for a pattern without one.
    """
    directives = re.findall("%[a-zA-Z]", pattern)
    shape = re.escape(pattern).replace(r"\ ", f"{text.WS}+")
    for directive in directives:
        shape = shape.replace(directive, f"({_PART[directive]})")
    shape = rf"^{shape}\z"
    group = {d: f"${i}" for i, d in enumerate(directives, start=1)}
    day = f"{group['%m']}-{group['%d']}"
    clock = f"{group.get('%H', '0')}:{group.get('%M', '0')}:{group.get('%S', '0')}.{group.get('%f', '0')}"
    if year is None:
        moment = F.regexp_replace(c, shape, f"{group['%Y']}-{day} {clock}")
    else:
        moment = F.concat(year, F.lit("-"), F.regexp_replace(c, shape, f"{day} {clock}"))
    return F.when(c.rlike(shape), _wall_clock(moment))


def without_noise(c: Column) -> Column:
    return text.unify(F.regexp_replace(c, f"(?iu){DATE_NOISE}", ""))


def parse_noisy(c: Column, pattern: str, year: Column | None = None) -> Column:
    """`parse` after removal of update marks."""
    return parse(without_noise(c), pattern, year)


def parse_day_time(c: Column) -> Column:
    """Date with time, else date alone."""
    return F.coalesce(parse_noisy(c, DAY_TIME_SPACED), parse_noisy(c, DAY_SPACED))


def parse_iso(c: Column) -> Column:
    """ISO text to wall-clock time. `Z` and `+0200` are taken as well, which is wider than the strict form."""
    c = text.unify(c, c)
    # an hour without minutes needs them for the cast
    moment = F.regexp_replace(F.regexp_replace(c, _ISO, "$1 $2"), r"( \d{2})\z", "$1:00")
    return F.when(c.rlike(_ISO), _wall_clock(moment))


def iso_offset(c: Column) -> Column:
    """Zone text of an ISO value as `+HH:MM`, empty when it has none."""
    zone = F.regexp_extract(text.unify(c, c), _ISO, 3)
    return F.regexp_replace(F.regexp_replace(zone, r"^Z\z", "+00:00"), r"^([+-]\d{2})(\d{2})\z", "$1:$2")


def iso_text(moment: Column, offset: Column | None = None) -> Column:
    """`yyyy-MM-dd HH:mm:ss[.ffffff][+HH:MM]`. A cast, since `date_format` would move hours that a zone skips."""
    plain = _plain(moment)
    shown = F.when(F.length(plain) > 19, F.rpad(plain, 26, "0")).otherwise(plain)
    return shown if offset is None else F.concat(shown, offset)


def czech_months(c: Column) -> Column:
    """Month names to `N.`; no name contains another, so one replacement each is enough."""
    numbered = enumerate(CZECH_MONTHS, start=1)
    return reduce(lambda col, m: F.replace(col, F.lit(m[1]), F.lit(f"{m[0]}.")), numbered, c)


def without_weekday(c: Column) -> Column:
    return F.regexp_replace(c, "|".join(CZECH_WEEKDAYS), "")


def parse_czech(c: Column) -> Column:
    return parse_day_time(czech_months(c))


def footer_year(c: Column) -> Column:
    """Closing year of a `2001 – 2014` footer."""
    pattern = FOOTER_YEAR.replace(r"\s", text.WS)
    return F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))


def json_ld_date(c: Column) -> Column:
    """`datePublished` of a JSON-LD script; broken JSON, or text behind it, gives null."""
    # the parser stops behind a value; inside a list and inside an object nothing but one value can stand
    alone = [F.try_parse_json(F.concat(F.lit(a), c, F.lit(b))).isNotNull() for a, b in (("[", "]"), ('{"x":', "}"))]
    whole = F.when(alone[0] & alone[1], c)
    return parse_noisy(F.get_json_object(whole, "$.datePublished"), JSON_LD)


def date_text(
    raw: Column,
    cut_dash: bool = False,
    drop_weekday: bool = False,
    month_names: bool = False,
    cleaner: Callable[[Column], Column] | None = None,
) -> Column:
    """Steps of the ladder that come before parsing, as far as a site needs them."""
    if cut_dash:
        raw = F.substring_index(raw, "-", 1)
    if drop_weekday:
        raw = without_weekday(raw)
    if cleaner is not None:
        raw = cleaner(raw)
    return czech_months(raw) if month_names else raw


def climb(
    cleaned: Column,
    quiet: Column,
    crawl_ts: Column,
    formats: Sequence[str],
    year: Column | None = None,
    no_year_format: str | None = None,
    time_of_crawl_day: bool = False,
) -> Column:
    """Publication date by steps: full formats, year-less format with the footer year, time of the crawl day,
    crawl time. `quiet` is `cleaned` without update marks. No date element (null text) gives null at once.

    29 February parses in the year-less step, and an impossible time of day falls through to the crawl time.
    """
    steps = [parse(quiet, f) for f in formats]
    if no_year_format is not None and year is not None:
        steps.append(parse(quiet, no_year_format, year))
    if time_of_crawl_day:
        steps.append(on_day_of(crawl_ts, cleaned))
    return F.when(cleaned.isNotNull(), F.coalesce(*steps, crawl_ts))


def ladder(
    raw: Column,
    crawl_ts: Column,
    formats: Sequence[str],
    year_text: Column | None = None,
    no_year_format: str | None = None,
    time_of_crawl_day: bool = False,
    **cleaning,
) -> Column:
    """`date_text` and `climb` in one expression."""
    cleaned = date_text(raw, **cleaning)
    year = None if year_text is None else footer_year(year_text)
    return climb(cleaned, without_noise(cleaned), crawl_ts, formats, year, no_year_format, time_of_crawl_day)


def ladder_column(
    df: DataFrame,
    name: str,
    raw: Column,
    crawl_ts: Column,
    formats: Sequence[str],
    year_text: Column | None = None,
    no_year_format: str | None = None,
    time_of_crawl_day: bool = False,
    **cleaning,
) -> DataFrame:
    """The ladder as a new column, in steps so that no text is cleaned twice."""
    year = F.lit(None).cast("string") if year_text is None else footer_year(year_text)
    df = df.withColumns({"_cleaned": date_text(raw, **cleaning), "_year": year, "_crawled": crawl_ts})
    df = df.withColumn("_quiet", without_noise(F.col("_cleaned")))
    steps = climb(
        F.col("_cleaned"), F.col("_quiet"), F.col("_crawled"), formats, F.col("_year"), no_year_format, time_of_crawl_day
    )
    return df.withColumn(name, steps).drop("_cleaned", "_year", "_crawled", "_quiet")


def on_day_of(moment: Column, c: Column) -> Column:
    """`moment` with hour and minute replaced by the first `H:MM` of the text; seconds stay."""
    plain = _plain(moment)
    day, seconds = F.left(plain, F.lit(11)), F.substr(plain, F.lit(17))
    return _wall_clock(F.concat(day, F.regexp_extract(c, TIME_OF_DAY, 0), seconds))


def local_date(c: Column) -> Column:
    """ISO text to its local calendar date."""
    return F.regexp_extract(c, r"^\d{4}-\d{2}-\d{2}", 0).try_cast("date")


def day_of_week(c: Column) -> Column:
    """1 = Monday … 7 = Sunday, 0 for null."""
    return F.coalesce(F.weekday(c) + 1, F.lit(0))
