"""String and string-list cleaning as Column expressions.

Patterns spell out the whitespace class because Java's `\\s` is ASCII only and the data holds no-break spaces.
"""

from __future__ import annotations

import html
import html.entities
import unicodedata

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Unicode whitespace plus the four ASCII separators. The class reads the same in Java and RE2.
WS = r"[\t-\r\x1c-\x20\x85\p{Z}]"
# The same characters one by one, for Spark's native `trim`.
WS_CHARS = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())

# Site names that close a page title.
SITE_SUFFIXES = (
    "Novinky.cz",
    "Aktuálně.cz",
    "aktualne.cz",
    "denik.cz",
    "deník.cz",
    "ihned.cz",
    "idnes.cz",
    "seznam zprávy",
    "seznamzpravy.cz",
)
# Marker words removed from titles, briefs and one site's article text.
HEADLINE_MARK = "ONLINE:"
BRIEF_MARK = "EXKLUZIVNĚ."
AUDIO_NOTE = "Článek si také můžete poslechnout v audioverzi.\n"

_SITE_TAIL = "(?iud)[-–|][^-–|]*(?:" + "|".join(SITE_SUFFIXES) + ").*$"


# Blocks without combining marks: text made of their stable characters alone is already normal.
_BLOCKS = ((0x80, 0x24F), (0x400, 0x45F), (0x2010, 0x205E), (0x20A0, 0x20BF))


def _stable(char: str) -> bool:
    """A character that NFKC leaves as it is and that joins with no neighbour."""
    inside = char < "\x80" or any(low <= ord(char) <= high for low, high in _BLOCKS)
    return inside and unicodedata.is_normalized("NFKC", char) and not unicodedata.combining(char)


def _stable_class() -> str:
    """The stable characters that are not ASCII, as a regex class."""
    parts, start = [], None
    for low, high in _BLOCKS:
        for point in range(low, high + 2):
            good = point <= high and _stable(chr(point))
            if good and start is None:
                start = point
            elif not good and start is not None:
                parts.append(f"\\x{{{start:x}}}-\\x{{{point - 1:x}}}")
                start = None
    return "".join(parts)


def _named_entities() -> dict[str, str]:
    """Name to the normal form of its character, for the names whose characters are stable once they are normal."""
    names = {**{n: chr(p) for n, p in html.entities.name2codepoint.items()}, "apos": "'"}
    normal = {n: unicodedata.normalize("NFKC", c) for n, c in names.items()}
    return {n: c for n, c in sorted(normal.items()) if all(map(_stable, c))}


# Named entities that are decoded without Python, a no-break space as the space that it becomes.
ENTITIES = _named_entities()
# Text that only Python can decode: other names, names without a semicolon, numbers, characters that are not stable.
NEEDS_DECODING = rf"&(?!(?:{'|'.join(ENTITIES)});)[A-Za-z]|&#[0-9xX]|[^\x00-\x7f](?<![{_stable_class()}])"


def strip(c: Column) -> Column:
    """Remove leading and trailing Unicode whitespace (`trim` alone knows the plain space only)."""
    return F.trim(c, F.lit(WS_CHARS))


def _lines(c: Column) -> Column:
    """Blank lines become one line break, tab runs too."""
    return F.regexp_replace(F.regexp_replace(c, rf"\n{WS}*\n+", "\n"), rf"\t{WS}*\t+", "\n")


def _spaces(c: Column) -> Column:
    """No-break spaces become spaces, then strip."""
    return strip(F.replace(c, F.lit("\xa0"), F.lit(" ")))


def _broken(c: Column) -> Column:
    return c.contains("\n") | c.contains("\t")


def unify(c: Column, source: Column | None = None) -> Column:
    """Blank lines become one line break, tab runs too, no-break spaces become spaces, then strip.

    `source` is a plain column that `c` was made of, by removals; where it has no line break and no tab, no pattern is tried.
    """
    return _spaces(_lines(c)) if source is None else F.when(_broken(source), _spaces(_lines(c))).otherwise(_spaces(c))


def unify_all(c: Column, source: Column | None = None) -> Column:
    """`unify` every member of a list and drop the empty ones; `source` as there."""
    if source is None:
        return F.filter(F.transform(c, lambda x: unify(x)), lambda x: x != "")
    return F.when(_broken(source), unify_all(c)).otherwise(F.filter(F.transform(c, _spaces), lambda x: x != ""))


def squash(c: Column) -> Column:
    """Strip and turn every whitespace run into one space."""
    return F.trim(F.regexp_replace(c, f"{WS}+", " "))


def _decode(text: str) -> str:
    return unicodedata.normalize("NFKC", html.unescape(text))


def _decode_texts(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else _decode(t) for t in texts.to_pylist()], pa.string())


def _decode_lists(lists: pa.Array) -> pa.Array:
    return pa.array(
        [None if m is None else [None if t is None else _decode(t) for t in m] for m in lists.to_pylist()],
        pa.list_(pa.string()),
    )


def needs_python(c: Column) -> Column:
    """Whether a text has entities or characters that only Python can decode. The native tests spare plain ASCII text the regex."""
    return (c.contains("&") | (F.octet_length(c) > F.length(c))) & c.rlike(NEEDS_DECODING)


def _decode_named(c: Column) -> Column:
    """The named entities of a text, each once: what follows an `&` is looked up up to its semicolon."""
    known = F.create_map(*[F.lit(x) for pair in ENTITIES.items() for x in pair])
    pieces = F.split(c, "&")

    def decoded(piece: Column) -> Column:
        name = F.regexp_extract(piece, "^([A-Za-z][A-Za-z0-9]*);", 1)
        rest = F.substr(piece, F.length(name) + 2)
        return F.coalesce(F.concat(F.try_element_at(known, name), rest), F.concat(F.lit("&"), piece))

    later = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), decoded)
    text = F.concat(F.get(pieces, F.lit(0)), F.array_join(later, ""))
    return F.when(c.contains("&"), text).otherwise(c)


def decode_entities(c: Column) -> Column:
    """HTML entities, then NFKC. Spark has neither; common named entities are decoded natively, and only texts with other
    ones or with characters that may change travel to Python."""
    decode = F.arrow_udf(_decode_texts, T.StringType())
    return F.coalesce(decode(F.when(needs_python(c), c)), _decode_named(c))


def decode_entities_all(c: Column) -> Column:
    """`decode_entities` for each member of a list."""
    decode = F.arrow_udf(_decode_lists, T.ArrayType(T.StringType()))
    return F.coalesce(decode(F.when(F.exists(c, needs_python), c)), F.transform(c, _decode_named))


def normalize(c: Column) -> Column:
    """Dataset normalisation. Decoding comes last, so a decoded no-break space may leave a double space."""
    return decode_entities(squash(c))


def normalize_columns(df: DataFrame, *names: str) -> DataFrame:
    """`normalize` several columns; whitespace is settled first so that no regex runs twice."""
    settled = df.withColumns({n: squash(F.col(n)) for n in names})
    return settled.withColumns({n: decode_entities(F.col(n)) for n in names})


def _drop_final_dot(c: Column) -> Column:
    single = c.endswith(".") & ~c.endswith("..") & (c != ".")
    return F.when(single, F.left(c, F.length(c) - 1)).otherwise(c)


def _upper_first(c: Column) -> Column:
    return F.when(c.rlike(r"(?s)^\p{Ll}."), F.concat(F.upper(F.left(c, F.lit(1))), F.substr(c, F.lit(2)))).otherwise(c)


def tidy_sentence(c: Column) -> Column:
    """Strip, drop one closing dot (an ellipsis stays), upper-case a small first letter of longer texts."""
    return _upper_first(_drop_final_dot(strip(c)))


def tidy_columns(df: DataFrame, *names: str) -> DataFrame:
    """`tidy_sentence` on several columns, one projection per step, so that no text is handled twice."""
    for step in (strip, _drop_final_dot, _upper_first):
        df = df.withColumns({n: step(F.col(n)) for n in names})
    return df


def tidy_all(c: Column) -> Column:
    """`tidy_sentence` for each member of a list, one pass per step."""
    for step in (strip, _drop_final_dot, _upper_first):
        c = F.transform(c, step)
    return c


def headline(c: Column) -> Column:
    """Dataset headline or brief: tidy, then normalise."""
    return normalize(tidy_sentence(c))


brief = headline
content = normalize


def category(c: Column) -> Column:
    """Lower-case, then tidy."""
    return tidy_sentence(F.lower(c))


def keywords(c: Column) -> Column:
    """Each keyword: lower-case, normalise, tidy. Null stays null."""
    return tidy_all(decode_entities_all(_lowered(c)))


def _lowered(c: Column) -> Column:
    return F.transform(c, lambda x: squash(F.lower(x)))


def keyword_column(df: DataFrame, name: str) -> DataFrame:
    """`keywords` on a column, in steps so that the list is handled once; null becomes the empty list."""
    df = df.withColumn(name, _lowered(F.col(name)))
    df = df.withColumn(name, decode_entities_all(F.col(name)))
    return df.withColumn(name, or_default(tidy_all(F.col(name)), F.array().cast("array<string>")))


def page_headline(c: Column) -> Column:
    """Page title without the live mark and without the closing site name, for a plain column."""
    title = F.replace(c, F.lit(HEADLINE_MARK), F.lit(""))
    dashed = c.contains("-") | c.contains("–") | c.contains("|")
    return unify(F.when(dashed, F.regexp_replace(title, _SITE_TAIL, "")).otherwise(title), c)


def page_brief(c: Column, source: Column | None = None) -> Column:
    return unify(F.replace(c, F.lit(BRIEF_MARK), F.lit("")), c if source is None else source)


def page_category(c: Column) -> Column:
    return unify(c, c)


def page_keywords(c: Column) -> Column:
    """Comma-separated keywords to a clean list."""
    return unify_all(F.split(c, ","), c)


def page_keywords_spaced(c: Column) -> Column:
    """Space-separated keywords to a clean list."""
    return page_keywords(F.replace(c, F.lit(" "), F.lit(",")))


def join_texts(c: Column) -> Column:
    return F.array_join(c, ",")


def first_number(c: Column) -> Column:
    """First run of digits as text, null without one."""
    return F.nullif(F.regexp_extract(c, r"(\p{Nd}+)", 1), F.lit(""))


def first_number_before_comma(c: Column) -> Column:
    return first_number(F.get(F.split(c, ","), F.lit(0)))


def without_audio_note(c: Column) -> Column:
    return F.replace(c, F.lit(AUDIO_NOTE), F.lit(""))


def chain(c: Column, *steps) -> Column:
    """Apply Column functions in order."""
    for step in steps:
        c = step(c)
    return c


def or_default(c: Column, default: Column) -> Column:
    """Null becomes `default`."""
    return F.coalesce(c, default)


def is_capitalized(c: Column) -> Column:
    """Empty, or an upper-case letter followed by lower-case ones only (a lone capital does not count)."""
    return c.rlike(r"^\z|^\p{Lu}(?=.*\p{Ll})[^\p{Lu}]*\z")


def is_upper(c: Column) -> Column:
    """Holds an upper-case letter and no lower-case one."""
    return c.rlike(r"\p{Lu}") & ~c.rlike(r"\p{Ll}")
