"""Author lines: splitting, title and role removal, capitalisation, name checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressloom.functions import text

# Words that introduce an author line, and the photo credit mark.
BYLINE_WORDS = ("autor/ři", "autoři", "autori", "autor", "authors", "author")
PHOTO_CREDIT = "foto:?"

# Fixed values (patterns): agency names and academic titles that close a name.
# "idnes" and "bc" are one entry, as the dataset was built with it.
NAME_SUFFIXES = (
    r"pro téma",
    r"pro právo",
    r"pro atm",
    r"pro .*dnes(\.cz)?(\))?",
    r"idnesbc(\.?)",
    r"čtk",
    r"mgr(\.?)",
    r"ing(\.?)",
    r"phdr(\.?)",
    r"prof(\.?)",
    r"doc(\.?)",
    r"mudr(\.?)",
)

# Fixed values (patterns): roles and academic titles that open a name.
NAME_PREFIXES = (
    r"připravil(a|i)?",
    r"přeložil(a|i)?",
    r"zpracoval(a|i)?",
    r"zaznamenal(a|i)?",
    r"upravil(a|i)?",
    r"rozhovor vedli",
    r"daňová poradkyně",
    r"vizualizace",
    r"advokát(ka)?",
    r"právní(k|ci)",
    r"etoložka",
    r"čtenář(ka)?",
    r"stránku připravil(a|i)?",
    r"kartářka",
    r"zahradní architekt(ka)?",
    r"kritik",
    r"mykoložka",
    r"astroložka",
    r"politolog",
    r"překlad",
    r"(odborná)? spolupráce",
    r"spolupacoval(a|i)?",
    r"redakčně připravil(a|i)?",
    r"text(:)?",
    r"recenze",
    r"kardinál",
    r"pro právo",
    r"pro téma",
    r"pro .*dnes(\.cz)?",
    r"pro novinky(\.cz)?",
    r"bc(\.?)",
    r"mgr(\.?)",
    r"ing(\.?)",
    r"phdr(\.?)",
    r"prof(\.?)",
    r"doc(\.?)",
    r"mudr(\.?)",
    r"lord",
)

# Removing one prefix (or suffix) at a time until nothing changes is one repeated group.
_OPENING = rf"(?iu)^(?:(?:{'|'.join(NAME_PREFIXES)}){text.WS}+)+"
_CLOSING = rf"(?iu)(?:{'|'.join(NAME_SUFFIXES)})+\z"
# Suffixes need no space before them; the relaxed form only removes whole words.
_CLOSING_WORDS = rf"(?iu)(?:(?:^|{text.WS}+)(?:{'|'.join(NAME_SUFFIXES)}))+\z"
_BYLINE = rf"(?iu)(?:{'|'.join(BYLINE_WORDS)}):?"


def split_byline(c: Column) -> Column:
    """Author line to a list: no byline words, no empty names, no photo credits."""
    names = text.unify_all(F.split(F.regexp_replace(c, _BYLINE, ""), ","), c)
    return F.filter(names, lambda x: ~x.rlike(f"(?iu){PHOTO_CREDIT}"))


def bare_name(c: Column, whole_words: bool = False) -> Column:
    """Name without remarks, roles and titles.

    Suffixes cut into words ("Fleming" gives "Flem"), as in the published dataset; `whole_words` avoids that.
    """
    for cut in ("|", " - ", "(", "["):
        c = F.substring_index(c, cut, 1)
    c = F.regexp_replace(text.strip(c), _OPENING, "")
    return text.strip(F.regexp_replace(c, _CLOSING_WORDS if whole_words else _CLOSING, ""))


def capitalized_name(c: Column, whole_words: bool = False) -> Column:
    """`bare_name`, lower-cased, single-spaced, each word capitalised; entities are still to be decoded."""
    single = F.regexp_replace(F.lower(bare_name(c, whole_words)), f"{text.WS}+", " ")
    return text.squash(F.initcap(single))


def author_name(c: Column, whole_words: bool = False) -> Column:
    """One cleaned author name."""
    return text.decode_entities(capitalized_name(c, whole_words))


def author_names(c: Column, whole_words: bool = False) -> Column:
    """Cleaned names of a list; a null or empty list gives null."""
    return text.decode_entities_all(_capitalized_names(c, whole_words))


def _capitalized_names(c: Column, whole_words: bool) -> Column:
    return F.when(F.size(c) > 0, F.transform(c, lambda x: capitalized_name(x, whole_words)))


def author_column(df: DataFrame, name: str, whole_words: bool = False) -> DataFrame:
    """`author_names` on a column, in steps so that the list is handled once."""
    df = df.withColumn(name, _capitalized_names(F.col(name), whole_words))
    return df.withColumn(name, text.decode_entities_all(F.col(name)))


def is_human_name(c: Column) -> Column:
    """Two to four words, each longer than two characters, letters and digits only, no ASCII digit."""
    words = F.filter(F.split(c, " "), lambda x: x != "")
    return (
        F.size(words).between(2, 4)
        & F.forall(words, lambda x: F.length(x) > 2)
        & F.replace(c, F.lit(" "), F.lit("")).rlike(r"^[\p{L}\p{N}]+\z")
        & ~c.rlike("[0-9]")
    )


def human_authors(c: Column) -> Column:
    """Raw names whose cleaned form is a plausible human name; null when none is left."""
    pairs = F.transform(c, lambda x: F.struct(x.alias("raw"), bare_name(x).alias("bare")))
    kept = F.transform(F.filter(pairs, lambda p: is_human_name(p["bare"])), lambda p: p["raw"])
    return F.when(F.size(kept) > 0, kept)
