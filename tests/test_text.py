"""Text, list and author functions against literal expectations."""

from __future__ import annotations

import html
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pressloom.functions import authors, labels, text, urls

AWKWARD = "   \t\n\r\x0b\x0c\x1c\x1f\x85.…&amp;&nbsp;aěŠßﬁ½ "


def py_unify(s: str) -> str:
    import re

    s = re.sub(r"\n\s*\n+", "\n", s)
    s = re.sub(r"\t\s*\t+", "\n", s)
    return s.replace("\xa0", " ").strip()


def py_normalize(s: str) -> str:
    return unicodedata.normalize("NFKC", html.unescape(" ".join(s.split())))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=AWKWARD, max_size=30), min_size=200, max_size=200))
def test_unify_and_normalize_equal_python(one, values):
    assert one(text.unify, values) == [py_unify(v) for v in values]
    assert one(text.normalize, values) == [py_normalize(v) for v in values]
    assert one(text.strip, values) == [v.strip() for v in values]


def test_decoding_test_never_misses_a_character(one):
    chars = [chr(p) for p in range(0x20, 0x3000) if unicodedata.category(chr(p)) not in ("Cs", "Zs", "Zl", "Zp", "Cc")]
    assert one(text.normalize, chars) == [unicodedata.normalize("NFKC", c) for c in chars]


def test_named_entities_equal_python_without_it(one):
    """Each name alone, next to others, doubly encoded and cut off; with the common ones no text travels to Python."""
    whole = [f"a&{n};b &{n};&{m};&amp;{n};" for n, m in zip(text.ENTITIES, reversed(text.ENTITIES))]
    common = ["&amp;&quot;x&quot;&nbsp;&lt;b&gt; & Co &eacute;&scaron;&hellip;", "AT&T; R&D, a & b", "&", "&;", "&&amp;", "100 &euro;", "č&amp;š"]
    odd = ["&amp", "&quot x", "&#39;", "&#x41;", "&notit;", "&alpha;", "&acute;", "&ampamp;", "ﬁ&amp;", "e\u0301&amp;", "&NotEqualTilde;", "AT&T;"]
    values = [*whole, *common, *odd, "", None]
    want = [None if v is None else unicodedata.normalize("NFKC", html.unescape(v)) for v in values]
    assert one(text.decode_entities, values) == want
    assert one(text.decode_entities_all, [values], "array<string>") == [want]
    assert not any(one(text.needs_python, [*whole, common[0], *common[2:]], "string")) and all(one(text.needs_python, odd[:-1]))
    assert len(text.ENTITIES) > 120 and text.ENTITIES["nbsp"] == " "


def test_normalize_keeps_spaces_that_entities_leave(one):
    assert one(text.normalize, ["a &nbsp;b&nbsp;", "&amp;lt;", None]) == ["a  b ", "&lt;", None]


@pytest.mark.parametrize(
    "raw, tidy",
    [
        ("  konec. ", "Konec"),
        ("konec..", "Konec.."),
        (".", "."),
        ("a", "a"),
        ("a.", "a"),
        ("ab", "Ab"),
        ("", ""),
        ("šaty…", "Šaty…"),
        ("1. máj.", "1. máj"),
        (None, None),
    ],
)
def test_tidy_sentence(one, raw, tidy):
    assert one(text.tidy_sentence, [raw]) == [tidy]


def test_keywords_are_normalised_before_they_are_tidied(one):
    values = [["PRAHA.", " nové\n zprávy ", "&amp;x"], [], None]
    assert one(text.keywords, values, "array<string>") == [["Praha", "Nové zprávy", "&x"], [], None]


def test_page_headline(one):
    raw = ["ONLINE: Zápas - Sport | iDNES.cz", "A - b – Aktuálně.cz zprávy", "A | Deník", "A - NOVINKY.CZ\nB", "X-y"]
    assert one(text.page_headline, raw) == ["Zápas - Sport", "A - b", "A | Deník", "A - NOVINKY.CZ\nB", "X-y"]


def test_numbers(one):
    assert one(text.first_number, ["Diskuse (12) 3", "nic", None]) == ["12", None, None]
    assert one(text.first_number_before_comma, ["5 čtenářů, 9", "x, 9"]) == ["5", None]


def test_word_case(one):
    words = ["", "A", "Ab", "AB", "aB", "Čáp", "ab", "A1", "1"]
    assert one(text.is_capitalized, words) == [True, False, True, False, False, True, False, False, False]
    assert one(text.is_upper, words) == [False, True, False, True, False, False, False, True, False]


def test_byline(one):
    raw = ["Autoři: Jan Novák, FOTO: Petr, ,\xa0Eva", "autor/ři Jan", "", None]
    assert one(authors.split_byline, raw) == [["Jan Novák", "Eva"], ["Jan"], [], None]


@pytest.mark.parametrize(
    "raw, name",
    [
        ("Mgr. Jan Novák (autor)", "Jan Novák"),
        ("připravila Eva Malá | red", "Eva Malá"),
        ("text: recenze Eva Malá - editorka", "Eva Malá"),
        ("JANA ČÁPOVÁ-NOVÁ", "Jana Čápová-nová"),
        ("jan o'neil", "Jan O'neil"),
        # suffixes need no space before them
        ("Petr Fleming", "Petr Flem"),
        # a space left by one suffix keeps the next one
        ("Novák mgr ing", "Novák Mgr"),
        # "idnes" alone is no suffix, and neither is "bc"
        ("Jan Malý idnes", "Jan Malý Idnes"),
        ("Jan Malý idnesbc.", "Jan Malý"),
        ("ČTK", ""),
        ("Jan  \t Malý &amp; syn", "Jan Malý & Syn"),
    ],
)
def test_author_name(one, raw, name):
    assert one(authors.author_name, [raw]) == [name]
    assert one(authors.author_names, [[raw]], "array<string>") == [[name]]


def test_empty_author_lists_become_null(one):
    assert one(authors.author_names, [[], None, ["Eva Malá"]], "array<string>") == [None, None, ["Eva Malá"]]


def test_whole_word_suffixes(one):
    assert one(lambda c: authors.bare_name(c, whole_words=True), ["Petr Fleming", "Jan Malý čtk"]) == [
        "Petr Fleming",
        "Jan Malý",
    ]


def test_human_names(one):
    names = ["Jan Novák", "Jan", "Jan de Vos", "A B C D E", "Jan Novák1", "Jan Novák-Malý", "Jan  Novák", "Jana Eva Malá Nová"]
    assert one(authors.is_human_name, names) == [True, False, False, False, False, False, True, True]


def test_human_authors_keep_the_raw_name(one):
    lists = [["Mgr. Jan Novák (red)", "ČTK"], ["red"], None]
    assert one(authors.human_authors, lists, "array<string>") == [["Mgr. Jan Novák (red)"], None, None]


def test_server(one):
    links = ["https://www.idnes.cz/x", "http://aktualne.cz:443/", "http://a.b.com", "https://x.cz/a|b{c}", "http://cz/", "x"]
    assert one(urls.server, links) == ["idnes", "aktualne", "com", "x", None, ""]


def test_domains_include_subdomains_only(one):
    links = ["http://m.idnes.cz/", "http://idnes.cz:80", "http://xidnes.cz", "http://u@IDNES.cz/", "http://a.cz/idnes.cz"]
    assert one(lambda c: urls.in_domain(c, ["idnes.cz"]), links) == [True, True, False, True, False]


def test_file_name(one):
    assert one(urls.file_name, ["https://a/" + "b/" * 60]) == [("https:__a_" + "b_" * 60)[:80]]


def test_joint_gender(one):
    lists = [[], [1], [2, 2], [1, 0], [0, 0], [1, 2]]
    assert one(labels.joint_gender, lists, "array<int>") == [0, 1, 2, 3, 0, 3]


def test_labels(spark, one):
    names = ["idnes", None, "ihned"]
    assert one(lambda c: labels.to_id(c, labels.SERVERS), names) == [1, 0, 0]
    with pytest.raises(Exception, match="unknown class name: ihned"):
        one(lambda c: labels.to_id(c, labels.SERVERS, strict=True), names)
    assert one(lambda c: labels.to_name(c, labels.GENDERS), [0, 3, 4], "int") == ["None", "Mixed", None]
    table = labels.label_table(spark)
    assert table.where("column = 'category'").count() == 26
    assert table.where("column = 'category' AND name = 'Bike'").first()["id"] == 25
