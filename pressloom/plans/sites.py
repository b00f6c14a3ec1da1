"""Site rules: where the fields of an article stand on the pages of each site."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressloom.functions import dates
from pressloom.operators.html import HEADINGS, LIST_TAGS, PLAIN_BODY, TABLE_TAGS


@dataclass(frozen=True)
class Take:
    """What to read: the first selector that hits, then its text, an attribute, member texts or body text.

    `clean` names the Column chain that is applied to the raw text.
    """

    css: tuple[str, ...]
    get: str = "text"
    clean: str | None = None
    attribute: str = ""
    members: tuple[str, ...] = ()
    own_text: bool = False
    body: dict = field(default_factory=dict)
    extra_members: tuple[str, ...] = ()


@dataclass(frozen=True)
class DateRule:
    """Arguments of the date ladder."""

    css: tuple[str, ...]
    formats: tuple[str, ...]
    year_css: str | None = None
    no_year_format: str | None = None
    time_of_crawl_day: bool = True
    cut_dash: bool = False
    drop_weekday: bool = False
    month_names: bool = False
    cleaner: str | None = None
    json_ld_css: str | None = None


@dataclass(frozen=True)
class Site:
    """Rules of one extractor. Custom values win over article values, those over head values; null never wins."""

    head: dict[str, Take]
    root: str
    article: dict[str, Take]
    custom: dict[str, Take] = field(default_factory=dict)
    date: DateRule | None = None
    charset: str | None = None
    must_exist: tuple[str, ...] = ()
    must_not_exist: tuple[str, ...] = ()
    rejected_segments: tuple[str, ...] = ()
    required_segments: tuple[str, ...] = ()
    any_status: bool = False
    host_labels: tuple[str, ...] | None = None
    # User hooks: a page predicate as Column, a tree predicate and extra raw values inside the parse.
    page_filter: Callable[[], Column] | None = None
    tree_filter: Callable[[Any], bool] | None = None
    hook: Callable[[Any], dict[str, str]] | None = None


def _text(*css: str, clean: str | None = None) -> Take:
    return Take(css, "text", clean)


def _meta(css: str, clean: str | None = None) -> Take:
    return Take((css,), "attribute", clean, attribute="content")


def _members(css: str, *members: str, own_text: bool = False, clean: str | None = None) -> Take:
    return Take((css,), "members", clean, members=members, own_text=own_text)


def _body(*css: str, clean: str | None = None, **rule: Any) -> Take:
    return Take(css, "body", clean, body=rule or {"tags": PLAIN_BODY})


_OG_TITLE = "meta[property='og:title']"
_OG_BRIEF = "meta[property='og:description']"
_KEYWORDS = "meta[name='keywords']"
_DESCRIPTION = "meta[name='description']"
_PUBLISHED = "meta[property='article:published_time']"
_BLOCKS = (*LIST_TAGS, "figure", *TABLE_TAGS)
_RIGHT_ALIGNED = ".page-content .bbtext > p[style='text-align: right;']"
_SPACED = (dates.DAY_TIME_SPACED, dates.DAY_SPACED)

# Fixed values (patterns): update notes inside the dates of one site.
DATE_CLEANERS = {
    "updated": r"(?d)\(aktualizováno.*",
    "last_update": r"(?d)(\(?Poslední aktualizace) | (\(aktualizováno.*)",
}


def clean_date(name: str) -> Callable[[Column], Column]:
    return lambda c: F.regexp_replace(c, DATE_CLEANERS[name], "")


# Selectors, class names and attribute values as the sites use them.
SITES: dict[str, Site] = {
    "idnes_cz_v1": Site(
        head={"headline": _text("title"), "keywords": _meta(_KEYWORDS), "brief": _meta(_DESCRIPTION)},
        root="#main",
        article={
            "content": _body("div.text > div.bbtext"),
            "category": _text("li.act > a"),
            "author": _members("div.authors > ul", "li a", "li span.name"),
            "publication_date": _text("div.art-info > span.time", clean="czech"),
            "comments_num": _text("div.btm", clean="number_before_comma"),
        },
        charset="windows-1250",
    ),
    "idnes_cz_v2": Site(
        head={
            "headline": _meta(_OG_TITLE),
            "keywords": _meta(_KEYWORDS),
            "publication_date": _meta(_PUBLISHED, clean="iso"),
            "brief": _meta(_OG_BRIEF),
        },
        root="#main",
        article={
            "content": _body("#art-text > div.bbtext"),
            "author": _members("div.authors", "div span[itemprop='name']"),
            "comments_num": _text("#moot-linkin"),
            "publication_date": _text("div.art-info > span.time", clean="czech"),
            "category": _text("li.act > a"),
        },
        must_not_exist=("div#paywall-unlock", "div#paywall"),
        charset="windows-1250",
    ),
    "aktualne_cz_v1": Site(
        head={"headline": _meta(_OG_TITLE), "keywords": _meta(_KEYWORDS)},
        root="div#obsah",
        article={
            "content": _body("div[class*=clanek-text]", tags=_BLOCKS, tags_no_class=("p", *HEADINGS)),
            "category": _text("ul#nav-breadcrumb > li >  a"),
            "author": _text("p.clanek-autor"),
            "comments_num": _text("#disqusCounter > span"),
            "brief": _text(".clanek-perex"),
        },
        date=DateRule(
            (".clanek-datum",), _SPACED, year_css="#paticka-utm", no_year_format=dates.DAY_TIME_NO_YEAR
        ),
        rejected_segments=("wiki",),
    ),
    "aktualne_cz_v2": Site(
        head={"headline": _meta(_OG_TITLE), "keywords": _meta(_KEYWORDS)},
        root="body",
        article={"category": _text(".hlavicka a.active"), "brief": _text(".perex")},
        custom={
            "content": _body(
                "div[data-ec-list*='zpravy']",
                "div[data-upscore='article']",
                "div.clanek",
                tags=_BLOCKS,
                tags_no_class=("p", *HEADINGS),
                allowed_classes=frozenset({"p1"}),
            ),
            "author": _members("p[class*=clanek-autor]", "a.autor", own_text=True),
        },
        date=DateRule(
            (".titulek-pubtime",), _SPACED, year_css="#copyright-utm", no_year_format=dates.DAY_TIME_NO_YEAR
        ),
        rejected_segments=("wiki",),
    ),
    "aktualne_cz_v3": Site(
        head={
            "headline": _meta(_OG_TITLE),
            "keywords": _meta(_KEYWORDS),
            "publication_date": _meta(_PUBLISHED, clean="iso"),
            "category": _meta("meta[property='article:section']"),
            "brief": _meta(_OG_BRIEF),
        },
        root="body",
        article={
            "content": _body(
                "div.article__content",
                tags=(*_BLOCKS, "p", *HEADINGS),
                classes={"div": frozenset({"article__photo", "infobox"})},
            ),
            "author": _members("div.author", "div > a.author__name"),
            "category": _text("div.header__menu > nav > ul > li:nth-child(1) > a"),
        },
        rejected_segments=("wiki",),
    ),
    "denik_cz_v1": Site(
        head={"headline": _text("title"), "keywords": _meta(_KEYWORDS, clean="keywords_spaced")},
        root="#content",
        article={
            "content": _body(".pane > .bbtext"),
            "brief": _text(".perex p.info"),
            "author": _text(".det-top > .a-img"),
            "comments_num": _text(".sum > a.comm"),
            "category": _text(".cookie-nav > p > span:nth-child(3)"),
        },
        custom={"author": _text(_RIGHT_ALIGNED)},
        date=DateRule(("#content .sum > span.date",), (dates.DAY_TIME_TIGHT,)),
    ),
    "denik_cz_v2": Site(
        head={"headline": _meta(_OG_TITLE), "keywords": _meta(_KEYWORDS), "brief": _meta(_OG_BRIEF)},
        root=".page-content",
        article={
            "content": _body(".bbtext", tags=_BLOCKS, tags_no_attrs=(*HEADINGS, "p")),
            "author": _text("p[class*=clanek-autor]"),
            "category": _text("ul[class*=menu] > li > a.active"),
        },
        custom={
            "author": _text(_RIGHT_ALIGNED),
            "comments_num": _text(".page-content .diskuse-vstup"),
            "comments_form": Take(("#frm-diskuse-diskuseForm",), "exists"),
        },
        date=DateRule(
            (".page-content div[class*=clanek-datum] > .datum", ".page-content  p.clanek-datum"),
            (dates.DAY_TIME_TIGHT, dates.DAY_TIGHT),
        ),
    ),
    "denik_cz_v3": Site(
        head={
            "headline": _meta(_OG_TITLE),
            "keywords": _meta(_KEYWORDS, clean="keywords_spaced"),
            "brief": _meta(_OG_BRIEF),
            "author": _meta("meta[name='author']"),
            "publication_date": _meta(_PUBLISHED, clean="iso"),
        },
        root=".page",
        article={
            "content": Take(
                (".article-text",),
                "blocks",
                members=(".article-text > p",),
                extra_members=("div > div[class*=paywall]",),
                body={"tags": PLAIN_BODY},
            ),
            "category": _text("ul[class*=menu] > li > a.active"),
            "keywords": _text("ul.article-tags-list"),
            "author": _text(".section-article-autor"),
        },
    ),
    "novinky_cz_v1": Site(
        head={"keywords": _meta(_KEYWORDS), "brief": _meta(_DESCRIPTION), "headline": _text("title")},
        root="div#main",
        article={
            "content": _body("div#articleBody"),
            "author": _text("p.articleAuthors"),
            "category": _text("div#navigation > ul > li:nth-child(2) > a"),
            "keywords": _members("div#navigation > p", "p a[href*='novinky.cz']"),
            "brief": _text("p.perex"),
        },
        date=DateRule(
            ("p#articleDate",),
            (dates.DAY_COMMA_TIME,),
            time_of_crawl_day=False,
            cut_dash=True,
            drop_weekday=True,
            month_names=True,
        ),
    ),
    "novinky_cz_v2": Site(
        head={"headline": _meta(_OG_TITLE), "keywords": _meta(_KEYWORDS), "brief": _meta(_OG_BRIEF)},
        root="main[role='main']",
        article={
            "content": _body(
                "article > div[data-dot-data='{\"component\":\"article-content\"}'] > div",
                tags=("p", "span", "figcaption", *HEADINGS, *TABLE_TAGS, *LIST_TAGS),
                classes={"div": frozenset({"g_c6", "g_c9", "f_cZ", "f_eB", "e_eR", "e_dp", "g_cJ", "g_fq"})},
                div_with_value="mol-paragraph",
            ),
            "category": _text("[data-dot*='navi'] > a[href*=novinky]:nth-child(2)"),
        },
        custom={
            "author": _text(
                "div.ogm-article-author__texts > div:nth-child(2)", "div[data-dot-data='{\"click\":\"author\"}']"
            )
        },
        date=DateRule((".ogm-article-author-social .atm-date-formatted",), (dates.DAY_COMMA_TIME,)),
    ),
    "seznamzpravy_cz": Site(
        head={"headline": _meta(_OG_TITLE), "brief": _meta(_OG_BRIEF), "keywords": _meta(_KEYWORDS)},
        root="main[role='main']",
        article={
            "content": _body(
                "article > div[data-dot='ogm-article-content'] > div",
                clean="content_without_audio_note",
                tags=(*HEADINGS, "span", "p", *TABLE_TAGS, *LIST_TAGS),
                classes={
                    "div": frozenset({"g_aa", "d_ch", "g_V", "f_c5", "f_c6", "c_Q", "d_cg", "d_c7", "f_dm"}),
                    "figure": frozenset({"g_bu", "f_cN", "d_bD"}),
                },
                div_with_value="mol-paragraph",
            ),
            "author": _text("[data-dot='mol-author-names']"),
            "category": _text("div[data-dot='ogm-breadcrumb-navigation'] > a:nth-child(2) > span"),
        },
        custom={"category": _text(".ogm-header-toggle-button-text")},
        date=DateRule(
            ("div[data-dot='ogm-date-of-publication']", "span.atm-date-formatted"),
            (dates.DAY_TIME_SPACED,),
            year_css=".main-footer footer",
            no_year_format=dates.DAY_TIME_NO_YEAR,
            json_ld_css="div[class*='document-type'] > script[type='application/ld+json']",
        ),
        required_segments=("clanek",),
        any_status=True,
    ),
    "ihned_cz_v1": Site(
        head={"headline": _text("title")},
        root="#main",
        article={
            "content": _body(".d-text"),
            "category": _text(".site-name > a"),
            "author": _text(".d-autor > form > span"),
            "comments_num": _text(".d-source > a.disc"),
            "keywords": _text("#tagy > .d-elem-in"),
        },
        custom={
            "brief": _text(".d-perex", clean="brief_or_null"),
            "brief_fallback": Take(
                ("head > meta[name='description']",), "attribute", "brief_twice_or_null", attribute="content"
            ),
        },
        date=DateRule((".d-source > span",), _SPACED, cleaner="updated"),
        charset="windows-1250",
    ),
    "ihned_cz_v2": Site(
        head={"headline": _text("title")},
        root="body",
        article={
            "content": _body(".article-body"),
            "author": _members(".article-info", "div > p.author > a"),
            "comments_num": _text(".article-info > a[href='#disqus_thread']"),
            "keywords": _members(".tag-list", "div > a"),
        },
        custom={
            "brief": _text(".headlines", clean="brief_or_null"),
            "brief_fallback": Take(
                ("head > meta[name='description']",), "attribute", "brief_or_null", attribute="content"
            ),
        },
        date=DateRule((".article-info > p.time",), _SPACED, cleaner="last_update"),
        charset="windows-1250",
    ),
    "ihned_cz_v3": Site(
        head={
            "headline": _meta(_OG_TITLE),
            "publication_date": _meta(_PUBLISHED, clean="iso"),
            "keywords": _meta(_KEYWORDS),
            "brief": _meta(_DESCRIPTION),
        },
        root="body",
        article={
            "content": _body(".clanek-telo"),
            "author": _members(".authors", "div > .name > a"),
            "category": _text(".main-menu li.active"),
        },
        must_not_exist=("[class*='paywall']",),
    ),
    "irozhlas_cz": Site(
        head={"headline": _meta(_OG_TITLE)},
        root="main#main",
        article={
            "content": _body("div.b-detail", tags=_BLOCKS, tags_no_attrs=(*HEADINGS, "p")),
            "author": _text("div.b-detail > p.meta strong"),
            "publication_date": _text("header.b-detail__head > p.meta time", clean="time_day"),
            "keywords": _members("nav.m-breadcrumb", "nav > a[href*='zpravy-tag']"),
            "category": _text("nav.m-breadcrumb > a:nth-child(3)", clean="brief"),
            "brief": _text(".b-detail > header > p "),
        },
        must_exist=("#menu-main",),
    ),
}

_registered: dict[str, Site] = dict(SITES)


def register_site(name: str, site: Site) -> None:
    """Add an extractor, or replace one, under the name used by the routes."""
    _registered[name] = site


def sites() -> dict[str, Site]:
    return dict(_registered)
