"""Page extraction: the `pages` table, and pages of every site built from `documents`."""

from __future__ import annotations

from dataclasses import replace
from string import Formatter
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalog.base import dealt, query, sql_entities, sql_strip, sql_unify, table
from pressloom.functions import labels, text, urls
from pressloom.functions.dates import CZECH_MONTHS, CZECH_WEEKDAYS
from pressloom.operators.html import PLAIN_BODY
from pressloom.plans.extract import Report, extract
from pressloom.plans.sites import SITES, Site, Take, register_site
from pressloom.session import shared_dir
from pressloom.sources.config import DEFAULT_ROUTES, Route

# A rule for the hosts of the `pages` table.
EXAMPLE_SITE = Site(
    head={"headline": Take(("title",))},
    root="body",
    article={
        "content": Take(("article",), "body", body={"tags": PLAIN_BODY}),
        "brief": Take(("article > h1",)),
        "author": Take(("footer",)),
        "keywords": Take(("nav",), "members", members=("li > a[href*='/']",)),
        "category": Take(("nav li:nth-child(2) > a",)),
    },
)
EXAMPLE_ROUTES = [Route(r".*\.example\.(com|net|org).*", "example")]

_H1 = r"regexp_extract(html, '(?s)<article><h1>(.*?)</h1>', 1)"
_AFTER = r"regexp_extract(html, '(?s)<article><h1>.*?</h1>(.*)</article>', 1)"
_LINKS = r"regexp_extract_all(html, '<li><a [^>]*>(.*?)</a></li>', 1)"
_FOOTER = r"regexp_extract(html, '(?s)<footer>(.*?)</footer>', 1)"
# Closed paragraphs give a line each. The first unclosed one swallows all that follows into one line.
PAGE_CTES = f"""a AS (SELECT page_id, url, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title, {_H1} AS h1,
          {_LINKS} AS links, {_FOOTER} AS footer,
          CASE WHEN contains({_AFTER}, '<p><b>') THEN split_part({_AFTER}, '<p><b>', 1) ELSE {_AFTER} END AS closed,
          CASE WHEN contains({_AFTER}, '<p><b>') THEN
               substr({_AFTER}, length(split_part({_AFTER}, '<p><b>', 1)) + 1) END AS rest FROM pages),
     b AS (SELECT page_id, url, {sql_unify(sql_entities('title'))} AS headline, {sql_unify(sql_entities('h1'))} AS brief,
          [{sql_unify(sql_entities('x'))} for x in [h1] || regexp_extract_all(closed, '(?s)<p>(.*?)</p>', 1)
             || CASE WHEN rest IS NULL THEN [] ELSE [regexp_replace(rest, '<[^>]*>', '', 'g')] END] AS lines,
          array_to_string([w for w in [{sql_unify('k')} for k in
             string_split({sql_entities("array_to_string(links, ',')")}, ',')] if w <> ''], '|') AS keywords,
          {sql_unify(sql_entities('links[2]'))} AS category,
          [w for w in [{sql_unify('n')} for n in string_split(regexp_replace({sql_entities('footer')},
             '(?i)(autor/ři|autoři|autori|autor|authors|author):?', '', 'g'), ',')]
             if w <> '' AND NOT regexp_matches(w, '(?i)foto:?')] AS author FROM a),
     page_rows AS (SELECT page_id, url, headline, brief, {sql_unify("array_to_string(lines, chr(10))")} AS content,
          array_to_string(author, '|') AS author, keywords, category FROM b
          WHERE headline <> '' AND len(author) > 0)"""


def example_articles(spark, d):
    pages = dealt(table(spark, d, "pages"), "page_id").select(
        "url", "html", F.col("page_id").alias("offset"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("crawl_ts")
    )
    return extract(pages, EXAMPLE_ROUTES, {"example": EXAMPLE_SITE})


@query(
    "page_fields",
    f"""WITH {PAGE_CTES} SELECT page_id, url, headline, brief, content, author, keywords, category,
          left(replace(url, '/', '_'), 80) AS file_name FROM page_rows WHERE content <> ''""",
)
def page_fields(spark, d):
    return example_articles(spark, d).select(
        F.col("domain_record.offset").alias("page_id"),
        "url",
        "headline",
        "brief",
        "content",
        F.array_join("author", "|").alias("author"),
        F.array_join("keywords", "|").alias("keywords"),
        "category",
        "file_name",
    )


_PAGE_SERVERS = ("None", "org", "net", "example")


@query(
    "page_articles",
    f"""WITH {PAGE_CTES},
          t AS (SELECT *, CASE WHEN headline LIKE '%_.' AND headline NOT LIKE '%..' THEN left(headline, length(headline) - 1)
                          ELSE headline END AS x FROM page_rows WHERE content <> '')
        SELECT page_id, trim(regexp_replace(CASE WHEN length(x) > 1 THEN replace(upper(left(x, 1)), 'ẞ', 'SS') || substr(x, 2)
                 ELSE x END, '\\s+', ' ', 'g')) AS headline,
               trim(regexp_replace(content, '\\s+', ' ', 'g')) AS content,
               CASE WHEN regexp_matches(url, '^[a-z]+://[^/?#]*[.]org([/?#]|$)') THEN 1
                    WHEN regexp_matches(url, '^[a-z]+://[^/?#]*[.]net([/?#]|$)') THEN 2 ELSE 3 END::INTEGER AS server
        FROM t""",
)
def page_articles(spark, d):
    """Flagship: pages to articles to normalised, labelled rows."""
    articles = example_articles(spark, d).withColumn("server", urls.server(F.col("url"), suffix="com"))
    tidy = text.tidy_columns(articles, "headline")
    clean = text.normalize_columns(tidy, "headline", "content")
    return clean.select(
        F.col("domain_record.offset").alias("page_id"),
        "headline",
        "content",
        labels.to_id(F.col("server"), _PAGE_SERVERS).alias("server"),
    )


# --- pages of each site, built from documents -------------------------------------------------------------------


def _escape(c: Column) -> Column:
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(char), F.lit(name))
    return c


def _template(markup: str, parts: dict[str, Column]) -> Column:
    """A page as one concat; `{{name}}` of the template is a part."""
    pieces = []
    for literal, name, _, _ in Formatter().parse(markup):
        if literal:
            pieces.append(F.lit(literal))
        if name:
            pieces.append(parts[name])
    return F.concat(*pieces)


def _parts() -> dict[str, Column]:
    """Derived fields of a document as they stand in the markup."""
    moment = F.col("moment")
    month = F.get(F.array(*[F.lit(m) for m in CZECH_MONTHS]), F.month(moment) - 1)
    weekday = F.get(F.array(*[F.lit(w) for w in CZECH_WEEKDAYS]), F.weekday(moment))
    body = F.replace(_escape(F.col("text")), F.lit("\n"), F.lit("</p><p>"))
    return {
        "title": _escape(F.split_part("text", F.lit("\n"), F.lit(1))),
        "body": F.concat(F.lit("<p>"), body, F.lit("</p>")),
        "p1": F.concat(F.lit("<p class='p1'>"), F.replace(body, F.lit("<p>"), F.lit("<p class='p1 x'>")), F.lit("</p>")),
        "lang": F.col("lang"),
        "source": F.col("source"),
        "id": F.col("doc_id").cast("string"),
        "keywords": F.concat(F.col("lang"), F.lit(", "), F.col("source"), F.lit(",,slovo")),
        "keywords_spaced": F.concat(F.col("lang"), F.lit(" "), F.col("source"), F.lit("  slovo")),
        "byline": F.concat(F.lit("Autor: Jan "), F.col("source"), F.lit(", foto: Petr,\nEva")),
        "iso": F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'+01:00'"),
        "ld": F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'.000Z'"),
        "spaced": F.date_format(moment, "d. M. yyyy H:mm"),
        "spaced_day": F.date_format(moment, "d. M. yyyy"),
        "tight": F.date_format(moment, "dd.MM.yyyy HH:mm"),
        "tight_day": F.date_format(moment, "d.M.yyyy"),
        "no_year": F.date_format(moment, "d. M. H:mm"),
        "time": F.date_format(moment, "H:mm"),
        "comma": F.date_format(moment, "d. M. yyyy, H:mm"),
        "czech": F.concat(F.date_format(moment, "d. "), month, F.date_format(moment, " yyyy H:mm")),
        "weekday": F.concat(weekday, F.date_format(moment, " d. "), month, F.date_format(moment, " yyyy, H:mm")),
        "time_day": F.concat(F.date_format(moment, "H:mm d. "), month, F.date_format(moment, " yyyy")),
    }


_META = '<meta name="keywords" content="{keywords}"><meta property="og:title" content="{title}">'
_OG = _META + '<meta property="og:description" content="EXKLUZIVNĚ. {source} perex">'
_ISO = '<meta property="article:published_time" content="{iso}">'
_LIST = "<ul><li>ztraceno</li><li><p>položka</p></li></ul><script>var a='<p>x</p>';</script>"
_MOMENT = "strftime(m, '%Y-%m-%d %H:%M:%S')"
_CRAWL = "strftime(crawl, '%Y-%m-%d %H:%M:%S')"
_CRAWL_DAY = "strftime(crawl, '%Y-%m-%d') || strftime(m, ' %H:%M') || strftime(crawl, ':%S')"
_ISO_SQL = _MOMENT + " || '+01:00'"
_FOOTER_YEAR = (
    f"CASE WHEN strftime(m, '%m-%d') = '02-29' THEN {_CRAWL_DAY} ELSE '2013' || strftime(m, '-%m-%d %H:%M:%S') END"
)


class Sample(NamedTuple):
    """Markup by `doc_id` modulo the number of variants, and what is expected of it."""

    host: str
    crawl: str
    variants: tuple[str, ...]
    tail: str = "''"
    date: str = _MOMENT
    brief: str = "source || ' perex'"
    category: str = "lang"
    comments: str = "NULL"
    path: str = "clanek"
    where: str = "true"


_AKTUALNE_1 = (
    f"<html><head>{_META}</head><body><div id='obsah'><ul id='nav-breadcrumb'><li><a> {{lang}} </a></li></ul>"
    "<p class='clanek-perex'>{source} perex</p><p class='clanek-autor'>{byline}</p><span class='clanek-datum'>@</span>"
    "<div class='x clanek-text'>{body}<p class='reklama'>reklama</p><figure>obrázek</figure><div>mimo</div></div>"
    "<div id='disqusCounter'><span>{id} názorů</span></div></div><div id='paticka-utm'>© 1999 – 2013 A</div></body></html>"
)
_AKTUALNE_2 = (
    f"<html><head>{_META}</head><body><div class='hlavicka'><a>ne</a><a class='b active'>{{lang}}</a></div>"
    "<div class='perex'>{source} perex</div><span class='titulek-pubtime'>{spaced_day}</span>"
    "<p class='clanek-autor-x'>#</p><div @>{p1}<p class='x'>reklama</p><p>konec</p></div></body></html>"
)
_LINKED = "Autor: <a class='autor'>Jan {source}</a> <a class='autor'>Eva</a>"
_IHNED_1 = (
    "<html><head><title>{title} | ihned.cz</title><meta name='description' content='{source} perex'></head><body>"
    "<div id='main'><div class='site-name'><a>{lang}</a></div><div class='d-autor'><form><span>{byline}</span></form>"
    "</div><div class='d-source'><span>{spaced} (aktualizováno v poledne)</span><a class='disc'>diskuse ({id})</a></div>"
    "@<div class='d-text'>{body}" + _LIST + "</div><div id='tagy'><div class='d-elem-in'>{keywords}</div></div></div></body></html>"
)
_IHNED_2 = (
    "<html><head><title>{title} - zprávy iHNED.cz</title><meta name='description' content='{source} perex'></head><body>"
    "<div class='headlines'>@</div><div class='article-info'><p class='author'><a>Jan {source}</a><a>Eva</a></p>"
    "<p class='time'>(Poslední aktualizace {spaced_day} (aktualizováno dnes)</p><a href='#disqus_thread'>{id}</a></div>"
    "<div class='article-body'>{body}" + _LIST + "</div><div class='tag-list'><a>{lang}</a><a>{source}</a><a>slovo</a></div></body></html>"
)
_SEZNAM = (
    f"<html><head>{_OG}</head><body><main role='main'>@<div data-dot='ogm-date-of-publication'>#</div>"
    "<div data-dot='mol-author-names'>{byline}</div><article><div data-dot='ogm-article-content'><div>"
    "<p>Článek si také můžete poslechnout v audioverzi.</p><div class='g_aa z'>{body}</div><div class='jiny'>mimo</div>"
    "<div data-dot='mol-paragraph'><p>odstavec</p></div><figure class='g_bu'>obrázek</figure><figure>mimo</figure>"
    "</div></div></article></main><div class='main-footer'><footer>© 2007 – 2013 S</footer></div></body></html>"
)
_BREADCRUMB = "<div data-dot='ogm-breadcrumb-navigation'><a>x</a><a><span>{lang}</span></a></div>"
_TOGGLE = "<b class='ogm-header-toggle-button-text'>{lang}</b>" + _BREADCRUMB.replace("{lang}", "jiná")
_JSON_LD = (
    "<div class='a document-type-b'><script type='application/ld+json'>"
    '{{"datePublished":"{ld}","name":"x"}}</script></div>'
)
_IROZHLAS = (
    "<html><head><meta property='og:title' content=\"{title}\"></head><body>@<main id='main'><nav class='m-breadcrumb'>"
    "<a href='/'>1</a><a href='/z'>2</a><a href='/zpravy-tag/1'>{lang}</a><a href='/zpravy-tag/2'>{source}</a>"
    "<a href='/zpravy-tag/3'>slovo</a></nav><div class='b-detail'><header class='b-detail__head'><p class='meta'>"
    "<time>{time_day}</time></p></header><p class='meta'><strong>{byline}</strong></p>{body}<p id='x'>mimo</p></div>"
    "</main></body></html>"
)
_DENIK_2 = (
    f"<html><head>{_OG}</head><body><ul class='hlavni-menu'><li><a class='active'>mimo</a></li></ul>"
    "<div class='page-content'><ul class='a-menu'><li><a class='active'>{lang}</a></li></ul>@"
    "<p class='clanek-autor'>#</p><div class='bbtext'>{body}<p class='x'>mimo</p><h2>mezititulek</h2>"
    "<table><tr><td><p>buňka</p></td><td>ztraceno</td></tr></table></div></div></body></html>"
)

SAMPLES: dict[str, Sample] = {
    "idnes_cz_v1": Sample(
        "www.idnes.cz",
        "2010-06-01 10:00:09",
        (
            "<html><head><title>{title} - iDNES.cz</title><meta name='keywords' content='{keywords}'>"
            "<meta name='description' content='EXKLUZIVNĚ. {source} perex'></head><body><li class='act'><a>ven</a></li>"
            "<div id='main'><li class='act'><a> {lang} </a></li><div class='authors'><ul><li><a>Jan {source}</a></li>"
            "<li><span class='name'>Eva</span></li></ul></div><div class='art-info'><span class='time'>{czech}</span></div>"
            "<div class='text'><div class='bbtext'>{body}<div>mimo</div>" + _LIST + "</div></div>"
            "<div class='btm'>{id} čtenářů, 99</div></div></body></html>",
        ),
        tail="chr(10) || 'položka'",
        comments="doc_id::VARCHAR",
    ),
    "idnes_cz_v2": Sample(
        "sport.idnes.cz",
        "2015-06-01 10:00:09",
        tuple(
            f"<html><head>{_OG}{_ISO}</head><body><div id='main'>{wall}<div id='art-text'><div class='bbtext'>{{body}}"
            f"{_LIST}</div></div><li class='act'><a>{{lang}}</a></li><div class='authors'><div>"
            "<span itemprop='name'>Jan {source}</span><span itemprop='name'>Eva</span></div></div>"
            f"{when}<a id='moot-linkin'>Diskuse ({{id}})</a></div></body></html>"
            for wall, when in (
                ("", "<div class='art-info'><span class='time'>{spaced}</span></div>"),
                ("", ""),
                ("<div id='paywall'></div>", ""),
            )
        ),
        tail="chr(10) || 'položka'",
        date=f"CASE WHEN doc_id % 3 = 0 THEN {_MOMENT} ELSE {_ISO_SQL} END",
        comments="doc_id::VARCHAR",
        where="doc_id % 3 <> 2",
    ),
    "aktualne_cz_v1": Sample(
        "zpravy.aktualne.cz",
        "2012-06-01 10:00:09",
        tuple(_AKTUALNE_1.replace("@", when) for when in ("{spaced}", "DNES {no_year}", "dnes {time}")),
        tail="chr(10) || 'obrázek'",
        date=f"CASE doc_id % 3 WHEN 0 THEN {_MOMENT} WHEN 1 THEN {_FOOTER_YEAR} ELSE {_CRAWL_DAY} END",
        comments="doc_id::VARCHAR",
    ),
    "aktualne_cz_v2": Sample(
        "zpravy.aktualne.cz",
        "2016-06-01 10:00:09",
        tuple(
            _AKTUALNE_2.replace("@", box).replace("#", names)
            for box, names in (
                ("data-ec-list='zpravy-1'", _LINKED),
                ("data-upscore='article'", "{byline}"),
                ("class='clanek'", _LINKED),
            )
        ),
        tail="chr(10) || 'konec'",
        date="strftime(m, '%Y-%m-%d') || ' 00:00:00'",
    ),
    "aktualne_cz_v3": Sample(
        "zpravy.aktualne.cz",
        "2021-06-01 10:00:09",
        tuple(
            f"<html><head>{_OG}{_ISO}<meta property='article:section' content='{section}'></head><body>{nav}"
            "<div class='author'><a class='author__name'>Jan {source}</a><a class='author__name'>Eva</a></div>"
            "<div class='article__content'>{p1}<div class='infobox'><p>rámeček</p></div><div>mimo</div></div></body></html>"
            for section, nav in (
                ("{lang}", ""),
                ("jiná", "<div class='header__menu'><nav><ul><li><a>{lang}</a></li><li><a>x</a></li></ul></nav></div>"),
            )
        ),
        tail="chr(10) || 'rámeček'",
        date=_ISO_SQL,
    ),
    "aktualne_wiki": Sample("www.aktualne.cz", "2021-06-01 10:00:09", (_AKTUALNE_2,), path="wiki", where="false"),
    "denik_cz_v1": Sample(
        "www.denik.cz",
        "2011-06-01 10:00:09",
        tuple(
            "<html><head><title>{title} | Deník.cz</title><meta name='keywords' content='{keywords_spaced}'></head><body>"
            "<div id='content'><div class='cookie-nav'><p><span>1</span><span>2</span><span>{lang}</span></p></div>"
            "<div class='perex'><p class='info'>{source} perex</p></div>" + names + "<div class='sum'>"
            "<span class='date'>{tight}</span><a class='comm'>Komentářů {id}</a></div>"
            "<div class='pane'><div class='bbtext'>{body}" + _LIST + "</div></div></div></body></html>"
            for names in (
                "<div class='det-top'><div class='a-img'>{byline}</div></div>",
                "<div class='det-top'><div class='a-img'>Jiný Autor</div></div><div class='page-content'>"
                "<div class='bbtext'><p style='text-align: right;'>{byline}</p></div></div>",
            )
        ),
        tail="chr(10) || 'položka'",
        comments="doc_id::VARCHAR",
    ),
    "denik_cz_v2": Sample(
        "www.denik.cz",
        "2015-06-01 10:00:09",
        (
            _DENIK_2.replace("@", "<div class='clanek-datum'><b class='datum'>{tight}</b></div><a class='diskuse-vstup'>{id} x</a>")
            .replace("#", "{byline}"),
            _DENIK_2.replace("@", "<p class='clanek-datum'>{tight_day}</p><form id='frm-diskuse-diskuseForm'></form>")
            .replace("#", "{byline}"),
            _DENIK_2.replace("@", "<p class='clanek-datum'>v {time}</p><a class='diskuse-vstup'>beze slov</a>")
            .replace("#", "{byline}"),
        ),
        tail="chr(10) || 'mezititulek' || chr(10) || 'buňka'",
        date=f"CASE doc_id % 3 WHEN 0 THEN {_MOMENT} WHEN 1 THEN strftime(m, '%Y-%m-%d') || ' 00:00:00' ELSE {_CRAWL_DAY} END",
        comments="CASE doc_id % 3 WHEN 0 THEN doc_id::VARCHAR WHEN 1 THEN '0' END",
    ),
    "denik_cz_v3": Sample(
        "www.denik.cz",
        "2020-06-01 10:00:09",
        (
            "<html><head><meta name='keywords' content='jiná slova'><meta property='og:title' content=\"{title}\">"
            "<meta property='og:description' content='{source} perex'><meta name='author' content='{byline}'>"
            + _ISO + "</head><body><div class='page'><ul class='menu'><li><a class='active'>{lang}</a></li></ul>"
            "<ul class='article-tags-list'>{keywords}</ul><div class='article-text'>{body}"
            "<div class='x-paywall'><p>placené</p><div>mimo</div></div></div></div></body></html>",
            "<html><head><meta name='keywords' content='{keywords_spaced}'><meta property='og:title' content=\"{title}\">"
            "<meta property='og:description' content='{source} perex'><meta name='author' content='Jiná'>"
            + _ISO + "</head><body><div class='page'><ul class='menu'><li><a class='active'>{lang}</a></li></ul>"
            "<div class='section-article-autor'>{byline}</div><div class='article-text'>{body}"
            "<div class='x-paywall'><p>placené</p></div></div></div></body></html>",
        ),
        tail="chr(10) || 'placené'",
        date=_ISO_SQL,
    ),
    "novinky_cz_v1": Sample(
        "www.novinky.cz",
        "2015-06-01 10:00:09",
        tuple(
            "<html><head><title>{title} – Novinky.cz</title><meta name='keywords' content='jiná'>"
            "<meta name='description' content='jiný'></head><body><div id='main'><div id='navigation'><ul><li><a>x</a></li>"
            "<li><a>{lang}</a></li></ul><p><a href='http://www.novinky.cz/1'>{lang}</a><a href='http://novinky.cz/2'>{source}"
            "</a><a href='/x'>mimo</a><a href='//novinky.cz'>slovo</a></p></div><p class='perex'>{source} perex</p>"
            "<p class='articleAuthors'>{byline}</p><p id='articleDate'>" + when + "</p>"
            "<div id='articleBody'>{body}<span>dodatek</span><div>mimo</div></div></div></body></html>"
            for when in ("{weekday} - Praha", "dnes {time}")
        ),
        tail="chr(10) || 'dodatek'",
        date=f"CASE WHEN doc_id % 2 = 0 THEN {_MOMENT} ELSE {_CRAWL} END",
    ),
    "novinky_cz_v2": Sample(
        "www.novinky.cz",
        "2021-06-01 10:00:09",
        tuple(
            f"<html><head>{_OG}</head><body><main role='main'><div data-dot='navi-x'><a href='https://www.novinky.cz'>1</a>"
            "<a href='https://www.novinky.cz/2'>{lang}</a></div>" + names +
            "<div class='ogm-article-author-social'><i class='atm-date-formatted'>" + when + "</i></div><article>"
            "<div data-dot-data='{{\"component\":\"article-content\"}}'><div><div class='f_cZ'>{body}</div>"
            "<div data-x='mol-paragraph'><span>odstavec</span></div><div class='mol-paragraph'>mimo</div></div></div>"
            "</article></main></body></html>"
            for names, when in (
                ("<div class='ogm-article-author__texts'><div>x</div><div>{byline}</div></div>", "{comma}"),
                ("<div data-dot-data='{{\"click\":\"author\"}}'>{byline}</div>", "Dnes {time}"),
                ("<div data-dot-data='{{\"click\":\"author\"}}'>{byline}</div>", "včera"),
            )
        ),
        tail="chr(10) || 'odstavec'",
        date=f"CASE doc_id % 3 WHEN 0 THEN {_MOMENT} WHEN 1 THEN {_CRAWL_DAY} ELSE {_CRAWL} END",
    ),
    "seznamzpravy_cz": Sample(
        "www.seznamzpravy.cz",
        "2020-06-01 10:00:09",
        (
            _SEZNAM.replace("@", _BREADCRUMB + _JSON_LD).replace("#", "{time}"),
            _SEZNAM.replace("@", _TOGGLE).replace("#", "{spaced}"),
            _SEZNAM.replace("@", _TOGGLE + _JSON_LD.replace("{ld}", "{iso}")).replace("#", "{no_year}"),
        ),
        tail="chr(10) || 'odstavec' || chr(10) || 'obrázek'",
        date=f"CASE WHEN doc_id % 3 = 2 THEN {_FOOTER_YEAR} ELSE {_MOMENT} END",
    ),
    "ihned_cz_v1": Sample(
        "domaci.ihned.cz",
        "2010-06-01 10:00:09",
        (
            _IHNED_1.replace("@", "<p class='d-perex'>EXKLUZIVNĚ. {source} perex</p>").replace("content='{source} perex'", "content='jiný'"),
            _IHNED_1.replace("@", "<p class='d-perex'> </p>"),
            _IHNED_1.replace("@", ""),
        ),
        tail="chr(10) || 'položka'",
        comments="doc_id::VARCHAR",
    ),
    "ihned_cz_v2": Sample(
        "domaci.ihned.cz",
        "2015-06-01 10:00:09",
        (
            _IHNED_2.replace("@", "{source} perex").replace("content='{source} perex'", "content='jiný'"),
            _IHNED_2.replace("@", " "),
        ),
        tail="chr(10) || 'položka'",
        date="strftime(m, '%Y-%m-%d') || ' 00:00:00'",
        category="NULL",
        comments="doc_id::VARCHAR",
    ),
    "ihned_cz_v3": Sample(
        "archiv.ihned.cz",
        "2020-06-01 10:00:09",
        tuple(
            f"<html><head>{_META}{_ISO}<meta name='description' content='{{source}} perex'></head><body>"
            "<ul class='main-menu'><li>x</li><li class='active'>{lang}</li></ul><div class='authors'><div class='name'>"
            "<a>Jan {source}</a><a>Eva</a></div></div><div class='clanek-telo'>{body}" + _LIST + wall + "</div></body></html>"
            for wall in ("", "<b class='x-paywall'></b>")
        ),
        tail="chr(10) || 'položka'",
        date=_ISO_SQL,
        where="doc_id % 2 = 0",
    ),
    "irozhlas_cz": Sample(
        "www.irozhlas.cz",
        "2020-06-01 10:00:09",
        (_IROZHLAS.replace("@", "<div id='menu-main'></div>"), _IROZHLAS.replace("@", "")),
        brief="strftime(m, '%-H:%M %-d. ') || @month || strftime(m, ' %Y')",
        where="doc_id % 2 = 0",
    ),
}

# Expected values, written out.
_MONTH_SQL = """(['ledna', 'února', 'března', 'dubna', 'května', 'června', 'července', 'srpna', 'září', 'října', 'listopadu',
    'prosince'])[month(m)]"""


def _site_page(name: str) -> Column:
    """The page of one site for a document."""
    sample = SAMPLES[name]
    key, parts = F.col("doc_id"), {k: F.col(f"_{k}") for k in _parts()}
    minutes = F.make_dt_interval(mins=(key % 1000).cast("int"))
    markup = F.lit(None).cast("string")
    for i, variant in enumerate(sample.variants):
        markup = F.when(key % len(sample.variants) == i, _template(variant, parts)).otherwise(markup)
    return F.struct(
        F.concat(F.lit(f"https://{sample.host}/{sample.path}/"), key.cast("string")).alias("url"),
        (F.lit(sample.crawl).cast("timestamp_ntz") + minutes).alias("crawl_ts"),
        (F.lit(404) if name == "seznamzpravy_cz" else F.lit(None).cast("int")).alias("http_status"),
        markup.alias("html"),
        key.alias("offset"),
    )


def site_pages(spark, d, *names: str):
    """Pages of some sites with whole documents as article text, from one scan of the documents."""
    hours = F.make_dt_interval(hours=(F.col("doc_id") * 7 % 90000).cast("int"))
    moment = (F.lit("2010-01-01 08:05:00").cast("timestamp_ntz") + hours).alias("moment")
    docs = dealt(table(spark, d, "documents"), "doc_id").select("doc_id", "lang", "source", "text", moment)
    # the parts are columns of their own, so that no page repeats them
    docs = docs.withColumns({f"_{k}": c for k, c in _parts().items()})
    return docs.select(F.explode(F.array(*map(_site_page, names))).alias("p")).select("p.*")


def site_oracle(name: str, key: str = "doc_id") -> str:
    sample = SAMPLES[name]
    lines = f"array_to_string([{sql_strip('l')} for l in string_split(text, chr(10))], chr(10))"
    brief = sample.brief.replace("@month", _MONTH_SQL)
    return f"""WITH d AS (SELECT doc_id, lang, source, text,
               TIMESTAMP '2010-01-01 08:05:00' + INTERVAL (doc_id * 7 % 90000) HOUR AS m,
               TIMESTAMP '{sample.crawl}' + INTERVAL (doc_id % 1000) MINUTE AS crawl FROM documents),
          p AS (SELECT *, {sql_unify('split_part(text, chr(10), 1)')} AS headline, {sql_unify(lines)} AS body FROM d)
        SELECT doc_id, headline, {brief} AS brief, body || {sample.tail} AS content, 'Jan ' || source || '|Eva' AS author,
               lang || '|' || source || '|slovo' AS keywords, {sample.category}::VARCHAR AS category,
               {sample.comments}::VARCHAR AS comments_num, {sample.date} AS publication_date
        FROM p WHERE headline <> '' AND body <> '' AND {sample.where}"""


def _shown() -> list[Column]:
    return [
        F.col("domain_record.offset").alias("doc_id"),
        F.col("headline"),
        F.col("brief"),
        F.col("content"),
        F.array_join("author", "|").alias("author"),
        F.array_join("keywords", "|").alias("keywords"),
        F.col("category"),
        F.col("comments_num"),
        F.col("publication_date"),
    ]


def _register_site_query(name: str) -> None:
    def run(spark, d):
        return extract(site_pages(spark, d, *built)).select(*_shown())

    # pages that a rule rejects stand among pages that it keeps
    built = ("aktualne_wiki", "aktualne_cz_v3") if name == "aktualne_wiki" else (name,)
    run.__doc__ = f"Extraction of {name} pages."
    query(f"extract_{name}", site_oracle(built[-1]))(run)


for _name in SAMPLES:
    _register_site_query(_name)


@query(
    "extract_all_sites",
    " UNION ALL ".join(f"SELECT '{n}' AS site, * FROM ({site_oracle(n)})" for n in SITES),
)
def extract_all_sites(spark, d):
    """Pages of all sites in one job, routed by URL and crawl time."""
    articles = extract(site_pages(spark, d, *SITES), DEFAULT_ROUTES)
    return articles.select(F.col("extractor").alias("site"), *_shown())


# --- capture records and hooks ------------------------------------------------------------------------------------


@query(
    "page_domain_record",
    f"""WITH {PAGE_CTES} SELECT page_id, 'D' || page_id AS digest, CASE WHEN page_id % 2 = 0 THEN 'utf-8' END AS encoding,
          'crawl/' || page_id % 7 || '.warc.gz' AS filename, (page_id * 3)::INTEGER AS length, page_id + 3000000000 AS "offset",
          '2024-01-01 00:00:' || lpad((page_id % 60)::VARCHAR, 2, '0') AS "timestamp", url FROM page_rows WHERE content <> ''""",
)
def page_domain_record(spark, d):
    """All fields of the capture that an article came from."""
    key = F.col("page_id")
    second = F.lpad((key % 60).cast("string"), 2, "0")
    pages = dealt(table(spark, d, "pages"), "page_id").select(
        "url",
        "html",
        F.concat(F.lit("2024-01-01 00:00:"), second).cast("timestamp_ntz").alias("crawl_ts"),
        F.concat(F.lit("D"), key.cast("string")).alias("digest"),
        F.when(key % 2 == 0, "utf-8").alias("encoding"),
        F.concat(F.lit("crawl/"), (key % 7).cast("string"), F.lit(".warc.gz")).alias("filename"),
        (key * 3).cast("int").alias("length"),
        (key + 3000000000).alias("offset"),
    )
    record = extract(pages, EXAMPLE_ROUTES, {"example": EXAMPLE_SITE}).select("domain_record.*")
    return record.select((F.col("offset") - 3000000000).alias("page_id"), "*")


def _has_headline(page) -> bool:
    return page.first(page.root, "article > h1") is not None


def _title_as_brief(page) -> dict[str, str]:
    return {"brief": "HOOK " + page.text(page.first(page.root, "title"))}


@query(
    "registered_site",
    f"""WITH {PAGE_CTES} SELECT page_id, headline, 'HOOK ' || headline AS brief FROM page_rows
        WHERE content <> '' AND contains(url, '/en/')""",
)
def registered_site(spark, d):
    """A user's site: its page predicate, its tree predicate and the fields that its hook adds."""
    site = replace(EXAMPLE_SITE, page_filter=lambda: F.col("url").contains("/en/"), tree_filter=_has_headline, hook=_title_as_brief)
    register_site("hooked_example", site)
    pages = dealt(table(spark, d, "pages"), "page_id").select(
        "url", "html", F.col("page_id").alias("offset"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("crawl_ts")
    )
    routes = [Route(r".*\.example\.(com|net|org).*", "hooked_example")]
    return extract(pages, routes).select(F.col("domain_record.offset").alias("page_id"), "headline", "brief")


def _title(page) -> str:
    return page.text(page.first(page.root, "title")) or ""


def _title_without_k(page) -> bool:
    return "k" not in _title(page)


def _no_z(page) -> dict[str, str]:
    if "z" in _title(page):
        raise ValueError("a hook that fails on some pages")
    return {}


@query(
    "extract_report",
    f"""WITH {PAGE_CTES}, t AS (SELECT page_id, headline, content_of, author,
            coalesce([200, 404, NULL, 301][page_id % 4 + 1], 200) <> 200 AS filtered, contains(headline, 'k') AS rejected,
            contains(headline, 'z') AS unreadable,
            CASE WHEN regexp_matches(url, '[.]example[.]com') THEN 'without_author' ELSE 'example' END AS extractor
          FROM (SELECT *, {sql_unify("array_to_string(lines, chr(10))")} AS content_of FROM b)
          WHERE regexp_matches(url, '[.]example[.](com|net)')),
        u AS (SELECT *, NOT filtered AND NOT rejected AND NOT unreadable AS parsed,
            extractor = 'example' AND headline <> '' AND len(author) > 0 AND content_of <> '' AS complete FROM t)
        SELECT extractor, count(*) AS routed, count(*) FILTER (filtered) AS filtered,
               count(*) FILTER (NOT filtered AND NOT rejected AND unreadable) AS unreadable, count(*) FILTER (NOT filtered AND rejected) AS rejected,
               count(*) FILTER (parsed AND NOT complete) AS incomplete, count(*) FILTER (parsed AND complete) AS articles,
               (SELECT count(*) FROM pages WHERE NOT regexp_matches(url, '[.]example[.](com|net)')) AS unrouted
        FROM u GROUP BY extractor""",
)
def extract_report(spark, d):
    """Why pages gave no article, counted by the extraction that writes the others."""
    example = replace(EXAMPLE_SITE, tree_filter=_title_without_k, hook=_no_z)
    article = {k: v for k, v in EXAMPLE_SITE.article.items() if k != "author"}
    sites = {"example": example, "without_author": replace(example, article=article)}
    key = F.col("page_id")
    status = F.get(F.array(F.lit(200), F.lit(404), F.lit(None).cast("int"), F.lit(301)), (key % 4).cast("int"))
    moment = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    pages = dealt(table(spark, d, "pages"), "page_id").select("url", "html", key.alias("offset"), moment.alias("crawl_ts"), status.alias("http_status"))
    routes = [Route(r".*\.example\.com.*", "without_author"), Route(r".*\.example\.net.*", "example")]
    report = Report()
    extract(pages, routes, sites, report=report).write.parquet(shared_dir(spark, "reported"))
    return report.table(spark).withColumn("unrouted", F.lit(report.unrouted).cast("bigint"))
