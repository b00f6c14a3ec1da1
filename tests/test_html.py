"""The page tree: events against the standard library's tokeniser, selectors, body text."""

from __future__ import annotations

from html.parser import HTMLParser

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pressloom.operators.html import _TOKEN, PLAIN_BODY, VOID, Page, body_text, compile_selector

FRAGMENTS = [
    "<p>", "</p>", '<div class="a b">', "</div>", "<a href='x>y' id=q>", "</a>", "text ", "&amp;", "&lt", "<br>", "<br/>",
    "<!-- c <p> -->", "<!DOCTYPE html>", '<script>var a="<p>";</script>', "<style>x</style>", "<ul>", "<li>", "</li>",
    "\n \n", "\xa0", "<td>", "<b title=it's>", "</b>", "<I>", "</i >", "a < b", "<pre> \n </pre>", "<p/>", "</span>",
    "<x data-a='{\"k\":\"v\"}'>", '<input disabled value="a&quot;b">', "</SCRIPT>", "<?php x ?>",
]


class Events(HTMLParser):
    def __init__(self, markup):
        super().__init__(convert_charrefs=True)
        self.tags, self.data, self.hidden = [], [], 0
        self.feed(markup)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.tags.append((tag, {k: v or "" for k, v in attrs}))

    def handle_data(self, data):
        self.data.append(data)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(FRAGMENTS), max_size=14))
def test_tags_and_text_equal_the_standard_tokeniser(parts):
    markup = "".join(parts)
    page, events = Page(markup), Events(markup)
    assert [(e.name, e.attrs) for e in page.elements[1:]] == events.tags
    text = "".join(t for _, t in page.texts)
    assert text.split() == "".join(events.data).split()


def test_unclosed_paragraphs_nest_and_stray_ends_are_ignored():
    page = Page("<div><p>a<p>b</p></i>c</div>d")
    outer, inner = page.by_name["p"]
    assert inner.parent is outer
    assert page.text(outer) == "abc"
    assert page.text(page.root) == "abcd"


def test_hidden_text():
    page = Page("<div>a<script>s</script><style>t</style>b</div>")
    assert page.text(page.by_name["div"][0]) == "ab"
    assert page.text(page.by_name["script"][0]) == "s"


def test_an_element_with_only_text_is_one_token():
    """Start tag, text and end tag are read at once, unless the element treats its text in a way of its own."""
    assert len(_TOKEN.split("<p class='a>b'>x &amp; y</p><a>z</a>")) == 2 * _TOKEN.groups + 3
    page = Page("<div> <p>x &amp; y</p><P>\xa0</P><br>a</br><p/>b</p><i> \n </i><pre> \n </pre><template>t</template></div>c")
    assert [(e.name, page.text(e)) for e in page.elements[2:]] == [
        ("p", "x & y"), ("p", "\xa0"), ("br", ""), ("p", ""), ("i", "\n"), ("pre", " \n "), ("template", "t")
    ]
    div = page.elements[1]
    assert page.text(div) == " x & y\xa0ab\n \n " and [e.nth for e in div.children] == [1, 2, 3, 4, 5, 6, 7]


def test_raw_text_that_no_tag_ends():
    for markup in ("<b>x</b><script>a<p>b", "<b>x</b><script>a<p>b</script ", "<b>x</b><script>a<p>b</script <"):
        page = Page(markup)
        assert [e.name for e in page.elements[1:]] == ["b", "script"] and page.text(page.elements[2]).startswith("a<p>b")
        assert page.text(page.root) == "x"


def test_broken_pages_end():
    Page("<a" * 200_000)
    Page("<a href='" * 200_000)
    Page("<!-- " * 100_000 + "x>")
    page = Page("<li>" * 30_000 + "x")
    assert page.text(page.elements[1]) == "x"
    assert all(name in VOID for name in ("br", "img", "meta"))


@pytest.mark.parametrize(
    "css, hits",
    [
        ("p", ["1", "2", "3"]),
        ("#m > p", ["1", "3"]),
        ("div p", ["1", "2", "3"]),
        ("p.x", ["2"]),
        ("div[class*=ar] > p", ["2"]),
        ("p[data-k='{\"a\":\"b\"}']", ["3"]),
        ("#m > :nth-child(3)", ["3"]),
        ("body > p", []),
        ("p[id]", []),
    ],
)
def test_selectors(css, hits):
    page = Page("<body><div id='m'><p>1</p><div class='b  ar'><p class='y x'>2</p></div><p data-k='{\"a\":\"b\"}'>3</p></div>")
    assert [page.text(e) for e in page.select(page.root, css)] == hits


def test_selectors_see_ancestors_outside_of_the_scope():
    page = Page("<main><div><p><a>1</a></p></div></main><p><a>2</a></p>")
    scope = page.first(page.root, "div")
    assert [page.text(e) for e in page.select(scope, "main p > a")] == ["1"]


def test_unsupported_selector():
    with pytest.raises(ValueError):
        compile_selector("p ~ a")


def test_body_text_loses_bare_text_of_list_items():
    page = Page("<div><p>a\xa0</p><ul><li>lost</li><li><p>kept</p></li></ul><div>no</div><b>no</b></div>")
    rule = {"tags": PLAIN_BODY}
    assert body_text(page, page.by_name["div"][0], rule) == "a\nkept"
    assert body_text(page, page.by_name["div"][0], {**rule, "keep_bare_text": True}) == "a\nlost\nkept"


def _seconds(markup, act):
    import time

    best = 1e9
    for _ in range(3):
        start = time.perf_counter()
        act(Page(markup))
        best = min(best, time.perf_counter() - start)
    return best


@pytest.mark.parametrize(
    ("piece", "act"),
    [
        ("<li><p>x</p>", lambda page: body_text(page, page.root, {"tags": PLAIN_BODY})),
        ("<li><p>", lambda page: body_text(page, page.root, {"tags": PLAIN_BODY})),
        ("<p>x", lambda page: list(page.select(page.root, "div p"))),
        ("<i>x</b>", lambda page: list(page.select(page.root, "b i > i"))),
    ],
)
def test_time_follows_the_size_of_nested_pages(piece, act):
    small, large = _seconds(piece * 4_000, act), _seconds(piece * 16_000, act)
    assert large < 8 * small + 0.05


def test_deep_pages_are_read():
    page = Page("<li>a" * 120_000)
    assert body_text(page, page.root, {"tags": ("li",)}) == ""
    page = Page("<ul>" * 50_000 + "<li><p>x</p></li>")
    assert body_text(page, page.root, {"tags": ("ul", "li", "p")}) == "x"


def test_ancestors_are_found_as_one_by_one():
    page = Page("<div class=a><p><b><i>1</i></b></p><b><div class=c><i>2</i></div></b></div><b><i>3</i></b>")
    text = lambda css: [page.text(e) for e in page.select(page.root, css)]
    assert text(".a i") == ["1", "2"] and text(".a b > i") == ["1"] and text("p b i") == ["1"]
    assert text(".a > b i") == ["2"] and text("div div i") == ["2"] and text("b > i") == ["1", "3"] and text("i i") == []
