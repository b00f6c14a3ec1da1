"""Small page tree used inside the parse UDF: elements, CSS selection, element text, article body text.

Spark has no HTML reader and its XPath functions need well-formed XML. This module only turns one page into raw
strings; all cleaning happens in Spark on the columns that come back.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from functools import lru_cache

# Elements without content, and elements whose text is not part of the page text.
VOID = frozenset("area base br col embed hr img input keygen link meta param source track wbr".split())
HIDDEN = frozenset("script style template rt rp".split())
PREFORMATTED = frozenset(("pre", "textarea"))
_BLANKS = " \n\t\f\r"

# Tag groups of article bodies.
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
TABLE_TAGS = ("table", "tbody", "td", "tr", "th")
LIST_TAGS = ("ul", "li")
PLAIN_BODY = ("p", "table", "span", *HEADINGS, *TABLE_TAGS, *LIST_TAGS)
EXPANDED = frozenset(("div", "table", "figcaption", *TABLE_TAGS, *LIST_TAGS))

_BLANK_LINES = re.compile(r"\n\s*\n+")
_TAB_RUNS = re.compile(r"\t\s*\t+")


def unify(text: str) -> str:
    """Same rule as `functions.text.unify`, needed here between the pieces of a body."""
    if "\n" in text:
        text = _BLANK_LINES.sub("\n", text)
    if "\t" in text:
        text = _TAB_RUNS.sub("\n", text)
    return text.replace("\xa0", " ").strip()


# Attributes, in which a quote counts only after "=".
_REST = r"""(?:[^>=]++|=\s*+(?:"[^"]*"|'[^']*')?+)*+"""
# A start tag, with all of its text and its end tag if nothing else stands between them, or with its raw text; an end tag; a CDATA
# section; a comment or another declaration. The groups are a start tag's name, the name if raw text follows, its attributes,
# the text, an end tag's name, a section's text.
_TOKEN = re.compile(
    rf"""<(?:((script|style)(?=[\s/>])|[a-z][^\s/>]*+)({_REST})>
        (?:((?(2)(?<!/>)(?:[^<]++|<(?!/\2[\s/>]))*+|[^<]*+))(?(2)|</(?-i:\1)>))?+
    |/([a-z][^\s/>]*+){_REST}>
    |!\[CDATA\[(.*?)\]\]>|!--.*?(?:-->|\Z)|/?[!?/][^>]*>|/[^a-z>][^>]*>)""",
    re.S | re.I | re.X,
)
_ATTRIBUTE = re.compile(r"""([^\s/=][^\s/=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'][^\s]*)?))?""")
_RAW_END = {name: re.compile(f"</{name}(?=[\\s/>])", re.I) for name in ("script", "style")}
# Elements that treat the text within them in a way of their own.
_SPECIAL = HIDDEN | PREFORMATTED


class Element:
    __slots__ = ("name", "markup", "parent", "index", "last", "text_from", "text_to", "_page", "_nth", "_attrs")

    def __init__(self, name: str, markup: str, parent: Element | None, index: int, text_from: int, page: list[Element]):
        self.name, self.markup, self.parent, self._page = name, markup, parent, page
        self.index = self.last = index
        self.text_from = self.text_to = text_from
        self._nth = self._attrs = None

    @property
    def children(self) -> list[Element]:
        found, at, page = [], self.index + 1, self._page
        while at <= self.last:
            child = page[at]
            found.append(child)
            at = child.last + 1
        return found

    @property
    def nth(self) -> int:
        """Place among the children of the parent, from 1; counted for all of them when first asked for."""
        if self._nth is None:
            for place, child in enumerate(self.parent.children if self.parent is not None else [self], 1):
                child._nth = place
        return self._nth

    @property
    def attrs(self) -> dict[str, str]:
        """Attributes, read when first asked for; the last of equal names wins."""
        if self._attrs is None:
            found = _ATTRIBUTE.findall(self.markup) if self.markup else ()
            if "&" in self.markup:
                self._attrs = {name.lower(): html.unescape(double or single or bare) for name, double, single, bare in found}
            else:
                self._attrs = {name.lower(): double or single or bare for name, double, single, bare in found}
        return self._attrs

    @property
    def classes(self) -> list[str]:
        return self.attrs["class"].split() if "class" in self.attrs else []


class Page:
    """Elements in document order; the text of an element is a slice of one shared list.

    Unclosed elements stay open to the end of their parent, stray end tags are ignored, void elements are empty.
    """

    def __init__(self, markup: str):
        self._data: list[str] = []
        # hidden pieces of text: their places, and the elements that hide them
        self._hidden_at: list[int] = []
        self._hidden_by: dict[int, str] = {}
        self.by_name: dict[str, list[Element]] = {}
        self.elements: list[Element] = []
        self.root = Element("", "", None, 0, 0, self.elements)
        self.elements.append(self.root)
        self._marked: list[Element] | None = None
        self._open = [self.root]
        self._open_names: dict[str, int] = {"": 1}
        self._hidden: list[str] = []
        self._preformatted = 0
        self._read(markup)
        while self._open:
            self._finish(self._open.pop())

    @property
    def texts(self) -> list[tuple[str, str]]:
        """The pieces of text, each with the name of the element that hides it."""
        return [(self._hidden_by.get(at, ""), data) for at, data in enumerate(self._data)]

    def release(self) -> None:
        """Undo the links from the elements to the list that holds them, so that the tree goes with its page."""
        self.elements.clear()

    def _read(self, markup: str) -> None:
        # nothing after the last ">" can be a tag; not looking there keeps broken pages linear
        limit = markup.rfind(">") + 1
        *pieces, rest = _TOKEN.split(markup[:limit])
        if not rest and limit < len(markup) and pieces and pieces[-5] and pieces[-3] is not None:
            # raw text at the end, which goes on to its end tag or to the end of the page
            end = _RAW_END[pieces[-6].lower()].search(markup, limit)
            stop = len(markup) if end is None else end.start()
            pieces[-3], limit = pieces[-3] + markup[limit:stop], stop
        rest += markup[limit:]
        data, elements, by_name = self._data, self.elements, self.by_name
        opened, counts, start, close, unescape = self._open, self._open_names, self._start, self._close, html.unescape
        parent, usual = self.root, True  # usual: nothing open hides its text or keeps its blanks
        tokens = iter(pieces)
        for text, name, raw, attributes, inner, end, section in zip(tokens, tokens, tokens, tokens, tokens, tokens, tokens):
            if text:
                self._add(unescape(text) if "&" in text else text)
            if name:
                name = name.lower()
                ended = attributes and attributes[-1] == "/"
                if not usual or ended or name in _SPECIAL:
                    start(name, attributes)
                    if ended:
                        close(name)
                    if inner is not None:
                        self._add(unescape(inner) if "&" in inner and not raw else inner)
                        if not raw:
                            close(name)
                    parent, usual = opened[-1], not self._hidden and not self._preformatted
                    continue
                # the same for the others, at once
                element = Element(name, attributes, parent, len(elements), len(data), elements)
                elements.append(element)
                if name in by_name:
                    by_name[name].append(element)
                else:
                    by_name[name] = [element]
                if inner is not None:
                    if inner:
                        if "&" in inner:
                            inner = unescape(inner)
                        if inner.isspace() and not inner.strip(_BLANKS):
                            inner = "\n" if "\n" in inner else " "
                        data.append(inner)
                        if name not in VOID:
                            element.text_to = len(data)
                elif name not in VOID:
                    opened.append(element)
                    counts[name] = counts.get(name, 0) + 1
                    parent = element
            elif end:
                end = end.lower()
                if usual and parent.name == end:
                    opened.pop()
                    parent.last, parent.text_to = len(elements) - 1, len(data)
                    counts[end] -= 1
                else:
                    close(end)
                    usual = not self._hidden and not self._preformatted
                parent = opened[-1]
            elif section:
                self._add(section)
        self._add(unescape(rest))

    def _start(self, name: str, rest: str) -> None:
        element = Element(name, rest, self._open[-1], len(self.elements), len(self._data), self.elements)
        self.elements.append(element)
        self.by_name.setdefault(name, []).append(element)
        if name not in VOID:
            self._open.append(element)
            self._open_names[name] = self._open_names.get(name, 0) + 1
            if name in HIDDEN:
                self._hidden.append(name)
            self._preformatted += name in PREFORMATTED

    def _close(self, name: str) -> None:
        if not self._open_names.get(name):
            return  # a stray end tag
        while True:
            element = self._open.pop()
            self._finish(element)
            if element.name == name:
                return

    def _finish(self, element: Element) -> None:
        element.last, element.text_to = len(self.elements) - 1, len(self._data)
        self._open_names[element.name] -= 1
        if element.name in HIDDEN:
            self._hidden.pop()
        self._preformatted -= element.name in PREFORMATTED

    def _add(self, data: str) -> None:
        if not data:
            return
        if not self._preformatted and not data.strip(_BLANKS):
            data = "\n" if "\n" in data else " "
        if self._hidden:
            self._hidden_at.append(len(self._data))
            self._hidden_by[len(self._data)] = self._hidden[-1]
        self._data.append(data)

    def text(self, element: Element) -> str:
        start, stop = element.text_from, element.text_to
        own = element.name if element.name in HIDDEN else ""
        if not own:
            hidden = bisect_left(self._hidden_at, start)
            if hidden == len(self._hidden_at) or self._hidden_at[hidden] >= stop:
                return self._data[start] if stop == start + 1 else "".join(self._data[start:stop])
        by = self._hidden_by
        return "".join(t for at, t in enumerate(self._data[start:stop], start) if by.get(at, "") == own)

    def _pool(self, scope: Element, steps: tuple) -> Sequence[Element]:
        """The elements among which those that match are, those outside of the scope too."""
        _, tag, tests, _, needle = steps[-1]
        if tag:
            pool = self.by_name.get(tag, ())
        elif tests:
            if self._marked is None:
                self._marked = [e for e in self.elements if e.markup]
            pool = self._marked
        else:
            return self.elements[scope.index + 1 : scope.last + 1]
        # most elements end here, before their attributes are read
        return [e for e in pool if needle in e.markup or "&" in e.markup] if needle else pool

    def select(self, scope: Element, css: str) -> Iterator[Element]:
        """Descendants of `scope` that match; ancestors in the selector may lie outside of it."""
        steps = compile_selector(css)
        seen: dict[tuple[int, int], bool] = {}
        at, after, last = len(steps) - 1, scope.index, scope.last
        for element in self._pool(scope, steps):
            if after < element.index <= last and _matches(element, steps, at, seen):
                yield element

    def first(self, scope: Element, css: str) -> Element | None:
        steps = compile_selector(css)
        after, last = scope.index, scope.last
        if len(steps) > 1:
            at, seen = len(steps) - 1, {}
            for element in self._pool(scope, steps):
                if after < element.index <= last and _matches(element, steps, at, seen):
                    return element
            return None
        _, _, tests, nth, _ = steps[0]
        for element in self._pool(scope, steps):
            if after < element.index <= last and (not tests or _passes(element, tests)) and (not nth or element.nth == nth):
                return element
        return None


_SELECTOR = re.compile(
    r"""(?P<join>\s*>\s*|\s+)
    |(?P<tag>[A-Za-z][\w-]*)
    |\#(?P<id>[\w-]+)
    |\.(?P<class>[\w-]+)
    |\[(?P<attr>[\w:-]+)(?:(?P<op>\*?=)(?:'(?P<single>[^']*)'|"(?P<double>[^"]*)"|(?P<bare>[^\]]*)))?\]
    |:nth-child\((?P<nth>\d+)\)""",
    re.X,
)


@lru_cache(maxsize=4096)
def compile_selector(css: str) -> tuple:
    """Steps `(join, tag, tests, nth, needle)`: tag, `#id`, `.class`, `[a=v]`, `[a*=v]`, descendant, `>`, `:nth-child(n)`. The needle
    stands in the markup of every element that passes the tests, unless entities do."""
    steps, place, css = [["", None, [], None]], 0, css.strip()
    while place < len(css):
        token = _SELECTOR.match(css, place)
        if token is None:
            raise ValueError(f"unsupported selector: {css}")
        place, part = token.end(), token.groupdict()
        if part["join"] is not None:
            steps.append([part["join"].strip() or " ", None, [], None])
        elif part["tag"]:
            steps[-1][1] = part["tag"].lower()
        elif part["nth"]:
            steps[-1][3] = int(part["nth"])
        elif part["id"]:
            steps[-1][2].append(("id", "=", part["id"]))
        elif part["class"]:
            steps[-1][2].append(("class", ".", part["class"]))
        else:
            value = next((part[k] for k in ("single", "double", "bare") if part[k] is not None), "")
            steps[-1][2].append((part["attr"].lower(), part["op"] or "has", value))
    return tuple((join, tag, tuple(tests), nth, max(filter(None, map(_needle, tests)), key=len, default="")) for join, tag, tests, nth in steps)


def _needle(test: tuple[str, str, str]) -> str:
    """The value of a test if an attribute that passes has it as it is written, or nothing: entities, blanks and case may differ."""
    name, _, value = test
    return "" if " " in value or name == "type" else value


def _passes(element: Element, tests: tuple) -> bool:
    markup = element.markup
    if not markup:
        return False
    for test in tests:
        name, op, value = test
        if "&" not in markup and _needle(test) not in markup:
            return False
        if op == ".":
            if value not in element.classes:
                return False
            continue
        if name not in element.attrs:
            return False
        actual = " ".join(element.classes) if name == "class" else element.attrs[name]
        if name == "type":
            actual, value = actual.lower(), value.lower()
        if (op == "=" and actual != value) or (op == "*=" and (not value or value not in actual)):
            return False
    return True


def _matches(element: Element, steps: tuple, at: int, seen: dict[tuple[int, int], bool]) -> bool:
    join, tag, tests, nth, _ = steps[at]
    if (tag and element.name != tag) or (tests and not _passes(element, tests)) or (nth and element.nth != nth):
        return False
    if at == 0:
        return True
    above = element.parent
    if above is None or above.parent is None:
        return False
    return _matches(above, steps, at - 1, seen) if join == ">" else _inside(above, steps, at - 1, seen)


def _inside(element: Element, steps: tuple, at: int, seen: dict[tuple[int, int], bool]) -> bool:
    """Whether the element or one above it matches; `seen` has the answers so far, so each is found once."""
    path = []
    while element.parent is not None and (element.index, at) not in seen:
        path.append(element)
        element = element.parent
    found = element.parent is not None and seen[element.index, at]
    for e in reversed(path):
        found = found or _matches(e, steps, at, seen)
        seen[e.index, at] = found
    return found


def keeps(element: Element, rule: dict) -> bool:
    """Whether a child belongs to the article body, by the rule's tag lists and class lists."""
    name = element.name
    if name in rule.get("tags", ()):
        return True
    if name in rule.get("tags_no_attrs", ()) and not element.attrs:
        return True
    if name in rule.get("tags_no_class", ()):
        if not element.classes or not rule.get("allowed_classes", frozenset()).isdisjoint(element.classes):
            return True
    if not rule.get("classes", {}).get(name, frozenset()).isdisjoint(element.classes):
        return True
    value = rule.get("div_with_value")
    return bool(value) and name == "div" and any(v == value for k, v in element.attrs.items() if k != "class")


def body_text(page: Page, element: Element, rule: dict) -> str:
    """Text of the kept children, one line each; containers are opened and give their own kept children.

    Text that stands directly in a list item or cell is lost, unless the rule sets `keep_bare_text`.
    """
    lines: list[str] = []
    tags, keep_bare_text = rule.get("tags", ()), rule.get("keep_bare_text")
    # children still to be looked at, the next one last: containers nest without bound, so no recursion
    waiting = element.children
    waiting.reverse()
    while waiting:
        child = waiting.pop()
        if child.name not in tags and not keeps(child, rule):
            continue
        opened = child.name in EXPANDED
        if opened and keep_bare_text:
            opened = any(keeps(c, rule) for c in child.children)
        if opened:
            waiting.extend(reversed(child.children))
        else:
            lines.append(unify(page.text(child)))
    return unify("\n".join(lines))
