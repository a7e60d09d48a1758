"""A small element tree over the standard library's HTML parser, with CSS selection.

Selectors know tag, class, attribute equality and containment, descendants and
comma lists, which is what the extractors need.  The tree tolerates void tags,
unclosed tags and stray end tags, at any depth.  Text and attributes are decoded
in the tree and escaped when an element is written, so what a post shows as text
stays text.
"""

from __future__ import annotations

import collections
import functools
import re
from collections.abc import Iterator
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_PLAIN = frozenset(("script", "style"))  # their text knows no references
_SIMPLE = re.compile(r"\.([\w-]+)|\[([\w:-]+)(?:(\*?=)[\"']?([^\"'\]]*)[\"']?)?\]|([a-zA-Z][\w-]*)")


class Comment(str):
    """A comment; written again, but no text."""


class Element:
    __slots__ = ("attrs", "children", "name", "parent")

    def __init__(self, name: str, attrs: dict[str, str], parent: Element | None):
        self.name, self.attrs, self.parent = name, attrs, parent
        self.children: list[Element | str] = []

    def walk(self) -> Iterator[Element]:
        """Descendants in document order."""
        todo = [x for x in reversed(self.children) if isinstance(x, Element)]
        while todo:
            x = todo.pop()
            yield x
            todo.extend(y for y in reversed(x.children) if isinstance(y, Element))

    def strings(self) -> Iterator[str]:
        todo: list[Element | str] = list(reversed(self.children))
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                if x.strip() and not isinstance(x, Comment):
                    yield x.strip()
            else:
                todo.extend(reversed(x.children))

    def text(self) -> str:
        return "".join(self.strings())

    def above(self, *names: str) -> Element | None:
        """The nearest enclosing element of the first name that has one."""
        for name in names:
            x = self.parent
            while x is not None and x.name != name:
                x = x.parent
            if x is not None:
                return x
        return None

    def select(self, selector: str) -> Iterator[Element]:
        options = _options(selector)
        if len(options) == 1:
            steps = options[0]
            return (x for x in self.walk() if _matches(x, steps))
        return (x for x in self.walk() if any(_matches(x, steps) for steps in options))

    def first(self, selector: str) -> Element | None:
        return next(self.select(selector), None)

    def inner_html(self) -> str:
        out: list[str] = []
        todo: list[Element | str | _End] = list(reversed(self.children))
        parents = [self.name]
        while todo:
            x = todo.pop()
            if isinstance(x, _End):
                out.append(f"</{parents.pop()}>")
            elif isinstance(x, Comment):
                out.append(f"<!--{x}-->")
            elif isinstance(x, str):
                out.append(x if parents[-1] in _PLAIN else _escaped(x))
            elif x.name in VOID:
                out.append(x.start("/"))
            else:
                out.append(x.start(""))
                parents.append(x.name)
                todo.append(_END)
                todo.extend(reversed(x.children))
        return "".join(out)

    def start(self, end: str) -> str:
        return f"<{self.name}{''.join(f' {k}={_quoted(v)}' for k, v in self.attrs.items())}{end}>"

    def outer_html(self) -> str:
        return self.start("/") if self.name in VOID else f"{self.start('')}{self.inner_html()}</{self.name}>"


class _End:
    """Ends the element that was opened last."""


_END = _End()


def _escaped(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def _quoted(value: str) -> str:
    """An attribute's value in quotes that it doesn't hold, in double ones if it holds both."""
    value = _escaped(value)
    if '"' in value and "'" not in value:
        return f"'{value}'"
    return '"' + value.replace('"', "&quot;") + '"'


def _simple(text: str) -> list[tuple]:
    found = (m.groups() for m in _SIMPLE.finditer(text))
    return [(cls, attr, how, value, name and name.lower()) for cls, attr, how, value, name in found]


@functools.cache  # the extractors have a few fixed ones
def _options(selector: str) -> list[list[list[tuple]]]:
    return [[_simple(s) for s in option.split()] for option in selector.split(",")]


def _is(x: Element, tests: list[tuple]) -> bool:
    for cls, attr, how, value, name in tests:
        if cls is not None:
            have = x.attrs.get("class")
            if have is None or cls not in have or cls not in have.split():
                return False
        if attr is not None:
            have = x.attrs.get(attr)
            if have is None or how == "=" and have != value or how == "*=" and value not in have:
                return False
        if name is not None and x.name != name:
            return False
    return True


def _matches(x: Element, steps: list[list[tuple]]) -> bool:
    if not _is(x, steps[-1]):
        return False
    up, k = x.parent, len(steps) - 2
    while k >= 0 and up is not None:
        if _is(up, steps[k]):
            k -= 1
        up = up.parent
    return k < 0


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("#root", {}, None)
        self.open: collections.Counter = collections.Counter()

    def updatepos(self, i, j):
        return j  # lines are not counted

    def handle_starttag(self, tag, attrs):
        own: dict[str, str] = {}
        for name, value in attrs:  # of one name the first counts
            own.setdefault(name, value or "")
        x = Element(tag, own, self.at)
        self.at.children.append(x)
        if tag not in VOID:
            self.at = x
            self.open[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.open[tag] -= 1
            self.at = self.at.parent

    def handle_endtag(self, tag):
        if not self.open[tag]:
            return  # nothing to end
        while True:
            x, self.at = self.at, self.at.parent
            self.open[x.name] -= 1
            if x.name == tag:
                return

    def handle_data(self, data):
        self.at.children.append(data)

    def handle_comment(self, data):
        self.at.children.append(Comment(data))


def parse(html: str) -> Element:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root
