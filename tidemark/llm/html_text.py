"""Main text of web pages by composite text density (operator 8).

Every page becomes a tree, from which only what browsers never show (head,
scripts, styles, hidden parts, comments) is missing.  The composite density of a
block node is its number of characters per tag, adjusted for the characters and
tags of links and for the page's share of link text; the density sum of a node is
the sum of its children's densities.  Formatting tags belong to the block around
them and count as tags, not as nodes, since a lone ``<b>`` would otherwise
outweigh its paragraph's siblings.  The node of largest density sum is the core;
the smallest density on the path from it to the body is the threshold; further
nodes at or above the threshold, each by the largest sum below it, are content
too, and the text is that of the smallest subtree that spans them.

Two things are weighed beside.  *Marks*: what the contract excludes and a tag, a
role or a class or id declares (menus, footers, sidebars, forms, notices,
adverts, reader comments) counts as link text in the densities, and is left out
of the chosen subtree.  Marks cut nothing before the choice, ``marks=False``
turns them off, and the driver's pages give the same text without them.  A
marked form or name may as well be a wrapper of the whole layout; the mark is
void if the element holds the page's article, main or first heading, or most of
the text that is no link (``_settle``).  *Heading*: densities of fewer than
``EVIDENCE`` characters say nothing, so if the choice has less than that beside
the section of the page's title heading, and neither paragraph nor heading among
it, that section is the text.

A list of links is dropped as a menu only outside an article or main, and where
no heading or text stands right before it.

One task reads one page at a time; nothing is shuffled and no text is cut off.
Parsing and measuring take time in proportion to the page, broken markup and any
depth of nesting included.

Defined results: a null or empty page gives an empty text; broken markup is
read as browsers do in outline (void tags, implied ends, stray end tags), and a
quote that never closes is no quote; of nodes with equal sums the first in page
order is the core; an empty table gives an empty result; repeated rows give
repeated results; other columns play no role.
"""

from __future__ import annotations

import heapq
import html as entities
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import binary, whole_text

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noframes noembed xmp template".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rb rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
NEVER_SHOWN = RAW | frozenset("head svg canvas object embed applet audio video map".split())
MARKED = frozenset("nav header footer aside form menu dialog button select option input fieldset".split())
CUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
CUT_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?\d*|advert\w*|adsense|sponsor\w*|promo\w*|banner|nav|navbar|navigation|menu|breadcrumbs?|sidebar|side|aside|widget|footer|foot|header|masthead|topbar|toolbar|comments?|commentlist|disqus|respond|replies|cookies?|consent|gdpr|notice|notices|alert|popup|modal|overlay|newsletter|subscribe|signup|login|share|sharing|social|related|recommended|pagination|pager|tags|copyright|legal|skip|hidden)(?:$|[\s_-])",
    re.IGNORECASE,
)
#: Parts of names that say nothing against an element: a text's own header, and what a layout is said to have or lack.
_HARMLESS = re.compile(r"(?:article|post|entry|story|content|title|page)[\s_-]*(?:header|head)|(?:header|head)[\s_-]*title|(?<![A-Za-z])(?:no|with|without|has)[_-][\w-]+", re.IGNORECASE)
#: Names that say what an element's text is, where the others may also say how it is laid out.
_KINDS = re.compile(
    r"(?:^|[\s_-])(?:ads?\d*|advert\w*|adsense|sponsor\w*|promo\w*|comments?|commentlist|disqus|respond|replies|cookies?|consent|gdpr|popup|newsletter|subscribe|signup|login|share|sharing|social|related|recommended)(?:$|[\s_-])",
    re.IGNORECASE,
)
_LAYOUT = re.compile(r"(?:^|[_-])(?:content|main|article|post|entry|story|text|body|page|wrap\w*|container|layout|outer|inner|site|root|app)(?:$|[_-])", re.IGNORECASE)
#: So many times the unmarked text elsewhere must an element hold to stay: of a layout or form, of other names, of _KINDS.
LAYOUT_TIMES, OTHER_TIMES, KIND_TIMES = 1, 9, 20
EVIDENCE = 200
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_PARAGRAPHS = frozenset("p pre blockquote".split())
_RUNNING = _HEADINGS | _PARAGRAPHS
_OPEN = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][^\s/>]*))")
_COMMENT_END = re.compile(r"--!?>")
_STOP = re.compile(r">|=\s*([\"'])")
_ATTR = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|(?=[\s/]|$))", re.IGNORECASE)
_CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
#: A start tag ends open elements of these names, up to the nearest of the stops.
_IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_SCOPE = frozenset("html body table td th caption button object article section div nav header footer aside main form".split())


class Node:
    __slots__ = ("tag", "parent", "parts", "cut", "marked", "within", "chars", "tags", "link_chars", "link_tags", "density", "total", "names", "place", "last")

    def __init__(self, tag: str, parent: Node | None, cut: bool):
        self.tag, self.parent, self.cut, self.marked = tag, parent, cut, False
        self.within = tag in ("article", "main") or (parent is not None and parent.within)  # in an article
        self.parts: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        self.names: list[str] | None = None
        self.place = self.last = 0  # in page order: its own place and that of its last descendant


def _declared(attributes: str) -> tuple[bool, bool, list[str]]:
    """Whether an element is never shown, whether its role marks it, and its classes and ids if one of them is a name that may mark it."""
    names: list[str] = []
    named = role = False
    for match in _ATTR.finditer(attributes):
        name, value = match[1].lower(), entities.unescape(match[2] or match[3] or match[4] or "")
        if name in ("class", "id"):
            names.extend(value.split())
            named = named or CUT_NAMES.search(_HARMLESS.sub("", value)) is not None
        if name == "role" and value.strip().lower() in CUT_ROLES:
            role = True
        if name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true":
            return True, role, names
        if name == "style" and re.search(r"display\s*:\s*none", value, re.IGNORECASE):
            return True, role, names
    return False, role, names if named else []


class _Stack:
    """Open elements, with the places of those of each tag, so that no search walks over the others."""

    def __init__(self, root: Node):
        self.nodes = [root]
        self.places: dict[str, list[int]] = {}
        self.blocks = [0]

    def push(self, node: Node) -> None:
        place = len(self.nodes)
        self.nodes.append(node)
        self.places.setdefault(node.tag, []).append(place)
        if node.tag not in INLINE:
            self.blocks.append(place)

    def cut_to(self, place: int) -> None:
        while len(self.nodes) > place:
            self.places[self.nodes.pop().tag].pop()
        while self.blocks[-1] >= place:
            self.blocks.pop()

    def nearest(self, tags) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def close(self, names, stops) -> None:
        """Ends the nearest of ``names``, and what is open in it, unless a stop is nearer."""
        place = self.nearest(names)
        if place and place >= self.nearest(stops):
            self.cut_to(place)


class _Scanner:
    """Markup after a position; looks at every character a bounded number of times."""

    def __init__(self, source: str):
        self.source, self.quotes = source, True
        self.end = source.rfind(">")
        self.last = {q: source.rfind(q) for q in "\"'"}

    def tag_end(self, at: int) -> int:
        """The place of the ``>`` that ends the tag which is open at ``at``; quoted values may hold others."""
        source, start = self.source, at
        while self.quotes:
            match = _STOP.search(source, at)
            if match is None:
                break
            if match[1] is None:
                return match.start()
            if match.end() > self.last[match[1]]:
                break
            at = source.find(match[1], match.end()) + 1
        self.quotes = False  # one that never closes: from here on none counts
        return source.find(">", start)


def parse(source: str, marks: bool = True) -> tuple[Node, str]:
    """The page as a tree, and its title."""
    root = Node("#root", None, False)
    stack, scanner, position, end, title = _Stack(root), _Scanner(source), 0, len(source), None

    def text(start: int, stop: int) -> None:
        node = stack.nodes[-1]
        if start < stop and not node.cut:
            piece = source[start:stop]
            node.parts.append(entities.unescape(piece) if "&" in piece else piece)

    while position < end:
        match = _OPEN.search(source, position)
        if not match:
            text(position, end)
            break
        text(position, match.start())
        position = match.end()
        if match[2] is None:
            if match[0] == "<!--":
                stop = _COMMENT_END.search(source, position)
                position = stop.end() if stop else end
            elif position <= scanner.end:
                position = source.find(">", position) + 1
            else:
                text(match.start(), end)
                break
            continue
        if position > scanner.end:
            text(match.start(), end)
            break
        stop_at = scanner.tag_end(position)
        tag, attributes, position = match[2].lower(), source[position:stop_at], stop_at + 1
        parent = stack.nodes[-1]
        if match[1]:
            if tag == "br":
                if not parent.cut:
                    parent.parts.append(Node("br", parent, False))
                continue
            place = stack.nearest((tag,))
            if place and (tag not in INLINE or place > stack.blocks[-1]):
                stack.cut_to(place)
            continue
        if tag in _CLOSES_P:
            stack.close(("p",), _SCOPE)
        if tag in _IMPLIED:
            stack.close(*_IMPLIED[tag])
        if tag == "a":
            stack.close(("a",), _SCOPE | {"p", "li"})
        if tag in ("body", "html") and stack.nearest((tag,)):
            continue
        if tag == "body" and stack.places.get("head"):
            stack.cut_to(stack.places["head"][0])
        parent = stack.nodes[-1]
        own = parent.tag in ("article", "main") and tag == "header"  # an article's own header holds its title
        looked = "=" in attributes and tag not in ("html", "body", "article", "main") or "hidden" in attributes
        unseen, role, names = _declared(attributes) if looked else (False, False, [])
        node = Node(tag, parent, parent.cut or tag in NEVER_SHOWN or unseen)
        node.marked = marks and (role or tag in MARKED and tag != "form" and not own)
        if marks and not node.cut and (names or tag == "form"):
            node.names = names
        if not parent.cut:
            parent.parts.append(node)
        if tag in VOID or attributes.endswith("/") and tag not in INLINE and tag not in _CLOSES_P:
            continue
        if tag in RAW:
            found = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.IGNORECASE).search(source, position)
            if tag == "title" and title is None:
                title = " ".join(entities.unescape(source[position : found.start() if found else end]).split())
            position = source.find(">", found.end()) + 1 or end if found else end
            continue
        stack.push(node)
    if marks:
        _settle(root)
    return root, title or ""


def _times(node: Node) -> int:
    names = _HARMLESS.sub("", " ".join(node.names))
    if _KINDS.search(names):
        return KIND_TIMES
    plain = [x for x in names.split() if not CUT_NAMES.search(x)]
    return LAYOUT_TIMES if node.tag == "form" or any(_LAYOUT.search(x) for x in plain) else OTHER_TIMES


def _settle(root: Node) -> None:
    """Marks the elements with such ``names`` but those that hold the content.

    The element with most text comes first.  One stays that holds the ``main``;
    or an ``article`` while none stands elsewhere, if no name says what its text
    is; or an ``h1`` and a quarter of the text; or some times the text elsewhere.
    Text is what is neither link nor heading; text in marked elements counts
    elsewhere once they stay, and the marked elements in them come in turn.
    """
    order = _walk(root, marked=False)
    if all(x.names is None for x in order):
        return
    link, heading, owner = {}, {}, {}
    own: dict[int, list[int]] = {id(root): [0, 0, 0, 0]}  # characters, main, article, h1 that no marked element below holds
    inner: dict[int, list[Node]] = {id(root): []}
    found = [root]
    for x in order:
        up = id(x.parent)
        link[id(x)] = x.tag == "a" or link.get(up, False)
        heading[id(x)] = x.tag in _HEADINGS or heading.get(up, False)
        holder = owner.get(up, root)
        if x.names is not None:
            inner[id(holder)].append(x)
            own[id(x)], inner[id(x)], holder = [0, 0, 0, 0], [], x
            found.append(x)
        owner[id(x)] = holder
        counts = own[id(holder)]
        if not link[id(x)] and not heading[id(x)]:
            counts[0] += sum(len(" ".join(y.split())) for y in x.parts if type(y) is str)
        if x.tag in ("main", "article", "h1"):
            counts[("main", "article", "h1").index(x.tag) + 1] += 1
    whole = {k: list(v) for k, v in own.items()}
    for x in reversed(found):
        for y in inner[id(x)]:
            whole[id(x)] = [a + b for a, b in zip(whole[id(x)], whole[id(y)], strict=True)]
    elsewhere, todo, number = [0, 0, 0, 0], [], 0

    def stay(x: Node) -> None:
        nonlocal number
        elsewhere[:] = [a + b for a, b in zip(elsewhere, own[id(x)], strict=True)]
        for y in inner[id(x)]:
            heapq.heappush(todo, (-whole[id(y)][0], number, y))
            number += 1

    stay(root)
    while todo:
        x = heapq.heappop(todo)[2]
        chars, mains, articles, heads = whole[id(x)]
        times = _times(x)
        holds = mains or articles and times != KIND_TIMES and not elsewhere[1] and not elsewhere[2] or heads and 3 * chars >= elsewhere[0] and chars
        if holds or chars and chars > times * elsewhere[0] and not elsewhere[1] and not elsewhere[2]:
            stay(x)
        else:
            x.marked = True


def _walk(root: Node, marked: bool = True) -> list[Node]:
    """Nodes that are shown, parents first, in page order."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        node.place = len(order)
        order.append(node)
        todo.extend(x for x in reversed(node.parts) if type(x) is Node and not x.cut and (marked or not x.marked))
    for node in reversed(order):
        node.last = max(node.last, node.place)
        if node.parent is not None:
            node.parent.last = max(node.parent.last, node.last)
    return order


def density(chars: int, tags: int, link_chars: int, link_tags: int, share: float) -> float:
    """Characters per tag, times a logarithm that falls with the share of links; ``share`` is the body's."""
    if not chars:
        return 0.0
    base = math.log(chars * link_chars / max(1, chars - link_chars) + share * chars + math.e)
    ratio = chars * max(1, tags) / (max(1, link_chars) * max(1, link_tags))
    return chars / max(1, tags) * math.log(max(ratio, 1.0)) / base


def _measure(order: list[Node]) -> None:
    links: dict[int, bool] = {}
    for node in order:
        links[id(node)] = node.tag == "a" or node.marked or (node.parent is not None and links.get(id(node.parent), False))
    for node in reversed(order):
        own = sum(len(" ".join(x.split())) for x in node.parts if type(x) is str)
        node.chars += own
        if links[id(node)]:
            node.link_chars += own
        if node.parent is not None:
            up = node.parent
            up.chars += node.chars
            up.link_chars += node.link_chars
            up.tags += node.tags + 1
            up.link_tags += node.link_tags + (node.tag == "a" or node.marked)
    body = next((x for x in order if x.tag == "body"), order[0])
    share = body.link_chars / max(1, body.chars)
    block: dict[int, Node | None] = {id(None): None}  # the block around
    for node in order:
        node.density = density(node.chars, node.tags, node.link_chars, node.link_tags, share)
        up = node.parent
        block[id(node)] = up if up is None or up.tag not in INLINE else block[id(up)] or up
    for node in order:
        up = block[id(node)]
        if up is not None and node.tag not in INLINE:
            up.total += node.density


def _path(node: Node | None) -> list[Node]:
    """From the node up to the body."""
    path = []
    while node is not None and node.tag not in ("html", "#root"):
        path.append(node)
        node = node.parent
    return path


def _holds(node: Node, first: int, last: int) -> bool:
    return node.place <= first and node.last >= last


def _content(order: list[Node], title: str = "") -> Node:
    """The smallest subtree that spans all content."""
    body = next((x for x in order if x.tag == "body"), order[0])
    blocks = [x for x in order if x.tag not in INLINE and x.tag not in ("html", "#root")] or order
    core = max(blocks, key=lambda x: x.total)
    path = _path(core)
    threshold = min((x.density for x in path), default=0.0)
    best: dict[int, Node] = {}
    for x in reversed(blocks):  # children first: the largest sum in each subtree
        found = max([x, *(best[id(c)] for c in x.parts if type(c) is Node and id(c) in best)], key=lambda y: y.total)
        best[id(x)] = found
    first, last, todo, above = core.place, core.last, [body], {id(x) for x in path} | {id(body)}
    while todo:
        x = todo.pop()
        if x is core:
            continue
        content = best[id(x)] if id(x) in best and best[id(x)].total > 0 else x if x.tag in _PARAGRAPHS else None
        if content is not None and id(x) not in above and x.density >= threshold and x.chars > x.link_chars:
            first, last = min(first, content.place), max(last, content.last)
        else:
            todo.extend(c for c in x.parts if type(c) is Node and not c.cut)
    top = core
    while not _holds(top, first, last) and top.parent is not None:
        top = top.parent
    heading = _heading(order, title)
    return top if heading is None else _with_heading(_by_evidence(top, heading, order), heading)


def _heading(order: list[Node], title: str) -> Node | None:
    """The first main heading with which the page's title begins or ends, or the other way round; else the first one."""
    heads = [x for x in order if x.tag == "h1" and x.chars and x.link_chars < x.chars]
    if not title:
        return heads[0] if heads else None
    for k, x in enumerate(heads):
        if k + 1 == len(heads) or heads[k + 1].place > x.last:  # one with another in it is broken markup
            t = " ".join("".join(_strings(x)).split())
            if title.startswith(t) or title.endswith(t) or t.startswith(title) or t.endswith(title):
                return x
    return heads[0] if heads else None


def _strings(node: Node):
    todo: list[Node | str] = [node]
    while todo:
        x = todo.pop()
        if type(x) is str:
            yield x
        elif not x.cut:
            todo.extend(reversed(x.parts))


def _by_evidence(top: Node, heading: Node, order: list[Node]) -> Node:
    """The heading's own section, the first around it with a paragraph, where ``top`` has next to nothing beside it."""
    section: Node | None = heading
    while section is not None and not _has_paragraph(section):
        section = section.parent
    if section is None or _holds(section, top.place, top.last):
        return top
    beside = [*order[top.place : section.place], *order[max(top.place, section.last + 1) : top.last + 1]]
    if any(x.tag in _RUNNING and x.chars > x.link_chars for x in beside):
        return top
    chars = top.chars - top.link_chars
    if _holds(top, section.place, section.last):
        chars -= section.chars - section.link_chars
    return section if chars < EVIDENCE else top


def _has_paragraph(node: Node) -> bool:
    return any(type(x) is Node and not x.cut and not x.marked and x.tag in _PARAGRAPHS and x.chars for x in node.parts)


def _with_heading(top: Node, heading: Node) -> Node:
    """The subtree that also spans the heading, if little else comes with it."""
    wider = top
    while not _holds(wider, heading.place, heading.last):
        wider = wider.parent
    return wider if wider.chars - wider.link_chars - (top.chars - top.link_chars) - heading.chars <= 0.1 * top.chars else top


def _is_menu(node: Node) -> bool:
    """Whether a list outside an article is one of links only."""
    return node.tag in ("ul", "ol") and node.link_tags >= 2 and 10 * node.link_chars >= 9 * node.chars


def _after_text(parent: Node | None) -> set[int]:
    """The children right after a heading or text, among running text: a list there is one of sources, not a menu."""
    found, before, text = set(), "", False
    for x in parent.parts if parent is not None else []:
        if type(x) is str:
            kind = "p" if x.strip() else None
        elif x.cut or x.marked or not x.chars:
            kind = None
        else:
            kind = "" if x.chars == x.link_chars else "p" if x.tag in INLINE else x.tag
            if before in _RUNNING:
                found.add(id(x))
        if kind is not None:
            before, text = kind, text or kind == "p"
    return found if text else set()


def _render(top: Node) -> str:
    blocks: list[str] = []
    line: list[str] = []
    after: dict[int, set[int]] = {}

    def menu(x: Node) -> bool:
        if x.within or not _is_menu(x):
            return False
        if id(x.parent) not in after:
            after[id(x.parent)] = _after_text(x.parent)
        return id(x) not in after[id(x.parent)]

    def flush() -> None:
        joined = " ".join("".join(line).split())
        if joined:
            blocks.append(joined)
        line.clear()

    todo: list[Node | str | None] = [top]
    while todo:
        x = todo.pop()
        if x is None:
            flush()
        elif type(x) is str:
            line.append(x)
        elif x.tag == "br":
            line.append(" ")
        elif not x.cut and not x.marked and not menu(x):
            if x.tag in INLINE:
                todo.extend(reversed(x.parts))
            else:
                flush()
                todo.append(None)
                todo.extend(reversed(x.parts))
    flush()
    return "\n".join(blocks)


def main_text(source: str, marks: bool = True) -> str:
    if not source:
        return ""
    root, title = parse(source, marks)
    order = _walk(root)
    _measure(order)
    return _render(_content(order, title))


def html_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", marks: bool = True) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), whole_text(html).alias("html"))
    kinds = dict(rows.dtypes)

    def run(batches):
        for batch in batches:
            texts = [main_text(x.decode(), marks) for x in binary(batch, "html")]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
