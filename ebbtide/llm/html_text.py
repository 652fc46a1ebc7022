"""Main text of web pages by text-to-tag ratios.

The events of the standard library's streaming parser cut a page into lines, one per block of running text. A
line's ratio is its characters over its tags; the ratios are smoothed with a Gaussian, and lines above their
standard deviation form the content regions. The smallest element that holds all of them, or all of those in the page's main
or article elements, is the article: its blocks are returned in order, whatever their own ratios, with the headline
before it and without the elements that are never part of an article.

Navigation, forms and elements named like a part beside the article are areas of their own and left out, unless
the area with most of the running text is one of them: then it and what surrounds it belong to the page.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import bounded_batches, text_of, travels

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q ruby rp rt s samp small span "
    "strike strong sub sup time tt u var wbr".split())
#: Not part of an article, unless they hold it.
BESIDE = frozenset("nav footer aside".split())
WRAPPERS = frozenset("form fieldset".split())
#: Never part of an article.
CONTROLS = frozenset("button select option textarea input label menu dialog".split())
#: Words of class, id and role that name such parts.
NAMED = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices alert popup modal overlay sidebar nav navbar navigation menu breadcrumb breadcrumbs footer "
    "comment comments disqus respond replies related recommended share sharing social newsletter subscribe subscription "
    "login signup search pagination pager toolbar widget masthead contentinfo complementary".split())
#: The only ones that count on an element inside running text, where other names belong to the text.
ADVERTS = frozenset("ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion".split())
#: Elements that may be a menu where all that they say is links.
LISTS = frozenset("ul ol dl div section table".split())
#: Elements that one of these starts anew.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
PARAGRAPH_ENDS = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol "
    "p pre section table ul".split())
#: What an end tag inside one of these does not reach past.
SCOPES = frozenset("table td th li ul ol div section article main aside nav body html".split())
CONTAINERS = frozenset("html body main article section div table tbody tr td center".split())
SPLIT = re.compile(r"[^a-z]+")
#: A comment as browsers end it; one without an end goes on to the end of the page.
COMMENT = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))", re.S)
#: What starts a tag or a comment.
OPENING = re.compile(r"<[a-zA-Z/!?]")
#: First words of names that tell about a neighbour, as in has-sidebar.
ABOUT = frozenset("has with no without is js".split())
#: Elements whose text is not shown.
SILENT = frozenset("head script style noscript template iframe object svg math canvas audio video map".split())

HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Kinds of areas: the page itself, what may wrap an article, what stands beside one, what is no text of the page.
PAGE, WRAPPER, ASIDE, NEVER = range(4)

SMOOTHING = 2
#: Times the running text of the page's own article elements that a wrapper without one must hold to count as the page.
OUTWEIGHS = 4


class _Lines(HTMLParser):
    """Nodes (parent, tag, area), areas (parent area, kind) and lines (node, parts, tags) of a page.

    A part is (area, text). Text that is not shown is in no line. ``linked`` has the characters inside links of each line.
    Open elements are found by their places, per name, so that time grows with the page whatever its nesting.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: list[tuple[int, str, int]] = [(-1, "", 0)]
        self.areas: list[tuple[int, int]] = [(-1, PAGE)]
        self.open = [0]
        self.places: dict[str, list[int]] = {}
        self.scopes: list[int] = [0]
        self.blocks: list[int] = [0]
        self.lines: list[tuple[int, list[tuple[int, str]], int]] = []
        self.linked: list[int] = []
        self.in_links = 0
        self.parts: list[tuple[int, str]] = []
        self.tags = 0

    def cut(self) -> None:
        if any(data.strip() for _, data in self.parts):
            # the innermost open element that is not inline
            self.lines.append((self.open[self.blocks[-1]], self.parts, self.tags))
            self.linked.append(self.in_links)
            self.tags = 0
        self.parts, self.in_links = [], 0

    def place(self, tag: str) -> int:
        """Where the innermost open element of that name stands; 0 if there is none."""
        found = self.places.get(tag)
        return found[-1] if found else 0

    def push(self, tag: str, area: int) -> None:
        self.nodes.append((self.open[-1], tag, area))
        at = len(self.open)
        self.open.append(len(self.nodes) - 1)
        self.places.setdefault(tag, []).append(at)
        if tag in SCOPES:
            self.scopes.append(at)
        if tag not in INLINE:
            self.blocks.append(at)

    def leave(self, at: int) -> None:
        """Close the open element at a place and all inside it."""
        for n in self.open[at:]:
            self.places[self.nodes[n][1]].pop()
        del self.open[at:]
        for places in (self.scopes, self.blocks):
            while places[-1] >= at:
                places.pop()

    def known(self, tag: str) -> str:
        """The name that counts: a label outside of forms is a part of its sentence."""
        return "span" if tag == "label" and not any(map(self.place, WRAPPERS)) else tag

    def kind(self, tag: str, attributes: list[tuple[str, str | None]]) -> int:
        """The kind of area that an element opens; PAGE if it opens none."""
        if tag in SILENT or tag in CONTROLS:
            return NEVER
        if tag in ("html", "body", "article", "main"):
            return PAGE
        found = PAGE
        if tag in BESIDE or tag == "header" and not self.place("article") and not self.place("main"):
            found = ASIDE
        elif tag in WRAPPERS:
            found = WRAPPER
        for name, value in attributes:
            if name in ("class", "id", "role") and value:
                for token in value.lower().split():
                    words = SPLIT.split(token)
                    if words[0] not in ABOUT and (ADVERTS if tag in INLINE else NAMED).intersection(words):
                        # a word among others may tell about a neighbour or a state
                        found = max(found, ASIDE if token in NAMED else WRAPPER)
            if name == "hidden" or name == "aria-hidden" and value == "true":
                return NEVER
            if name == "style" and value and "display:none" in value.replace(" ", "").lower():
                return NEVER
        return found

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        tag = self.known(tag)
        if tag == "br":
            self.parts.append((self.nodes[self.open[-1]][2], " "))
            return
        if tag not in INLINE:
            self.cut()
            closes = CLOSES.get(tag, set()) | ({"p"} if tag in PARAGRAPH_ENDS else set())
            at = max(map(self.place, closes), default=0)
            if at and at >= self.scopes[-1]:
                self.leave(at)
        if tag not in VOID:
            area = self.nodes[self.open[-1]][2]
            kind = NEVER if self.areas[area][1] == NEVER else self.kind(tag, attrs)
            if kind != PAGE and self.areas[area][1] != NEVER:
                self.areas.append((area, kind))
                area = len(self.areas) - 1
            self.push(tag, area)

    def parse_comment(self, i, report=True):
        return COMMENT.match(self.rawdata, i).end()

    def parse_html_declaration(self, i):
        if not self.rawdata.startswith("<![", i):
            return super().parse_html_declaration(i) if self.rawdata.find(">", i) >= 0 else len(self.rawdata)
        # a comment up to the next '>', or up to ']]>' for character data of SVG and MathML; the page comes in one piece
        foreign = self.rawdata.startswith("<![CDATA[", i) and (self.place("svg") or self.place("math"))
        end = "]]>" if foreign else ">"
        at = self.rawdata.find(end, i + 3)
        return len(self.rawdata) if at < 0 else at + len(end)

    def handle_startendtag(self, tag, attrs):
        # HTML knows no self-closing elements besides the void ones
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in VOID:
            return
        if not self.place(tag):
            tag = self.known(tag)
        if tag not in INLINE:
            self.cut()
        at = self.place(tag)
        # a stray inline or paragraph end closes nothing around it
        if at and (at > self.scopes[-1] or tag not in INLINE and tag != "p"):
            self.leave(at)

    def handle_data(self, data):
        _, tag, area = self.nodes[self.open[-1]]
        if tag not in SILENT:
            self.parts.append((area, data))
            if self.place("a"):
                self.in_links += len(data.strip())

    def close(self):
        super().close()
        self.cut()


def smoothed(values: list[float], reach: int = SMOOTHING) -> list[float]:
    weights = [math.exp(-(k * k) / 2) for k in range(-reach, reach + 1)]
    out = []
    for i in range(len(values)):
        own = [(w, values[i + k]) for k, w in zip(range(-reach, reach + 1), weights) if 0 <= i + k < len(values)]
        out.append(sum(w * v for w, v in own) / sum(w for w, _ in own))
    return out


def read_lines(page: _Lines, shown: set[int]) -> list[tuple[int, str, int, int]]:
    """Lines (node, text of the areas shown, tags, characters); lines without any count their other characters."""
    out = []
    for node, parts, tags in page.lines:
        text = " ".join("".join(data for area, data in parts if area in shown).split())
        out.append((node, text, tags, len(text) or sum(len(data.strip()) for area, data in parts if area not in shown)))
    return out


def content_lines(lines: list[tuple[int, str, int, int]]) -> list[int]:
    """Indices of the lines whose smoothed ratio reaches the standard deviation of all."""
    ratios = smoothed([characters / max(1, tags) for _, _, tags, characters in lines])
    mean = sum(ratios) / len(ratios)
    bound = math.sqrt(sum((r - mean) ** 2 for r in ratios) / len(ratios))
    return [i for i, r in enumerate(ratios) if r >= bound]


def marked(nodes: list[tuple[int, str, int]]) -> list[int]:
    """For each node the innermost article or main around or at it, or -1."""
    out = []
    for n, (parent, tag, _) in enumerate(nodes):
        out.append(n if tag in ("article", "main") else out[parent] if parent >= 0 else -1)
    return out


def shown_areas(page: _Lines, lines: list[tuple[int, str, int, int]]) -> set[int]:
    """The area with most of the running text and those around it.

    What stands beside an article counts with its heaviest article or main element only, unless it has a first
    heading. A wrapper that has no such element gives way to article elements of the page itself that hold a
    fourth of its text.
    """
    around, total, own = marked(page.nodes), [0] * len(page.areas), {}
    for i in content_lines(lines):
        at = around[lines[i][0]]
        for area, data in page.lines[i][1]:
            size = len(data.strip())
            total[area] += size
            if at >= 0 and page.nodes[at][2] == area:
                own[at] = own.get(at, 0) + size
    best, inside = [0] * len(page.areas), [0] * len(page.areas)
    for at, weight in own.items():
        area = page.nodes[at][2]
        best[area], inside[area] = max(best[area], weight), inside[area] + weight
    headed = {area for _, tag, area in page.nodes if tag == "h1"}
    chosen, most = 0, total[0]
    for area, (_, kind) in enumerate(page.areas):
        weight = 0 if kind in (PAGE, NEVER) else total[area] if kind == WRAPPER or area in headed else best[area]
        if weight > most and (inside[area] or OUTWEIGHS * inside[0] < weight):
            chosen, most = area, weight
    shown = set()
    while chosen >= 0:
        shown.add(chosen)
        chosen = page.areas[chosen][0]
    return shown


def article(nodes: list[tuple[int, str, int]], lines: list[tuple[int, str, int, int]]) -> tuple[int, int]:
    """The element that holds all content lines, and the line of the headline before it (or one past all lines).

    A main element with over half of the content text, or article elements with over half of it together, stand
    for the page; an article or main element is not cut into.
    """
    content = [i for i in content_lines(lines) if lines[i][1]]
    weight = sum(len(lines[i][1]) for i in content)
    depth, around, scopes = [], marked(nodes), {"main": [], "article": []}
    for n, (parent, tag, _) in enumerate(nodes):
        depth.append(depth[parent] + 1 if parent >= 0 else 0)
        scopes["main"].append(tag == "main" or parent >= 0 and scopes["main"][parent])
        scopes["article"].append(tag == "article" or parent >= 0 and scopes["article"][parent])
    for tag in ("main", "article"):
        own = [i for i in content if scopes[tag][lines[i][0]]]
        if 2 * sum(len(lines[i][1]) for i in own) > weight:
            content = own
            break
    top = lines[content[0]][0] if content else 0
    # all of these lie under the element in the end, so no way up is gone twice
    under = {top}
    for i in content[1:]:
        node = lines[i][0]
        while node not in under:
            if depth[node] > depth[top]:
                under.add(node)
                node = nodes[node][0]
            else:
                top = nodes[top][0]
                under.add(top)
    if around[top] >= 0:
        top = around[top]
        return top, headline(nodes, lines, top, scopes["main"])
    # a block of running text has its neighbours around it
    if any(lines[i][0] == top for i in content) and top:
        top = nodes[top][0]
    while top and nodes[top][1] not in CONTAINERS:
        top = nodes[top][0]
    return top, headline(nodes, lines, top, scopes["main"])


def headline(nodes: list[tuple[int, str, int]], lines: list[tuple[int, str, int, int]], top: int, in_main: list[bool]) -> int:
    """The line of the highest heading before the element, the last of that level; one past all lines if there is none.

    An element with a first heading has its headline; an article or main element with any heading has it too, and
    one inside a main element takes it from there only.
    """
    inside, marked_up = within(nodes, top), nodes[top][1] in ("article", "main")
    first = next((i for i, line in enumerate(lines) if inside[line[0]]), 0)
    own = HEADINGS if marked_up and not in_main[nodes[top][0]] else {"h1"}
    if any(text and inside[node] and nodes[node][1] in own for node, text, *_ in lines):
        return len(lines)
    before = [i for i in range(first) if lines[i][1] and nodes[lines[i][0]][1] in HEADINGS
              and (in_main[lines[i][0]] or not in_main[top])]
    least = min((nodes[lines[i][0]][1] for i in before), default="")
    return next((i for i in reversed(before) if nodes[lines[i][0]][1] == least), len(lines))


def within(nodes: list[tuple[int, str, int]], top: int) -> list[bool]:
    inside = [False] * len(nodes)
    for n, (parent, _, _) in enumerate(nodes):
        inside[n] = n == top or parent >= 0 and inside[parent]
    return inside


def menus(page: _Lines, lines: list[tuple[int, str, int, int]]) -> list[bool]:
    """For each node whether it is in an element that says little but links, with no content line and no heading in it.

    Articles and main elements have none: their authors put the links there.
    """
    size, linked, kept = ([0] * len(page.nodes) for _ in range(3))
    content = set(content_lines(lines))
    for i, (node, text, *_) in enumerate(lines):
        size[node] += len(text)
        linked[node] += min(len(text), page.linked[i])
        kept[node] += bool(text) and page.linked[i] * 2 < len(text) and (i in content or page.nodes[node][1] in HEADINGS)
    for n in range(len(page.nodes) - 1, 0, -1):
        parent = page.nodes[n][0]
        size[parent] += size[n]
        linked[parent] += linked[n]
        kept[parent] += kept[n]
    around, out = marked(page.nodes), []
    for n, (parent, tag, _) in enumerate(page.nodes):
        own = tag in LISTS and around[n] < 0 and not kept[n] and 2 * linked[n] > size[n]
        out.append(own or parent >= 0 and out[parent])
    return out


def main_text(html: str) -> str:
    """The article's blocks, joined by two line feeds; empty if the page has no text.

    A tag or comment that the page's end cuts off is dropped.
    """
    page = _Lines()
    after = html.rfind(">") + 1
    cut = OPENING.search(html, after)
    page.feed(html[: cut.start()] if cut else html)
    page.close()
    if not page.lines:
        return ""
    lines = read_lines(page, {0})
    shown = shown_areas(page, lines)
    if len(shown) > 1:
        lines = read_lines(page, shown)
    top, begin = article(page.nodes, lines)
    inside, out, begun, links = within(page.nodes, top), [], False, menus(page, lines)
    if all(links[node] for node, text, *_ in lines if text and inside[node]):
        links = [False] * len(links)
    for i, (node, text, *_) in enumerate(lines):
        begun = begun or inside[node]
        if text and not links[node] and (inside[node] or i >= begin and not begun):
            out.append(text)
    return "\n\n".join(out)


def extracted(html: Column) -> Column:
    @F.pandas_udf("string")
    def column(pages: pd.Series) -> pd.Series:
        return pages.map(main_text)

    return column(html)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page; null and empty pages have an empty text.

    Broken markup is read as browsers read it; page_id and url pass through, null or repeated.
    """
    bounded_batches(pages.sparkSession)
    made = pages.select("page_id", "url", extracted(text_of("html")).alias("text"))
    return made.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


travels(__name__)
