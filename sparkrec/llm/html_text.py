"""Main text of web pages by tag-path ratios.

A page is read once into text blocks, each with the path of block elements from the root (tag and
class names). Per path, text length and punctuation are added up and divided by its number of
blocks. The two ratios are smoothed along the page, fused by multiplication, and
paths that reach a share of the page's best value are content paths. The content node
is the lowest element around all text on content paths. It grows to the element around it as long as
that adds only headings, sentences before it and paragraphs beside it, and to an enclosing article or main
element. All its blocks in page order are the text, lists of links too. Elements that
are no article by their kind (menus, forms, asides, ...) or by their names (adverts,
notices, comments, ...) take no part; where names would leave nothing, those around the best path do not
count. Where the content node is the page itself, its parts that are mostly links and hold no
content path are left out.

Each page is a row of its own: nothing is shuffled or gathered, and pages are read whole.

Defined results: NULL or empty html, and pages without text, give an empty string and 0; broken markup is
read as far as it goes (open elements end with the page, unmatched end tags are skipped);
repeated rows give repeated results; other columns are not read; paths of equal score are all content paths;
pages of any length are read whole.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

# Kinds of elements.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol optgroup option p pre section select summary table tbody td "
    "tfoot th thead tr ul button label legend head".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math canvas object audio video".split())
BREAKS = frozenset(("br", "wbr", "img"))
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead"}}
NO_ARTICLE = frozenset("nav aside footer form button select label legend dialog menu head option fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ARTICLE_TAGS = frozenset(("article", "main"))
TEXTUAL = frozenset(("p", "li", "ul", "ol", "dl", "dt", "dd", "blockquote", "pre", *HEADINGS))  # parts of a text, never all of it
WHOLE = frozenset(("", "html", "body"))
# Parts of class, id and role names of what is no article, and of what is.
NO_ARTICLE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|sponsor(?:ed)?|promos?|promotions?|banners?|sidebars?|side|aside|"
    r"widgets?|nav|navbar|navigation|menus?|breadcrumbs?|footers?|masthead|topbar|toolbar|cookies?|consent|gdpr|"
    r"notices?|alerts?|disclaimers?|newsletters?|subscribe|subscription|signup|login|register|popups?|modals?|overlays?|comments?|commentlist|"
    r"respond|replies|reply|disqus|discussion|related|recommended|recommendations?|more-stories|share|sharing|social|pagination|pager|"
    r"tags|tagcloud|search|skip-link|contentinfo|complementary|hidden|sr-only)(?:$|[\s_-])", re.I)
#: names that tell how an element is laid out, not what it is
LAYOUT_NAMES = re.compile(r"(?:^|(?<=\s))(?:has|no|with|without|overflow)[-_]\S+", re.I)
HEADER_NAMES = re.compile(r"(?:^|[\s_-])headers?(?:$|[\s_-])", re.I)
ARTICLE_NAMES = re.compile(r"(?:^|[\s_-])(?:article|post|entry|story|main|body)(?:$|[\s_-])", re.I)
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？¿¡\"“”«»]")
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*>|<[a-zA-Z][^>]*>", re.S)
NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)

SENTENCE = re.compile(r"[.!?…。！？:][\"”»)]*$")
SHARE, OWN, LINKED = 0.3, 0.05, 0.6  # of the best score; of the best ratios before smoothing; of a block's text
KERNEL = np.array([0.25, 0.5, 0.25])


@dataclass
class Element:
    tag: str
    parent: int
    path: str
    out: bool  # no part of an article, by itself or an element around it
    named: bool = False  # called an article
    by_kind: bool = False  # out by itself, whatever its names
    by_name: bool = False  # out by itself for its names


@dataclass
class Block:
    element: int
    text: str
    linked: int = 0  # characters inside links


@dataclass
class Page:
    elements: list[Element] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)


class Reader:
    """Builds the blocks of one page."""

    def __init__(self):
        self.page = Page([Element("", -1, "", False)])
        self.stack = [0]
        self.parts: list[str] = []
        self.linked, self.in_link = 0, False

    def text(self, raw: str) -> None:
        if raw:
            if "&" in raw:
                raw = references.unescape(raw)
            self.parts.append(raw)
            if self.in_link:
                self.linked += len(raw)

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.page.blocks.append(Block(self.stack[-1], text, self.linked))
            self.parts = []
        self.linked = 0

    def open(self, tag: str, rest: str) -> None:
        self.flush()
        self.in_link = False
        tags = self.page.elements
        if tags[self.stack[-1]].tag in ("p", *HEADINGS) and tag not in ("button", "select", "label"):
            self.stack.pop()
        while tags[self.stack[-1]].tag in CLOSED_BY.get(tag, ()):
            self.stack.pop()
        if tag in VOID:
            return
        around = tags[self.stack[-1]]
        found = {m[0].lower(): m[1] or m[2] or m[3] for m in NAMES.findall(rest)} if "=" in rest else {}
        names = " ".join(found.values())
        article = tag in ARTICLE_TAGS or bool(names and ARTICLE_NAMES.search(names))
        by_kind, by_name = tag in NO_ARTICLE or bool(rest and HIDDEN.search(rest)), False
        if tag not in ("html", "body", *ARTICLE_TAGS):
            by_name = bool(names and NO_ARTICLE_NAMES.search(LAYOUT_NAMES.sub("", names)))
        elif tag == "article" and names and re.search("comment|reply|promo|related|teaser", names, re.I):
            by_kind = True
        if (tag == "header" or HEADER_NAMES.search(names)) and not article:  # of the site, unless an article is around it
            by_kind = by_kind or not self._inside_article()
        label = tag + ("." + ".".join(sorted(found["class"].lower().split())) if found.get("class") else "")
        tags.append(Element(tag, self.stack[-1], f"{around.path}/{label}", around.out or by_kind or by_name, article, by_kind, by_name))
        self.stack.append(len(tags) - 1)

    def _inside_article(self) -> bool:
        return any(self.page.elements[e].named for e in self.stack)

    def close(self, tag: str) -> None:
        self.flush()
        self.in_link = False
        for at in range(len(self.stack) - 1, 0, -1):
            if self.page.elements[self.stack[at]].tag == tag:
                del self.stack[at:]
                return


def read_page(html: str) -> Page:
    """Elements and text blocks of a page, in one pass."""
    reader, at = Reader(), 0
    while (m := TAG.search(html, at)) is not None:
        reader.text(html[at:m.start()])
        at = m.end()
        name = m["name"]
        if not name:
            continue
        name = name.lower()
        if m["end"]:
            if name in BLOCKS:
                reader.close(name)
            elif name == "a":
                reader.in_link = False
        elif name in RAW:
            if not m["rest"].endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
                at = end.end() if end else len(html)
        elif name in BLOCKS:
            reader.open(name, m["rest"])
        elif name == "a":
            reader.in_link = True
        elif name in BREAKS:
            reader.text(" ")
    reader.text(html[at:])
    reader.flush()
    _readmit(reader.page)
    return reader.page


def _readmit(page: Page) -> None:
    """Names put nothing out that is around the article.

    Where no article or main element has text left, the names around the one with the most text do not
    count; on a page without any, where all text is out, those around the best path do not.
    """
    tags = page.elements
    if not any(e.by_name for e in tags):
        return
    barred = [False] * len(tags)  # by kind, by itself or around it
    inside = [0] * len(tags)  # the innermost article or main element around it
    for i, e in enumerate(tags[1:], 1):
        barred[i] = barred[e.parent] or e.by_kind
        inside[i] = i if e.tag in ARTICLE_TAGS else inside[e.parent]
    if any(inside[b.element] and not tags[b.element].out for b in page.blocks):
        return
    able = [b for b in page.blocks if not barred[b.element]]
    held: dict[int, int] = {}
    for b in able:
        if inside[b.element]:
            held[inside[b.element]] = held.get(inside[b.element], 0) + len(b.text) - b.linked
    if held:
        around = [max(held, key=held.get)]
    elif able and all(tags[b.element].out for b in page.blocks):
        scores = path_scores(page, able)
        best = max(scores, key=scores.get)
        around = [b.element for b in able if tags[b.element].path == best]
    else:
        return
    for e in around:
        while e > 0:
            tags[e].by_name = False
            e = tags[e].parent
    for e in tags[1:]:
        e.out = tags[e.parent].out or e.by_kind or e.by_name


def path_scores(page: Page, live: list[Block]) -> dict[str, float]:
    """Fused, smoothed ratios of text length and punctuation, per path."""
    paths = [page.elements[b.element].path for b in live]
    keys = {p: i for i, p in enumerate(dict.fromkeys(paths))}
    of = np.array([keys[p] for p in paths])
    length = np.array([max(0, len(b.text) - b.linked) for b in live], float)
    marks = np.array([len(PUNCTUATION.findall(b.text)) for b in live], float)
    nodes = np.bincount(of)
    fused, own = np.ones(len(live)), np.ones(len(nodes))
    for values in (length, marks + 1):
        ratio = np.bincount(of, values) / nodes
        own *= ratio
        fused *= np.convolve(np.pad(ratio[of], 1, mode="edge"), KERNEL, mode="valid")
    # neighbours lift a path, but not one that has next to nothing of its own
    mean = np.where(own >= OWN * own.max(), np.bincount(of, fused) / nodes, 0.0)
    return {p: float(mean[i]) for p, i in keys.items()}


def content_elements(page: Page, live: list[Block], scores: dict[str, float]) -> set[int]:
    """Elements with text on content paths."""
    least = SHARE * max(scores.values())
    return {b.element for b in live if scores[page.elements[b.element].path] >= least}


def content_node(page: Page, live: list[Block]) -> int:
    """The lowest element around all text on content paths, grown by what belongs to it."""
    tags = page.elements
    held = np.zeros(len(tags), int)
    for e in content_elements(page, live, path_scores(page, live)):
        held[e] = 1
    for e in range(len(tags) - 1, 0, -1):  # children come after their parents
        held[tags[e].parent] += held[e]
    node = int(np.flatnonzero(held == held[0])[-1])  # those that hold everything lie in each other
    while tags[node].tag in TEXTUAL:
        node = tags[node].parent
    node = _grown(page, live, node)
    up = node
    while up > 0:
        if tags[up].tag in ARTICLE_TAGS:
            return up
        up = tags[up].parent
    return node


def _under(page: Page, node: int) -> np.ndarray:
    inside = np.zeros(len(page.elements), bool)
    inside[node] = True
    for e in range(node + 1, len(page.elements)):
        inside[e] = inside[page.elements[e].parent]
    return inside


def _grown(page: Page, live: list[Block], node: int) -> int:
    """The node, or an element around it that adds only headings, leads before it and text of its own beside it."""
    tags = page.elements
    up = tags[node].parent
    while up > 0 and tags[up].tag not in WHOLE:
        held, around = _under(page, node), _under(page, up)
        first = next((i for i, b in enumerate(live) if held[b.element]), len(live))

        def joins(i: int, b: Block) -> bool:
            element = tags[b.element]
            if element.tag in HEADINGS:
                return True
            own = b.element == up or (element.parent == up and element.tag in TEXTUAL)
            return b.linked < LINKED * len(b.text) and (own or (i < first and bool(SENTENCE.search(b.text))))

        if not all(joins(i, b) for i, b in enumerate(live) if around[b.element] and not held[b.element]):
            break
        node, up = up, tags[up].parent
    return node


def _link_lists(page: Page, live: list[Block], inside: np.ndarray, node: int) -> set[int]:
    """Children of the node without content paths whose text is mostly links."""
    tags, top = page.elements, np.arange(len(page.elements))
    for e in range(node + 1, len(tags)):
        if inside[e] and tags[e].parent != node:
            top[e] = top[tags[e].parent]
    content = {int(top[e]) for e in content_elements(page, live, path_scores(page, live))}
    text, linked = np.zeros(len(tags), int), np.zeros(len(tags), int)
    for b in live:
        text[top[b.element]] += len(b.text)
        linked[top[b.element]] += b.linked
    lists = {int(t) for t in set(top[inside].tolist()) - content - {node} if text[t] and linked[t] >= LINKED * text[t]}
    return {e for e in range(len(tags)) if int(top[e]) in lists}


def main_text(html: str | None) -> str:
    """The article's text."""
    page = read_page(html or "")
    live = [b for b in page.blocks if not page.elements[b.element].out]
    if not live:
        return ""
    node = content_node(page, live)
    inside = _under(page, node)
    # only where no element smaller than the page holds the content may there be lists of links beside it
    dropped = _link_lists(page, live, inside, node) if page.elements[node].tag in WHOLE else set()
    return " ".join(b.text for b in live if inside[b.element] and b.element not in dropped)


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"page_id": b["page_id"], "url": b["url"], "text": [main_text(h) for h in b["html"]]})

    read = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce("html", F.lit("")).alias("html"))
    return read.mapInPandas(run, "page_id long, url string, text string").withColumn("n_chars", F.length("text").cast("long"))
