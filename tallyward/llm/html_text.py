"""Main text of web pages by composite text density.

A page is read into a tree of its elements, with the implied ends of HTML. What is never article text goes first: menus,
headers and footers (but the titled header of an article), sidebars, forms, scripts, styles and hidden parts. Containers that
call themselves adverts or notices go if links dominate in them or their density is below the threshold (see next),
unless they hold most of the text; those that call themselves reader comments go whatever they hold, and one line that
calls itself an advert goes in any case. Paragraphs and titles are no containers. Then every node gets its density: characters per tag, weighted by how little of them is link text
(see `_densities`). The node whose children's densities have the greatest sum, inside a `main` element if there is one, is the body of the article; the least
density on its path up to `body` is the threshold, and other subtrees of at least that density add their own
greatest-sum node. Inside an `article` or `main` element the whole element is taken, as it marks the article itself; on a
page that has one, only such elements are added.

Text is put out block by block in page order: references decoded, white space in a block made one space, ends trimmed,
blocks joined by a newline, empty blocks left out.

Defined results: null or empty html, and pages without text, give the empty text; html without tags is one block; tags
cut off by the end of the page are dropped, text before the end is kept; repeated rows are each extracted; an empty
table gives no rows; further columns are not read.
"""

from __future__ import annotations

import html as references
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import per_batch, text_of

MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z) | <!\[CDATA\[.*?(?:\]\]>|\Z) | <[!?][^>]*+(?:>|\Z)
      | <(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attributes>(?:[^=>]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+)(?:>|\Z)""",
    re.S | re.X,
)
ATTRIBUTE = re.compile(r"""([^\s=/]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"']+))?""")
NAME = re.compile(r"[a-z0-9]+")
#: Decimal references of many digits, which `int` may refuse; code points have seven at most.
LONG_REFERENCE = re.compile(r"&#(?=[0-9]{8})0*+([0-9]*+);?")
RAW_END = {t: re.compile(rf"</{t}\b[^>]*+(?:>|\Z)", re.I) for t in ("script", "style", "title", "textarea", "noscript", "iframe", "template", "xmp")}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements whose open element of one of these kinds ends where the key begins, up to one of the stops.
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"}), "tfoot": ({"tr", "td", "th", "thead", "tbody"}, {"table"}),
}
NOT_TEXT = set("head script style title noscript template iframe object svg math canvas audio video map nav aside footer form button select textarea input dialog menu".split())
NOT_TEXT_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
#: Parts of class names and ids that name such containers.
NOT_TEXT_NAMES = set(
    "ad ads adbox adslot adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments comentarios commentaires kommentare "
    "consent cookie cookies dfp discussion disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification "
    "pager pagination paywall popup promo promotion related replies respond share sharing sidebar signup social sponsor sponsored sponsors subscribe "
    "subscription toolbar widget widgets".split()
)
#: Those of reader comments, which go whatever they hold.
COMMENTS = set("comment comments comentarios commentaires kommentare discussion disqus replies respond".split())
#: Elements that may be a container by their name; others are one if blocks lie in them. Paragraphs and titles never are.
CONTAINERS = set("article aside details div dl figure form footer header main menu nav ol section table ul".split())
ADVERTS = set("ad ads adbox adslot adsense advert adverts advertisement advertising sponsor sponsored sponsors".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
KEEP = {"html", "body", "article", "main"}


def _unescaped(text: str) -> str:
    """References decoded; numbers beyond all code points become U+FFFD."""
    return references.unescape(LONG_REFERENCE.sub(lambda m: "\ufffd" if len(m[1]) > 7 else f"&#{m[1] or 0};", text) if "&#" in text else text)


class Page:
    """Elements in page order (parent before child) and what happens in that order."""

    def __init__(self, source: str) -> None:
        self.tags, self.parents, self.attributes = ["html"], [-1], [""]
        self.events: list[tuple[int, str | None]] = []  # (node, text), or (node, None) where a block begins or ends
        self._read(source)

    def _read(self, source: str) -> None:
        open_nodes, at, size = [0], 0, len(source)
        self._open = Counter()  # open elements of each kind, so that no stack is searched for one that is not there
        while at < size:
            found = MARKUP.search(source, at)
            self._text(open_nodes[-1], source[at : found.start() if found else size])
            if not found:
                return
            at = found.end()
            tag = found["tag"]
            if tag is None:
                continue
            tag = tag.lower()
            if found["end"]:
                self._end(open_nodes, tag)
                continue
            self._implied(open_nodes, tag)
            node = len(self.tags)
            self.tags.append(tag)
            self.parents.append(open_nodes[-1])
            self.attributes.append(found["attributes"])
            if tag in BLOCKS:
                self.events.append((node, None))
            if tag == "br":
                self.events.append((open_nodes[-1], " "))
            if tag in RAW_END:
                end = RAW_END[tag].search(source, at)
                at = end.end() if end else size
            elif tag not in VOID and not found["attributes"].rstrip().endswith("/") or tag in BLOCKS - VOID:
                open_nodes.append(node)
                self._open[tag] += 1

    def _text(self, node: int, text: str) -> None:
        if text:
            self.events.append((node, _unescaped(text)))

    def _close(self, open_nodes: list[int], depth: int) -> None:
        for node in reversed(open_nodes[depth:]):
            self._open[self.tags[node]] -= 1
            if self.tags[node] in BLOCKS:
                self.events.append((node, None))
        del open_nodes[depth:]

    def _end(self, open_nodes: list[int], tag: str) -> None:
        if tag in ("html", "body") or not self._open[tag]:
            return
        for depth in range(len(open_nodes) - 1, 0, -1):
            if self.tags[open_nodes[depth]] == tag:
                return self._close(open_nodes, depth)
            if tag not in BLOCKS and self.tags[open_nodes[depth]] in BLOCKS:  # an inline end does not end a block
                return None

    def _implied(self, open_nodes: list[int], tag: str) -> None:
        ends, stops = IMPLIED_END.get(tag, (set(), set()))
        if tag in BLOCKS and tag not in ("td", "th", "tr", "tbody", "thead", "tfoot"):
            ends, stops = ends | {"p"}, stops | ({"table", "td", "th", "button", "object"} if not ends else set())
        if not any(self._open[kind] for kind in ends):
            return
        for depth in range(len(open_nodes) - 1, 0, -1):
            kind = self.tags[open_nodes[depth]]
            if kind in stops:
                return
            if kind in ends:
                self._close(open_nodes, depth)
                if tag not in ("tr", "tbody", "tfoot"):
                    return


def _dropped(page: Page) -> tuple[list[bool], list[int]]:
    """Whether a node is, or lies in, something that is no article text; and the containers that only call themselves so."""
    size = len(page.tags)
    holds, titled, holds_main = [False] * size, [False] * size, [False] * size  # an article or main element, a heading, a main element
    for node in range(size - 1, 0, -1):
        if titled[node] or page.tags[node] in HEADINGS:
            titled[page.parents[node]] = True
        if holds[node] or page.tags[node] in ("article", "main"):
            holds[page.parents[node]] = True
        if holds_main[node] or page.tags[node] == "main":
            holds_main[page.parents[node]] = True
    called = []
    holds_blocks = {parent for tag, parent in zip(page.tags, page.parents, strict=True) if tag in BLOCKS}
    dropped, in_article = [False] * size, [False] * size
    for node in range(1, size):
        tag, parent = page.tags[node], page.parents[node]
        in_article[node] = in_article[parent] or tag in ("article", "main")
        dropped[node] = dropped[parent] or tag in NOT_TEXT or tag == "header" and not holds[node] and not (in_article[node] and titled[node])
        if not dropped[node] and page.attributes[node].strip(" /") and tag not in ("html", "body", "main") and not holds_main[node]:
            given = {k.lower(): (v or "").strip("\"'").lower() for k, v in ATTRIBUTE.findall(page.attributes[node])}
            words = set(NAME.findall(f"{given.get('class', '')} {given.get('id', '')}"))
            named = bool(words & NOT_TEXT_NAMES) and not words & {"no", "has", "with", "without"}
            style = given.get("style", "").replace(" ", "")
            unseen = "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style
            container = tag in CONTAINERS or node in holds_blocks and tag not in HEADINGS and tag != "p"
            if named and container and words & COMMENTS:
                dropped[node] = True
            elif tag != "article" and not holds[node]:
                advert = named and bool(words & ADVERTS) and node not in holds_blocks
                dropped[node] = unseen or advert or given.get("role", "") in NOT_TEXT_ROLES
                if named and container and not dropped[node]:
                    called.append(node)
    return dropped, called


def _without(page: Page, dropped: list[bool], called: list[int]) -> list[bool]:
    """`dropped`, with those of the called containers that are no article by their text either."""
    if not called:
        return dropped
    density, chars, links = _densities(page, dropped)
    threshold = _path(page, density)[1]
    gone = {n for n in called if 2 * links[n] > chars[n] or density[n] < threshold and 2 * chars[n] <= chars[0]}
    out = dropped[:]
    for node in range(1, len(page.tags)):
        out[node] = dropped[node] or out[page.parents[node]] or node in gone
    return out


def _densities(page: Page, dropped: list[bool]) -> tuple[list[float], list[int], list[int]]:
    """Characters per tag of each node, times the logarithm of its (characters / link characters) * (tags / link tags),
    to a base that grows with the share of links in the node and in the page. Also its characters and link characters."""
    size = len(page.tags)
    chars, links, tags, link_tags = [0] * size, [0] * size, [0] * size, [0] * size
    linked = [False] * size
    for node in range(1, size):
        linked[node] = linked[page.parents[node]] or page.tags[node] == "a"
    for node, text in page.events:
        if text and not dropped[node]:
            n = sum(map(len, text.split()))
            chars[node] += n
            links[node] += n if linked[node] else 0
    for node in range(size - 1, 0, -1):
        if not dropped[node]:
            up = page.parents[node]
            chars[up] += chars[node]
            links[up] += links[node]
            tags[up] += tags[node] + 1
            link_tags[up] += link_tags[node] + (page.tags[node] == "a")
    share = links[0] / max(1, chars[0])
    out = [0.0] * size
    for node in range(size):
        if chars[node] and not dropped[node]:
            base = math.log(chars[node] / max(1, chars[node] - links[node]) * links[node] + share * chars[node] + math.e)
            ratio = chars[node] / max(1, links[node]) * max(1, tags[node]) / max(1, link_tags[node])
            out[node] = chars[node] / max(1, tags[node]) * max(0.0, math.log(ratio) / math.log(max(base, 1.0001)))
    return out, chars, links


def _path(page: Page, density: list[float]) -> tuple[int, float, list[float]]:
    """The node of the greatest sum, the least density on its path up to `body`, and the sums."""
    size, parents = len(page.tags), page.parents
    below, in_main = [0.0] * size, [False] * size
    for node in range(1, size):
        below[parents[node]] += density[node]
        in_main[node] = in_main[parents[node]] or page.tags[node] == "main"
    sums = [below[i] or density[i] for i in range(size)]  # a node without element children stands for its own text
    inside = [i for i in range(size) if in_main[i] and sums[i]]  # what a page calls its main part has its article
    best = max(inside or range(size), key=lambda i: (sums[i], -i))
    if not sums[best]:
        best = 0
    threshold, node = density[best], best
    while parents[node] > 0 and page.tags[node] != "body":
        node = parents[node]
        threshold = min(threshold, density[node])
    return best, threshold, sums


def _chosen(page: Page, dropped: list[bool]) -> list[bool]:
    """Whether a node belongs to the article."""
    size, parents, density = len(page.tags), page.parents, _densities(page, dropped)[0]
    best, threshold, sums = _path(page, density)
    marked = {best}
    own = [i for i in range(size) if page.tags[i] in ("article", "main") and not dropped[i]]
    if own:
        marked |= {i for i in own if density[i] >= threshold > 0}
    else:
        top = list(range(size))  # the greatest-sum node of each subtree
        for node in range(size - 1, 0, -1):
            if sums[top[node]] > sums[top[parents[node]]] and not dropped[node]:
                top[parents[node]] = top[node]
        marked |= {top[i] for i in range(1, size) if not dropped[i] and density[i] >= threshold > 0 and density[i]}
    lifted = set()
    for node in marked:
        outer, up = node, node
        while up >= 0:
            if page.tags[up] in ("article", "main"):
                outer = up
            up = parents[up]
        lifted.add(outer)
    inside = [False] * size
    for node in range(size):
        inside[node] = not dropped[node] and (node in lifted or parents[node] >= 0 and inside[parents[node]])
    return inside


def main_text(source: str) -> str:
    """The article's text of one page."""
    page = Page(source)
    inside = _chosen(page, _without(page, *_dropped(page)))
    blocks, words = [], []
    for node, text in page.events:
        if text is None:
            if words and (block := " ".join("".join(words).split())):
                blocks.append(block)
            words = []
        elif inside[node]:
            words.append(text)
    if words and (block := " ".join("".join(words).split())):
        blocks.append(block)
    return "\n".join(blocks)


def page_texts(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Main text of each page and its length."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(h) for h in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), text_of(html).alias("html"))
    return rows.mapInArrow(per_batch(make), "page_id long, url string, text string, n_chars long")
