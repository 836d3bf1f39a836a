"""Main text of web pages by site style trees.

A page is read into a tree of elements.  The pages of a host are merged: nodes with the same path of tags and classes are one
node of the site's tree, and for each of them the pages' different contents are counted.  The importance of a node is the
entropy of its content over the pages, from 0 (the same on every page) to 1 (different on each): for a presentation node
(a branch) over the sequences of child elements and what is below it, for a content node over its texts.  Branches of low importance
are cut from each page; so are branches whose markup says what they are (menus, headers, footers, forms, scripts, adverts, comments
and the like).  What the page itself marks as its article is not judged by entropy, so that passages many pages share stay in.

Equal pages of a host are one page to the entropies, however many urls they have, and few pages are weak evidence: importance is
drawn towards 1 as if ``PRIOR`` more pages had each had a content of their own.

The sums behind the entropies are additive: they are counted by host, node and content in tasks before they are shuffled,
so that a host with a third of all pages is no heavier than its different contents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigia.llm.common import annotate, free_name, slices, stored
from vigia.llm.urlfilter import host_of

#: Branches of less importance are cut; pages that importance is drawn towards 1 by.
LEAST, PRIOR = 0.3, 3
#: Elements nested deeper have no style nodes of their own; they mean what they mean all the same.
DEEPEST = 512
#: A style node whose pages have, on average, more links than this in their text is a menu.
LINKED = 0.6

#: HTML's elements by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript plaintext".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form
    frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table
    caption tbody td tfoot th thead tr ul""".split())
DROPPED = frozenset("""script style noscript template head title nav footer aside form button select textarea input iframe object embed
    svg canvas audio video map dialog menu math applet noembed noframes xmp search datalist""".split())
CLOSES_P = BLOCK - {"body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "legend", "option", "optgroup"}
#: Words of a class, id or role that name what is not the article.
NOT_TEXT = frozenset("""ad ads adv advert adverts advertisement advertising banner promo promos promotion sponsor sponsored
    nav navbar navigation menu menus breadcrumb breadcrumbs pager pagination toc sidebar sidebars aside rail widget widgets
    header masthead topbar toolbar footer footers foot bottom colophon copyright cookie cookies consent gdpr notice notices alert
    popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended
    comment comments commentlist disqus reply replies respond discussion form search skip hidden""".split())
#: Within an article only these elements are taken for something else, and only by a whole class, id or role that names it.
HOLDERS = frozenset("div section ul ol dl table details fieldset figure center".split())
NAMES_OTHERS = NOT_TEXT - {"header", "bottom", "foot", "search", "skip", "hidden", "reply", "replies", "respond", "discussion", "alert", "overlay", "aside"}
#: Words that name the article.
IS_TEXT = frozenset("article post entry story".split())
#: Elements that the standard closes when another one opens: what opens -> what it closes, and where to stop looking.
_ITEMS = {"li": (frozenset({"li"}), frozenset({"ul", "ol", "menu", "dir"})), "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
          "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})), "tr": (frozenset({"tr", "td", "th"}), frozenset({"table"})),
          "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})), "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
          "option": (frozenset({"option"}), frozenset({"select", "datalist"}))}
_P = frozenset({"p"})
_BARRIER = frozenset({"table", "td", "th", "html", "body", "template", "object", "button", "applet", "marquee", "caption"})

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?>[^>\"'=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|[\"'=])*+)>", re.S)
#: A name and, after an equals sign, its value.
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@lru_cache(maxsize=65536)
def _described(tag: str, attributes: str, inside: bool = False) -> tuple[str, bool, bool]:
    """Style of an element (tag and classes), whether its markup says it is no text, and whether it says it is the article.

    ``inside`` an article, a word in a name is not enough: the name has to be that of a menu, an advert, the comments and so on.
    """
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(attributes):
        found.setdefault(name.lower(), unescape(value[1:-1] if value[:1] in "\"'" and value[:1] else value))
    classes = sorted(set(found.get("class", "").split()))
    style = ".".join([tag, *classes])
    words = {w.lower() for key in ("class", "id", "role") for w in _NAME.findall(found.get(key, ""))}
    article = tag in ("article", "main") or bool(words & IS_TEXT) and tag in ("div", "section", "td")
    hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true" or re.search(
        r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I) is not None
    if inside:
        names = {w.lower() for key in ("class", "id", "role") for w in found.get(key, "").split()}
        named = tag in HOLDERS and bool(names & NAMES_OTHERS)
    else:
        named = tag not in ("body", "html", "article", "main") and bool(words & NOT_TEXT)
    return style, tag in DROPPED or hidden or named, article


class Block(NamedTuple):
    """A run of text between block boundaries."""

    #: Styles of the block elements around it, outermost first.
    path: tuple[str, ...]
    text: str
    #: How many elements of the path stand around the article that it is in and including it; 0 outside.
    article: int
    #: Share of its characters that are in links.
    linked: float


def _end_of(tag: str, html: str, at: int) -> int:
    """Where an element whose content is no markup ends."""
    stop = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(html, at)
    closing = html.find(">", stop.end()) if stop else -1
    return len(html) if closing < 0 else closing + 1


class _Open:
    """The elements open at a place of a page."""

    def __init__(self):
        self.tags: list[str] = []
        self.styles: list[str] = []
        self.no_text: list[bool] = []
        self.articles: list[bool] = []
        #: How many of them are no text, are links, and are articles.
        self.silent = self.anchors = self.inside = 0

    def push(self, tag: str, style: str, no_text: bool, article: bool) -> None:
        self.tags.append(tag)
        self.styles.append(style)
        self.no_text.append(no_text)
        self.articles.append(article)
        self.silent += no_text
        self.anchors += tag == "a"
        self.inside += article

    def cut(self, part: slice) -> None:
        self.silent -= sum(self.no_text[part])
        self.anchors -= self.tags[part].count("a")
        self.inside -= sum(self.articles[part])
        for held in (self.tags, self.styles, self.no_text, self.articles):
            del held[part]

    def last(self, wanted: frozenset[str], barrier: frozenset[str]) -> int:
        """The innermost open element among ``wanted`` inside the innermost of ``barrier``; -1 if there is none."""
        for k in range(len(self.tags) - 1, -1, -1):
            if self.tags[k] in wanted:
                return k
            if self.tags[k] in barrier:
                break
        return -1

    def make_room(self, tag: str) -> None:
        """Closes what the start of a block element closes."""
        if tag in CLOSES_P:
            k = self.last(_P, _BARRIER)
            if k >= 0:
                self.cut(slice(k, None))
        if tag in _ITEMS:
            wanted, barrier = _ITEMS[tag]
            while (k := self.last(wanted, barrier)) >= 0:
                self.cut(slice(k, None))

    def close(self, tag: str) -> None:
        """Handles an end tag: a block's closes all inside it, an inline element's only itself."""
        if tag not in self.tags:
            return
        k = len(self.tags) - 1 - self.tags[::-1].index(tag)
        if tag in BLOCK or not any(t in BLOCK for t in self.tags[k + 1:]):
            self.cut(slice(k, None))
        else:
            self.cut(slice(k, k + 1))

    def block(self, pieces: list[str], links: list[bool]) -> Block | None:
        joined = "".join(pieces)
        text = " ".join((unescape(joined) if "&" in joined else joined).split())
        if not text:
            return None
        path, article = [], 0
        for tag, style, own in zip(self.tags, self.styles, self.articles, strict=True):
            if tag in BLOCK and len(path) < DEEPEST:
                path.append(style)
            article = article or own and max(1, len(path))
        linked = sum(len(p) for p, a in zip(pieces, links, strict=True) if a) / len(joined)
        return Block(tuple(path), text, int(article), linked)


def blocks(html: str) -> list[Block]:
    """The page's text blocks in order, without those whose markup says that they are no text.

    Elements are nested as browsers do for the common omissions of end tags: a block element closes an open paragraph, list items
    and table cells close each other, an end tag closes what is open inside, and one without a start is passed over.
    """
    out: list[Block] = []
    open_ = _Open()
    pieces: list[str] = []
    links: list[bool] = []

    def flush() -> None:
        if pieces:
            block = open_.block(pieces, links)
            if block:
                out.append(block)
            pieces.clear()
            links.clear()

    def say(text: str) -> None:
        if not open_.silent:
            pieces.append(text)
            links.append(open_.anchors > 0)

    at, size = 0, len(html)
    while at < size:
        mark = html.find("<", at)
        if mark < 0:
            mark = size
        if mark > at:
            say(html[at:mark])
        if mark == size:
            break
        found = _TOKEN.match(html, mark)
        if found is None:
            if html[mark + 1:mark + 2].isalpha():
                # A tag that never ends, which browsers drop to the end of the page.
                break
            say("<")
            at = mark + 1
            continue
        at = found.end()
        end, start, attributes = found.groups()
        if start:
            tag = start.lower()
            if tag == "br":
                say(" ")
                continue
            if tag in BLOCK:
                flush()
                open_.make_room(tag)
            if tag in RAW:
                at = _end_of(tag, html, at)
            elif tag not in VOID:
                open_.push(tag, *_described(tag, attributes, open_.inside > 0))
        elif end:
            tag = end.lower()
            if tag in BLOCK:
                flush()
            open_.close(tag)
    flush()
    return out


def _key(*parts: str) -> int:
    return xxhash.xxh64_intdigest("\x1f".join(parts).encode("utf-8", "replace")) - (1 << 63)


def contents(page: list[Block]) -> list[tuple[int, int, float]]:
    """(style node, content, linked share) of a page: for each node one content, hashed.

    A content node's content is its texts; a presentation node's is what its branch holds, child by child.
    """
    held: dict[tuple[str, ...], list[str]] = {}
    chars: dict[tuple[str, ...], list[float]] = {}
    for block in page:
        # What is in an article is never cut; only the branches around it need to be known.
        for depth in range(1, 1 + (block.article or len(block.path))):
            if block.path[depth - 1].partition(".")[0] in ("html", "body"):
                continue
            node = block.path[:depth]
            below = block.path[depth] if depth < len(block.path) else "#"
            held.setdefault(node, []).append(f"{below}\x1e{block.text}")
            total = chars.setdefault(node, [0.0, 0.0])
            total[0] += len(block.text)
            total[1] += len(block.text) * block.linked
    return [(_key(*node), _key(*texts), chars[node][1] / chars[node][0]) for node, texts in held.items()]


def whole(page: list[Block]) -> int:
    """A hash of all that a page's blocks hold, the same for its copies."""
    return _key(*(part for block in page for part in (*block.path, "\x1e", block.text, "\x1e")))


def main_text(page: list[Block], cut: set[int]) -> str:
    """The blocks of a page, one line each; those below a style node of ``cut`` go unless they are in an article."""
    return "\n".join(block.text for block in page if block.article or not cut or not any(
        _key(*block.path[:depth]) in cut for depth in range(1, len(block.path) + 1)))


def style_trees(pages: DataFrame) -> DataFrame:
    """(host, node) of the branches of low importance, from ``pages`` (host, html).

    With ``m`` different pages that have a node, content ``c`` on ``n_c`` of them has the share ``n_c / m``; importance is the entropy of
    these shares to the base ``m``, averaged with ``PRIOR`` pages of importance 1 (and without links).
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, htmls = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for part in slices(htmls):
                read = [blocks(html or "") for html in htmls[part]]
                found = [(h, whole(page), *c) for h, page in zip(hosts[part], read, strict=True) for c in contents(page)]
                columns = list(zip(*found, strict=True)) or [[]] * 5
                types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types, strict=True)],
                                                 names=["host", "page", "node", "content", "linked"])

    rows = pages.select("host", "html").mapInArrow(count, "host string, page bigint, node bigint, content bigint, linked double")
    once = rows.groupBy("host", "page", "node", "content").agg(F.min("linked").alias("linked"))
    each = once.groupBy("host", "node", "content").agg(F.count(F.lit(1)).alias("n"), F.sum("linked").alias("linked"))
    nodes = each.groupBy("host", "node").agg(
        F.sum("n").alias("m"), F.sum(F.col("n") * F.log("n")).alias("s"), F.sum("linked").alias("linked"))
    importance = F.when(F.col("m") > 1, (F.log("m") - F.col("s") / F.col("m")) / F.log("m")).otherwise(1.0)
    seen = F.col("m") + PRIOR
    low = ((importance * F.col("m") + PRIOR) / seen < LEAST) | (F.col("linked") / seen > LINKED)
    return nodes.where(low).select("host", "node")


def extract(df: DataFrame, *, html: str = "html", url: str = "url", text: str = "text", length: str = "n_chars",
            keep_html: bool = True) -> DataFrame:
    """``df`` with the main text of the whole column ``html`` and its number of code points.

    Character references are decoded, white space within a block is one space, blocks are joined by line feeds in page
    order.  A NULL or empty page has an empty text, and so has one of nothing but its host's template.  Very long pages are read to the end.  Pages without a host share the empty one.  Repeated rows get the same text;
    an empty table gives no rows.  Columns named like a new one are replaced, all others kept (``html`` only if ``keep_html``).
    """
    host = free_name(df, "host")
    pages = df.withColumn(host, host_of(F.coalesce(F.col(url).cast("string"), F.lit(""))))
    cut = stored(style_trees(pages.select(F.col(host).alias("host"), F.col(html).alias("html"))), "style-nodes")
    # A host has as many low nodes as its templates have branches, which its own pages bound; all hosts together do not fit
    # a task, so they come by join.
    by_host = cut.groupBy("host").agg(F.collect_list("node").alias("nodes"))
    nodes = free_name(pages, "nodes")
    joined = pages.join(by_host.select(F.col("host").alias(host), F.col("nodes").alias(nodes)), host, "left")
    return _extracted(joined, html, nodes, text, length, keep_html).drop(host)


def _extracted(df: DataFrame, html: str, nodes: str, text: str, length: str, keep_html: bool) -> DataFrame:
    """``df`` with texts, the nodes to cut being in the column ``nodes``, without that column."""
    both = free_name(df, "page")
    packed = df.withColumn(both, F.concat(F.coalesce(F.array_join(F.transform(nodes, lambda n: n.cast("string")), " "), F.lit("")),
                                          F.lit("\n"), F.coalesce(F.col(html).cast("string"), F.lit("")))).drop(nodes)
    packed = packed if keep_html else packed.drop(html)

    def make():
        def work(pages):
            texts = []
            for page in pages:
                cut, _, source = page.partition("\n")
                texts.append(main_text(blocks(source), set(map(int, cut.split()))))
            return {text: texts, length: np.array([len(t) for t in texts], dtype=np.int64)}

        return work

    return annotate(packed, both, make, {text: "string", length: "bigint"}).drop(both)
