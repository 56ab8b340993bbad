"""Main text of web pages, with site template removal.

1. Each page is parsed once (Arrow batches, the standard library's parser).
   Elements that are never main text are left out: scripts, styles, menus,
   headers, footers, sidebars, notices, adverts, forms and reader comments, by
   tag, role or class.  A class or id word, or a form, is only a sign: an element
   that holds the page's main or most of its article's or of its own text is layout
   (``class="wrap with-sidebar"``) and stays, which is decided after parsing;
   names that begin with has-, no-, with- and the like say nothing.  If the page
   has an article (else a main) element, the rest of the page goes too; an
   article is never lost to such signs alone.  What stays is a list of text
   blocks, and the containers round them as ranges of blocks, each with a hash of
   its tag, class and whole content (from its blocks' and inner containers'
   hashes, so that depth costs nothing).
2. Spark counts, for each host, on how many different pages a container's hash
   occurs; pages with the same text are one.  A container that is on
   ``min_pages`` of them and on ``min_share`` of the host's different pages, or
   more, is site template; ``many_pages`` are enough on a host of any size.
3. Blocks inside template containers are deleted, but for containers that hold
   the whole text of the page.  Paragraphs, headings and
   list items of an article count as text, not as containers: a sentence that
   several articles share stays.

Only pages with containers meet the template list, and only blocks of text are
shuffled, never html.  Counts are combined map-side, so a host with a third of
all pages is no hot key; AQE splits the joins.

Defined cases: null or empty html gives an empty text; broken markup is read
as a browser would start to (unclosed elements end with their parent); a null
url counts as the empty host; repeated pages and null ids are kept, each row
for itself (equal rows have equal texts).
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitscope.llm import text as X
from hitscope.llm.runtime import prepare, stored
from hitscope.llm.url_filter import url_host

MIN_PAGES = 3
MIN_SHARE = 0.3
MANY_PAGES = 30

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset(
    "head script style noscript template title nav footer aside form iframe object svg math canvas audio video map "
    "button select textarea dialog menu datalist progress".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
BLOCK = frozenset(
    "html body main article section div p h1 h2 h3 h4 h5 h6 header hgroup address blockquote pre ul ol li dl dt dd table caption "
    "thead tbody tfoot tr td th figure figcaption details summary center fieldset legend hr".split()
)
#: Elements whose recurrence marks site template; the rest of BLOCK is text.
CONTAINERS = frozenset("div section ul ol dl table details figure fieldset center address header hgroup span".split())
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar footer cookie cookies consent gdpr notice popup modal overlay newsletter subscribe "
    "share sharing social comment comments commentlist disqus reply replies respond related recommended widget toolbar "
    "pagination pager login signup search masthead topbar skip".split()
)
#: Long enough to be told within a longer name (cookiebar, leftsidebar).
_DROPPED_PARTS = re.compile("sidebar|cookie|newsletter|advert|sponsor|breadcrumb|popup|disqus|subscri|navigation")
#: Words of reader comments, which may be longer than the article.
COMMENT_WORDS = frozenset("comment comments commentlist disqus reply replies respond".split())
#: Class names that describe the layout of what they stand on.
_LAYOUT = re.compile(r"(?:has|no|not|non|with|without|is|show|shows|hide|hides|enable|disable|open|closed)[-_]")
KEPT_TAGS = frozenset("html body main".split())
#: Inline elements are cut at once by their class; they do not hold articles.
INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
#: An open p ends where one of these begins.
_ENDS_P = BLOCK - {"html", "body", "td", "th", "tr", "caption", "thead", "tbody", "tfoot"} | {"nav", "aside", "footer", "form"}
#: An open element ends where a sibling of its kind begins.
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_LIMIT = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
_WORD = re.compile(r"[^a-z0-9]+")


class _Node:
    """An element that matters later: a container, an article or main, or one
    with a sign that it may not be text.  It covers blocks ``lo`` to ``hi``."""

    __slots__ = ("parent", "scope", "kind", "sign", "digest", "mark", "lo", "hi")

    def __init__(self, parent, kind, sign, key, lo):
        self.parent, self.kind, self.sign, self.lo, self.hi = parent, kind, sign, lo, lo
        self.scope = parent and (parent if parent.kind else parent.scope)  # the innermost article or main round it
        self.digest = hashlib.blake2b(key, digest_size=8) if key is not None else None
        self.mark = None


class _Element:
    __slots__ = ("tag", "cut", "node", "own", "article", "main")

    def __init__(self, tag, cut, article, main, node, own=False):
        self.tag, self.cut, self.article, self.main, self.node, self.own = tag, cut, article, main, node, own


def _held(node: _Node | None) -> _Node | None:
    """The innermost container at or above a node."""
    while node is not None and node.digest is None:
        node = node.parent
    return node


class _Page(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack = [_Element("", False, False, False, None)]
        self.open: Counter[str] = Counter()
        self.parts: list[str] = []
        self.blocks: list[tuple[str, bool, bool]] = []  # text, in article, in main
        self.nodes: list[_Node] = []

    def flush(self):
        text = " ".join("".join(self.parts).split()) if self.parts else ""
        self.parts = []
        if text:
            top = self.stack[-1]
            if (held := _held(top.node)) is not None:
                held.digest.update(b"\x01" + hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest())
            self.blocks.append((text, top.article, top.main))

    def push(self, e: _Element):
        self.stack.append(e)
        self.open[e.tag] += 1

    def pop(self):
        e = self.stack.pop()
        self.open[e.tag] -= 1
        if e.own:
            n = e.node
            n.hi = len(self.blocks)
            if n.digest is not None:
                d = n.digest.digest()
                n.mark = int.from_bytes(d, "little", signed=True)
                if (held := _held(n.parent)) is not None:
                    held.digest.update(b"\x02" + d)
                n.digest = None

    def ends(self, i: int):
        """Closes all open elements from place ``i`` on."""
        if any(e.tag in BLOCK or e.tag in DROPPED or (e.own and e.node.sign) for e in self.stack[i:]):
            self.flush()
        while len(self.stack) > i:
            self.pop()

    def close_to(self, tags, limit):
        """Ends the innermost open element of ``tags``, if none of ``limit``
        stands between."""
        if not any(self.open[t] for t in tags):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in tags:
                self.ends(i)
                return
            if self.stack[i].tag in limit:
                return

    def handle_starttag(self, tag, attrs):
        if tag in _ENDS_P:
            self.close_to({"p"}, {"article", "section", "div", "td", "th", "li", "blockquote", "button", "table"})
        if tag in _SIBLINGS:
            self.close_to(_SIBLINGS[tag], _LIMIT[tag])
        if tag in VOID:
            if tag == "hr":
                self.flush()
            elif tag == "br":
                self.parts.append(" ")
            return
        if tag in BLOCK or tag in DROPPED:
            self.flush()
        top = self.stack[-1]
        if top.cut:
            self.push(_Element(tag, True, top.article, top.main, top.node))
            return
        a = {k: v or "" for k, v in attrs} if attrs else {}
        inside = top.article or top.main
        cut = (
            (tag in DROPPED and tag != "form")
            or (tag == "header" and not inside)
            or a.get("role", "").lower() in DROPPED_ROLES
            or "hidden" in a
            or a.get("aria-hidden", "").lower() == "true"
        )
        if cut:
            self.push(_Element(tag, True, top.article, top.main, top.node))
            return
        sign = "" if tag in KEPT_TAGS else _sign(tag, a, inside)
        if sign and tag in INLINE:
            self.push(_Element(tag, True, top.article, top.main, top.node))
            return
        kind = "article" if tag == "article" else "main" if tag == "main" or a.get("role") == "main" else ""
        key = f"{tag}|{a.get('class', '')}|{a.get('role', '')}".encode("utf-8", "replace") if tag in CONTAINERS else None
        node = top.node
        if own := bool(kind or sign or key is not None):
            if sign:
                self.flush()
            node = _Node(top.node, kind, sign, key, len(self.blocks))
            self.nodes.append(node)
        self.push(_Element(tag, False, top.article or kind == "article", top.main or kind == "main", node, own))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("svg", "math", "object", "iframe"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in VOID:
            if tag == "br":
                self.parts.append(" ")
            return
        for i in range(len(self.stack) - 1, 0, -1) if self.open[tag] else ():
            if self.stack[i].tag == tag:
                self.ends(i)
                return
            # an end tag does not reach out of the block that it stands in, if it is inline
            if tag not in BLOCK and tag not in DROPPED and self.stack[i].tag in BLOCK:
                return
        if tag == "p":
            self.flush()

    def handle_data(self, data):
        if not self.stack[-1].cut:
            self.parts.append(data)

    def cuts(self) -> list[bool]:
        """Which blocks lie in an element whose sign holds."""
        upto = [0]
        for b in self.blocks:
            upto.append(upto[-1] + len(b[0]))
        size = lambda lo, hi: upto[hi] - upto[lo]
        in_article = [0]
        for b in self.blocks:
            in_article.append(in_article[-1] + len(b[0]) * b[1])
        first = next((n for n in self.nodes if n.kind), None)
        mains = [n for n in self.nodes if n.kind == "main" and n.hi > n.lo]
        turns = [0] * (len(self.blocks) + 1)
        for n in self.nodes:
            if not n.sign or n.hi == n.lo:
                continue
            if n.scope is not None:
                layout = 2 * size(n.lo, n.hi) > size(n.scope.lo, n.scope.hi)
            elif n.sign == "comment":
                layout = first is not None and n.lo <= first.lo and first.hi <= n.hi
            else:
                layout = (
                    any(n.lo <= m.lo and m.hi <= n.hi for m in mains)
                    or 2 * (in_article[n.hi] - in_article[n.lo]) > in_article[-1]
                    or 2 * size(n.lo, n.hi) > upto[-1]
                )
            if not layout:
                turns[n.lo] += 1
                turns[n.hi] -= 1
        out, now = [], 0
        for t in turns[:-1]:
            now += t
            out.append(now > 0)
        return out

    def result(self) -> tuple[list[tuple[str, int]], list[tuple[int, int, int]]]:
        self.close()
        self.flush()
        while len(self.stack) > 1:
            self.pop()
        gone = self.cuts()
        kept: list[int] = []
        for here in (1, 2, None):  # the article, else main, else the whole page
            kept = [i for i, b in enumerate(self.blocks) if not gone[i] and (here is None or b[here])]
            if kept:
                break
        for here in (1, 2):  # nothing is left: signs do not empty an article
            kept = kept or [i for i, b in enumerate(self.blocks) if b[here]]
        if not kept:
            return [], []
        before = [0] * (len(self.blocks) + 1)
        for i in kept:
            before[i + 1] = 1
        for i in range(len(self.blocks)):
            before[i + 1] += before[i]
        ranges = {
            (n.mark, n.lo, n.hi) for n in self.nodes if n.mark is not None and 0 < before[n.hi] - before[n.lo] < len(kept)
        }  # containers round all blocks of the page are none of its parts
        return [(self.blocks[i][0], i) for i in kept], sorted(ranges)


def _sign(tag: str, attrs: dict[str, str], inside: bool) -> str:
    """Why an element may not be main text: "comment", "word", or nothing."""
    words: set[str] = set()
    for name in (attrs.get("class", "") + " " + attrs.get("id", "")).lower().split():
        if not _LAYOUT.match(name):
            words.update(_WORD.split(name))
    if not COMMENT_WORDS.isdisjoint(words):
        return "comment"
    if tag == "form" or not DROPPED_WORDS.isdisjoint(words) or any(map(_DROPPED_PARTS.search, words)):
        return "word"
    return "word" if "header" in words and not inside else ""


def page_blocks(html: str | None) -> list[tuple[str, int]]:
    """The text blocks of a page (text, place)."""
    return page_parts(html)[0]


def page_parts(html: str | None) -> tuple[list[tuple[str, int]], list[tuple[int, int, int]]]:
    """The text blocks of a page (text, place), and its containers (hash, first
    place, place after the last)."""
    if not html:
        return [], []
    page = _Page()
    page.feed(html)
    return page.result()


_BLOCKS = pa.list_(pa.struct([("text", pa.string()), ("at", pa.int32())]))
_PARTS = pa.list_(pa.struct([("mark", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())]))


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for b in X.pieces(whole, "html"):
            found = [page_parts(h) for h in b.column("html").to_pylist()]
            blocks = [[{"text": t.encode("utf-8", "replace").decode(), "at": i} for t, i in x] for x, _ in found]
            parts = [[dict(zip(("mark", "lo", "hi"), r)) for r in x] for _, x in found]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("url"), b.column("host"), b.column("key"), pa.array(blocks, _BLOCKS), pa.array(parts, _PARTS)],
                names=["id", "url", "host", "key", "blocks", "parts"],
            )


def extract_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, many_pages: int = MANY_PAGES,
) -> DataFrame:
    """(id, url, text) for every page."""
    prepare(pages.sparkSession)
    page = pages.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"), url_host(F.col(f"`{url_col}`")).alias("host"),
        F.struct(F.xxhash64(f"`{id_col}`", f"`{url_col}`", f"`{html_col}`").alias("a"), F.xxhash64(F.lit(1), f"`{html_col}`", f"`{url_col}`").alias("b")).alias("key"),
        F.col(f"`{html_col}`").alias("html"),
    )
    kinds = dict(page.dtypes)
    out = (
        f"id {kinds['id']}, url string, host string, key {kinds['key']}, blocks array<struct<text:string,at:int>>, "
        "parts array<struct<mark:bigint,lo:int,hi:int>>"
    )
    parsed = stored(page.mapInArrow(_parse, out), "blocks").withColumn("content", F.xxhash64("blocks.text"))
    marked = parsed.where(F.size("parts") > 0)
    on = marked.select("host", "key", "content", F.inline("parts"))
    hosts = parsed.select("host", "content").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    template = stored(
        on.select("host", "mark", "content").distinct().groupBy("host", "mark").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
        .join(hosts, "host").where((F.col("n") >= F.col("pages") * min_share) | (F.col("n") >= many_pages)).select("host", "mark"),
        "template",
    )
    gone = on.join(template, ["host", "mark"]).groupBy("key").agg(F.collect_set(F.struct("lo", "hi")).alias("gone"))
    within = lambda b: F.exists("gone", lambda g: (g["lo"] <= b["at"]) & (b["at"] < g["hi"]))
    cleaned = marked.join(gone, "key", "left").withColumn(
        "blocks", F.when(F.col("gone").isNull(), F.col("blocks")).otherwise(F.filter("blocks", lambda b: ~within(b)))
    )
    cols = ["id", "url", "blocks"]
    both = parsed.where(F.size("parts") <= 0).select(cols).unionByName(cleaned.select(cols))
    return both.select(F.col("id").alias(id_col), "url", F.array_join("blocks.text", "\n").alias("text"))
