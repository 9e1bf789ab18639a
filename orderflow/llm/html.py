"""Main text of web pages by differencing pages with near URLs.

A page is read into blocks of text. The pages of a host are ordered by URL path; each is
paired with the one before and the one after it, their blocks are aligned by the longest
common subsequence, and shared blocks are deleted as the site's template. Every page goes
this way, with all its blocks. Differencing alone can't give right results on two kinds of
blocks; there markup corrects it:

* Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader
  comments are recognised by their tags, roles, classes and ids and are deleted even where
  neighbours have others.
* What lies inside ``article`` or ``main`` stays even where a neighbour has it too, since
  sites hold copies of articles; then everything outside of it goes.

A neighbour that shares all blocks which markup leaves is a copy and tells nothing.

Pages of one host with equal blocks count as one page, at the smallest of their paths, so
equal pages give equal texts, and neighbours follow from the table alone: neither the
number of partitions nor the cuts between them matter. Distinct pages get their places by
ranges and their counts; each sends its block hashes to the places beside it, so a host with
a third of all pages is many tasks. Texts meet the result of their page by one join; copies
of one page are a hot key there, which adaptive execution splits.

Null html counts as empty and gives an empty text; markup may break off anywhere. Pages are
never cut; an empty table gives an empty one. Null urls share the empty host and path. Only
id, url and html are read.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.common import staged, with_columns
from orderflow.llm.urls import split_url

# Tags without content that is shown, tags of page furniture, tags that begin a block.
SILENT = {"script", "style", "template", "noscript", "svg", "math", "iframe", "object", "canvas"}
FURNITURE = {"nav", "header", "footer", "aside", "form", "dialog", "menu", "button", "select", "textarea", "title", "head"}
BLOCKS = {
    "address", "article", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl",
    "dt", "fieldset", "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "hr", "html",
    "legend", "li", "main", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot",
    "th", "thead", "tr", "ul",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "sponsor", "sponsored",
    "promo", "promotion", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "header",
    "masthead", "footer", "sidebar", "aside", "widget", "cookie", "cookies", "consent", "notice",
    "notification", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription",
    "signup", "login", "comment", "comments", "disqus", "replies", "respond", "share", "sharing",
    "social", "related", "recommended", "pagination", "pager", "toolbar", "copyright", "disclaimer",
    "gdpr", "skip", "search", "form",
}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "alertdialog", "dialog", "menu", "menubar", "toolbar"}
MAIN = {"article", "main"}

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|</([a-zA-Z][^\s/>]*)[^>]*(?:>|$)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
DROPPED, OPEN, KEPT = 0, 1, 2


def _is_furniture(tag: str, attributes: str) -> bool:
    if tag in FURNITURE:
        return True
    if "=" not in attributes and "hidden" not in attributes:
        return False
    for name, *values in ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        name = name.lower()
        if name in ("class", "id"):
            parts = re.split(r"[\s_\-]+", value)
            if WORDS.intersection(parts) and tag not in ("body", "html"):
                return True
        elif name == "role" and value in ROLES:
            return True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
        elif name == "aria-hidden" and value == "true":
            return True
    return bool(re.search(r"(?:^|\s)hidden(?:\s|/|$|=)", attributes))


class Reader:
    """Reads html into blocks: text and whether it is dropped, open, or kept as the article."""

    def __init__(self) -> None:
        self.blocks: list[tuple[str, int]] = []
        self.stack: list[tuple[str, bool, bool]] = []
        self.open: Counter[str] = Counter()
        self.furniture = self.inside = 0
        self.text: list[str] = []

    def _push(self, tag: str, furniture: bool) -> None:
        self.stack.append((tag, furniture, tag in MAIN))
        self.open[tag] += 1
        self.furniture += furniture
        self.inside += tag in MAIN

    def _cut(self, n: int) -> None:
        """Leaves the first n open elements."""
        for tag, furniture, main in self.stack[n:]:
            self.open[tag] -= 1
            self.furniture -= furniture
            self.inside -= main
        del self.stack[n:]

    def _end_block(self) -> None:
        text = " ".join(html.unescape("".join(self.text)).split())
        self.text.clear()
        if text:
            self.blocks.append((text, DROPPED if self.furniture else KEPT if self.inside else OPEN))

    def _close(self, tag: str) -> None:
        if not self.open[tag]:
            return
        for n in range(len(self.stack) - 1, -1, -1):
            if self.stack[n][0] == tag:
                special = any(s[1] or s[2] or s[0] in BLOCKS for s in self.stack[n:])
                if special:
                    self._end_block()
                self._cut(n)
                return

    def _open(self, tag: str, attributes: str) -> None:
        furniture = _is_furniture(tag, attributes)
        if tag in BLOCKS or furniture or tag in MAIN:
            self._end_block()
        if tag in CLOSES:
            for n in range(len(self.stack) - 1, -1, -1):
                name = self.stack[n][0]
                if name in CLOSES[tag]:
                    self._cut(n)
                    break
                if name in BLOCKS or self.stack[n][1]:
                    break
        elif tag in BLOCKS and self.stack and self.stack[-1][0] == "p":
            self._cut(len(self.stack) - 1)
        if tag not in VOID and not attributes.rstrip().endswith("/"):
            self._push(tag, furniture)

    def read(self, page: str) -> list[tuple[str, int]]:
        at = 0
        while True:
            found = TOKEN.search(page, at)
            if found is None:
                self.text.append(page[at:])
                break
            self.text.append(page[at : found.start()])
            at = found.end()
            if closing := found[1]:
                self._close(closing.lower())
            elif opening := found[2]:
                tag = opening.lower()
                if tag == "br":
                    self.text.append(" ")
                elif tag in SILENT or tag == "title":
                    end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|$)", re.I).search(page, at)
                    at = end.end() if end else len(page)
                    self.text.append(" ")
                elif tag in ("textarea", "select", "option"):
                    self._open(tag, found[3] or "")
                else:
                    self._open(tag, found[3] or "")
        self._end_block()
        return self.blocks


def page_blocks(page: str | None) -> tuple[list[str], list[int]]:
    """The blocks of a page and their kinds; with an article all else is dropped."""
    found = Reader().read(page or "")
    if any(kind == KEPT for _, kind in found):
        found = [(text, kind if kind == KEPT else DROPPED) for text, kind in found]
    return [text for text, _ in found], [kind for _, kind in found]


def _lengths(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How long a common subsequence of ``x`` and each beginning of ``y`` can be."""
    row = np.zeros(len(y) + 1, np.int32)
    for value in x.tolist():
        row[1:] = np.maximum.accumulate(np.where(y == value, row[:-1] + 1, row[1:]))
    return row


def longest_common(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Places of ``x`` that a longest common subsequence with ``y`` uses.

    ``x`` is halved, and ``y`` cut where the lengths of both sides sum to the most, so only
    single rows of lengths are kept.
    """
    found, waiting = [], [(0, len(x), 0, len(y))]
    while waiting:
        a, b, c, d = waiting.pop()
        if a == b or c == d:
            continue
        if b - a == 1:
            if (y[c:d] == x[a]).any():
                found.append(a)
            continue
        half = (a + b) // 2
        before = _lengths(x[a:half], y[c:d])
        after = _lengths(x[half:b][::-1], y[c:d][::-1])[::-1]
        cut = c + int(np.argmax(before + after))
        waiting += [(half, b, cut, d), (a, half, c, cut)]
    return np.array(sorted(found), np.int64)


def common_places(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which places of ``a`` a longest common subsequence with ``b`` uses."""
    shared = np.zeros(len(a), bool)
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    shared[:head] = True
    shared[len(a) - tail :] = True
    if head + tail >= min(len(a), len(b)):
        return shared
    rows = np.flatnonzero(np.isin(a[head : len(a) - tail], b[head : len(b) - tail])) + head
    if not len(rows):
        return shared
    x, y = a[rows], b[head : len(b) - tail]
    y = y[np.isin(y, x)]
    shared[rows[longest_common(x, y)]] = True
    return shared


def template_places(
    own: np.ndarray, left: np.ndarray, neighbours: list[np.ndarray]
) -> np.ndarray:
    """Which blocks a neighbour shares; one that shares all that markup ``left`` tells nothing."""
    shared = np.zeros(len(own), bool)
    for other in neighbours:
        found = common_places(own, other)
        if not found[left].all():
            shared |= found
    return shared


def _digest(host: str, hashes: bytes, kinds: bytes) -> bytes:
    name = host.encode("utf-8", "surrogatepass")
    return xxhash.xxh3_128_digest(b"%d:%b%b%b" % (len(name), name, hashes, kinds))


def _read(host: str, page: str | None) -> tuple[bytes, list[str], bytes, bytes]:
    """A page's digest, its blocks, their hashes and their kinds."""
    blocks, kinds = page_blocks(page)
    hashes = [xxhash.xxh3_64_intdigest(b.encode("utf-8", "surrogatepass")) for b in blocks]
    packed, kinds = np.array(hashes, np.uint64).tobytes(), bytes(kinds)
    return _digest(host, packed, kinds), blocks, packed, kinds


def _start_outlines():
    def work(hosts, pages):
        found = [_read(*x) for x in zip(hosts, pages)]
        return [[f[0] for f in found], [f[2] for f in found], [f[3] for f in found]]

    return work


def _start_blocks():
    def work(hosts, pages):
        digests, texts = [], []
        for digest, blocks, _, kinds in (_read(*x) for x in zip(hosts, pages)):
            digests.append(digest)
            texts.append([
                {"at": n, "kept": k == KEPT, "text": b}
                for n, (b, k) in enumerate(zip(blocks, kinds))
                if k != DROPPED
            ])
        return [digests, texts]

    return work


def _start_differences():
    """Aligns the page of a place, side 0, with those of the places beside it."""

    def work(nears):
        digests, shared = [], []
        for near in nears:
            own = next(x for x in near if x["side"] == 0)
            kinds = np.frombuffer(own["kinds"], np.uint8)
            others = [
                np.frombuffer(x["hashes"], np.uint64)
                for x in near
                if x["side"] != 0 and x["host"] == own["host"]
            ]
            hashes = np.frombuffer(own["hashes"], np.uint64)
            digests.append(own["digest"])
            shared.append(template_places(hashes, kinds != DROPPED, others).tolist())
        return [digests, shared]

    return work


def placed(outlines: DataFrame) -> DataFrame:
    """The distinct pages of ``host, path, url, digest, hashes, kinds`` and their ``place``.

    Places count all pages without gaps, ordered by host and path. Ranges are counted, so
    nothing is sorted in one task; the window runs over one row for each range.
    """
    whole = F.struct("path", "url", "hashes", "kinds")
    distinct = outlines.groupBy("host", "digest").agg(F.min(whole).alias("page"))
    distinct = distinct.select("host", "digest", "page.*")
    order = ["host", "path", "url", "digest"]
    ranged = distinct.repartitionByRange(*order).sortWithinPartitions(*order)
    number = F.monotonically_increasing_id()
    rows = staged(ranged.withColumn("number", number), "html-outlines").select(
        "host",
        "digest",
        "hashes",
        "kinds",
        F.shiftright("number", 33).alias("range"),
        F.col("number").bitwiseAND((1 << 33) - 1).alias("row"),
    )
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("range").agg(F.count("*").alias("rows"))
    counts = counts.select("range", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    return rows.join(counts, "range").select(
        "host", "digest", "hashes", "kinds", (F.col("before") + F.col("row")).alias("place")
    )


def template(outlines: DataFrame) -> DataFrame:
    """``digest, shared``: which blocks of each distinct page its neighbours have too."""
    sides = placed(outlines).withColumn("side", F.explode(F.array(*map(F.lit, (-1, 0, 1)))))
    own = F.col("side") == 0
    page = F.struct(
        "side",
        "host",
        "hashes",
        F.when(own, F.col("digest")).alias("digest"),
        F.when(own, F.col("kinds")).alias("kinds"),
    )
    near = sides.groupBy((F.col("place") + F.col("side")).alias("place"))
    near = near.agg(F.collect_list(page).alias("near"), F.min(F.abs("side")).alias("own"))
    near = near.where("own = 0").select("near")
    return with_columns(near, ["near"], "near binary, shared array<boolean>", _start_differences).select(
        F.col("near").alias("digest"), "shared"
    )


def extracted(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``key, url, text, n_template`` of every page: its main text, blocks joined by line
    ends, and how many of its blocks the neighbours have too."""
    host, path = split_url(F.coalesce(F.col(url), F.lit("")))
    rows = pages.select(
        F.col(key).alias("id"),
        F.col(url).alias("url"),
        host.alias("host"),
        path.alias("path"),
        F.col(page).alias("page"),
    )
    outlines = with_columns(
        rows.drop("id"), ["host", "page"], "digest binary, page binary, kinds binary", _start_outlines
    ).withColumnRenamed("page", "hashes")
    blocks = "array<struct<at:int,kept:boolean,text:string>>"
    read = with_columns(
        rows.drop("path"), ["host", "page"], f"digest binary, page {blocks}", _start_blocks
    )
    known = read.join(template(outlines), "digest")
    left = F.filter("page", lambda b: b["kept"] | ~F.get("shared", b["at"]))
    return known.select(
        F.col("id").alias(key),
        "url",
        F.array_join(F.transform(left, lambda b: b["text"]), "\n").alias("text"),
        F.size(F.filter("shared", lambda x: x)).alias("n_template"),
    )
