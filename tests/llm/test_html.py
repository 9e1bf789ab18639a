import re
from html import unescape

import numpy as np
import pytest

from orderflow.llm import html
from orderflow.llm.queries import op4_html

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script>
</head><body class="site"><header><h1>Site</h1></header><nav><ul><li><a href="/a">A</a></li></ul></nav>
<div class="cookie-notice">We use cookies</div><div class="ad">Buy!</div><!-- <p>hidden</p> -->
<main><h1>A  title</h1><p>One &amp; two<br>three &eacute; &#8364; &lt;b&gt;<p>Four <b>five</b>
six<ul><li>seven<li>eight</ul><form><p>Name</p><input name=x></form><aside>More</aside>
<table><tr><td>c1<td>c2</table><blockquote>"Said" &amp</blockquote></main>
<section id="comments"><p>First!</p></section><footer>&copy; Site</footer></body></html>"""
MAIN = 'A title\nOne & two three é € <b>\nFour five six\nseven\neight\nc1\nc2\n"Said" &'


def text_of(page):
    blocks, kinds = html.page_blocks(page)
    return "\n".join(b for b, k in zip(blocks, kinds) if k != html.DROPPED)


def test_markup():
    assert text_of(PAGE) == MAIN


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("plain  text", "plain text"),
        ("<p>a<p>b</div></span>c", "a\nbc"),
        ("<article><p><b>a<br><p>b</article><footer>x</footer>", "a\nb"),
        ("<article><div role=navigation>x</div><p>a &amp; b &am", "a & b &am"),
        ("<p>a <script>if (a < b) {}", "a"),
        ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
        ("<P CLASS='Sidebar'>x</P><DIV>y</DIV>", "y"),
        ("<div hidden>x</div><div style='display: none'>y</div><p>z<!-- open", "z"),
        ("<article>" + "<div>" * 3000 + "deep", "deep"),
    ],
)
def test_odd_markup(page, text):
    assert text_of(page) == text


def test_common_places_is_a_longest_subsequence():
    draw = np.random.default_rng(1)
    for _ in range(200):
        a, b = (draw.integers(0, 5, draw.integers(0, 12)).astype(np.uint64) for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        found = html.common_places(a, b)
        assert found.sum() == table[-1][-1]
        rest = iter(b.tolist())
        assert all(x in rest for x in a[found].tolist())


def page(menu, article, end="Contact us"):
    return f"<html><body><p>{menu}</p><p>{article}</p><p>{end}</p></body></html>"


def test_differencing(spark):
    rows = [
        (1, "http://a.com/x/1", page("Home About", "First story")),
        (2, "http://a.com/x/2", page("Home About", "Second story")),
        (3, "http://a.com/x/2", page("Home About", "Second story")),
        (4, "http://a.com/x/3", page("Home About", "Third story")),
        (5, "http://b.com/x/1", page("Home About", "Alone")),
        (6, None, None),
        (7, "http://c.com/1", "<article><p>Same</p></article>"),
        (8, "http://c.com/2", "<article><p>Same</p></article>"),
    ]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    found = {r.page_id: r.text for r in html.extracted(pages).collect()}
    assert found == {
        1: "First story",
        2: "Second story",
        3: "Second story",
        4: "Third story",
        5: "Home About\nAlone\nContact us",
        6: "",
        7: "Same",
        8: "Same",
    }
    assert html.extracted(pages.where("false")).collect() == []


def plain(value):
    """Main text of the generated pages: what stands in the article's headings and paragraphs."""
    inner = re.search(r"<article>(.*?)(?:</article>|$)", value or "", re.DOTALL)
    if not inner:
        return ""
    parts = re.split(r"</?(?:h1|p)>", inner[1])
    texts = (" ".join(unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in parts)
    return "\n".join(t for t in texts if t)


def test_query(spark, tables_dir):
    pages = {r.page_id: r for r in spark.read.parquet(f"{tables_dir}/pages.parquet").collect()}
    rows = op4_html(spark, tables_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert (r.url, r.text) == (pages[r.page_id].url, plain(pages[r.page_id].html))
        assert r.n_chars == len(r.text)


def test_longest_common_places_of_long_pages():
    """Twenty thousand lines on both sides need rows of lengths only, not a table of them."""
    import tracemalloc

    draw = np.random.default_rng(6)
    x, y = (draw.integers(0, 300, 4000).astype(np.uint64) for _ in range(2))
    tracemalloc.start()
    found = html.longest_common(x, y)
    assert tracemalloc.get_traced_memory()[1] < 4 << 20
    tracemalloc.stop()
    assert len(found) == html._lengths(x, y)[-1]
    rest = iter(y.tolist())
    assert all(v in rest for v in x[found].tolist())
    many = np.arange(20_000).astype(np.uint64)
    own = np.concatenate((many, [1, 2]))
    assert html.common_places(own, np.concatenate(([7], many))).sum() == 20_000


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 100_000 + "deep",
        "<div><p>x" * 60_000 + "</div>" * 60_000,
        "<ul><li>a" * 50_000,
        "<span>" * 100_000 + "</b>" * 100_000 + "end",
        "<article>" + "<section>t" * 60_000 + "</article>" + "<p>out</p>" * 1000,
    ],
)
def test_deep_pages_take_linear_time(page):
    import time

    start = time.perf_counter()
    blocks, _ = html.page_blocks(page)
    assert time.perf_counter() - start < 5
    assert blocks


def by_hand(rows):
    """Main texts by going along the distinct pages of each host, with a table for each pair."""

    def shared_by(a, b):
        table = [[frozenset()] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                both = table[i][j] | {i} if x == y else frozenset()
                table[i + 1][j + 1] = max(both, table[i][j + 1], table[i + 1][j], key=len)
        return table[-1][-1]

    def host_and_path(url):
        rest = re.split("[?#]", url.split("://", 1)[1])[0] if url and "://" in url else ""
        host, _, path = rest.partition("/")
        return host.lower(), "/" + path if "/" in rest else ""

    places, texts = {}, {}
    for number, url, page in rows:
        blocks, kinds = html.page_blocks(page)
        host, path = host_and_path(url)
        place = (path, url is not None, url or "")
        name = (host, tuple(blocks), tuple(kinds))
        places[name] = min(places.get(name, place), place)
        texts[number] = name
    ordered = sorted(places, key=lambda name: (name[0], places[name]))
    found = {}
    for n, (host, blocks, kinds) in enumerate(ordered):
        template = set()
        for m in (n - 1, n + 1):
            if 0 <= m < len(ordered) and ordered[m][0] == host:
                same = shared_by(blocks, ordered[m][1])
                if not {i for i, k in enumerate(kinds) if k != html.DROPPED} <= same:
                    template |= same
        text = "\n".join(
            b for i, (b, k) in enumerate(zip(blocks, kinds))
            if k == html.KEPT or (k == html.OPEN and i not in template)
        )
        found[host, blocks, kinds] = text, len(template)
    return {number: found[name] for number, name in texts.items()}


def site(draw, number, host):
    """A page whose lines are all different, so that the longest common subsequence is unique."""
    menu = [f"menu {i}" for i in range(6) if draw.random() < 0.7]
    body = [f"line {number} {i}" for i in range(3)]
    lines = "".join(f"<p>{x}</p>" for x in [*menu, *body, "foot"])
    if draw.random() < 0.3:
        lines += f"<footer>f {number % 2}</footer><article><p>text {number % 3}</p></article>"
    return (number, f"http://{host}.com/{int(draw.integers(0, 40)):02d}/{number:03d}", lines)


@pytest.mark.parametrize("partitions", [1, 4, 61])
def test_neighbours_do_not_depend_on_partitions(spark, partitions):
    draw = np.random.default_rng(4)
    rows = [site(draw, n, "hot" if n % 3 else f"h{n % 5}") for n in range(150)]
    rows += [(200 + n, rows[7][1], rows[7][2]) for n in range(20)]
    rows += [(300 + n, f"http://hot.com/{n:02d}/copy", rows[8][2]) for n in range(20)]
    rows += [(400, None, "<p>a<p>b"), (401, None, None), (402, "", "<p>a<p>c"), (None, None, None)]
    wanted = by_hand(rows)
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(partitions)
        found = html.extracted(pages).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(found) == len(rows)
    assert {r.page_id: (r.text, r.n_template) for r in found} == wanted


def test_copies_in_a_row_are_equal(spark):
    rows = [(n, f"http://a.com/{n}", page("Home", "Same" if 0 < n < 4 else f"Story {n}")) for n in range(5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = {r.page_id: r.text for r in html.extracted(pages).collect()}
    assert texts == {0: "Story 0", 1: "Same", 2: "Same", 3: "Same", 4: "Story 4"}
