import re

import pytest
from pyspark.sql import functions as F

from orderflow.llm import urls
from orderflow.llm.queries import op5_urls

URLS = [
    None, "", "no scheme", "http://a.com", "http://a.com/", "HTTP://WWW.EXAMPLE.COM/en/x",
    "http://x.example.com/en/", "http://example.com/en", "https://b.net/es/1?u=http://c.com/",
    "ftp://net/fr/", "x://aexample.com/en/?a=1&b=2#f", "http://b.net?x", "http://b.net#/es/",
    "http://ÄB.com/", "a://b://c.com/", "http://b.net/fr/" + "long/" * 2000, "http://com/",
]


def plain(url):
    """Host, path and the rule's name and verdict, as the contract words them."""
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [
        r
        for r in urls.RULES
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, best and best.name, best and best.verdict


def check(rows, by_id):
    for r in rows:
        host, path, name, verdict = plain(by_id[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, name)
        assert r.verdict == (verdict or ("block" if r.score >= 0.5 else "allow"))
        assert 0 <= r.score <= 1


def test_query(spark, tables_dir):
    pages = spark.read.parquet(f"{tables_dir}/pages.parquet").collect()
    rows = op5_urls(spark, tables_dir).collect()
    assert len(rows) == len(pages)
    check(rows, {r.page_id: r.url for r in pages})


def test_trees_agree_with_rules(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    trained = pages.where("page_id % 3 > 0")
    rows = urls.judged(pages.where("page_id % 3 = 0"), urls.fit(trained)).where("rule IS NOT NULL")
    right = rows.select(F.avg(F.expr("int((score >= 0.5) = (verdict = 'block'))"))).first()[0]
    assert right > 0.7


def test_odd_urls(spark):
    rows = [(n, u, "x") for n, u in enumerate(URLS)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    model = urls.fit(pages)
    check(urls.judged(pages, model).collect(), dict(enumerate(URLS)))
    assert urls.judged(pages.where("false"), urls.fit(pages.where("false"))).collect() == []


@pytest.mark.parametrize("text, bits", [("", 0.0), ("aaaa", 0.0), ("abab", 1.0), ("abcd", 2.0)])
def test_entropy(spark, text, bits):
    assert spark.range(1).select(urls._entropy(F.lit(text))).first()[0] == pytest.approx(bits)


def test_plan_has_no_python_and_no_shuffle(spark, tables_dir):
    pages = spark.read.parquet(f"{tables_dir}/pages.parquet")
    plan = urls.judged(pages, urls.fit(pages))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan and "Arrow" not in plan
