"""Verdicts on URLs: rules for hosts and paths, else gradient-boosted trees on lexical features.

The rules label the URLs that they fit; a bounded sample of those trains the trees, which
judge all other URLs. Features, trees and rules are DataFrame expressions, so scoring is
one pass without a shuffle and without Python.

A null URL, and one without ``://``, has an empty host and path and is judged by its
features like any other. URLs are never cut; repeated rows give repeated results; an empty
table gives an empty one. If the rules fit no URL, or label all alike, the trees are empty
and their verdict is that label, or allow. Only id and url are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm import boosting
from orderflow.llm.common import slices
from orderflow.llm.licenses import ascii_lower

SAMPLE = 20_000
"""URLs that the trees are trained on, at most about."""
SUFFIXES = 200
"""Values of each kind of suffix with statistics of their own; the rarer ones share one."""


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


# The rules that hold.
RULES = [
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
]

FEATURES = [
    "length", "host_length", "path_length", "depth", "labels", "digits", "host_digits", "hyphens",
    "host_hyphens", "entropy", "parameters", "query_length", "fragment", "secure", "extension",
    "longest", "vowels",
]

# Parts of a URL for which the share of blocked sample URLs is a feature.
KINDS = {
    "suffix": ("host", r"[^.]*$"),
    "domain": ("host", r"[^.]*\.[^.]*$"),
    "prefix": ("host", r"^[^.]*"),
    "section": ("path", r"^/[^/]*/?"),
}
ALL = [*FEATURES, *KINDS]


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A to Z in lower case) and path; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(url, "://", 1))
    rest = F.coalesce(F.substring(url, F.length(rest) + 4, F.length(url)), F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_columns(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), len(r.host), r.name)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def _entropy(text: Column) -> Column:
    """Bits for each letter of the text."""
    size = F.length(text)
    letters = F.array_distinct(F.split(text, ""))

    def bits(total: Column, letter: Column) -> Column:
        share = (size - F.length(F.replace(text, letter))) / size
        return total - F.when(letter == "", 0.0).otherwise(share * F.log2(share))

    return F.when(size > 0, F.aggregate(letters, F.lit(0.0), bits)).otherwise(0.0)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def measured(pages: DataFrame, rules: list[Rule], key: str = "page_id", url: str = "url") -> DataFrame:
    """``key, host, path, rule, ruled``, the parts of ``KINDS`` and the features."""
    address = F.coalesce(F.col(url), F.lit(""))
    host, path = split_url(address)
    parts = pages.select(
        F.col(key).alias("id"), address.alias("address"), host.alias("host"), path.alias("path")
    )
    name, verdict = rule_columns(rules, F.col("host"), F.col("path"))
    query = F.regexp_extract("address", r"\?([^#]*)", 1)
    host, path, address = F.col("host"), F.col("path"), F.col("address")
    whole = F.greatest(F.length(address), F.lit(1))
    found = {
        "length": F.length(address),
        "host_length": F.length(host),
        "path_length": F.length(path),
        "depth": _count(path, "/"),
        "labels": _count(host, r"[^.]+"),
        "digits": _count(address, r"[0-9]") / whole,
        "host_digits": _count(host, r"[0-9]"),
        "hyphens": _count(address, "-"),
        "host_hyphens": _count(host, "-"),
        "entropy": _entropy(host),
        "parameters": F.when(query == "", 0).otherwise(1 + _count(query, "&")),
        "query_length": F.length(query),
        "fragment": address.contains("#").cast("int"),
        "secure": address.startswith("https://").cast("int"),
        "extension": F.length(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)),
        "longest": F.array_max(F.transform(F.split(host, r"[.]"), F.length)),
        "vowels": _count(host, "[aeiou]") / F.greatest(F.length(host), F.lit(1)),
    }
    return parts.select(
        "id",
        "host",
        "path",
        name.alias("rule"),
        verdict.alias("ruled"),
        *(F.regexp_extract(part, p, 0).alias(f"{k}_name") for k, (part, p) in KINDS.items()),
        *(value.cast("double").alias(feature) for feature, value in found.items()),
    )


@dataclass(frozen=True)
class Model:
    """Trees for a block verdict, and the share of blocked sample URLs by part."""

    trees: boosting.Trees
    shares: dict[str, dict[str, float]]
    other: float

    def share(self, kind: str) -> Column:
        found = F.lit(self.other)
        if self.shares[kind]:
            pairs = [F.lit(x) for item in sorted(self.shares[kind].items()) for x in item]
            found = F.coalesce(F.create_map(*pairs)[F.col(f"{kind}_name")], found)
        return found

    def probability(self) -> Column:
        """The chance of block, of columns named as the features."""
        trees = self.trees

        def value(node: int) -> Column:
            if trees.left[node] == node:
                return F.lit(float(trees.value[node]))
            goes_left = F.col(ALL[trees.feature[node]]) <= float(trees.threshold[node])
            left, right = int(trees.left[node]), int(trees.right[node])
            return F.when(goes_left, value(left)).otherwise(value(right))

        margin = F.lit(trees.base)
        for root in trees.roots.tolist():
            margin = margin + value(root)
        return 1 / (1 + F.exp(-margin))


def fit(pages: DataFrame, rules: list[Rule] = RULES, sample: int = SAMPLE, url: str = "url") -> Model:
    """Trees trained on a bounded sample of different URLs that the rules label."""
    addresses = pages.where(F.col(url).isNotNull()).select(F.col(url).alias("url")).distinct()
    host, path = split_url(F.col("url"))
    ruled = addresses.where(rule_columns(rules, host, path)[1].isNotNull())
    rows = measured(slices(ruled, F.col("url"), sample), rules, "url").orderBy("id").collect()
    y = np.array([r.ruled == "block" for r in rows], float)
    other = float((y.sum() + 1) / (len(y) + 2))
    shares = {kind: _shares([r[f"{kind}_name"] for r in rows], y, other) for kind in KINDS}
    x = np.array(
        [
            [
                *(r[f] for f in FEATURES),
                *(shares[kind].get(r[f"{kind}_name"], other) for kind in KINDS),
            ]
            for r in rows
        ],
        float,
    ).reshape(-1, len(ALL))
    return Model(boosting.fit(x, y, rounds=20), shares, other)


def _shares(names: list[str], y: np.ndarray, other: float) -> dict[str, float]:
    """The share of blocked URLs of the most common names, drawn towards the overall share."""
    totals: dict[str, list[float]] = {}
    for name, label in zip(names, y.tolist()):
        found = totals.setdefault(name, [0.0, 0.0])
        found[0] += label
        found[1] += 1
    common = sorted(totals.items(), key=lambda x: (-x[1][1], x[0]))[:SUFFIXES]
    return {name: (a + 10 * other) / (n + 10) for name, (a, n) in common}


def judged(
    pages: DataFrame, model: Model, rules: list[Rule] = RULES, key: str = "page_id", url: str = "url"
) -> DataFrame:
    """``key, host, path, rule, verdict, score`` of every URL; score: the trees' chance of block."""
    rows = measured(pages, rules, key, url)
    rows = rows.withColumns({kind: model.share(kind) for kind in KINDS})
    rows = rows.withColumn("score", model.probability())
    own = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return rows.select(
        F.col("id").alias(key),
        "host",
        "path",
        "rule",
        F.coalesce("ruled", own).alias("verdict"),
        "score",
    )
