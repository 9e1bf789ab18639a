"""Licence statements in texts by ordered signature rules, in DataFrame expressions alone.

A text is first searched for a few general words; only texts with one of them are tried
further. There every rule's own keyword must occur before its pattern is run. All places
of all patterns become intervals. An interval inside another one is suppressed; of equal
intervals the rule of higher priority stays. Going along the text, of two that overlap in
part the one of higher priority stays, with equal priorities the one that starts first.
What is left gives the labels.

Besides, three phrases are counted by words: see ``PHRASES``. Their labels stay whatever
the rules find.

Null texts count as empty: no words, no labels (an empty string), score 0. Texts are never
cut; repeated rows give repeated results; an empty table gives an empty one. Only id and
text are read. No step shuffles. Places are summed up in blocks of about the square root of
their number, since arrays that grow place by place would take quadratic time.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.license_rules import Rule, rules

# The phrases that are counted, as single-spaced lower-case words, and labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

GATES = [
    "licen", "copyright", "creative", "public domain", "gpl", "bsd", "rights reserved",
    "permission is hereby", "redistribution and use", "warrant", "as is", "proprietary",
    "©", "cc0", "wtfpl", "beer", "cecill", "cc by", "cc-by", "unlicense", "opensource.org",
]
"""General words; every rule's pattern needs one of them."""


def ascii_lower(text: Column) -> Column:
    """The text with A to Z in lower case and all else as it is."""
    return F.translate(text, UPPER, LOWER)


def _any(text: Column, words: list[str]) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | text.contains(word)
    return found


def _phrase_columns(padded: Column, n_words: Column) -> list[Column]:
    """``n_base, first_word, last_word, base_labels`` of words with single spaces around."""
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in PHRASES.items():
        found = padded.contains(f" {phrase} ")
        counts.append(F.when(found, F.regexp_count(padded, F.lit(f" {phrase}(?= )"))).otherwise(0))
        before = F.substring_index(padded, f" {phrase} ", 1)
        firsts.append(F.when(found, F.length(before) - F.length(F.replace(before, F.lit(" ")))))
        after = F.substring_index(padded, f" {phrase} ", -1)
        behind = F.length(after) - F.length(F.replace(after, F.lit(" ")))
        lasts.append(F.when(found, n_words - behind - len(phrase.split(" "))))
        labels.append(F.when(found, F.lit(label)))
    n_base = counts[0] + counts[1] + counts[2]
    return [
        n_base.cast("long").alias("n_base"),
        F.least(*firsts).cast("long").alias("first_word"),
        F.greatest(*lasts).cast("long").alias("last_word"),
        F.array_sort(F.array_compact(F.array(*labels))).alias("base_labels"),
    ]


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of the value, which is worked out a single time however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _running(values: Column, of: Callable[[Column], Column]) -> Column:
    """``of`` each value, plus all before it; a fold that copies its array for each value."""
    start = F.array().cast("array<int>")

    def add(sums: Column, x: Column) -> Column:
        last = F.coalesce(F.try_element_at(sums, F.lit(-1)), F.lit(0))
        return F.concat(sums, F.array(last + of(x)))

    return F.aggregate(values, start, add)


def _ends(lengths: Column) -> Column:
    """``to, length`` of one or more places given by the ``gap`` before each and its ``length``."""
    width = F.ceil(F.sqrt(F.size(lengths))).cast("int")
    blocks = F.transform(
        F.sequence(F.lit(1), F.size(lengths), width), lambda n: F.slice(lengths, n, width)
    )
    summed = F.transform(
        blocks,
        lambda block: F.struct(
            block.alias("places"), _running(block, lambda x: x["gap"] + x["length"]).alias("ends")
        ),
    )

    def shifted(block: Column, end: Column) -> Column:
        before = end - F.element_at(block["ends"], -1)
        ends = F.transform(block["ends"], lambda to: to + before)
        return F.zip_with(
            block["places"],
            ends,
            lambda x, to: F.struct(to.alias("to"), x["length"].alias("length")),
        )

    def whole(parts: Column) -> Column:
        totals = _running(parts, lambda block: F.element_at(block["ends"], -1))
        return F.flatten(F.zip_with(parts, totals, shifted))

    return _once(summed, whole)


def _intervals(text: Column, keyword: Column, group: Column) -> Column:
    """``from, to, priority, label, weight`` of all places of a keyword's rules in the text."""

    kind = "array<struct<from:int,to:int,priority:int,label:string,weight:double>>"

    def lengths(rule: Column, matches: Column) -> Column:
        pieces = F.split(text, rule["pattern"], -1)
        return F.zip_with(
            F.slice(pieces, F.lit(1), F.size(matches)),
            matches,
            lambda piece, match: F.struct(
                F.length(piece).alias("gap"), F.length(match).alias("length")
            ),
        )

    def intervals(rule: Column, ends: Column) -> Column:
        return F.transform(
            ends,
            lambda p: F.struct(
                (p["to"] - p["length"]).alias("from"),
                (-p["to"]).alias("to"),
                (-rule["priority"]).alias("priority"),
                rule["label"].alias("label"),
                rule["weight"].alias("weight"),
            ),
        )

    def places(rule: Column) -> Column:
        return _once(
            F.regexp_extract_all(text, rule["pattern"], F.lit(0)),
            lambda matches: F.when(
                F.size(matches) > 0,
                intervals(rule, _once(lengths(rule, matches), _ends)).cast(kind),
            ).otherwise(F.array().cast(kind)),
        )

    return F.when(text.contains(keyword), F.flatten(F.transform(group, places)))


def _resolved(intervals: Column) -> Column:
    """Different labels and weights of the intervals that stay.

    They come sorted by start, then the longer first. The last that stayed is open, as a
    later one of higher priority may take its place; those before it are settled. Only
    different ones are held, so the fold is linear.
    """
    kind = "struct<label:string,weight:double>"
    start = F.struct(
        F.lit(-1).alias("end"),
        F.lit(0).alias("priority"),
        F.lit(None).cast(kind).alias("open"),
        F.array().cast(f"array<{kind}>").alias("kept"),
    )

    def settled(state: Column) -> Column:
        known = state["open"].isNull() | F.array_contains(state["kept"], state["open"])
        return F.when(known, state["kept"]).otherwise(
            F.concat(state["kept"], F.array(state["open"]))
        )

    def add(state: Column, x: Column) -> Column:
        own = F.struct(x["label"].alias("label"), x["weight"].alias("weight"))
        opened = lambda kept: F.struct(
            (-x["to"]).alias("end"), x["priority"].alias("priority"), own.alias("open"), kept.alias("kept")
        )
        behind = x["from"] >= state["end"]
        wins = (-x["to"] > state["end"]) & (x["priority"] < state["priority"])
        return (
            F.when(behind, opened(settled(state)))
            .when(wins, opened(state["kept"]))
            .otherwise(state)
        )

    return F.aggregate(F.array_sort(intervals), start, add, settled)


def _table(known: list[Rule]) -> Column:
    """The rules as a constant array, grouped by keyword; one literal that is read once."""
    groups = [
        {"keyword": keyword, "rules": [asdict(rule) for rule in members]}
        for keyword, members in groupby(sorted(known, key=lambda r: r.keyword), lambda r: r.keyword)
    ]
    rule = "struct<pattern:string,label:string,priority:int,weight:double>"
    kind = f"array<struct<keyword:string,rules:array<{rule}>>>"
    return F.from_json(F.lit(json.dumps(groups)), kind)


def scanned(
    documents: DataFrame, key: str = "doc_id", text: str = "text", known: list[Rule] | None = None
) -> DataFrame:
    """``key, n_words, n_base, first_word, last_word, base_labels, labels, score``."""
    table = _table(known if known is not None else rules())
    low = documents.select(
        F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).select("id", "text", F.lower("text").alias("low"))
    gated = low.select(
        "id",
        "text",
        "low",
        (F.col("low").contains("license") | F.col("low").contains("cc")).alias("phrases"),
        _any(F.col("low"), GATES).alias("gate"),
    )
    spaced = F.regexp_replace(ascii_lower(F.col("text")), NO_WORD, " ")
    words = gated.select(
        "id",
        F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
        .cast("long")
        .alias("n_words"),
        F.when(F.col("phrases"), F.concat(F.lit(" "), F.trim(spaced), F.lit(" ")))
        .otherwise("  ")
        .alias("padded"),
        F.when(
            F.col("gate"),
            _resolved(
                F.flatten(
                    F.array_compact(
                        F.transform(table, lambda g: _intervals(F.col("low"), g["keyword"], g["rules"]))
                    )
                )
            ),
        ).alias("found"),
    )
    counted = words.select(
        "id", "n_words", *_phrase_columns(F.col("padded"), F.col("n_words")), "found"
    )
    none = F.array().cast("array<string>")
    detected = F.coalesce(F.transform("found", lambda x: x["label"]), none)
    weights = F.coalesce(F.array_max(F.transform("found", lambda x: x["weight"])), F.lit(0.0))
    return counted.select(
        F.col("id").alias(key),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base_labels", detected)), ",").alias("labels"),
        F.when(F.size("base_labels") > 0, 1.0).otherwise(weights).alias("score"),
    )
