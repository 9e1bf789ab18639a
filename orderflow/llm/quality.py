"""Quality of documents by gradient-boosted trees over statistics of the whole text.

Statistics are counted in Arrow batches, one text at a time. The trees are trained on a
bounded sample of labelled documents, with the score held monotonic: more symbols,
repeats, shouting or bars never make a text better.

Null texts count as empty: they have no words. Texts without words, ties and repeated
rows need no care: equal texts have equal results. An empty table gives an empty one, and
without labels the trees are empty and judge every text alike.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from orderflow.llm import boosting
from orderflow.llm.common import WHITE, labelled, with_columns

# The symbols that are counted, and the length of a window of words.
SYMBOLS = "#*$%&|<>"
WINDOW = 5

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = [
    "log_words", "word_length", "symbols", "repeat_lines", "repeat_words",
    "upper", "exclamations", "distinct", "stutter", "digits", "lines",
]
FALLING = ["symbols", "repeat_lines", "repeat_words", "upper", "exclamations", "stutter"]
MONOTONIC = {FEATURES.index(name): -1 for name in FALLING}

SAMPLE = 20_000
"""Labelled documents that the trees are trained on, at most."""

LEAST = 0.5
"""Score from which a text is good."""

COLUMNS = ", ".join(f"{name} long" for name in COUNTS) + ", features array<double>"


def repeated_words(ids: np.ndarray) -> int:
    """Words inside windows of five words that are found twice or more."""
    n = len(ids)
    if n < WINDOW:
        return 0
    if n < 2**12:
        code = ids[: n - 4]
        for k in range(1, WINDOW):
            code = (code << 12) | ids[k : n - 4 + k]
    else:
        pairs = np.unique(ids[:-1] * n + ids[1:], return_inverse=True)[1]
        fours = np.unique(pairs[:-2] * n + pairs[2:], return_inverse=True)[1]
        code = fours[:-1] * n + ids[4:]
    _, place, times = np.unique(code, return_inverse=True, return_counts=True)
    again = times[place] > 1
    if not again.any():
        return 0
    inside = np.zeros(n, bool)
    for k in range(WINDOW):
        inside[k : k + len(again)] |= again
    return int(inside.sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The counts and the features of a text."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    lines = [line for line in text.split("\n") if line.strip(WHITE)]
    last = dict(zip(words, range(n)))
    ids = np.fromiter(map(last.__getitem__, words), np.int64, n)
    word_chars = len(text) - sum(map(text.count, WHITE))
    n_symbols = sum(map(text.count, SYMBOLS))
    n_dup_lines = len(lines) - len(set(lines))
    n_repeat = repeated_words(ids)
    chars = max(1, word_chars)
    upper = _upper(text)
    per_word = max(1, n)
    features = [
        float(np.log1p(n)),
        word_chars / per_word,
        n_symbols / chars,
        n_dup_lines / max(1, len(lines)),
        n_repeat / per_word,
        upper / chars,
        text.count("!") / per_word,
        len(last) / per_word,
        float((ids[1:] == ids[:-1]).sum()) / per_word,
        sum(map(text.count, "0123456789")) / chars,
        len(lines) / per_word,
    ]
    return [n, word_chars, n_symbols, n_dup_lines, n_repeat], features


def _upper(text: str) -> int:
    """Letters A to Z."""
    letters = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    return int(((letters >= 65) & (letters <= 90)).sum())


def measured(documents: DataFrame, text: str = "text") -> DataFrame:
    """The rows with the counts and features of their text."""

    def start():
        def work(texts):
            found = [statistics(t) for t in texts]
            counts = list(zip(*(c for c, _ in found))) or [()] * len(COUNTS)
            return [*map(list, counts), [f for _, f in found]]

        return work

    return with_columns(documents, [text], COLUMNS, start)


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> boosting.Trees:
    """Trees for ``labels.quality``, from a bounded sample outside fold 0."""
    rows = measured(labelled(documents, labels, "quality", sample)).select("features", "label")
    found = rows.collect()
    x = np.array([r.features for r in found], float).reshape(-1, len(FEATURES))
    y = np.array([r.label for r in found], float)
    return boosting.fit(x, np.clip(y, 0, 1), MONOTONIC)


def scored(documents: DataFrame, trees: boosting.Trees, text: str = "text") -> DataFrame:
    """The rows with ``quality_score``, the counts, and whether a base rule or the trees reject."""

    def start():
        def work(texts):
            found = [statistics(t) for t in texts]
            x = np.array([f for _, f in found], float).reshape(-1, len(FEATURES))
            scores = trees.probabilities(x).tolist()
            counts = list(zip(*(c for c, _ in found))) or [()] * len(COUNTS)
            failed = [c[0] < 10 or 100 * c[4] > 20 * c[0] for c, _ in found]
            kept = [not bad and s >= LEAST for bad, s in zip(failed, scores)]
            return [*map(list, counts), scores, failed, kept]

        return work

    counts = ", ".join(f"{name} long" for name in COUNTS)
    schema = f"{counts}, quality_score double, base_failed boolean, kept boolean"
    return with_columns(documents, [text], schema, start)
