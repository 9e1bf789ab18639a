"""Toxicity of texts by a support vector machine over a subsequence string kernel.

**Kernel.** Two words are alike by the subsequences of three letters that they share, a
subsequence that spans ``s`` places counting ``DECAY ** s`` (up to ``SPAN`` places), so
letters put in between, dots, or other endings lower the value without voiding it. The
start of a word counts as a letter. Values are divided by the lengths of both words in
feature space. Single letters that stand apart ("i d i o t") are read as one word.

**Training.** Rows are sentences with the label of their document. A sentence is as toxic as
its worst word, so what a toxic sentence teaches is its witness: the word whose share among
toxic documents most exceeds that among others. A witness stands in ``SUPPORT`` toxic documents
at least that are no near copies of each other (told by the least hash of their words); a
sentence without one teaches nothing, as a label alone doesn't say which word it is for. A
witness is learnt in altered forms too: with dots, spaces or a hyphen between its letters, a
letter twice or a foreign letter inside. From clean sentences come words by hash, and in each
round the words that the machine of the round before finds worst, which are look-alikes.
Landmarks are a part of these words, K(words, landmarks) K(landmarks, landmarks)^-1/2 are the
Nyström features, and a linear machine is trained on them by coordinate descent in the dual.
A document is as toxic as its worst sentence; Platt's logistic curve, fitted on documents
that are clean or hold a witness, turns that into a probability. Its middle lies inside of the
machine's margin, so that a word beyond the margin counts as toxic.

**Scoring.** The machine's value of a word is linear in its subsequences, so weights of
landmarks are summed into one weight for each of the 32^3 subsequences, and whole batches
of texts are scored as flat byte arrays. This is the same value as by landmarks
(``tests/llm/test_toxicity.py``).

Texts: null counts as empty; an empty text has the score of no evidence. Texts are never
cut. Repeated rows give repeated results; an empty table gives an empty one. Without
toxic labels every score is 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import labelled, slices, staged, with_columns

SPAN = 6
DECAY = 0.6
CODES = 32
GAP = 31
SAMPLE = 16_000
"""Labelled documents that the machine is trained on, at most."""
CLEAN_WORDS = 6_000
LANDMARKS = 384
ROUNDS = 3
COST = 20.0
MOST = 30
SUPPORT = 5
ODDS = 4.5
MIDDLE = (-0.5, 0.9)
"""Where the curve's middle may lie; the machine's margin is from -1 to 1."""
FOREIGN = "xzqk"
"""Letters that are put into witnesses."""
PLACES = 1 << 20
"""Bytes of text that are scored at once; each takes about 35 bytes of memory meanwhile."""

PATTERNS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]


def _code_table() -> np.ndarray:
    """0 for white space, 1-26 for letters in either case, 27-30 for bytes beyond ASCII, else a gap."""
    codes = np.full(256, GAP, np.uint8)
    codes[[9, 10, 11, 12, 13, 32]] = 0
    for n in range(26):
        codes[[65 + n, 97 + n]] = 1 + n
    codes[0x80:0xC0] = 27 + np.arange(0x40) % 4
    codes[0xC0:] = 27 + (np.arange(0x40) + 1) % 4
    return codes


TABLE = _code_table()
LETTERS = np.ones((CODES, CODES, CODES), np.float32)
"""1 for subsequences without gaps, by their number."""
LETTERS[GAP], LETTERS[:, GAP], LETTERS[:, :, GAP] = 0, 0, 0
LETTERS[:, 0], LETTERS[:, :, 0] = 0, 0
LETTERS = LETTERS.reshape(-1)


class Words:
    """The words of texts as places in one flat array of codes."""

    def __init__(self, texts: list[bytes]) -> None:
        joined = b" " + b" ".join(texts) + b" "
        self.bytes = np.frombuffer(joined, np.uint8)
        codes = TABLE[self.bytes]
        self.text_ends = np.cumsum([len(t) + 1 for t in texts])
        edge = codes == 0
        edges = np.flatnonzero(edge)
        single = np.diff(edges) == 2
        single &= (codes[edges[:-1] + 1] > 0) & (codes[edges[:-1] + 1] <= 26)
        between = np.zeros(len(edges), bool)
        between[1:-1] = single[:-1] & single[1:]
        between[np.isin(edges, self.text_ends)] = False
        codes[edges[between]] = GAP
        edges = edges[~between]
        room = np.diff(edges) - 1
        self.starts, self.room = edges[:-1][room > 0], room[room > 0]
        self.codes = codes.astype(np.int32)
        self.text = np.searchsorted(self.text_ends, self.starts, "right")
        # How many places of the word follow each place; the last edge has none.
        left = np.repeat(edges[1:], np.diff(edges)) - np.arange(len(codes) - 1) - 1
        self.left = np.append(np.minimum(left, SPAN - 1), 0).astype(np.int8)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """For each word the sum over its places, its start counted in."""
        if not len(self.starts):
            return np.zeros(0)
        total = np.concatenate(([0.0], np.cumsum(values, dtype=float)))
        return total[self.starts + self.room + 1] - total[self.starts]

    def subsequences(self):
        """Places, subsequence numbers and weights, by pattern of offsets."""
        codes = self.codes
        for a, b in PATTERNS:
            n = max(0, len(codes) - b)
            number = (codes[:n] * CODES + codes[a : a + n]) * CODES + codes[b:]
            yield n, number, (self.left[:n] >= b), DECAY ** (b + 1)

    def values(self, weights: np.ndarray) -> np.ndarray:
        """For each word the weights of its subsequences, divided by its length in feature space.

        Each place's subsequences are taken as different for that length.
        """
        total, square = np.zeros(len(self.codes), np.float32), np.zeros(len(self.codes), np.float32)
        for n, number, inside, decay in self.subsequences():
            number = np.where(inside, number, GAP)
            total[:n] += weights[number] * np.float32(decay)
            square[:n] += LETTERS[number] * np.float32(decay**2)
        return self.sums(total) / np.sqrt(np.maximum(self.sums(square), 1e-12))

    def word(self, n: int) -> str:
        start = self.starts[n] + 1
        return self.bytes[start : start + self.room[n]].tobytes().decode("utf-8", "replace")


def features(words: list[str]) -> np.ndarray:
    """Each word's vector over all subsequences, of length about one."""
    out = np.zeros((len(words), CODES**3), np.float32)
    for n, word in enumerate(words):
        flat = Words([word.encode("utf-8", "replace")])
        square = 0.0
        for _, number, inside, decay in flat.subsequences():
            counted = LETTERS[number] * inside
            np.add.at(out[n], number, counted * decay)
            square += counted.sum() * decay**2
        out[n] /= np.sqrt(max(square, 1e-12))
    return out


def svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, passes: int = 30) -> np.ndarray:
    """Weights of a linear machine with hinge loss, by coordinate descent in the dual."""
    alpha, w = np.zeros(len(x)), np.zeros(x.shape[1])
    squares = (x**2).sum(axis=1) + 1e-12
    order = np.random.default_rng(7)
    for _ in range(passes):
        for i in order.permutation(len(x)):
            new = min(max(alpha[i] - (y[i] * (x[i] @ w) - 1) / squares[i], 0.0), cost[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return w


@dataclass(frozen=True)
class Machine:
    """Landmarks with their weights, the offset, the same as subsequence weights, and the curve."""

    landmarks: list[str]
    weights: np.ndarray
    offset: float
    subsequences: np.ndarray
    slope: float = 1.0
    middle: float = 0.0

    def evidence(self, texts: list[str | None]) -> tuple[np.ndarray, list[str]]:
        """For each text the value of its worst word, -1 without words, and that word."""
        coded = [(t or "").encode("utf-8", "replace") for t in texts]
        best, worst = np.full(len(texts), -1.0), [""] * len(texts)
        begin = 0
        while begin < len(coded):
            end, room = begin + 1, PLACES - len(coded[begin])
            while end < len(coded) and room >= len(coded[end]):
                room -= len(coded[end])
                end += 1
            words = Words(coded[begin:end])
            values = words.values(self.subsequences) + self.offset
            if len(values):
                order = np.lexsort((-np.arange(len(values)), values, words.text))
                last = order[np.flatnonzero(np.diff(words.text[order], append=-1))]
                for n in last.tolist():
                    best[begin + words.text[n]] = values[n]
                    worst[begin + words.text[n]] = words.word(n)
            begin = end
        return best, worst

    def probabilities(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (evidence - self.middle), -40, 40)))


def altered(word: str) -> list[str]:
    """The word with dots, spaces or a hyphen, with a letter twice, and with foreign letters."""
    middle = len(word) // 2
    forms = [
        ".".join(word),
        " ".join(word) if word.isascii() and word.isalpha() else word,
        f"{word[:middle]}-{word[middle:]}",
        f"{word[:middle]}{word[middle - 1 : middle]}{word[middle:]}",
    ]
    return forms + [word[:n] + c + word[n:] for n in range(1, len(word)) for c in FOREIGN]


def train(
    positive: list[str],
    negative: list[str],
    landmarks: int = LANDMARKS,
    times: dict[str, int] | None = None,
) -> Machine:
    """A machine that tells the positive words, also altered ones, from the negative ones.

    ``times`` tells in how many sentences a word was met; it counts so often, ``MOST`` at most.
    """
    if not positive:
        return Machine([], np.zeros(0), -1.0, np.zeros(CODES**3, np.float32))
    variants = [v for word in positive for v in altered(word) if len(word) > 3]
    words = positive + variants + negative
    chosen = [*range(min(landmarks // 2, len(positive)))]
    first = len(positive) + len(variants)
    chosen += [first + n for n in range(min(landmarks - len(chosen), len(negative)))]
    base = features([words[n] for n in chosen])
    size, vectors = np.linalg.eigh((base @ base.T).astype(float))
    root = vectors / np.sqrt(np.maximum(size, 1e-6)) @ vectors.T
    flat = Words([word.encode("utf-8", "replace") for word in words])
    nystroem = np.stack([flat.values(landmark) for landmark in base], axis=1) @ root
    y = np.array([1.0] * first + [-1.0] * len(negative))
    balance = max(1.0, len(negative) / first)
    x = np.hstack((nystroem, np.ones((len(words), 1))))
    often = np.array([min(MOST, (times or {}).get(word, 1)) for word in words], float)
    found = svm(x, y, often * np.where(y > 0, COST * balance, COST))
    weights = root @ found[:-1]
    return Machine([words[n] for n in chosen], weights, float(found[-1]), (weights @ base).astype(np.float32))


def platt(evidence: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and middle of the logistic curve of labels over evidence."""
    a, b = 4.0, 0.0
    goal = np.where(y > 0, 1 - 1e-3, 1e-3)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(a * evidence + b, -40, 40)))
        v, error = p * (1 - p) + 1e-6, p - goal
        g = np.array([(error * evidence).sum() + 1e-3 * a, error.sum() + 1e-3 * b])
        h = np.array([[(v * evidence**2).sum() + 1e-3, (v * evidence).sum()]] * 2)
        h[1] = [(v * evidence).sum(), v.sum() + 1e-3]
        step = np.clip(np.linalg.solve(h, g), -1, 1)
        a, b = max(a - step[0], 1e-2), b - step[1]
        if np.abs(step).max() < 1e-7:
            break
    return float(a), float(-b / a)


WORD = r"[^\s.,;:!?\"()\[\]{}#$%&*|<>]+"


def sentences(rows: DataFrame) -> DataFrame:
    """``doc_id, label, sentence`` of ``doc_id, label, text``."""
    parts = F.split("text", r"(?<=[.!?])\s+|\n+")
    return rows.select("doc_id", "label", F.explode(parts).alias("sentence")).where("sentence <> ''")


def _words(rows: DataFrame, column: str) -> DataFrame:
    """``doc_id, label, word`` for all words of a column, each once a row."""
    found = F.array_distinct(F.expr(f"regexp_extract_all(lower({column}), r'{WORD}', 0)"))
    words = rows.select("doc_id", "label", F.explode(found).alias("word"))
    return words.where(F.length("word").between(2, 40))


def witnesses(rows: DataFrame) -> DataFrame:
    """``word, odds, times``: telling words of toxic sentences, and in how many they are that."""
    words = _words(sentences(rows), "sentence").distinct()
    alike = words.groupBy("doc_id").agg(F.min(F.xxhash64("word")).alias("alike"))
    words = words.join(alike, "doc_id")
    toxic = F.when(F.col("label") > 0, F.col("alike"))
    counted = words.groupBy("word").agg(
        F.count_distinct(toxic).alias("toxic"), F.count_distinct("alike").alias("docs")
    )
    total = words.agg(F.count_distinct(toxic).alias("toxic"), F.count_distinct("alike").alias("docs")).first()
    t, d = total["toxic"] or 0, total["docs"]
    odds = F.log((F.col("toxic") + 0.1) / (t + 1)) - F.log(
        (F.col("docs") - F.col("toxic") + 0.1) / (d - t + 1)
    )
    telling = counted.where(F.col("toxic") >= SUPPORT).select("word", odds.alias("odds"))
    telling = telling.where(F.col("odds") > ODDS)
    toxic_rows = sentences(rows.where("label > 0")).withColumn("n", F.monotonically_increasing_id())
    best = (
        _words(toxic_rows.withColumn("doc_id", F.col("n")), "sentence")
        .join(telling, "word")
        .groupBy("doc_id")
        .agg(F.max(F.struct("odds", "word")).alias("best"))
    )
    return best.groupBy(F.col("best.word").alias("word")).agg(
        F.max("best.odds").alias("odds"), F.count("*").alias("times")
    )


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """A machine trained on a bounded sample of labelled documents outside fold 0.

    Equal texts of one label count once. Only words reach the driver: the witnesses of toxic
    sentences, the worst words of clean ones, and ``CLEAN_WORDS`` more.
    """
    rows = labelled(documents, labels, "toxic", sample)
    rows = rows.groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.max("label").alias("label"))
    rows = staged(rows.where("text IS NOT NULL"), "toxicity-sample")
    found = witnesses(rows).collect()
    positive = [r.word for r in sorted(found, key=lambda r: (-r.times, r.word))]
    if not positive:
        return train([], [])
    clean = sentences(rows.where("label = 0")).select("label", F.col("sentence").alias("text"))
    clean = staged(clean, "toxicity-sentences")
    known = set(positive)
    every = _words(clean.withColumn("doc_id", F.lit(0)), "text").select("word").distinct()
    chosen = slices(every, F.col("word"), CLEAN_WORDS).collect()
    negative = sorted({r.word for r in chosen} - known, key=lambda w: (hash_of(w), w))
    times = {r.word: r.times for r in found}
    for _ in range(ROUNDS):
        machine = train(positive, negative, times=times)
        judged = _judged(clean, machine).where("evidence > -0.8").groupBy(F.lower("word").alias("word"))
        worst = judged.agg(F.max("evidence").alias("e"), F.count("*").alias("times"))
        worst = worst.orderBy(F.desc("e"), "word").limit(CLEAN_WORDS).collect()
        times |= {r.word: max(r.times, times.get(r.word, 0)) for r in worst if r.word not in known}
        # Look-alikes come first, since the first words become landmarks.
        new = dict.fromkeys(r.word for r in worst if r.word not in known)
        negative = [*new, *(w for w in negative if w not in new)]
    machine = train(positive, negative, times=times)
    telling = F.exists(
        F.expr(f"regexp_extract_all(lower(text), r'{WORD}', 0)"), lambda w: w.isin(positive)
    )
    judged = rows.where((F.col("label") == 0) | telling)
    values = _judged(judged, machine).select("label", "evidence").collect()
    y = np.array([r.label for r in values], float)
    slope, middle = platt(np.array([r.evidence for r in values]), y)
    middle = min(max(middle, MIDDLE[0]), MIDDLE[1])
    return Machine(
        machine.landmarks, machine.weights, machine.offset, machine.subsequences, slope, middle
    )


def hash_of(word: str) -> int:
    """A number that puts words in an order without meaning."""
    return int.from_bytes(word.encode("utf-8", "replace")[::-1][:8].ljust(8, b"\1"), "big") * 2654435761 % 2**32


def _judged(rows: DataFrame, machine: Machine) -> DataFrame:
    def start():
        def work(texts):
            evidence, words = machine.evidence(texts)
            return [evidence.tolist(), words]

        return work

    return with_columns(rows, ["text"], "evidence double, word string", start).drop("text")


def scored(documents: DataFrame, machine: Machine, text: str = "text") -> DataFrame:
    """The rows with ``toxicity`` from 0 to 1 and the ``toxic_word`` it comes from."""

    def start():
        def work(texts):
            evidence, words = machine.evidence(texts)
            return [machine.probabilities(evidence).tolist(), words]

        return work

    return with_columns(documents, [text], "toxicity double, toxic_word string", start)
