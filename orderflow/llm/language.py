"""Language of texts by error-correcting output codes over byte n-grams.

**Codewords.** Every language has a word of bits. Up to ``EXHAUSTIVE`` languages get every
way to split them into two camps; more get ``10 * log2`` random bits, of many draws the one
whose closest two words are farthest apart.

**Bits.** One binary classifier for each bit tells the languages with a 1 from those with a
0. It is a naive Bayes machine: a text's margin is the mean, over its n-grams of 2 to 4 bytes
inside words and at their edges, of the log ratio of their shares in both camps. The shares
are counted over all training documents, in each task before the shuffle; n-grams are
hashed to ``SLOTS`` slots, so what reaches the driver is bounded by languages times slots. A
document's n-grams count by the logarithm of their number, so that no single one outweighs
a language. A logistic curve fitted on a bounded sample of labelled rows turns margins
into log odds.

**Decoding.** A codeword's loss is the sum of the logistic losses of its bits, weighted by
how often that bit is right on the sample's texts of that language. The language of the
least loss wins, of equal ones the first by name. Its score is its share when losses are
turned into probabilities; a text is ambiguous if another language has more than half of
that share.

Null texts and texts without a letter are ``und`` with score 0, and so is every text if there
is nothing to learn from. Texts are never cut. Rows with a null text or label teach nothing;
repeated rows count as often as they stand there. Only id, text and label are read, so other
columns may have any names; an empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import remainder, slices, small_batches, with_columns

PARTS = 4
HELD_OUT = 2
SLOTS = 1 << 16
SIZES = (2, 3, 4)
EXHAUSTIVE = 6
DRAWS = 200
SAMPLE = 8_000
"""Labelled documents that the curves and the weights of bits are fitted on, at most."""
PLACES = 1 << 18
"""Bytes of text that are worked on at once; each takes about 150 bytes of memory meanwhile."""
UNKNOWN = "und"

_SPACE = bytes(c if chr(c).isalpha() or c >= 0x80 else 0x20 for c in range(256))


def codewords(languages: int) -> np.ndarray:
    """A row of -1 and 1 for each language; all rows differ and no column is constant."""
    if languages < 2:
        return np.ones((languages, 0))
    if languages <= EXHAUSTIVE:
        numbers = np.arange(1, 2 ** (languages - 1))
        bits = (numbers[None, :] >> np.arange(languages)[:, None]) & 1
        return np.where(bits, 1.0, -1.0)
    random = np.random.default_rng(3)
    width = math.ceil(10 * math.log2(languages))
    best, farthest = None, -1.0
    for _ in range(DRAWS):
        drawn = random.choice([-1.0, 1.0], (languages, width))
        drawn[0] = np.where(np.abs(drawn.sum(axis=0)) == languages, -drawn[0], drawn[0])
        alike = drawn @ drawn.T - 2 * width * np.eye(languages)
        if width - alike.max() > farthest:
            best, farthest = drawn, width - alike.max()
    return best


def chunks(texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Begin and end of some texts in turn, and the slots and text of all their n-grams."""
    coded = [(t or "").lower().encode("utf-8", "replace").translate(_SPACE) for t in texts]
    begin = 0
    while begin < len(coded):
        end, room = begin + 1, PLACES - len(coded[begin])
        while end < len(coded) and room >= len(coded[end]):
            room -= len(coded[end])
            end += 1
        yield (begin, end, *grams(coded[begin:end]))
        begin = end


def grams(coded: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all n-grams that no space parts, text by text, and the text of each."""
    flat = np.frombuffer(b" " + b" ".join(coded) + b" ", np.uint8)
    text = np.repeat(np.arange(len(coded)), [len(c) + 1 for c in coded])
    text = np.append(text, len(coded) - 1)
    space = flat == 0x20
    keep = np.ones(len(flat), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    flat, text, space = flat[keep].astype(np.uint32), text[keep], space[keep]
    slots, owners = [], []
    for size in SIZES:
        n = len(flat) - size + 1
        if n < 1:
            continue
        code = np.full(n, size, np.uint32)
        inside = np.ones(n, bool)
        for k in range(size):
            code = code * np.uint32(0x01000193) ^ flat[k : n + k]
            if 0 < k < size - 1:
                inside &= ~space[k : n + k]
        code = (code * np.uint32(0x9E3779B1)) >> np.uint32(16)
        if size == 2:
            inside &= ~(space[:n] & space[1 : n + 1])
        slots.append(code[inside])
        owners.append(np.where(space[:n], text[1 : n + 1], text[:n])[inside])
    owner, slot = np.concatenate([*owners, np.zeros(0, int)]), np.concatenate([*slots, np.zeros(0, np.uint32)])
    order = np.argsort(owner, kind="stable")
    return slot[order], owner[order]


@dataclass(frozen=True)
class Decoder:
    """Languages by name, their codewords, weights of slots by bit, curves, weights of bits."""

    languages: list[str]
    codes: np.ndarray
    slots: np.ndarray
    slopes: np.ndarray
    middles: np.ndarray
    trust: np.ndarray

    def margins(self, texts: list[str | None]) -> np.ndarray:
        """The mean log ratio of each text's n-grams for each bit; 0 without n-grams."""
        out = np.zeros((len(texts), self.codes.shape[1]))
        for begin, end, slots, owner in chunks(texts):
            if len(slots) and self.codes.shape[1]:
                edges = np.flatnonzero(np.diff(owner, prepend=-1))
                sums = np.add.reduceat(self.slots.take(slots, axis=0), edges, axis=0)
                counts = np.diff(np.append(edges, len(owner)))
                out[begin + owner[edges]] = sums / counts[:, None]
        return out

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """The weighted loss of every language's codeword for each text."""
        odds = self.slopes * (margins - self.middles)
        agrees, fails = np.logaddexp(0, -odds), np.logaddexp(0, odds)
        ones = np.where(self.codes > 0, self.trust, 0)
        return agrees @ ones.T + fails @ (self.trust - ones).T

    def decoded(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        """Language, score and whether another language is nearly as close."""
        names, scores, unsure = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
        known = [n for n, t in enumerate(texts) if t is not None and any(map(str.isalpha, t))]
        if known and self.languages:
            loss = self.losses(self.margins([texts[n] for n in known]))
            share = np.exp(loss.min(axis=1, keepdims=True) - loss)
            share /= share.sum(axis=1, keepdims=True)
            best = share.argmax(axis=1)
            top = share[np.arange(len(best)), best]
            share[np.arange(len(best)), best] = 0
            close = share.max(axis=1) > top / 2
            for n, b, s, c in zip(known, best.tolist(), top.tolist(), close.tolist()):
                names[n], scores[n], unsure[n] = self.languages[b], s, c
        return names, scores, unsure


def counted(rows: DataFrame, languages: list[str]) -> np.ndarray:
    """How much every slot counts for every language, over all rows ``text, lang``."""
    small_batches(rows.sparkSession)
    number = {name: n for n, name in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            texts, names = (batch.column(n).to_pylist() for n in range(2))
            for begin, _, slots, owner in chunks(texts):
                edges = np.flatnonzero(np.diff(owner, prepend=-1)).tolist()
                for a, b in zip(edges, [*edges[1:], len(owner)]):
                    language = number[names[begin + int(owner[a])]]
                    found, times = np.unique(slots[a:b], return_counts=True)
                    if language not in totals:
                        totals[language] = np.zeros(SLOTS)
                    totals[language][found] += np.log1p(times)
        for language, total in totals.items():
            at = np.flatnonzero(total)
            arrays = [
                pa.array(np.full(len(at), language, np.int32)),
                pa.array(at.astype(np.int32)),
                # Whole millionths, so that sums don't depend on their order.
                pa.array(np.rint(total[at] * 1e6).astype(np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["language", "slot", "times"])

    parts = rows.select("text", "lang").mapInArrow(run, "language int, slot int, times long")
    sums = parts.groupBy("language", "slot").agg(F.sum("times").alias("times")).toArrow()
    out = np.zeros((len(languages), SLOTS))
    language, slot, times = (sums.column(n).to_numpy() for n in range(3))
    out[language, slot] = times / 1e6
    return out


def bit_weights(counts: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Log ratio of each slot's share in both camps of each bit, languages weighing alike."""
    smooth = counts + 0.5
    shares = smooth / smooth.sum(axis=1, keepdims=True)
    ones, zeros = codes > 0, codes < 0
    first = shares.T @ ones / ones.sum(axis=0)
    second = shares.T @ zeros / zeros.sum(axis=0)
    return (np.log(first) - np.log(second)).astype(np.float32)


def curve(margin: np.ndarray, wanted: np.ndarray) -> tuple[float, float]:
    """Slope and middle of the logistic curve of a bit over its margins, both camps alike heavy."""
    heavy = np.where(wanted > 0, 0.5 / max(1, (wanted > 0).sum()), 0.5 / max(1, (wanted < 0).sum()))
    goal = np.where(wanted > 0, 0.995, 0.005)
    a, b = 4.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -40, 40)))
        error, v = heavy * (p - goal), heavy * p * (1 - p)
        gradient = np.array([error @ margin + 1e-4 * a, error.sum() + 1e-4 * b])
        cross = v @ margin
        second = np.array([[v @ margin**2 + 1e-4, cross], [cross, v.sum() + 1e-4]])
        step = np.clip(np.linalg.solve(second, gradient), -2, 2)
        a, b = max(a - step[0], 0.1), b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(a), float(-b / a)


def fit(documents: DataFrame, fold: int | None = HELD_OUT, sample: int = SAMPLE) -> Decoder:
    """A decoder learnt from ``text`` and ``lang`` of all documents outside the fold."""
    rows = documents.select("doc_id", "text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    if fold is not None:
        rows = rows.where(F.coalesce(remainder(F.col("doc_id"), PARTS) != fold, F.lit(True)))
    languages = sorted(r.lang for r in rows.select("lang").distinct().collect())
    codes = codewords(len(languages))
    bits = codes.shape[1]
    even = np.ones((len(languages), bits)) / max(1, bits)
    if not bits:
        return Decoder(languages, codes, np.zeros((SLOTS, 0), np.float32), np.ones(0), np.zeros(0), even)
    weights = bit_weights(counted(rows, languages), codes)
    plain = Decoder(languages, codes, weights, np.ones(bits), np.zeros(bits), even)

    def start():
        return lambda texts: [plain.margins(texts).tolist()]

    chosen = slices(rows.where("doc_id IS NOT NULL"), F.col("doc_id"), sample).select("text", "lang")
    found = with_columns(chosen, ["text"], "margins array<double>", start).select("lang", "margins").collect()
    if not found:
        return plain
    number = {name: n for n, name in enumerate(languages)}
    margins = np.array([r.margins for r in found])
    truth = np.array([number[r.lang] for r in found])
    curves = [curve(margins[:, b], codes[truth, b]) for b in range(bits)]
    slopes, middles = (np.array(x) for x in zip(*curves))
    right = (margins > middles) == (codes[truth] > 0)
    trust = np.stack([(right[truth == n].sum(axis=0) + 1) / ((truth == n).sum() + 1) for n in range(len(languages))])
    return Decoder(languages, codes, weights, slopes, middles, trust / trust.sum(axis=1, keepdims=True) * bits / 2)


def predicted(documents: DataFrame, decoder: Decoder, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, lang_pred, score, ambiguous`` of every row."""
    shared = documents.sparkSession.sparkContext.broadcast(decoder)

    def start():
        return lambda texts: list(shared.value.decoded(texts))

    rows = documents.select(F.col(key).alias("id"), F.col(text).alias("words"))
    found = with_columns(rows, ["words"], "lang_pred string, score double, ambiguous boolean", start)
    return found.select(F.col("id").alias(key), "lang_pred", "score", "ambiguous")
