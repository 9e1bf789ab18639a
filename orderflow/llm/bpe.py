"""Byte-pair encoding and decoding with a public vocabulary.

Merge rounds run in numpy over many words at once. The symbols of all words lie in one
flat array; in each round every word joins all places of its lowest-ranked pair. A
pair's rank is found by binary search over the sorted keys of all pairs. A joined
symbol can only take part in pairs of a higher rank, so rounds give what merging one
place at a time gives.

Texts: null counts as empty and has no ids; repeated rows give repeated results; texts
are never cut. An empty table gives an empty table. Only the id and text columns are
read, so others may have any name.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from orderflow.llm.common import small_batches

# Fixed value: the pattern that splits text for this vocabulary.
PIECES = regex.compile(
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)
NONE = np.iinfo(np.int64).max
SHIFT = 20
CACHED = 250_000
"""Words whose ids a worker remembers, about 60 MB; then it starts afresh."""


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class Vocabulary:
    """Ids, merges and bytes of a byte-level vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        ids, letters = content["model"]["vocab"], byte_letters()
        self.special = {
            t["content"]: t["id"] for t in content.get("added_tokens") or () if t["special"]
        }
        self.split_special = (
            regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
            if self.special
            else None
        )
        self.first = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.first[byte] = ids[letter]

        pairs = [p.split(" ") if isinstance(p, str) else p for p in content["model"]["merges"]]
        keys = np.array([(ids[a] << SHIFT) | ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.joined = np.array([ids[a + b] for a, b in pairs], np.int64)

        # What binary search gives for every two bytes.
        self.byte_ranks = self._ranks_of(self.first[:, None], self.first)

        size = 1 + max([*ids.values(), *self.special.values()])
        pieces = [b""] * size
        for token, number in ids.items():
            pieces[number] = bytes(letters[c] for c in token)
        for token, number in self.special.items():
            pieces[number] = token.encode()
        self.lengths = np.array([len(p) for p in pieces], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)[:-1]))
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.cache: dict[str, bytes] = {}

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(left), NONE)
        key = (left << SHIFT) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as little-endian 32-bit integers. Words may not be empty."""
        out: list[bytes] = [b""] * len(words)
        if not words:
            return out
        raw = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.first[raw]
        lengths = np.array([len(w) for w in words], np.int64)
        owner = np.arange(len(words))
        ranks = np.full(len(symbols), NONE)
        ranks[:-1] = self.byte_ranks[raw[:-1], raw[1:]]
        ranks[np.cumsum(lengths) - 1] = NONE
        while len(owner):
            starts = np.cumsum(lengths) - lengths
            lowest = np.minimum.reduceat(ranks, starts)
            done = lowest == NONE
            if done.any():
                ready = np.repeat(done, lengths)
                flat = symbols[ready].astype("<u4").tobytes()
                ends = np.cumsum(lengths[done]) * 4
                for word, begin, end in zip(
                    owner[done].tolist(), (ends - lengths[done] * 4).tolist(), ends.tolist()
                ):
                    out[word] = flat[begin:end]
                symbols, ranks = symbols[~ready], ranks[~ready]
                owner, lengths, lowest = owner[~done], lengths[~done], lowest[~done]
                if not len(owner):
                    break
            word_of = np.repeat(np.arange(len(owner)), lengths)
            chosen = np.flatnonzero(ranks == lowest[word_of])
            # Of overlapping places (as in "aaa") every second one counts, from the left.
            run = np.flatnonzero(np.diff(chosen, prepend=-2) != 1)
            place = np.arange(len(chosen)) - np.repeat(run, np.diff(run, append=len(chosen)))
            chosen = chosen[place % 2 == 0]

            symbols[chosen] = self.joined[ranks[chosen]]
            ranks[chosen] = ranks[chosen + 1]
            keep = np.ones(len(symbols), bool)
            keep[chosen + 1] = False
            lengths = lengths - np.bincount(word_of[chosen], minlength=len(owner))
            moved = chosen - np.arange(len(chosen))
            symbols, ranks = symbols[keep], ranks[keep]
            last = np.zeros(len(symbols), bool)
            last[np.cumsum(lengths) - 1] = True
            changed = np.zeros(len(symbols), bool)
            changed[moved] = changed[moved[moved > 0] - 1] = True
            touched = np.flatnonzero(changed & ~last)
            ranks[touched] = self._ranks_of(symbols[touched], symbols[touched + 1])
            ranks[last] = NONE
        return out

    def _pieces(self, text: str) -> list[str]:
        if self.split_special is None or not any(s in text for s in self.special):
            return PIECES.findall(text)
        pieces: list[str] = []
        for part in self.split_special.split(text):
            pieces += [part] if part in self.special else PIECES.findall(part)
        return pieces

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """The ids of each text, as little-endian 32-bit integers."""
        if len(self.cache) > CACHED or not self.cache:
            self.cache = {s: np.array([n], "<u4").tobytes() for s, n in self.special.items()}
        cache, split = self.cache, [self._pieces(text or "") for text in texts]
        new = list({piece for pieces in split for piece in pieces if piece not in cache})
        cache.update(zip(new, self.merge([piece.encode() for piece in new])))
        return [b"".join(map(cache.__getitem__, pieces)) for pieces in split]

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        numbers = np.frombuffer(ids, "<u4").astype(np.int64)
        lengths = self.lengths[numbers]
        ends = np.cumsum(lengths)
        offset = np.repeat(self.starts[numbers] - (ends - lengths), lengths)
        return self.bytes[offset + np.arange(len(offset))].tobytes().decode("utf-8", "replace")


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, loaded once in each worker."""
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def encode(texts: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and ``ids`` (little-endian unsigned 32-bit integers) of every row's whole text.

    A text holding a special token's string gets that token's id.
    """
    small_batches(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = vocabulary(path)
        for batch in batches:
            ids = pa.array(model.encode(batch.column(1).to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=[key, "ids"])

    rows = texts.select(key, text)
    return rows.mapInArrow(run, f"`{key}` {rows.schema[0].dataType.simpleString()}, ids binary")


def decode(ids: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """Key and ``ids`` with the ``decoded`` text, special tokens included."""
    small_batches(ids.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = vocabulary(path)
        for batch in batches:
            texts = [model.decode(x or b"") for x in batch.column(1).to_pylist()]
            arrays = [batch.column(0), batch.column(1), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=[key, "ids", "decoded"])

    rows = ids.select(key, "ids")
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, ids binary, decoded string")


def round_trip(texts: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """What ``encode`` and then ``decode`` give, by one worker for each task instead of two."""
    small_batches(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = vocabulary(path)
        for batch in batches:
            ids = model.encode(batch.column(1).to_pylist())
            decoded = pa.array([model.decode(x) for x in ids], pa.string())
            arrays = [batch.column(0), pa.array(ids, pa.binary()), decoded]
            yield pa.RecordBatch.from_arrays(arrays, names=[key, "ids", "decoded"])

    rows = texts.select(key, text)
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, ids binary, decoded string")
