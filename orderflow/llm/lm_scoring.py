"""Log probabilities of texts by a causal self-attention model and by word counts.

Words are runs without white space, A to Z in lower case; after the last comes an end. The
model sees each word as its subword ids in a public vocabulary. Training documents are those
whose crc32(id as text) mod 5 is not 1.

**Training covers all of them.** Word counts and the shares of ids are counts over all. So are
the pairs of frequent ids that classes of ids and the start of the ids' vectors are made
from. The weights and vectors start from these alone. They move in rounds; a training
document belongs to one round, by the hash of its text, and there every place of it is
predicted. In a round each task takes steps on its own windows, and the tasks' moves are
averaged by the number of places that a task predicted. What a task sends for that is of
fixed size. How the rows are dealt to tasks has a small part in the weights; a document has
one wherever it is.

Counts stay distributed. Words are summed in each task before they are shuffled, a word of
more than ``LONGEST`` bytes under a digest. The most frequent ones, ``COMMON`` at most, go to
every worker with their ids and serve most words of a text; the others of each row are
joined with the counts table. Ids are made once and written to the shared folder, two
bytes each, for training and scoring.

Null texts count as empty: the end alone. Texts are never cut. Repeated rows give repeated
results; an empty table gives an empty one; without training documents all counts are 0.
Only id and text are read, so other columns may have any names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm import attention, bpe
from orderflow.llm.common import remainder, small_batches, staged, with_columns

HELD_OUT = 1
COMMON = 300_000
LONGEST = 40
GRADES = 16
FLUSH = 1_000_000
SAMPLE_DOCUMENTS = 0
"""Documents that steps are taken on before the rounds over all: none."""
RATES = (0.02, 0.01, 0.005)
"""The size of steps in each round over its share of the documents."""
LEAST = 8
"""Windows of a step at least; small corpora take more steps on fewer windows."""
END = b"\n"
"""Stands for the end in the counts table; no word holds white space."""
END_ID = 50_256
IDS = 50_257
KEPT_AS = "<u2"
"""How ids are written; all are below 2^16."""

MARKS = [b".", b",", b";", b":", b"!", b"?"]


def words_in(texts: pa.Array) -> pa.ListArray:
    """The words of each text; a null text has none."""
    low = pc.ascii_trim_whitespace(pc.ascii_lower(texts))
    return pc.ascii_split_whitespace(pc.if_else(pc.equal(low, ""), None, low))


def named(words: pa.Array) -> pa.Array:
    """The words, with what stands for long ones in counts; no word holds white space."""
    long = pc.greater(pc.binary_length(words), LONGEST)
    found = words.filter(long).cast(pa.binary()).to_pylist()
    if not found:
        return words
    return pc.replace_with_mask(words, long, pa.array(["\t" + hashlib.md5(w).hexdigest() for w in found]))


def subwords(model: bpe.Vocabulary, words: list[bytes]) -> list[bytes]:
    """Ids of each word with a space before it, as little-endian 32-bit integers.

    Letters alone are one piece to the vocabulary, and so is a mark at their end.
    """
    ends = frozenset(MARKS)
    heads = [w[:-1] if w[-1:] in ends else w for w in words]
    whole = [h.decode("utf-8", "replace").isalpha() for h in heads]
    marks = dict(zip([b"", *MARKS], [b"", *model.merge(MARKS)]))
    merged = iter(model.merge([b" " + h for h, plain in zip(heads, whole) if plain]))
    model.cache.clear()
    rest = [" " + w.decode("utf-8", "replace") for w, plain in zip(words, whole) if not plain]
    coded = iter(model.encode(rest))
    return [
        next(merged) + marks[w[len(h) :]] if plain else next(coded)
        for w, h, plain in zip(words, heads, whole)
    ]


def laid_flat(coded: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All ids in a row, two bytes each, and how many each word has."""
    lengths = np.array([len(c) // 4 for c in coded], np.int64)
    return np.frombuffer(b"".join(coded), "<u4").astype(KEPT_AS), lengths


@dataclass(frozen=True)
class Lexicon:
    """Common words with their log shares and ids, and the log share of an end."""

    words: pa.Array
    logs: np.ndarray
    ids: np.ndarray
    lengths: np.ndarray
    path: str

    @cached_property
    def end(self) -> int:
        return int(self.places(pa.array([END.decode()]))[0])

    def places(self, words: pa.Array) -> np.ndarray:
        """The number of each word, -1 for others."""
        return pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy().astype(np.int64)

    def read(self, texts: pa.Array) -> dict[str, pa.Array]:
        """For each text its number of tokens, the sum of logs of its common ones, its other
        words with their times, and its ids."""
        split = words_in(texts)
        lengths = pc.fill_null(pc.list_value_length(split), 0).to_numpy().astype(np.int64)
        doc = np.repeat(np.arange(len(split)), lengths)
        flat = split.flatten().dictionary_encode()
        names = named(flat.dictionary)
        number = self.places(names)
        # Long words alone may be common under another name; their ids are made here all the same.
        other_name = np.where(pc.binary_length(flat.dictionary).to_numpy() > LONGEST, number, -1)
        number[other_name >= 0] = -1
        missing = np.flatnonzero(number < 0)
        new, common = flat.dictionary.take(pa.array(missing)), len(self.words)
        number[missing] = common + np.arange(len(new))
        at = number[flat.indices.to_numpy()]
        ids, rooms = laid_flat(subwords(bpe.vocabulary(self.path), new.cast(pa.binary()).to_pylist()))
        names, place = names.take(pa.array(missing)), other_name[missing]
        logs = np.append(self.logs, np.append(self.logs, 0.0)[place])
        part = np.bincount(doc, logs[at], len(split)).astype(float)
        # The end is one more token of every text.
        part += self.logs[self.end] if self.end >= 0 else 0.0

        other = at >= common
        other[other] = place[at[other] - common] < 0
        pairs, times = np.unique(doc[other] * max(1, len(new)) + at[other] - common, return_counts=True)
        owner, which = pairs // max(1, len(new)), pairs % max(1, len(new))
        if self.end < 0:
            names = pa.concat_arrays([names, pa.array([END.decode()])])
            owner = np.append(owner, np.arange(len(split)))
            order = np.argsort(owner, kind="stable")
            which = np.append(which, np.full(len(split), len(new)))[order]
            times, owner = np.append(times, np.ones(len(split), np.int64))[order], owner[order]
        rest = pa.StructArray.from_arrays(
            [names.take(pa.array(which)), pa.array(times, pa.int64())], names=["word", "times"]
        )
        cuts = np.searchsorted(owner, np.arange(len(split) + 1)).astype(np.int32)

        rooms = np.concatenate((self.lengths, rooms))
        starts = np.cumsum(rooms) - rooms
        every = np.concatenate((self.ids, ids))
        room = rooms[at]
        ends = np.cumsum(room)
        taken = every[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[at] - (ends - room), room)]
        edges = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(lengths)))].tolist()
        return {
            "n_tokens": pa.array(lengths + 1),
            "part": pa.array(part),
            "rest": pa.ListArray.from_arrays(pa.array(cuts), rest),
            "ids": pa.array([taken[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])], pa.binary()),
        }


def word_counts(training: DataFrame, text: str = "text") -> DataFrame:
    """``word, count`` over all texts, ends included."""
    small_batches(training.sparkSession)

    def summed(held: list[pa.Table]) -> pa.Table:
        table = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("times", "sum")])
        return table.select(["word", "times_sum"]).rename_columns(["word", "times"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            found = words_in(batch.column(0)).flatten().value_counts()
            ends = pa.table({"word": [END.decode()], "times": [batch.num_rows]})
            held += [pa.table({"word": named(found.field(0)), "times": found.field(1)}), ends]
            if sum(x.num_rows for x in held) > FLUSH:
                held = [summed(held)]
                # What is summed up to little goes on with the next texts.
                if held[0].num_rows > FLUSH // 2:
                    yield from held.pop().to_batches()
        if held:
            yield from summed(held).to_batches()

    parts = training.select(text).mapInArrow(run, "word string, times long")
    return parts.groupBy("word").agg(F.sum("times").alias("count"))


def most_common(counts: DataFrame) -> DataFrame:
    """The words that occur most, ``COMMON`` at most.

    Counts are cut where a step of ``GRADES`` to the doubling ends, so that tasks need not
    each send their best words to the driver.
    """
    grade = F.floor(F.log2("count") * GRADES)
    room, least = COMMON, None
    grades = counts.groupBy(grade.alias("grade")).agg(F.count("*").alias("words"))
    for row in grades.orderBy(F.desc("grade")).collect():
        room -= row.words
        if room < 0:
            break
        least = row.grade
    return counts.where(grade >= least) if least is not None else counts.where("false")


def lexicon(counts: DataFrame, floor: float, path: str) -> Lexicon:
    """The common words with ``log10(count + 0.5) - floor``."""
    table = most_common(counts).select("word", "count").toArrow()
    words = pa.concat_arrays(table.column(0).cast(pa.string()).chunks or [pa.array([], pa.string())])
    logs = np.log10(table.column(1).to_numpy() + 0.5) - floor
    # Ends and what stands for long words are no words of a text; their ids are never read.
    read = [w if w[:1].strip() else b"x" for w in words.cast(pa.binary()).to_pylist()]
    ids, lengths = laid_flat(subwords(bpe.vocabulary(path), read))
    return Lexicon(words, logs, ids, lengths, path)


def id_counts(training: DataFrame) -> np.ndarray:
    """How often each id and the end stand in the training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(IDS, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), KEPT_AS), minlength=IDS)
            total[END_ID] += batch.num_rows
        at = np.flatnonzero(total)
        arrays = [pa.array(at.astype(np.int32)), pa.array(total[at])]
        yield pa.RecordBatch.from_arrays(arrays, names=["id", "times"])

    rows = training.select("ids").mapInArrow(run, "id int, times long")
    found = np.zeros(IDS)
    for number, times in rows.groupBy("id").agg(F.sum("times")).collect():
        found[number] = times
    return found


def sequences_of(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, KEPT_AS).astype(np.int32) for x in column.to_pylist()]


def pair_counts(training: DataFrame, frequent: np.ndarray) -> np.ndarray:
    """``attention.pair_table`` of all training texts."""
    shape = (len(frequent), min(attention.FEATURES, len(frequent)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, np.int64)
        for batch in batches:
            sequences = sequences_of(batch.column(0))
            if sequences:
                given, target, _, _ = attention.laid_out(sequences, END_ID)
                total += attention.pair_table(given, target, frequent, IDS)
        at = np.flatnonzero(total)
        arrays = [pa.array(at.astype(np.int32)), pa.array(total.ravel()[at])]
        yield pa.RecordBatch.from_arrays(arrays, names=["at", "times"])

    parts = training.select("ids").mapInArrow(run, "at int, times long")
    sums = parts.groupBy("at").agg(F.sum("times").alias("times")).toArrow()
    table = np.zeros(shape[0] * shape[1], np.int64)
    table[sums.column(0).to_numpy()] = sums.column(1).to_numpy()
    return table.reshape(shape)


def passed_over(training: DataFrame, model: attention.Model, rate: float, batch: int) -> attention.Model:
    """The model after one pass over all places of the training texts, the tasks' moves averaged."""
    shared = training.sparkSession.sparkContext.broadcast(model)
    sizes = {"vectors" if n == "embed" else n: x.shape for n, x in model.by_slot.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moves, count = shared.value.passed_over((sequences_of(b.column(0)) for b in batches), rate, batch)
        flat = np.concatenate([*(moves[n].ravel().astype(float) * count for n in sizes), [count]])
        at = np.flatnonzero(flat)
        arrays = [pa.array(at.astype(np.int32)), pa.array(flat[at])]
        if count:
            yield pa.RecordBatch.from_arrays(arrays, names=["at", "move"])

    parts = training.select("ids").mapInArrow(run, "at int, move double")
    sums = parts.groupBy("at").agg(F.sum("move").alias("move")).toArrow()
    shared.unpersist()
    if not sums.num_rows:
        return model
    room = [int(np.prod(shape)) for shape in sizes.values()]
    flat = np.zeros(sum(room) + 1)
    flat[sums.column(0).to_numpy()] = sums.column(1).to_numpy()
    pieces = np.split(flat[:-1] / flat[-1], np.cumsum(room)[:-1])
    return model.moved({n: x.reshape(shape) for (n, shape), x in zip(sizes.items(), pieces)})


def trained(training: DataFrame) -> attention.Model:
    """A model of all rows ``first, ids``."""
    counts = id_counts(training)
    table = pair_counts(training, attention.frequent_ids(counts))
    model = attention.train(*attention.no_windows(), counts, END_ID, 0, table)
    windows = int(counts.sum()) // attention.LENGTH
    batch = min(attention.BATCH, max(LEAST, windows // (4 * attention.STEPS)))
    for turn, rate in enumerate(RATES):
        chosen = F.pmod(F.col("first"), F.lit(len(RATES))) == turn
        model = passed_over(training.where(chosen), model, rate, batch)
    return model


def model_scores(rows: DataFrame, model: attention.Model) -> DataFrame:
    """The rows with the model's ``score`` of their ids in place of ids and words."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def start():
        def work(ids):
            sequences = [np.frombuffer(x, KEPT_AS).astype(np.int32) for x in ids]
            return [shared.value.log10(sequences).tolist()]

        return work

    return with_columns(rows.drop("rest"), ["ids"], "score double", start).drop("ids")


def prepared(documents: DataFrame, words: Lexicon, held, key: str, text: str) -> DataFrame:
    """``row, id, held_out, first, n_tokens, part, rest, ids`` of every row, written out.

    ``row`` numbers the rows, ``first`` is a hash of the text, ``part`` the sum of the common
    words' logs, ``rest`` the other words.
    """
    small_batches(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(words)
    rows = documents.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).alias("id"),
        held.alias("held_out"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("first"),
        F.col(text).alias("text"),
    )
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.read(batch.column(4))
            names = [*batch.schema.names[:4], *found]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *found.values()], names=names)

    schema = f"row long, id {kind}, held_out boolean, first long, n_tokens long, part double"
    schema += ", rest array<struct<word:string,times:bigint>>, ids binary"
    return staged(rows.mapInArrow(run, schema), "lm-rows")


def scored(documents: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row."""
    held = F.coalesce(remainder(F.col(key)) == HELD_OUT, F.lit(False))
    counts = staged(word_counts(documents.where(~held), text), "lm-counts")
    total, different = counts.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*")).first()
    floor = math.log10(total + 0.5 * (different + 1))
    rows = prepared(documents, lexicon(counts, floor, path), held, key, text)
    model = trained(rows.where("NOT held_out").select("first", "ids"))
    count = F.coalesce("count", F.lit(0))
    rest = rows.select("row", F.inline("rest")).join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.col("times") * (F.log10(count + 0.5) - floor)).alias("more"),
        F.sum(F.when(count > 0, 0).otherwise(F.col("times"))).alias("unknown"),
    )
    return model_scores(rows, model).join(rest, "row", "left").select(
        F.col("id").alias(key),
        "held_out",
        "n_tokens",
        (F.col("n_tokens") - F.coalesce("unknown", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("part") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        "score",
    )
