"""A small causal self-attention model over subword ids, trained and run in numpy.

The next id's class is predicted from the ids before it inside a window: one attention
layer with relative position weights, added to the last id's own path. The id within its
class is drawn by its share of the training corpus, so probabilities of all ids sum to one.
Classes are clusters of ids that follow similar ids.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import cached_property

import numpy as np

LENGTH = 32
STRIDE = 24
SIZE = 16
CLASSES = 64
FREQUENT = 2048
"""Ids that are clustered by what stands before them, at most."""
FEATURES = 256
"""Of these the ids whose standing before others is counted."""
STEPS = 200
BATCH = 256
RATE = 0.01
PASS_RATE = 0.002
PARTS = 1
"""A pass predicts one of so many parts of the places: all of them."""
ROWS = 256
"""Windows that are scored at once; few, so that their arrays stay in a core's cache."""
TOGETHER = 24
"""Windows whose gradients are worked out at once, for the same reason; products of matrices
of that size are also the fastest."""
STEADY = 60.0
"""Sums of exponentials of numbers up to this one are exact enough in 32 bits."""

Weights = dict[str, np.ndarray]


@dataclass(frozen=True)
class Model:
    """Weights, each id's class, and each id's log10 share of its class."""

    weights: Weights
    classes: np.ndarray
    inside: np.ndarray
    end: int
    slots: np.ndarray
    """Ids of one slot share a vector; each clustered id has a slot of its own."""

    def log10(self, sequences: list[np.ndarray]) -> np.ndarray:
        """Log10 probability of each sequence of ids and its end.

        Windows overlap: the first one of a sequence scores all of its ids, the others those of
        their last ``STRIDE`` places, so each id is scored once, with ids before it in view.
        """
        total = np.zeros(len(sequences))
        if not len(sequences):
            return total
        given, target, starts, ends = laid_out(sequences, self.end)
        given, lengths = self.slots[given], ends - starts
        later = np.maximum(0, -(-(lengths - LENGTH) // STRIDE))
        place = np.arange(later.sum()) - np.repeat(np.cumsum(later) - later, later) + 1
        groups = [
            (starts, np.arange(len(sequences)), 0),
            (
                np.repeat(starts, later) + place * STRIDE,
                np.repeat(np.arange(len(later)), later),
                LENGTH - STRIDE,
            ),
        ]
        for begin, owner, first in groups:
            for n in range(0, len(begin), ROWS):
                rows = begin[n : n + ROWS, None] + np.arange(LENGTH)
                inside = rows < ends[owner[n : n + ROWS], None]
                rows = np.minimum(rows, len(target) - 1)
                wanted = target[rows[:, first:]]
                found = self.class_log10(given[rows], self.classes[wanted], first)
                found = (found + self.inside[wanted]) * inside[:, first:]
                total += np.bincount(owner[n : n + ROWS], found.sum(axis=1), len(sequences))
        return total

    def passed_over(
        self, batches: Iterable[list[np.ndarray]], rate: float = PASS_RATE, batch: int = BATCH
    ) -> tuple[Weights, int]:
        """How weights move in one pass over all sequences, and how many places it predicted.

        Every place of every sequence is predicted once, from all places of its window before.
        """
        w, steps, count = self.by_slot, Steps(self.by_slot, rate), 0
        for sequences in batches:
            if not sequences:
                continue
            given, target, starts, ends = laid_out(sequences, self.end)
            room = -(-(ends - starts) // LENGTH) * LENGTH
            at = np.arange(len(given)) + np.repeat(np.cumsum(room) - room - starts, ends - starts)
            ids, wanted = np.zeros((2, room.sum() // LENGTH, LENGTH), np.intp)
            valid = np.zeros(ids.shape, np.float32)
            ids.ravel()[at], wanted.ravel()[at] = self.slots[given], self.classes[target]
            valid.ravel()[at] = 1
            for n in range(0, len(ids), batch):
                part = slice(n, n + batch)
                _, g = gradients(w, ids[part], wanted[part], valid[part], with_loss=False)
                w = steps.taken(w, g)
            count += len(given)
        moves = {name: w[name] - x for name, x in self.by_slot.items()}
        moves["vectors"] = moves.pop("embed")
        return moves, count

    @cached_property
    def by_slot(self) -> Weights:
        """The weights with one vector for each slot instead of each id."""
        first = np.unique(self.slots, return_index=True)[1]
        return {**self.weights, "embed": self.weights["embed"][first]}

    def moved(self, by: Weights) -> Model:
        by = {"embed": by["vectors"], **by}
        weights = {n: (x + by[n]).astype(np.float32) for n, x in self.by_slot.items()}
        weights["embed"] = weights["embed"][self.slots]
        return Model(weights, self.classes, self.inside, self.end, self.slots)

    @cached_property
    def brought(self) -> Weights:
        """What the ids of each slot bring to a window: their place has no part in these."""
        w, x = self.by_slot, self.by_slot["embed"]
        return {
            "q": x @ w["q"] / np.float32(np.sqrt(SIZE)),
            "k": x @ w["k"],
            # One more column: the sums of what is weighed, and 1 once tanh is taken.
            "seen": np.pad(x @ (w["v"] @ w["seen"]), ((0, 0), (0, 1)), constant_values=1),
            "own": np.pad(x @ w["own"] + w["shift"], ((0, 0), (0, 1)), constant_values=100),
            "ends": np.vstack((w["out"], w["level"])),
        }

    @cached_property
    def steady(self) -> bool:
        return is_steady(self.by_slot, self.by_slot["q"] / np.float32(np.sqrt(SIZE)))

    def class_log10(self, given: np.ndarray, wanted: np.ndarray, first: int) -> np.ndarray:
        """Log10 probability of the wanted class after each place from ``first`` on.

        ``given`` are the slots of ids.
        """
        parts, w, length = self.brought, self.by_slot, given.shape[1]
        asking = given[:, first:]
        keys = parts["k"].take(given, axis=0).transpose(0, 2, 1)
        score = np.matmul(parts["q"].take(asking, axis=0), keys)
        score += bias(w, length, np.arange(first, length))
        if not self.steady:
            score -= score.max(axis=2, keepdims=True)
        np.exp(score, out=score)
        h = np.matmul(score, parts["seen"].take(given, axis=0)).reshape(-1, SIZE + 1)
        h /= h[:, SIZE:].copy()
        h += parts["own"].take(asking.ravel(), axis=0)
        z = np.tanh(h, out=h) @ parts["ends"]
        if not self.steady:
            z -= z.max(axis=1, keepdims=True)
        chosen = z.ravel()[np.arange(len(z)) * z.shape[1] + wanted.ravel()]
        np.exp(z, out=z)
        found = chosen - np.log(z @ np.ones(z.shape[1], z.dtype))
        return (found / np.float32(np.log(10))).reshape(wanted.shape)


def laid_out(sequences: list[np.ndarray], end: int) -> tuple[np.ndarray, ...]:
    """All sequences in a row: ids given and wanted at every place, where each begins and ends."""
    lengths = np.array([len(s) + 1 for s in sequences], np.int64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    target = np.empty(ends[-1], np.int32)
    for s, a in zip(sequences, starts.tolist()):
        target[a : a + len(s)] = s
    target[ends - 1] = end
    given = np.empty_like(target)
    given[1:], given[starts] = target[:-1], end
    return given, target, starts, ends


def bias(w: Weights, length: int, asked: np.ndarray) -> np.ndarray:
    """What the distance between two places adds; later places are masked."""
    distance = asked[:, None] - np.arange(length)
    return np.where(distance >= 0, w["near"][np.maximum(distance, 0)], np.float32(-1e9))


def _attention(w: Weights, given: np.ndarray, asked: np.ndarray):
    x = w["embed"][given]
    own = x if len(asked) == given.shape[1] else x[:, asked]
    q, k, v = own @ w["q"], x @ w["k"], x @ w["v"]
    length = given.shape[1]
    distance = asked[:, None] - np.arange(length)
    score = (q @ k.transpose(0, 2, 1)) / np.float32(np.sqrt(SIZE)) + bias(w, length, asked)
    score -= score.max(axis=2, keepdims=True)
    np.exp(score, out=score)
    score /= score.sum(axis=2, keepdims=True)
    context = score @ v
    h = np.tanh(own @ w["own"] + context @ w["seen"] + w["shift"])
    return x, own, q, k, v, distance, score, context, h


def class_logs(w: Weights, given: np.ndarray, first: int = 0) -> np.ndarray:
    """Log probabilities of the class that follows each place from ``first`` on."""
    h = _attention(w, given, np.arange(first, given.shape[1]))[-1]
    z = h @ w["out"] + w["level"]
    z -= z.max(axis=2, keepdims=True)
    z -= np.log(np.exp(z).sum(axis=2, keepdims=True))
    return z


def gradients(
    w: Weights,
    given: np.ndarray,
    wanted: np.ndarray,
    valid: np.ndarray,
    asked: np.ndarray | None = None,
    vectors: bool = True,
    with_loss: bool = True,
):
    """Mean loss over the valid places and its gradient for all weights.

    ``asked`` are the places whose next class is ``wanted``, all by default; without
    ``vectors`` the ids' vectors have no gradient, without ``with_loss`` the loss is 0.
    """
    length, kind, n = given.shape[1], w["embed"].dtype.type, SIZE
    every = asked is None
    asked = np.arange(length) if every else asked
    masked, distance = bias(w, length, asked).T.copy(), asked - np.arange(length)[:, None]
    scale = kind(1 / np.sqrt(n))
    # Every array has one row for each feature and one column for each place, so that what is
    # done to a feature is done to long rows.
    # The rows of q, k, v, one of ones, which sums up what v is multiplied with, own, and
    # one that becomes 1 by tanh, for the classes' levels.
    joint = np.concatenate((w["q"] * scale, w["k"], w["v"], w["own"]), axis=1)
    none = np.zeros((1, n), kind)
    brings = np.concatenate((joint.T[: 3 * n], none, w["own"].T, none))
    seen = np.vstack((np.vstack((w["seen"], w["shift"])).T, np.zeros((1, n + 1), kind)))
    ends = np.vstack((w["out"], w["level"])).T.copy()
    steady = is_steady(w, w["q"] * scale)
    count = max(1, int(valid.sum()))

    few, per, total = min(TOGETHER, len(given)), len(asked), len(ends)
    sizes = {"parts": (4 * n + 2, length), "x": (n, length), "a": (length, per), "ds": (length, per)}
    sizes |= {"context": (n + 1, per), "dc": (n + 1, per), "h": (n + 1, per), "z": (total, per)}
    sizes |= {"slope": (n + 1, per), "moved": (4 * n, length), "pre": (n, per)}
    room = {name: np.empty(few * a * b, kind) for name, (a, b) in sizes.items()}
    many, ones = 0, np.ones(total, kind)
    sums = {"ends": 0, "seen": 0, "near": 0, "joint": 0}
    back = np.empty((n, given.size if vectors else 0), kind)
    every_place = np.arange(few * per)
    loss = 0.0
    for first in range(0, len(given), few):
        ids, classes = given[first : first + few], wanted[first : first + few].ravel()
        counts = valid[first : first + few].ravel().astype(kind, copy=False)
        if many != len(ids):
            many = len(ids)
            parts, x, a, ds, context, dc, h, z, slope, moved, pre = (
                room[m][: many * a * b].reshape(a, many * b) for m, (a, b) in sizes.items()
            )
            a, ds = a.reshape(many, length, per), ds.reshape(many, length, per)
            by, to = by_window(dc, many), by_window(moved, many)
        x[:] = np.take(w["embed"], ids.ravel(), axis=0).T
        np.matmul(brings, x, out=parts)
        parts[3 * n], parts[-1] = 1, 100
        asking = parts if every else parts.reshape(-1, many, length)[..., asked].reshape(len(parts), -1)
        q, k, v = (by_window(m, many) for m in (asking[:n], parts[n : 2 * n], parts[2 * n : 3 * n + 1]))

        np.matmul(k.transpose(0, 2, 1), q, out=a)
        a += masked
        if not steady:
            a -= a.max(axis=1, keepdims=True)
        np.exp(a, out=a)
        np.matmul(v, a, out=by_window(context, many))
        part = 1 / context[n]
        context *= part
        np.matmul(seen, context, out=h)
        h += asking[3 * n + 1 :]
        np.tanh(h, out=h)
        np.matmul(ends, h, out=z)
        if not steady:
            z -= z.max(axis=0)
        np.exp(z, out=z)
        mass = ones @ z
        at = classes * len(mass) + every_place[: len(mass)]
        if with_loss:
            loss -= float(np.log(np.maximum(z.ravel()[at] / mass, 1e-30)) @ counts) / count

        # Below, z times its place's share is the gradient of what stood in the exponentials.
        z.ravel()[at] -= mass
        share = counts / (mass * kind(count))
        np.matmul(w["out"], z, out=pre)
        np.multiply(h, h, out=slope)
        np.subtract(1, slope, out=slope)
        slope *= share
        pre *= slope[:n]
        np.matmul(w["seen"], pre, out=dc[:n])
        np.multiply(dc[:n], context[:n], out=slope[:n])
        np.negative(slope[:n].sum(axis=0), out=dc[n])
        dc *= part
        np.matmul(v.transpose(0, 2, 1), by, out=ds)
        ds *= a
        np.matmul(by[:, :n], a.transpose(0, 2, 1), out=to[:, 2 * n : 3 * n])
        np.matmul(q, ds.transpose(0, 2, 1), out=to[:, n : 2 * n])
        if every:
            np.matmul(k, ds, out=to[:, :n])
            moved[3 * n :] = pre
        else:
            to[:, :n] = to[:, 3 * n :] = 0
            to[:, :n, asked] = np.matmul(k, ds)
            to[:, 3 * n :, asked] = by_window(pre, many)
        h *= share
        sums["ends"] += z @ h.T
        sums["seen"] += context @ pre.T
        sums["near"] += ds.sum(axis=0)
        sums["joint"] += moved @ x.T
        if vectors:
            np.matmul(joint, moved, out=back[:, first * length : first * length + x.shape[1]])

    of, ends = np.split(sums["joint"].T, 4, axis=1), sums["ends"].T
    g = {"out": ends[:n], "level": ends[n], "seen": sums["seen"][:n], "shift": sums["seen"][n]}
    g |= {"q": of[0] * scale, "k": of[1], "v": of[2], "own": of[3]}
    by_place = sums["near"] * (distance >= 0)
    g["near"] = np.bincount(np.maximum(distance, 0).ravel(), by_place.ravel(), LENGTH).astype(kind)
    if vectors:
        ids = given.ravel().astype(np.intp, copy=False)
        found = [np.bincount(ids, x, len(w["embed"])) for x in back]
        g["embed"] = np.array(found, kind).T.copy()
    return loss, g


def is_steady(w: Weights, q: np.ndarray) -> bool:
    """Whether the weights bound all exponents so that no maximum has to be taken off."""
    both = np.square(np.vstack((q.T, w["k"].T)) @ w["embed"].T).reshape(2, SIZE, -1)
    reach = np.sqrt(both.sum(axis=1).max(axis=1)).prod()
    levels = np.abs(w["out"]).sum(axis=0) + np.abs(w["level"])
    return reach + np.abs(w["near"]).max() < STEADY and levels.max() < STEADY


def by_window(x: np.ndarray, many: int) -> np.ndarray:
    """The columns of each of so many windows by themselves."""
    return x.reshape(len(x), many, -1).transpose(1, 0, 2)


class Steps:
    """Steps of equal size in every direction, by running means of gradients and squares."""

    def __init__(self, w: Weights, rate: float) -> None:
        self.rate, self.number = rate, 0
        self.first = {n: np.zeros_like(x) for n, x in w.items()}
        self.second = {n: np.zeros_like(x) for n, x in w.items()}
        self.room = {n: np.empty_like(x) for n, x in w.items()}

    def taken(self, w: Weights, g: Weights, share: float = 1.0) -> Weights:
        self.number += 1
        out = dict(w)
        for name, x in g.items():
            first, second, room = self.first[name], self.second[name], self.room[name]
            first *= 0.9
            first += np.multiply(x, 0.1, out=room)
            second *= 0.98
            np.multiply(x, x, out=room)
            room *= 0.02
            second += room
            np.sqrt(np.divide(second, 1 - 0.98**self.number, out=room), out=room)
            room += 1e-8
            np.divide(first, room, out=room)
            room *= self.rate * share / (1 - 0.9**self.number)
            out[name] = w[name] - room
        return out


def frequent_ids(counts: np.ndarray) -> np.ndarray:
    """The ids that are clustered, the most frequent ones first."""
    order = np.argsort(-counts, kind="stable")[:FREQUENT]
    return order[counts[order] > 4]


def pair_table(given: np.ndarray, target: np.ndarray, frequent: np.ndarray, vocabulary: int) -> np.ndarray:
    """How often each frequent id stands after each of the ``FEATURES`` most frequent ones."""
    many, features = len(frequent), min(FEATURES, len(frequent))
    # One row and one column more take what is not counted.
    row, column = np.full(vocabulary, many * (features + 1)), np.full(vocabulary, features)
    row[frequent] = np.arange(many) * (features + 1)
    column[frequent[:features]] = np.arange(features)
    table = np.bincount(row[target] + column[given], minlength=(many + 1) * (features + 1))
    return table.reshape(many + 1, features + 1)[:many, :features]


def cluster(
    counts: np.ndarray, table: np.ndarray, seed: int = 5
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes and slots of all ids, and a starting vector for every slot, by the ids that
    stand before."""
    vocabulary = len(counts)
    random = np.random.default_rng(seed)
    frequent = frequent_ids(counts)
    rest = np.arange(vocabulary) * 2654435761 % 2**32 % 4
    classes, slots = CLASSES + rest, len(frequent) + rest
    slots[frequent] = np.arange(len(frequent))
    slots = np.unique(slots, return_inverse=True)[1]
    vectors = random.normal(0, 0.1, (slots.max() + 1, SIZE)).astype(np.float32)
    if len(frequent) > CLASSES:
        table = np.sqrt(table.astype(np.float32))
        table /= np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-6)
        size, basis = np.linalg.eigh(table.T @ table)
        low = table @ basis[:, np.argsort(-size)[:SIZE]]
        low = np.pad(low, ((0, 0), (0, SIZE - low.shape[1])))
        weight = counts[frequent].astype(np.float32)
        centers = low[random.choice(len(low), CLASSES, False, weight / weight.sum())]
        for _ in range(15):
            nearest = ((low**2).sum(1)[:, None] - 2 * low @ centers.T + (centers**2).sum(1)).argmin(1)
            mass = np.bincount(nearest, weight, CLASSES)
            sums = np.stack([np.bincount(nearest, weight * low[:, n], CLASSES) for n in range(SIZE)], 1)
            centers = np.where(mass[:, None] > 0, sums / np.maximum(mass, 1)[:, None], centers)
        classes[frequent] = nearest
        vectors[: len(frequent)] = low
    return classes.astype(np.int64), slots, vectors


def no_windows() -> tuple[np.ndarray, np.ndarray]:
    """``windows`` and ``valid`` of ``train`` for a model that rests on counts alone."""
    return np.zeros((0, LENGTH + 1), np.int64), np.zeros((0, LENGTH), np.float32)


def train(
    windows: np.ndarray,
    valid: np.ndarray,
    counts: np.ndarray,
    end: int,
    steps: int = STEPS,
    table: np.ndarray | None = None,
) -> Model:
    """A model from windows of ids (the first of each only given) and ids' counts in the corpus.

    ``valid`` marks the places of ``windows[:, 1:]`` that count; ``table`` is the corpus's
    ``pair_table``, by default that of the windows. Without windows the model is that of the
    counts alone.
    """
    vocabulary = len(counts)
    if table is None:
        table = pair_table(windows[:, :-1].ravel(), windows[:, 1:].ravel(), frequent_ids(counts), vocabulary)
    classes, slots, vectors = cluster(counts, table)
    total = CLASSES + 4
    random = np.random.default_rng(11)

    def draw(*shape):
        return (random.normal(0, 1, shape) / np.sqrt(shape[0])).astype(np.float32)

    smooth = counts + 0.1
    mass = np.bincount(classes, smooth, total)
    level = np.log(np.maximum(mass, 1e-3) / mass.sum()).astype(np.float32)
    w: Weights = {
        "embed": vectors, "q": draw(SIZE, SIZE), "k": draw(SIZE, SIZE), "v": draw(SIZE, SIZE),
        "near": (-0.3 * np.arange(LENGTH)).astype(np.float32), "own": draw(SIZE, SIZE),
        "seen": draw(SIZE, SIZE), "shift": np.zeros(SIZE, np.float32),
        "out": 0.1 * draw(SIZE, total), "level": level,
    }
    taken = Steps(w, RATE)
    for step in range(1, steps + 1 if len(windows) else 1):
        rows = random.integers(0, len(windows), BATCH)
        _, g = gradients(w, slots[windows[rows, :-1]], classes[windows[rows, 1:]], valid[rows])
        w = taken.taken(w, g, min(1.0, 1.1 - step / steps))
    w["embed"] = w["embed"][slots]
    return Model(w, classes, np.log10(smooth / mass[classes]), end, slots)
