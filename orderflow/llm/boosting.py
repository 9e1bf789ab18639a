"""Gradient-boosted trees for a 0/1 label, trained in numpy on a bounded sample.

Features are cut into bins at sample quantiles; each level of a tree takes the best split
of every node by histograms of gradients. A feature may be held monotonic: then no split
on it may order its children the other way, and both keep to the middle between them.
The trees end up in flat node arrays.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """Nodes of all trees; a leaf's children are itself. ``roots`` holds each tree's first."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Log odds of the rows of ``x``; all trees go down one level at a time."""
        node = np.tile(self.roots, (len(x), 1))
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            goes_left = x[row, self.feature[node]] <= self.threshold[node]
            node = np.where(goes_left, self.left[node], self.right[node])
        return self.base + self.value[node].sum(axis=1)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margins(x)))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    monotonic: dict[int, int] | None = None,
    rounds: int = 40,
    depth: int = 3,
    rate: float = 0.3,
    bins: int = 64,
    least: float = 1.0,
    shrink: float = 1.0,
) -> Trees:
    """Trees for labels ``y`` in 0..1. ``monotonic`` maps a feature to +1 or -1.

    Without rows, or with one label only, the trees are empty and the answer constant.
    """
    mean = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(mean / (1 - mean)))
    nodes: list[list[float]] = []
    roots: list[int] = []
    if len(y) and 0 < y.mean() < 1:
        cuts = [_cuts(x[:, f], bins) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], 1)
        margin = np.full(len(y), base)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-margin))
            roots.append(len(nodes))
            step = _grow(
                nodes, binned, cuts, p - y, p * (1 - p), monotonic or {}, depth, least, shrink, rate
            )
            margin += step
    columns = np.array(nodes, float).reshape(-1, 5).T
    return Trees(
        columns[0].astype(np.int64),
        columns[1],
        columns[2].astype(np.int64),
        columns[3].astype(np.int64),
        columns[4],
        np.array(roots, np.int64),
        depth,
        base,
    )


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    """Thresholds between different sample values."""
    found = np.unique(values)
    if len(found) > bins:
        found = np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)))
    return (found[:-1] + found[1:]) / 2


def _grow(nodes, binned, cuts, gradient, hessian, monotonic, depth, least, shrink, rate):
    """Adds one tree's nodes and returns what it adds to each row."""

    def leaf(low, high, g, h):
        nodes.append([0, 0.0, len(nodes), len(nodes), rate * np.clip(-g / (h + shrink), low, high)])
        return len(nodes) - 1

    step = np.zeros(len(binned))
    open_nodes = [(leaf(-np.inf, np.inf, gradient.sum(), hessian.sum()), np.arange(len(binned)), -np.inf, np.inf)]
    for _ in range(depth):
        following = []
        for node, rows, low, high in open_nodes:
            split = _best(binned[rows], cuts, gradient[rows], hessian[rows], monotonic, low, high, least, shrink)
            if split is None:
                continue
            f, b, sums = split
            goes_left = binned[rows, f] <= b
            bounds = [low, high], [low, high]
            if sign := monotonic.get(f, 0):
                middle = float(np.mean([np.clip(-g / (h + shrink), low, high) for g, h in sums]))
                bounds = ([low, middle], [middle, high]) if sign > 0 else ([middle, high], [low, middle])
            children = [leaf(*w, *s) for w, s in zip(bounds, sums)]
            nodes[node][:4] = [f, cuts[f][b], *children]
            following += [
                (child, rows[side], *w)
                for child, side, w in zip(children, (goes_left, ~goes_left), bounds)
            ]
            for child, side in zip(children, (goes_left, ~goes_left)):
                step[rows[side]] = nodes[child][4]
        open_nodes = following
    return step


def _best(binned, cuts, gradient, hessian, monotonic, low, high, least, shrink):
    """The split with the largest gain: feature, last bin on the left, sums of both sides."""
    total_g, total_h = gradient.sum(), hessian.sum()

    def gain(g, h):
        value = np.clip(-g / (h + shrink), low, high)
        return -(g * value + 0.5 * (h + shrink) * value**2), value

    best, found = gain(total_g, total_h)[0] + 1e-6, None
    for f, edges in enumerate(cuts):
        if not len(edges):
            continue
        g = np.cumsum(np.bincount(binned[:, f], gradient, len(edges) + 1))[:-1]
        h = np.cumsum(np.bincount(binned[:, f], hessian, len(edges) + 1))[:-1]
        left, left_value = gain(g, h)
        right, right_value = gain(total_g - g, total_h - h)
        allowed = (h >= least) & (total_h - h >= least)
        if sign := monotonic.get(f, 0):
            allowed &= sign * (right_value - left_value) >= 0
        both = np.where(allowed, left + right, -np.inf)
        b = int(np.argmax(both))
        if both[b] > best:
            best, found = both[b], (f, b, ((g[b], h[b]), (total_g - g[b], total_h - h[b])))
    return found
