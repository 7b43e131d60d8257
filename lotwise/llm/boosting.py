"""Gradient-boosted trees in numpy: fitted on a bounded sample, applied to node arrays inside tasks."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    """All trees in flat arrays. A row goes left where its feature is at most the threshold; leaves point to themselves."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Log-odds for the rows of ``x``."""
        total, rows = np.full(len(x), self.start), np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            total += self.value[node]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.raw(x))

    def paths(self) -> list[tuple[tuple[int, bool, float], ...]]:
        """The way to each node but the roots, as conditions (feature, goes left, threshold)."""
        found, open_ = [], [(int(r), ()) for r in self.roots]
        while open_:
            node, way = open_.pop()
            if way:
                found.append(way)
            if self.left[node] != node:
                split = int(self.feature[node]), float(self.threshold[node])
                open_.append((int(self.left[node]), (*way, (split[0], True, split[1]))))
                open_.append((int(self.right[node]), (*way, (split[0], False, split[1]))))
        return found


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def constant(start: float) -> Forest:
    none = np.zeros(1, np.int64)
    return Forest(none, np.zeros(1), none, none, np.zeros(1), none[:0], 0, start)


def fit(
    x: np.ndarray,
    y: np.ndarray,
    monotone: dict[int, int] | None = None,
    trees: int = 60,
    depth: int = 3,
    rate: float = 0.2,
    bins: int = 64,
    l2: float = 1.0,
    least: float = 2.0,
) -> Forest:
    """Boosted trees for log-loss. ``monotone`` maps a feature to 1 (score never falls as it grows) or -1.

    A split on such a feature must order its two values, and all values below it are held to their side of the middle
    between the two. Without both classes, or without rows, the score is the same everywhere.
    """
    n, positive = len(y), float(np.sum(y))
    start = float(np.log((positive + 0.5) / (n - positive + 0.5)))
    if not 0 < positive < n:
        return constant(start)
    cuts = [np.unique(np.quantile(c, np.arange(1, bins) / bins)) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T, strict=True)], 1)
    sign = np.array([(monotone or {}).get(f, 0) for f in range(x.shape[1])])
    nodes: list[list] = []  # feature, threshold, left, right, value
    roots, raw = [], np.full(n, start)
    for _ in range(trees):
        p = sigmoid(raw)
        grown = _grow(binned, cuts, p - y, p * (1 - p), sign, depth, rate, l2, least, nodes)
        roots.append(grown[0])
        raw = raw + grown[1]
    f, t, lo, hi, v = (np.array(c) for c in zip(*nodes, strict=True))
    return Forest(f, t.astype(float), lo, hi, v.astype(float), np.array(roots), depth, start)


def _grow(binned, cuts, gradient, hessian, sign, depth, rate, l2, least, nodes) -> tuple[int, np.ndarray]:
    """One tree. Appends its nodes and gives its root and what it adds to each row."""
    many = max(len(c) for c in cuts) + 1
    at = np.arange(binned.shape[1]) * many

    def node(rows: np.ndarray, level: int, low: float, high: float) -> int:
        g, h = gradient[rows].sum(), hessian[rows].sum()
        value = float(np.clip(-g / (h + l2), low, high))
        me = len(nodes)
        nodes.append([0, 0.0, me, me, rate * value])
        if level < depth and (best := split(rows, g, h, low, high)):
            f, k, a, b = best
            goes = binned[rows, f] <= k
            middle = (a + b) / 2
            bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}
            (l0, l1), (r0, r1) = bounds[int(sign[f])]
            nodes[me][:2] = [f, cuts[f][k]]
            nodes[me][2] = node(rows[goes], level + 1, l0, l1)
            nodes[me][3] = node(rows[~goes], level + 1, r0, r1)
        else:
            added[rows] = rate * value
        return me

    def split(rows, g, h, low, high):
        flat = (binned[rows] + at).ravel()
        shape = (binned.shape[1], many)
        sums = lambda w: np.cumsum(np.bincount(flat, np.repeat(w, shape[0]), shape[0] * many).reshape(shape), 1)
        gl, hl = sums(gradient[rows]), sums(hessian[rows])
        gr, hr = g - gl, h - hl
        a, b = np.clip(-gl / (hl + l2), low, high), np.clip(-gr / (hr + l2), low, high)
        gain = lambda v, g, h: -(2 * g * v + (h + l2) * v * v)
        won = gain(a, gl, hl) + gain(b, gr, hr) - gain(np.clip(-g / (h + l2), low, high), g, h)
        ordered = (sign[:, None] == 0) | (sign[:, None] * (b - a) >= 0)
        there = np.arange(many)[None, :] < np.array([len(c) for c in cuts])[:, None]
        won = np.where(ordered & there & (hl >= least) & (hr >= least), won, -np.inf)
        f, k = np.unravel_index(int(np.argmax(won)), shape)
        return (int(f), int(k), float(a[f, k]), float(b[f, k])) if won[f, k] > 1e-6 else None

    added = np.zeros(len(gradient))
    return node(np.arange(len(gradient)), 0, -np.inf, np.inf), added


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pooled adjacent violators: points (score, share of positives), both rising, for np.interp."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []  # sum of labels, rows, sum of scores
    for s, label in zip(score[order], y[order], strict=True):
        blocks.append([float(label), 1.0, float(s)])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    if not blocks:
        return np.zeros(1), np.full(1, 0.5)
    return np.array([b[2] / b[1] for b in blocks]), np.array([b[0] / b[1] for b in blocks])
