"""Small gradient-boosted trees for bounded training samples, and their calibration."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Tree:
    """Splits and leaves in heap order: node i has the children 2 i + 1 and 2 i + 2."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def apply(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), dtype=np.int64)
        for _ in range(int(np.log2(len(self.feature) + 1))):
            node = 2 * node + 1 + (x[np.arange(len(x)), self.feature[node]] > self.cut[node])
        return self.value[node - len(self.feature)]


@dataclass
class BoostedTrees:
    """Logistic boosting of trees of a fixed depth, split at values of the rows."""

    rounds: int = 25
    depth: int = 3
    rate: float = 0.3
    ridge: float = 1.0
    base: float = 0.0
    trees: list[Tree] = field(default_factory=list)
    slope: float = 1.0
    shift: float = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        p = np.clip(y.mean() if len(y) else 0.0, 1e-3, 1 - 1e-3)
        self.base, self.trees = float(np.log(p / (1 - p))), []
        # values at even steps of the rows and of the distinct values, so that rare ones are told apart as well
        part = np.linspace(0, 1, 17)[1:-1]
        cuts = [np.unique([np.quantile(v, part, method="lower") for v in (x[:, j], np.unique(x[:, j]))]) if len(x) else np.zeros(1) for j in range(x.shape[1])]
        # the cell of a value is the number of cuts below it
        cells = [np.searchsorted(c, x[:, j]) for j, c in enumerate(cuts)]
        score = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = sigmoid(score)
            tree = self._grow(cells, y - p, np.maximum(p * (1 - p), 1e-6), cuts)
            score = score + self.rate * tree.apply(x)
            self.trees.append(tree)
        return self

    def _grow(self, cells: list[np.ndarray], gradient: np.ndarray, weight: np.ndarray, cuts: list[np.ndarray]) -> Tree:
        n = 2**self.depth - 1
        feature, cut = np.zeros(n, dtype=np.int64), np.full(n, np.inf)
        node = np.zeros(len(gradient), dtype=np.int64)
        for level in range(self.depth):
            first, nodes = 2**level - 1, 2**level
            best = np.full(nodes, 1e-9)
            for j, values in enumerate(cuts):
                shape = (nodes, len(values) + 1)
                place = (node - first) * shape[1] + cells[j]
                g, h = (np.bincount(place, w, minlength=nodes * shape[1]).reshape(shape) for w in (gradient, weight))
                g_all, h_all = g.sum(axis=1), h.sum(axis=1)
                g_left, h_left = g.cumsum(axis=1)[:, :-1], h.cumsum(axis=1)[:, :-1]
                g_right, h_right = g_all[:, None] - g_left, h_all[:, None] - h_left
                whole = g_all**2 / (h_all + self.ridge)
                gain = g_left**2 / (h_left + self.ridge) + g_right**2 / (h_right + self.ridge) - whole[:, None]
                i = gain.argmax(axis=1)
                top = gain[np.arange(nodes), i]
                for k in np.flatnonzero(top > best + 1e-9):
                    best[k] = top[k]
                    feature[first + k], cut[first + k] = j, values[i[k]]
            split = feature[node]
            right = np.zeros(len(node), dtype=np.int64)
            for j in np.unique(split):
                rows = np.flatnonzero(split == j)
                limit = np.searchsorted(cuts[j], cut[node[rows]]) if len(cuts[j]) else 0
                right[rows] = cells[j][rows] > limit
            node = 2 * node + 1 + right
        leaf = node - n
        sums = np.bincount(leaf, gradient, minlength=n + 1) / (np.bincount(leaf, weight, minlength=n + 1) + self.ridge)
        return Tree(feature, cut, sums)

    def raw(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.base)
        for tree in self.trees:
            score += self.rate * tree.apply(x)
        return score

    def calibrate(self, s: np.ndarray, y: np.ndarray, n: np.ndarray, steps: int = 50) -> BoostedTrees:
        """Platt scaling on raw scores that stand for ``n`` rows each, with smoothed targets."""
        right, wrong = float((n * y).sum()), float((n * (1 - y)).sum())
        if right and wrong:
            target = np.where(y > 0, (right + 1) / (right + 2), 1 / (wrong + 2))
            design = np.stack([s, np.ones_like(s)], axis=1)
            self.slope, self.shift = logistic(design, target, 1e-3, steps, n)
        return self

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * raw + self.shift)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float, steps: int = 50, n: np.ndarray | None = None) -> np.ndarray:
    """Weights of a logistic regression by Newton's method; row i stands for ``n[i]`` rows."""
    w = np.zeros(x.shape[1])
    n = np.ones(len(y)) if n is None else n
    for _ in range(steps):
        p = sigmoid(x @ w)
        h = (x * (n * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (n * (y - p)) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w
