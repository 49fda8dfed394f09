"""Gradient-boosted regression trees for logistic loss, in numpy, with isotonic calibration."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Depth-limited trees on binned features; small enough to be sent with a task."""

    def __init__(self, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 24, least: int = 10, ridge: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.least, self.ridge = rounds, depth, rate, bins, least, ridge

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        p = min(max(float(y.mean()) if len(y) else 0.5, 1e-3), 1 - 1e-3)
        self.start, self.trees = float(np.log(p / (1 - p))), []
        edges = [np.unique(np.quantile(column, np.linspace(0, 1, self.bins + 1)[1:-1])) for column in x.T] if len(x) else [np.zeros(0)] * x.shape[1]
        score = np.full(len(y), self.start)
        for _ in range(self.rounds if len(y) else 0):
            q = 1 / (1 + np.exp(-score))
            tree = self._grow(x, y - q, q * (1 - q), edges, np.arange(len(y)), self.depth)
            self.trees.append(tree)
            score += self._apply(tree, x)
        return self

    def _grow(self, x, gradient, hessian, edges, rows, depth):
        g, h = gradient[rows].sum(), hessian[rows].sum()
        best = (1e-6, None, None)
        if depth and len(rows) >= 2 * self.least:
            for f, cuts in enumerate(edges):
                if not len(cuts):
                    continue
                bin_ = np.searchsorted(cuts, x[rows, f], "left")
                sums = [np.cumsum(np.bincount(bin_, weights=w, minlength=len(cuts) + 1))[:-1] for w in (gradient[rows], hessian[rows], np.ones(len(rows)))]
                gain = sums[0] ** 2 / (sums[1] + self.ridge) + (g - sums[0]) ** 2 / (h - sums[1] + self.ridge) - g**2 / (h + self.ridge)
                gain[(sums[2] < self.least) | (len(rows) - sums[2] < self.least)] = 0
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], f, float(cuts[k]))
        if best[1] is None:
            return float(self.rate * g / (h + self.ridge))
        low = x[rows, best[1]] <= best[2]
        return (best[1], best[2], self._grow(x, gradient, hessian, edges, rows[low], depth - 1), self._grow(x, gradient, hessian, edges, rows[~low], depth - 1))

    def _apply(self, tree, x: np.ndarray) -> np.ndarray:
        if isinstance(tree, float):
            return np.full(len(x), tree)
        f, cut, low, high = tree
        return np.where(x[:, f] <= cut, self._apply(low, x), self._apply(high, x))

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.start + sum((self._apply(t, x) for t in self.trees), np.zeros(len(x)))


class Isotonic:
    """Pool-adjacent-violators calibration of a raw score to a probability."""

    def fit(self, score: np.ndarray, y: np.ndarray) -> Isotonic:
        order = np.argsort(score, kind="stable")
        blocks: list[list[float]] = []
        for s, v in zip(score[order].tolist(), y[order].tolist()):
            blocks.append([v, 1.0, s])
            while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
                v2, n2, _ = blocks.pop()
                blocks[-1][0] += v2
                blocks[-1][1] += n2
        self.at = np.array([b[2] for b in blocks])
        self.value = np.array([(b[0] + 0.5) / (b[1] + 1.0) for b in blocks])
        self.value = np.maximum.accumulate(self.value) if len(blocks) else self.value
        return self

    def __call__(self, score: np.ndarray) -> np.ndarray:
        if not len(self.at):
            return np.full(len(score), 0.5)
        return self.value[np.clip(np.searchsorted(self.at, score, "right") - 1, 0, len(self.at) - 1)]


def threshold_for(precision: float, probability: np.ndarray, y: np.ndarray) -> float:
    """The least threshold at which the selected rows reach the precision; above 1 if none does."""
    order = np.argsort(-probability, kind="stable")
    p, hit = probability[order], np.cumsum(y[order])
    last = np.append(p[1:] != p[:-1], True) if len(p) else np.zeros(0, bool)
    good = last & (hit / np.arange(1, len(p) + 1) >= precision)
    return float(p[np.flatnonzero(good)[-1]]) if good.any() else 2.0
