"""Gradient-boosted regression trees for a binary label, small and dependent on NumPy alone."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Logistic loss, complete trees of a fixed depth, splits on quantile bins."""

    def __init__(self, rounds: int = 60, depth: int = 4, rate: float = 0.25, bins: int = 24, shrink: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.shrink = rounds, depth, rate, bins, shrink

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], "left") for k, e in enumerate(self.edges)], 1)

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> BoostedTrees:
        self.edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, self.bins)))[:-1] for k in range(x.shape[1])]
        b = self._binned(x)
        width = self.bins + 1
        self.start = float(np.log((weight @ y) / (weight @ (1 - y))))
        score = np.full(len(y), self.start)
        self.trees: list[tuple[list[np.ndarray], np.ndarray]] = []
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            g, h = weight * (y - p), weight * p * (1 - p) + 1e-12
            node, levels = np.zeros(len(y), "i8"), []
            for level in range(self.depth):
                n = 1 << level
                best, split = np.full(n, 1e-9), np.zeros((n, 2), "i8")
                split[:, 1] = width  # everything goes left
                for k in range(b.shape[1]):
                    at = node * width + b[:, k]
                    gs = np.bincount(at, g, n * width).reshape(n, width)
                    hs = np.bincount(at, h, n * width).reshape(n, width)
                    gl, hl = gs.cumsum(1), hs.cumsum(1)
                    gr, hr = gl[:, -1:] - gl, hl[:, -1:] - hl
                    gain = gl**2 / (hl + self.shrink) + gr**2 / (hr + self.shrink) - gl[:, -1:] ** 2 / (hl[:, -1:] + self.shrink)
                    top = gain.argmax(1)
                    better = gain[np.arange(n), top] > best
                    best[better] = gain[np.arange(n), top][better]
                    split[better] = np.column_stack([np.full(n, k), top])[better]
                levels.append(split)
                node = node * 2 + (b[np.arange(len(y)), split[node, 0]] > split[node, 1])
            leaf = np.bincount(node, g, 1 << self.depth) / (np.bincount(node, h, 1 << self.depth) + self.shrink) * self.rate
            score += leaf[node]
            self.trees.append((levels, leaf))
        return self

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        b = self._binned(x)
        out, every = np.full(len(x), self.start), np.arange(len(x))
        for levels, leaf in self.trees:
            node = np.zeros(len(x), "i8")
            for split in levels:
                node = node * 2 + (b[every, split[node, 0]] > split[node, 1])
            out += leaf[node]
        return out
