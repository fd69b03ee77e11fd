"""Gradient-boosted trees for log-loss over binned features, in numpy."""

from __future__ import annotations

import numpy as np

BINS = 32


class BoostedTrees:
    """Level-wise trees of fixed depth; a tree is its split features, cut bins and leaf values."""

    def __init__(self, rounds: int = 60, depth: int = 4, rate: float = 0.2, smooth: float = 1.0):
        self.rounds, self.depth, self.rate, self.smooth = rounds, depth, rate, smooth

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(self.edges)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS)))[:-1] for c in x.T]
        b, n = self._binned(x), len(y)
        self.base = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
        score, self.trees = np.full(n, self.base), []
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            grad, curve = y - p, p * (1 - p)
            node, tree = np.zeros(n, np.int64), []
            for level in range(self.depth):
                width = 1 << level
                best = np.full(width, -1.0)
                split = np.zeros((width, 2), np.int64)
                for k in range(x.shape[1]):
                    cell = node * BINS + b[:, k]
                    g = np.bincount(cell, grad, width * BINS).reshape(width, BINS).cumsum(axis=1)
                    h = np.bincount(cell, curve, width * BINS).reshape(width, BINS).cumsum(axis=1)
                    gl, hl, gr, hr = g, h, g[:, -1:] - g, h[:, -1:] - h
                    gain = gl**2 / (hl + self.smooth) + gr**2 / (hr + self.smooth) - g[:, -1:] ** 2 / (h[:, -1:] + self.smooth)
                    at = gain.argmax(axis=1)
                    top = gain[np.arange(width), at]
                    better = top > best + 1e-9
                    best[better] = top[better]
                    split[better] = np.stack([np.full(width, k), at], axis=1)[better]
                tree.append(split)
                node = node * 2 + (b[np.arange(n), split[node, 0]] > split[node, 1])
            width = 1 << self.depth
            leaf = self.rate * np.bincount(node, grad, width) / (np.bincount(node, curve, width) + self.smooth)
            self.trees.append((tree, leaf))
            score += leaf[node]
        return self

    def decision(self, x: np.ndarray) -> np.ndarray:
        b, rows = self._binned(x), np.arange(len(x))
        score = np.full(len(x), self.base)
        for tree, leaf in self.trees:
            node = np.zeros(len(x), np.int64)
            for split in tree:
                node = node * 2 + (b[rows, split[node, 0]] > split[node, 1])
            score += leaf[node]
        return score
