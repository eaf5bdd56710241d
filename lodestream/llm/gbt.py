"""Gradient-boosted trees for a yes-or-no label, on binned features, with numpy."""

from __future__ import annotations

import numpy as np

BINS = 32


class Boosted:
    """Trees of fixed depth, fitted to the gradient of the logistic loss."""

    def __init__(self, rounds: int = 40, depth: int = 3, rate: float = 0.3, weight: float = 1.0):
        self.rounds, self.depth, self.rate, self.weight = rounds, depth, rate, weight
        self.edges: list[np.ndarray] = []
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.start = 0.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], "right") for k, e in enumerate(self.edges)], 1).astype(np.int64)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS)[1:-1])) for c in x.T]
        b = self._binned(x)
        n, width = b.shape
        mean = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
        self.start = float(np.log(mean / (1 - mean)))
        score = np.full(n, self.start)
        flat = b + np.arange(width) * BINS
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, np.maximum(p * (1 - p), 1e-6)
            node = np.zeros(n, np.int64)
            feature, cut = np.zeros(2**self.depth - 1, np.int64), np.full(2**self.depth - 1, BINS, np.int64)
            for level in range(self.depth):
                nodes = 1 << level
                at = (node[:, None] * (width * BINS) + flat).ravel()
                shape = (nodes, width, BINS)
                gs = np.bincount(at, np.repeat(g, width), nodes * width * BINS).reshape(shape).cumsum(2)
                hs = np.bincount(at, np.repeat(h, width), nodes * width * BINS).reshape(shape).cumsum(2)
                gt, ht = gs[:, :, -1:], hs[:, :, -1:]
                gain = gs**2 / (hs + self.weight) + (gt - gs) ** 2 / (ht - hs + self.weight) - gt**2 / (ht + self.weight)
                best = gain.reshape(nodes, -1).argmax(1)
                first = nodes - 1
                feature[first : first + nodes], cut[first : first + nodes] = best // BINS, best % BINS
                node = node * 2 + (b[np.arange(n), feature[first + node]] > cut[first + node])
            leaves = 1 << self.depth
            value = self.rate * np.bincount(node, g, leaves) / (np.bincount(node, h, leaves) + self.weight)
            self.trees.append((feature, cut, value))
            score += value[node]
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        """The probability of yes."""
        b = self._binned(x)
        score = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                first = (1 << level) - 1
                node = node * 2 + (b[rows, feature[first + node]] > cut[first + node])
            score += value[node]
        return 1 / (1 + np.exp(-score))
