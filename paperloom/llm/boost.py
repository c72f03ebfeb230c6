"""Gradient-boosted regression trees for a yes-or-no target, small enough to train in the driver and to broadcast."""

from __future__ import annotations

import numpy as np


class Boosted:
    """Logistic boosting of shallow trees over binned features."""

    def __init__(self, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 24, least: int = 5, ridge: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.least, self.ridge = rounds, depth, rate, bins, least, ridge
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.base = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        x, y = np.asarray(x, np.float64), np.asarray(y, np.float64)
        if not len(y) or y.min() == y.max():
            self.base = -10.0 if not len(y) or y.max() == 0 else 10.0
            return self
        self.base = float(np.log(y.mean() / (1 - y.mean())))
        edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, self.bins + 1)[1:-1])) for k in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(edges)], axis=1)
        f = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-f))
            g, h = y - p, p * (1 - p)
            feature = np.full(2**self.depth - 1, -1)
            cut = np.zeros(2**self.depth - 1)
            node = np.zeros(len(y), np.int64)
            for level in range(self.depth):
                first = 2**level - 1
                for n in range(first, 2 * first + 1):
                    mine = np.flatnonzero(node == n)
                    best, where = 1e-6, None
                    if len(mine) >= 2 * self.least:
                        total_g, total_h = g[mine].sum(), h[mine].sum()
                        for k, e in enumerate(edges):
                            if not len(e):
                                continue
                            b = binned[mine, k]
                            sums = [np.cumsum(np.bincount(b, weights=w, minlength=len(e) + 1))[:-1] for w in (g[mine], h[mine])]
                            count = np.cumsum(np.bincount(b, minlength=len(e) + 1))[:-1]
                            gain = sums[0] ** 2 / (sums[1] + self.ridge) + (total_g - sums[0]) ** 2 / (total_h - sums[1] + self.ridge) - total_g**2 / (total_h + self.ridge)
                            gain[(count < self.least) | (len(mine) - count < self.least)] = 0
                            if gain.max() > best:
                                best, where = gain.max(), (k, int(gain.argmax()))
                    if where is not None:
                        feature[n], cut[n] = where[0], edges[where[0]][where[1]]
                        node[mine] = 2 * n + 1 + (binned[mine, where[0]] > where[1])
                    else:
                        node[mine] = 2 * n + 1
            leaf = node - (2**self.depth - 1)
            value = np.bincount(leaf, weights=g, minlength=2**self.depth) / (np.bincount(leaf, weights=h, minlength=2**self.depth) + self.ridge)
            value *= self.rate
            f += value[leaf]
            self.trees.append((feature, cut, value))
        return self

    def probability(self, x: np.ndarray) -> np.ndarray:
        """All trees are walked at once: a table of trees and rows goes down level by level."""
        x = np.asarray(x, np.float64)
        n, count = len(x), len(self.trees)
        f = np.full(n, self.base)
        if not count or not n:
            return 1 / (1 + np.exp(-f))
        feature, cut, value = (np.concatenate([t[k] for t in self.trees]) for k in range(3))
        # A node that was not divided sends all to the left.
        cut = np.where(feature < 0, np.inf, cut)
        feature = np.maximum(feature, 0)
        inner = 2**self.depth - 1
        for begin in range(0, n, 4096):
            flat = x[begin : begin + 4096].ravel()
            at = np.arange(len(flat) // x.shape[1]) * x.shape[1]
            first = (np.arange(count) * inner)[:, None]
            node = np.zeros((count, len(at)), np.int64)
            for _ in range(self.depth):
                here = node + first
                node = 2 * node + 1 + (flat[at + feature[here]] > cut[here])
            leaf = node - inner + (np.arange(count) * (inner + 1))[:, None]
            f[begin : begin + 4096] += value[leaf].sum(axis=0)
        return 1 / (1 + np.exp(-f))
