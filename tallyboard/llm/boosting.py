"""Gradient-boosted trees for two classes, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Settings:
    trees: int = 50
    depth: int = 4
    rate: float = 0.2
    bins: int = 32
    ridge: float = 1.0
    least: float = 5.0


class Trees:
    """Trees of equal depth: a split on one feature at each node, a value at each leaf."""

    def __init__(self, edges: list[np.ndarray], depth: int):
        self.edges, self.depth = edges, depth
        self.features: list[np.ndarray] = []
        self.cuts: list[np.ndarray] = []
        self.values: list[np.ndarray] = []

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, i], "left") for i, e in enumerate(self.edges)], axis=1).astype(np.uint8)

    def _raw(self, bins: np.ndarray) -> np.ndarray:
        out, rows = np.zeros(len(bins)), np.arange(len(bins))
        for feature, cut, value in zip(self.features, self.cuts, self.values):
            node = np.zeros(len(bins), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (bins[rows, feature[node]] > cut[node])
            out += value[node - (2**self.depth - 1)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self._raw(self.binned(x)))) if len(x) else np.empty(0)


def fit(x: np.ndarray, y: np.ndarray, settings: Settings = Settings()) -> Trees:
    """Trees on the rows of ``x`` with classes ``y`` (0 or 1): each fits the gradient of the logistic loss."""
    n, d = x.shape
    q = np.linspace(0, 1, settings.bins)[1:-1]
    model = Trees([np.unique(np.quantile(x[:, i], q)) for i in range(d)], settings.depth)
    bins = model.binned(x)
    width = settings.bins
    cell = bins.astype(np.int64) + np.arange(d) * width
    raw = np.zeros(n)
    inner = 2**settings.depth - 1
    for _ in range(settings.trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        feature, cut, node = np.zeros(inner, np.int64), np.full(inner, width, np.int64), np.zeros(n, np.int64)
        for level in range(settings.depth):
            first, count = 2**level - 1, 2**level
            at = ((node - first)[:, None] * (d * width) + cell).ravel()
            sums = [np.bincount(at, np.repeat(v, d), count * d * width).reshape(count, d, width).cumsum(axis=2) for v in (g, h)]
            total = [s[:, :, -1:] for s in sums]
            gain = sum((a * a) / (b + settings.ridge) for a, b in ((sums[0], sums[1]), (total[0] - sums[0], total[1] - sums[1])))
            gain = gain - total[0] ** 2 / (total[1] + settings.ridge)
            gain[(sums[1] < settings.least) | (total[1] - sums[1] < settings.least)] = 0
            best = gain.reshape(count, -1).argmax(axis=1)
            some = gain.reshape(count, -1).max(axis=1) > 1e-9
            feature[first:first + count] = best // width
            cut[first:first + count] = np.where(some, best % width, width)
            node = 2 * node + 1 + (bins[np.arange(n), feature[node]] > cut[node])
        leaf = node - inner
        value = settings.rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + settings.ridge)
        raw += value[leaf]
        model.features.append(feature)
        model.cuts.append(cut)
        model.values.append(value)
    return model
