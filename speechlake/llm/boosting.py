"""Gradient-boosted trees for yes-or-no labels, on binned features, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass
class Trees:
    """Full trees of one depth: features, thresholds and leaf values, each one row for a tree."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    start: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Log odds of each row."""
        total = np.full(len(x), self.start)
        rows, depth = np.arange(len(x)), self.leaf.shape[1].bit_length() - 1
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            total += leaf[node - (len(leaf) - 1)]
        return total


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2,
        ridge: float = 1.0) -> Trees:
    """Newton steps on the logistic loss; each level splits where the gain over histograms is largest."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1)
    mean = np.average(y, weights=weight)
    start = float(np.log(mean / (1 - mean)))
    score = np.full(len(y), start)
    inner, n_leaves = (1 << depth) - 1, 1 << depth
    feature, threshold = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, n_leaves))
    for k in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = weight * (y - p), weight * p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            best, where = np.full(width, 1e-6), [(0, None)] * width
            for j, c in enumerate(cuts):
                if not len(c):
                    continue
                cell = (node - first) * BINS + binned[:, j]
                sg = np.bincount(cell, g, width * BINS).reshape(width, BINS).cumsum(1)
                sh = np.bincount(cell, h, width * BINS).reshape(width, BINS).cumsum(1)
                tg, th = sg[:, -1:], sh[:, -1:]
                gain = sg**2 / (sh + ridge) + (tg - sg) ** 2 / (th - sh + ridge) - tg**2 / (th + ridge)
                gain = gain[:, :len(c)]
                at = gain.argmax(1)
                for i in np.flatnonzero(gain[np.arange(width), at] > best):
                    best[i], where[i] = gain[i, at[i]], (j, at[i])
            right = np.zeros(len(y), bool)
            for i, (j, b) in enumerate(where):
                if b is None:
                    continue
                feature[k, first + i], threshold[k, first + i] = j, cuts[j][b]
                mine = node == first + i
                right[mine] = binned[mine, j] > b
            node = 2 * node + 1 + right
        at = node - inner
        leaf[k] = rate * np.bincount(at, g, n_leaves) / (np.bincount(at, h, n_leaves) + ridge)
        score += leaf[k][at]
    return Trees(feature, threshold, leaf, start)
